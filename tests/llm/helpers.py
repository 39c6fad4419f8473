"""Small tables with everything awkward in them."""

import random
import zlib

WORDS = "the of and a to in is was for on that by this with it as be at from or".split()


def text(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "er", "ing", "x%d" % rng.randint(0, 99)]) for _ in range(n))


def documents(spark, n: int = 60, seed: int = 1, clashing: bool = True):
    """Nulls in every column, empty and very long texts, repeated rows, and columns named like the operators'."""
    rng = random.Random(seed)
    rows = [(i, text(rng, rng.randint(1, 120)), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None])) for i in range(n)]
    rows += [(1000, None, None, None), (1001, "", "en", "s1"), (1002, " \t\n ", "en", "s1"), (1003, text(rng, 60_000), "en", "s1"), (1004, "one", "de", "s2")]
    rows += [(None, text(rng, 20), "en", "s1"), (None, None, None, None)]
    rows += [rows[3], rows[3]] + [(2000 + i, rows[5][1], "en", "s1") for i in range(5)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], kind)
    if clashing:
        for name in ("size", "target", "copies", "score", "piece", "length", "row", "doc", "kept", "m", "fp", "label", "v", "w", "rank", "n_words", "own_id", "bucket"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def none_of(df):
    return df.filter("1 = 0")


def crc(value) -> int:
    return zlib.crc32(str(value).encode())
