import difflib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.functions import text as tx
from tessella.operators import consensus as cs
from tessella.plans import analytics


@pytest.mark.parametrize(
    "number, word",
    [(0, "nulla"), (2, "kettő"), (10, "tíz"), (14, "tizennégy"), (22, "huszonkettő"), (100, "száz"), (200, "kétszáz"), (1000, "ezer"), (1999, "ezerkilencszázkilencvenkilenc"), (2000, "kétezer"),
     (2010, "kétezer-tíz"), (2024, "kétezer-huszonnégy"), (12_000, "tizenkétezer"), (1_000_000, "egymillió")],
)
def test_cardinals(number, word):
    assert tx.cardinal(number) == word


@pytest.mark.parametrize(
    "text, expected",
    [("Az 50%-ról — \"jó\"!", "az ötven százalékról jó"), ("kétezer-tíz €-ért", "kétezer tíz euróért"), (None, None), ("", ""), ("10-es", "tízes"), ("2024-es", "kétezerhuszonnégyes"), ("5,5", "öt egész öt tized"),
     ("3,14", "három egész tizennégy század"), ("2010", "kétezer tíz"), ("árvíz  tűrő\t_x", "árvíz tűrő _x"), ("A\u0301", "á")],
)
def test_normalize(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(tx.normalize(F.col("t")).alias("n")).first()["n"] == expected


PAIRS = [("a kis kutya", "a nagy kutya ugat", 2 / 3), ("", "", 0.0), ("", "x", 1.0), ("x", "", 1.0), ("x", "a b c", 3.0), ("a b", "a b", 0.0)]


def test_wer(spark):
    df = spark.createDataFrame([(a, b) for a, b, _ in PAIRS], "a string, b string")
    a, b = tx.words(F.col("a")), tx.words(F.col("b"))
    found = df.select(tx.wer(a, b).alias("x"), tx.wer_short(a, b).alias("y")).collect()
    assert [r["x"] for r in found] == [r["y"] for r in found] == [w for _, _, w in PAIRS]


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i] + [0] * len(b) if (old := row) is None else [i, *[0] * len(b)]
        for j, y in enumerate(b, 1):
            row[j] = min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y))
    return row[-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=12), st.lists(st.sampled_from("abc"), max_size=12))
def test_edit_distance(a, b):
    assert tx.edit_distance(a, b) == slow_distance(a, b)


def test_tiers(spark):
    df = spark.createDataFrame([(x,) for x in (0.02, 0.0201, 0.10, 0.1001)], "x double")
    assert [r["t"] for r in df.select(cs.tier(F.col("x")).alias("t")).collect()] == ["GOLD", "HIGH", "MEDIUM", "LOW"]
    df = spark.createDataFrame([(x,) for x in (None, 4.99, 5.0, 20.0, 45.0)], "x double")
    assert [r["t"] for r in df.select(cs.duration_bucket(F.col("x")).alias("t")).collect()] == ["unknown", "<5s", "5-10s", "20-30s", "20-30s"]
    rows = [(0.0, 0, 0), (0.6, 1, 0), (0.1, 2, 0), (0.1, 0, 1), (0.1, 0, 2), (0.1, 0, 0)]
    df = spark.createDataFrame(rows, "pw double, r int, u int")
    found = [r["t"] for r in df.select(cs.adjudicated_tier(F.col("pw"), F.col("r"), F.col("u")).alias("t")).collect()]
    assert found == ["GOLD", "LOW", "GOLD-via-kenlm", "HIGH", "MEDIUM", "LOW"]


def test_consensus(spark):
    a = spark.createDataFrame([("1", "s", "a b"), ("2", "s", ""), ("3", "s", "x")], "utterance_id string, source string, normalized string")
    b = spark.createDataFrame([("1", "s", "a b"), ("2", "s", "c"), ("4", "s", "x")], "utterance_id string, source string, normalized string")
    d = spark.createDataFrame([("1", 4.0)], "utterance_id string, duration_sec double")
    found = {r["utterance_id"]: r for r in cs.consensus(a, b, d).collect()}
    assert set(found) == {"1", "2"} and found["1"]["consensus_text"] == "a b" and found["1"]["duration_bucket"] == "<5s"
    assert (found["2"]["pairwise_wer"], found["2"]["consensus_tier"], found["2"]["consensus_text"]) == (1.0, "LOW", None)


def test_opcodes_and_adjudication(spark):
    a, b = "a b c d".split(), "a x c d e".split()
    df = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
    found = [tuple(r) for r in df.select(F.explode(cs.opcodes(F.col("a"), F.col("b"))).alias("o")).select("o.*").collect()]
    assert found == difflib.SequenceMatcher(a=a, b=b, autojunk=False).get_opcodes()
    prefer_x = lambda words: 5.0 * words.count("x") + 0.5 * words.count("e")
    verdict = cs.adjudicate(a, b, prefer_x)
    assert verdict["text"] == "a x c d" and (verdict["resolved"], verdict["unresolved"], verdict["b_wins"]) == (1, 1, 1)
    assert cs.in_context(prefer_x, [], [], []) == 0.0


def test_language_model(spark):
    df = spark.createDataFrame([("a b c",), ("a b d",)], "t string")
    model = cs.BigramModel.fit(df, "t")
    assert model.score(["a", "b", "c"]) > model.score(["c", "b", "a"])
    rows = spark.createDataFrame([("1", "a b c", "a q c")], "utterance_id string, x string, y string")
    judged = cs.adjudicated(rows, "x", "y", lambda: model.score)
    assert judged.first()["verdict"]["text"] == "a b c"
    assert cs.inspect(judged).count() == 1


@pytest.mark.parametrize("block_chars", [1, 300, 1 << 18])
def test_adjudication_uses_all_counts(spark, monkeypatch, block_chars):
    """Against counts of all words and pairs by plain loops, beyond the 100,000 that were once kept."""
    monkeypatch.setattr(cs, "BLOCK_CHARS", block_chars)
    filler = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(2000)]
    texts = [*filler, "zz rare pair here", "the the the", "", None, "zz rare pair here now"]
    rows = [(i, f"zz rare {x} here", f"zz {y} pair here") for i, (x, y) in enumerate([("pair", "the"), ("the", "rare"), ("w1x1", "w1x2"), ("w1999x58 w1999x59", "w5x5")])]
    rows += [(10, None, "a"), (11, "", ""), (12, "w3x1 w3x2 w3x3", "w3x1 q w3x3"), (12, "w3x1 w3x2 w3x3", "w3x1 q w3x3")]
    counts = Counter()
    for t in texts:
        if t:
            line = ["<s>", *t.split(), "</s>"]
            counts.update(line)
            counts.update(f"{x} {y}" for x, y in zip(line, line[1:], strict=False))
    assert len(counts) > 200_000
    model = cs.BigramModel(counts, sum(n for g, n in counts.items() if " " not in g))
    corpus = spark.createDataFrame([(t,) for t in texts], "t string")
    df = spark.createDataFrame(rows, "utterance_id long, x string, y string")
    found = sorted(((r["utterance_id"], r["verdict"].asDict(True)) for r in cs.adjudicated_by_counts(df, "x", "y", corpus, "t").collect()), key=lambda r: r[0])
    assert found == [(i, cs.adjudicate((x or "").split(), (y or "").split(), model.score)) for i, x, y in rows]
    assert cs.adjudicated_by_counts(df.filter("utterance_id = 11"), "x", "y", corpus, "t").first()["verdict"]["text"] == ""
    assert cs.adjudicated_by_counts(df.limit(0), "x", "y", corpus, "t").isEmpty()


def test_every_pair_of_turns_is_compared(spark, tmp_path):
    """Pairs that begin at an odd turn too, so that every last turn is read."""
    words = [["a b c", "a b d", "x b d", "x b", ""], ["p q", "p r"], ["alone"], ["m", "n o", "n o"]]
    spark.createDataFrame([(c, t, text) for c, texts in enumerate(words) for t, text in enumerate(texts)], "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    pairs = {(c, t): (texts[t].split(), texts[t + 1].split()) for c, texts in enumerate(words) for t in range(len(texts) - 1)}
    run = lambda name: analytics.QUERIES[name](spark, str(tmp_path)).collect()
    rates = {k: slow_distance(a, b) / max(len(a), 1) for k, (a, b) in pairs.items()}
    assert {(r["conv_id"], r["turn"]): r["wer"] for r in run("word_wer")} == rates and any(t % 2 for _, t in pairs)
    found = {}
    for r in sorted(run("align_opcodes"), key=lambda r: r["nth"]):
        found.setdefault((r["conv_id"], r["turn"]), []).append(tuple(r)[3:])
    assert found == {k: difflib.SequenceMatcher(a=a, b=b, autojunk=False).get_opcodes() for k, (a, b) in pairs.items()}
    for name in ("consensus_tiers", "lm_adjudicate"):
        assert sorted(r["utterance_id"] for r in run(name)) == sorted(f"{c}-{t}" for c, t in pairs)


def test_edit_distance_of_long_lists():
    """Lists beyond a machine word, alike and not, with few words and many."""
    import random

    draw = random.Random(4)
    for _ in range(60):
        words, n = draw.choice((2, 5, 400)), draw.choice((5, 64, 65, 130, 200))
        a = [str(draw.randrange(words)) for _ in range(n)]
        b = [w for w in a if draw.random() < 0.9] if draw.random() < 0.5 else [str(draw.randrange(words)) for _ in range(draw.randrange(150))]
        assert tx.edit_distance(a, b) == tx.edit_distance(b, a) == slow_distance(a, b)


def test_rates_are_made_on_all_cores(spark):
    """A table of one small partition comes to many tasks before the distances of its texts."""
    rows = spark.range(500).coalesce(1).selectExpr("cast(id as string) file", "concat('Word ', id, ' and, more') raw")
    meta = rows.selectExpr("file", "file utterance_id", "'s' source", "lower(raw) normalized_caption")
    found = cs.pillar(rows, meta).select("utterance_id", "ref_wer", F.spark_partition_id().alias("task")).collect()
    assert len(found) == 500 and len({r["task"] for r in found}) >= 4 * spark.sparkContext.defaultParallelism
    text = meta.selectExpr("utterance_id", "source", "normalized_caption normalized")
    tiers = cs.consensus(text, text, meta.selectExpr("utterance_id", "1.0D duration_sec")).select("consensus_tier", F.spark_partition_id().alias("task")).collect()
    assert {r["consensus_tier"] for r in tiers} == {"GOLD"} and len({r["task"] for r in tiers}) >= 4 * spark.sparkContext.defaultParallelism
