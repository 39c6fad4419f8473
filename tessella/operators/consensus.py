"""Consensus of two transcriptions: error rates, tiers, and a language model for the spans they disagree on."""

from __future__ import annotations

import difflib
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..runtime import cut, ship, spread

# The tiers' limits, and the limits of adjudication.
TIERS = (("GOLD", 0.02), ("HIGH", 0.05), ("MEDIUM", 0.10))
TIER_NAMES = ("GOLD", "HIGH", "MEDIUM", "LOW")
ADJUDICATED = ("GOLD", "GOLD-via-kenlm", "HIGH", "MEDIUM", "LOW")
HOPELESS = 0.5
CONTEXT = 5
LEAST_DIFFERENCE = 1.0


def tier(rate: Column) -> Column:
    found = F.lit("LOW")
    for name, limit in reversed(TIERS):
        found = F.when(rate <= limit, name).otherwise(found)
    return found


def duration_bucket(seconds: Column) -> Column:
    return (
        F.when(seconds.isNull(), "unknown").when(seconds < 5, "<5s").when(seconds < 10, "5-10s").when(seconds < 20, "10-20s").otherwise("20-30s")
    )


def pillar(transcriptions: DataFrame, meta: DataFrame) -> DataFrame:
    """Transcriptions (file, raw) with their clips (file, utterance_id, source, normalized_caption), and the error rate against a caption."""
    joined = spread(transcriptions, "file").join(meta, "file")
    rows = joined.withColumn("normalized", F.coalesce(tx.normalize(F.col("raw")), F.lit("")))
    rate = tx.wer(tx.words(F.col("normalized_caption")), tx.words(F.col("normalized")))
    return rows.select("utterance_id", "source", "raw", "normalized", F.when(F.coalesce("normalized_caption", F.lit("")) != "", rate).alias("ref_wer"))


def pairwise_rate(a: Column, b: Column, short: bool = False) -> Column:
    """Error rate of two texts' words: 0 if both are empty, 1 if one is."""
    return (tx.wer_short if short else tx.wer)(tx.words(a), tx.words(b))


def consensus(a: DataFrame, b: DataFrame, durations: DataFrame) -> DataFrame:
    """Clips in both pillars with their rate and tier; the text is the first pillar's if they agree.

    The tier comes from the rate before it is rounded.
    """
    other = b.select("utterance_id", F.col("normalized").alias("b_text"))
    joined = spread(a.select("utterance_id", "source", "normalized"), "utterance_id").join(other, "utterance_id").join(durations.select("utterance_id", "duration_sec"), "utterance_id", "left")
    rows = joined.withColumn("rate", pairwise_rate(F.col("normalized"), F.col("b_text"))).withColumn("consensus_tier", tier(F.col("rate")))
    return rows.select(
        "utterance_id", "source", F.bround("rate", 4).alias("pairwise_wer"), "consensus_tier", duration_bucket(F.col("duration_sec")).alias("duration_bucket"),
        F.when(F.col("consensus_tier") == "GOLD", F.col("normalized")).alias("consensus_text"),
    )


OPCODES = T.ArrayType(T.StructType().add("op", "string").add("i1", "integer").add("i2", "integer").add("j1", "integer").add("j2", "integer"))


@F.pandas_udf(OPCODES)
def _opcodes(a, b):
    import pandas as pd

    return pd.Series([[dict(zip(("op", "i1", "i2", "j1", "j2"), c, strict=True)) for c in difflib.SequenceMatcher(a=list(x), b=list(y), autojunk=False).get_opcodes()] for x, y in zip(a, b, strict=True)])


def opcodes(a: Column, b: Column) -> Column:
    """How one array of words turns into another: matching blocks and the spans between them."""
    from pyspark.sql import SparkSession

    ship(SparkSession.active())
    return _opcodes(a, b)


Scorer = Callable[[list[str]], float]


def in_context(score: Scorer, before: list[str], candidate: list[str], after: list[str]) -> float:
    """What a candidate adds to the log probability of its context; 0 for nothing at all."""
    whole, rest = before + candidate + after, before + after
    if not whole:
        return 0.0
    return score(whole) - (score(rest) if rest else 0.0)


def disagreements(a: list[str], b: list[str], context: int = CONTEXT) -> Iterator[dict]:
    """Spans in order, agreed ones too; the others with the words before and the common ones after."""
    for op, i1, i2, j1, j2 in difflib.SequenceMatcher(a=a, b=b, autojunk=False).get_opcodes():
        after = []
        for x, y in zip(a[i2 : i2 + context], b[j2 : j2 + context], strict=False):
            if x != y:
                break
            after.append(x)
        yield {"op": op, "before": a[max(0, i1 - context) : i1], "a": a[i1:i2], "b": b[j1:j2], "after": after}


def adjudicate(a: list[str], b: list[str], score: Scorer) -> dict:
    """Choose between two word lists span by span; too close a call keeps the first and stays unresolved."""
    chosen, spans = [], []
    won = {"a": 0, "b": 0, "tie": 0}
    for span in disagreements(a, b):
        if span["op"] == "equal":
            chosen += span["a"]
            continue
        first, second = (in_context(score, span["before"], span[side], span["after"]) for side in "ab")
        winner = "tie" if abs(second - first) < LEAST_DIFFERENCE else "b" if second > first else "a"
        won[winner] += 1
        chosen += span["b" if winner == "b" else "a"]
        spans.append({"op": span["op"], "a": " ".join(span["a"]), "b": " ".join(span["b"]), "score_a": first, "score_b": second, "winner": winner})
    return {"text": " ".join(chosen), "resolved": won["a"] + won["b"], "unresolved": won["tie"], "a_wins": won["a"], "b_wins": won["b"], "spans": spans}


SPAN = T.StructType().add("op", "string").add("a", "string").add("b", "string").add("score_a", "double").add("score_b", "double").add("winner", "string")
VERDICT = T.StructType().add("text", "string").add("resolved", "integer").add("unresolved", "integer").add("a_wins", "integer").add("b_wins", "integer").add("spans", T.ArrayType(SPAN))


def adjudicated(df: DataFrame, a: str, b: str, make_scorer: Callable[[], Scorer], name: str = "verdict") -> DataFrame:
    """``df`` with the verdict on two columns of normalized text; the model is made once per task."""
    ship(df.sparkSession)
    made: list[Scorer] = []

    @F.pandas_udf(VERDICT)
    def run(left, right):
        import pandas as pd

        if not made:
            made.append(make_scorer())
        return pd.DataFrame([adjudicate((x or "").split(), (y or "").split(), made[0]) for x, y in zip(left, right, strict=True)], columns=VERDICT.fieldNames())

    return df.withColumn(name, run(F.col(a), F.col(b)))


def adjudicated_tier(rate: Column, resolved: Column, unresolved: Column) -> Column:
    return (
        F.when(rate == 0, "GOLD").when(rate > HOPELESS, "LOW").when((unresolved == 0) & (resolved > 0), "GOLD-via-kenlm")
        .when(unresolved == 1, "HIGH").when(unresolved >= 2, "MEDIUM").otherwise("LOW")
    )


def inspect(df: DataFrame, verdict: str = "verdict", key: str = "utterance_id", n: int = 20, seed: int = 42) -> DataFrame:
    """A reproducible sample of adjudicated spans."""
    spans = df.select(key, F.posexplode(f"{verdict}.spans").alias("nth", "span")).select(key, "nth", "span.*")
    return spans.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), key, "nth").cast("binary")), key, "nth").limit(n)


def gram_counts(df: DataFrame, text: str) -> DataFrame:
    """How often each word (``gram``) and each pair of words (with a space between) occurs, ends of texts included."""
    w = F.concat(F.array(F.lit("<s>")), tx.words(F.col(text)), F.array(F.lit("</s>")))
    pairs = F.zip_with(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w") - 1), lambda x, y: F.concat_ws(" ", x, y))
    rows = df.select(w.alias("w")).filter(F.size("w") > 2)
    return rows.select(F.explode(F.concat("w", pairs)).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


def word_total(df: DataFrame, text: str) -> int:
    """All words of ``gram_counts``, counted without them."""
    n = F.size(tx.words(F.col(text)))
    return df.agg(F.sum(F.when(n > 0, n + 2))).first()[0] or 0


class BigramModel:
    """A small language model: log10 probabilities of words after their predecessors.

    ``counts`` has words and pairs as in ``gram_counts``, ``total`` is the number of words of
    all texts.  Unseen pairs fall back on words, those on a floor.
    """

    def __init__(self, counts: dict[str, int], total: int):
        self.counts, self.total = counts, total + 1

    @classmethod
    def fit(cls, df: DataFrame, text: str) -> "BigramModel":
        """All counts in one process, for few texts; ``adjudicated_by_counts`` is for any number."""
        return cls({r["gram"]: r["n"] for r in gram_counts(df, text).collect()}, word_total(df, text))

    def score(self, words: Sequence[str]) -> float:
        from math import log10

        total, before = 0.0, "<s>"
        for word in [*words, "</s>"]:
            seen = self.counts.get(f"{before} {word}")
            if seen:
                total += log10(seen / self.counts[before])
            else:
                total += log10(0.4 * (self.counts.get(word, 0) + 0.1) / self.total)
            before = word
        return total


class Asked:
    """In a model's place: keeps the words and pairs that it is asked for."""

    def __init__(self):
        self.grams: set[str] = set()

    def score(self, words: Sequence[str]) -> float:
        line = ["<s>", *words, "</s>"]
        self.grams.update(line)
        self.grams.update(map(" ".join, pairwise(line)))
        return 0.0


#: Characters of both texts that are judged together with one table of counts; a longer row is alone.
BLOCK_CHARS = 1 << 18


def adjudicated_by_counts(df: DataFrame, a: str, b: str, texts: DataFrame, text: str, name: str = "verdict") -> DataFrame:
    """``df`` with the verdict of the bigram model of all of ``texts``, whose counts stay a distributed table.

    Rows are put into blocks of bounded size.  A block asks once for each word and pair that its
    spans need, so even the most frequent word is asked for no more often than there are
    blocks; the counts found come back to the block, whose rows are then judged.
    """
    spark = df.sparkSession
    ship(spark)
    total = word_total(texts, text)

    def dealt(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes = pc.add(*[pc.fill_null(pc.utf8_length(batch.column(c)), 0) for c in (a, b)])
            ends = pc.divide(pc.cumulative_sum(pc.cast(sizes, pa.int64())), BLOCK_CHARS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pc.add(ends, block)], [*batch.schema.names, "_block"])
            block += (ends[-1].as_py() if len(ends) else 0) + 1

    def ask(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(block: int, asked: Asked) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block] * len(asked.grams), pa.int64()), pa.array(sorted(asked.grams), pa.string())], ["_block", "gram"])

        block, asked = None, Asked()
        for batch in batches:
            for own, x, y in zip(*(batch.column(c).to_pylist() for c in ("_block", a, b)), strict=True):
                if own != block:
                    if asked.grams:
                        yield out(block, asked)
                    block, asked = own, Asked()
                adjudicate((x or "").split(), (y or "").split(), asked.score)
        if asked.grams:
            yield out(block, asked)

    verdicts = T.StructType([*df.schema.fields, T.StructField(name, VERDICT)])

    def judge(rows, found):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        counts = dict(zip(found.column("gram").to_pylist(), found.column("n").to_pylist(), strict=True)) if found.num_rows else {}
        score = BigramModel(counts, total).score
        made = [adjudicate((x or "").split(), (y or "").split(), score) for x, y in zip(rows.column(a).to_pylist(), rows.column(b).to_pylist(), strict=True)]
        return rows.drop_columns(["_block"]).append_column(name, pa.array(made, to_arrow_type(VERDICT)))

    rows = cut(df.mapInArrow(dealt, T.StructType([*df.schema.fields, T.StructField("_block", T.LongType())])))
    needed = rows.select("_block", a, b).mapInArrow(ask, "_block long, gram string")
    found = needed.join(gram_counts(texts, text), "gram").select("_block", "gram", "n")
    return rows.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(judge, verdicts)
