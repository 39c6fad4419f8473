"""Toxicity by a factorization machine over hashed terms.

Terms are a text's words and their beginnings, hashed.  The machine adds a weight for
each term and, for each pair, the product of two short vectors, so it learns that an
insult and a mention of a group together are worse than their sum.

It is fitted on a bounded, hash-ordered sample of labelled documents (``MAX_TRAIN``).
Every term that tells the classes apart in that sample is in the model, and so is every
term that tells them apart among the documents with a term of the first kind that leans
to toxic: words that only matter beside others.  The rest, mostly rare, would only add
noise in long texts.  Scoring reads whole texts, one pass, without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import ship
from .common import col, cut, text_of

MAX_TRAIN = 16_384
#: A term is in so many sampled documents, at least; with few toxic ones it is fewer, two at least.
MIN_DOCS = 8
#: A term's shares in the two classes differ by so many standard deviations.
MIN_DEVIATIONS = 4.0
BUCKETS = 1 << 22
RANK = 8
# Set, like MIN_DEVIATIONS, by the log loss on a quarter of the labels (remainder 3), fitted on two others (0 and 1).
STEPS = 600
BATCH = 1_024
RATE = 0.03
#: The pull of weights and factors towards zero, over the number of rows fitted on.
DECAY = 2.0
#: Share of terms left out at random in each step, so that each learns to tell alone.
DROP = 0.25
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3
KEPT_WORDS = 100_000
#: Everything in ASCII that is not a letter separates words.
NOT_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def terms(word: bytes) -> list[int]:
    """The buckets of a word: of itself and of its beginnings."""
    word = word.decode("utf-8", "replace")
    found = ["=" + word, *("^" + word[:n] for n in PREFIXES if len(word) > n)]
    return [zlib.crc32(t.encode()) % BUCKETS for t in found]


def words(text: str) -> set[bytes]:
    return set(text.lower().encode("utf-8", "replace").translate(NOT_LETTERS).split())


@dataclass(frozen=True)
class Model:
    """bias + the sum of weight + half of (squared sums - sums of squares) of factors."""

    bias: float
    buckets: tuple[int, ...] = ()
    weight: tuple[float, ...] = ()
    factors: tuple[tuple[float, ...], ...] = ()
    #: A word's places in ``buckets``, learnt by and kept in each Python worker.
    known: dict[bytes, tuple[int, ...]] = field(default_factory=dict, compare=False, repr=False)
    lookup: dict[int, int] = field(default_factory=dict, compare=False, repr=False)
    arrays: list = field(default_factory=list, compare=False, repr=False)

    def score(self, found: list[list[int]]):
        """Probabilities for lists of places in ``buckets``."""
        import numpy as np

        sizes = np.array([len(x) for x in found], np.int64)
        total = np.full(len(found), self.bias)
        if self.buckets and sizes.sum():
            if not self.arrays:
                self.arrays.extend((np.array(self.weight), np.array(self.factors).T.copy()))
            w, v = self.arrays
            flat = np.fromiter((p for x in found for p in x), np.int64)
            row = np.repeat(np.arange(len(found)), sizes)
            total += np.bincount(row, w[flat], len(found))
            for factor in v:
                s = np.bincount(row, factor[flat], len(found))
                total += 0.5 * (s * s - np.bincount(row, factor[flat] ** 2, len(found)))
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))

    def places(self, text: str) -> list[int]:
        """The places of a text's terms in ``buckets``."""
        known, own = self.known, words(text)
        if new := own.difference(known):
            if len(known) > KEPT_WORDS:
                known.clear()
                new = own
            if not self.lookup:
                self.lookup.update(zip(self.buckets, range(len(self.buckets)), strict=True))
            for word in new:
                known[word] = tuple(p for t in terms(word) if (p := self.lookup.get(t)) is not None)
        return sorted(set().union(*set(map(known.__getitem__, own))))


def train(rows: list[tuple[list[int], int]], buckets: tuple[int, ...]) -> Model:
    """Fit by Adam on logistic loss, over rows of (places, label); ``buckets`` in order."""
    import numpy as np

    y = np.array([label for _, label in rows], np.float64)
    if not len(y) or not buckets:
        return Model(-40.0 if not y.sum() else float(np.log(y.mean() / max(1 - y.mean(), 1e-6))))
    sizes = np.array([len(at) for at, _ in rows], np.int64)
    flat, starts, n = np.fromiter((p for at, _ in rows for p in at), np.int64, sizes.sum()), np.cumsum(sizes) - sizes, len(buckets)
    rng, decay = np.random.default_rng(0), DECAY / len(y)
    rate = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    state = [np.array([np.log(rate / (1 - rate))]), np.zeros(n), rng.normal(0, 0.02, (RANK, n))]
    first, second = [np.zeros_like(p) for p in state], [np.zeros_like(p) for p in state]
    for step in range(1, STEPS + 1):
        pick, (bias, w, v) = rng.integers(0, len(y), min(BATCH, len(y))), state
        row = np.repeat(np.arange(len(pick)), sizes[pick])
        at = flat[np.repeat(starts[pick] - np.cumsum(sizes[pick]) + sizes[pick], sizes[pick]) + np.arange(len(row))]
        left = rng.random(len(at)) >= DROP
        row, at = row[left], at[left]
        by_row = lambda x: np.bincount(row, x, len(pick))  # noqa: B023, E731
        by_term = lambda x: np.bincount(at, x, n)  # noqa: B023, E731
        sums = [by_row(f[at]) for f in v]
        z = bias + by_row(w[at]) + 0.5 * sum(s * s - by_row(f[at] ** 2) for s, f in zip(sums, v, strict=True))
        off = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[pick]) / len(pick)
        slope = by_term(off[row])
        pull = np.array([by_term((off * s)[row]) for s in sums])
        grads = [np.array([off.sum()]), slope + decay * w, pull - slope * v + decay * v]
        pace = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for p, g, a, b in zip(state, grads, first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= pace * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    bias, w, v = state
    return Model(float(bias[0]), buckets, tuple(w.tolist()), tuple(map(tuple, v.T.tolist())))


def telling(seen: DataFrame, total: int, toxic: int) -> DataFrame:
    """``seen`` (term, bad, n) of the terms whose shares in the classes differ enough, with ``worse``."""
    least = min(MIN_DOCS, max(2, toxic // 4))
    share, clean = F.col("n") / total, total - toxic
    differ = F.col("bad") / toxic - (F.col("n") - F.col("bad")) / clean
    spread = (1 / toxic + 1 / clean) ** 0.5  # the difference of two shares has this deviation for each of theirs
    enough = F.abs(differ) >= MIN_DEVIATIONS * spread * F.sqrt(share * (1 - share) + 1e-9)
    return seen.filter((F.col("n") >= least) & enough).withColumn("worse", differ > 0)


def held_out(key: Column) -> Column:
    """Whether labels of this id are kept from training."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` labelled documents that aren't held out.

    Null labels and ids are left out; a document labelled twice counts as toxic if either
    label says so.  Without labelled documents every score is 0.
    """
    spark = docs.sparkSession
    ship(spark)
    known = labels.select(col(id_col).alias("label_id"), col(label_col).cast("int").alias("y")).filter("label_id IS NOT NULL AND y IS NOT NULL")
    known = known.filter(~held_out(F.col("label_id"))).groupBy("label_id").agg(F.max("y").alias("y"))
    sample = cut(known.orderBy(F.xxhash64("label_id"), "label_id").limit(max_train))
    rows = docs.select(col(id_col).alias("own_id"), text_of(text_col).alias("text")).join(F.broadcast(sample), F.col("own_id") == F.col("label_id"))  # max_train rows of an id and a label

    def extract(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [sorted({t for w in words(text.as_py()) for t in terms(w)}) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))], ["id", "y", "terms"])

    id_type = docs.select(col(id_col)).schema[0].dataType.simpleString()
    read = cut(rows.select("own_id", "text", "y").mapInArrow(extract, f"id {id_type}, y int, terms array<int>"))
    total, toxic = read.agg(F.count("*"), F.sum("y")).first()
    if not toxic or toxic == total:
        return train([([], 1)] if toxic else [], ())
    counted = lambda rows: rows.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("y").alias("bad"), F.count("*").alias("n"))
    found = telling(counted(read), total, toxic).select("term", "worse").collect()  # of the terms of max_train documents
    buckets = {r["term"] for r in found}
    worse = spark.sparkContext.broadcast({r["term"] for r in found if r["worse"]})

    def beside(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array([not worse.value.isdisjoint(x) for x in batch.column(2).to_pylist()], pa.bool_()))

    near = read.mapInArrow(beside, read.schema)
    n, bad = near.agg(F.count("*"), F.sum("y")).first()
    if bad and bad < n:
        buckets |= {r["term"] for r in telling(counted(near), n, bad).select("term").collect()}
    buckets = tuple(sorted(buckets))
    chosen = spark.sparkContext.broadcast({b: i for i, b in enumerate(buckets)})

    def pick(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            own = chosen.value
            found = [[own[t] for t in x if t in own] for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["id", "y", "places"])

    used = read.mapInArrow(pick, f"id {id_type}, y int, places array<int>").toArrow().to_pylist()  # at most max_train ids
    used = [(r["places"], r["y"]) for r in sorted(used, key=lambda r: (zlib.crc32(str(r["id"]).encode()), r["id"]))]
    return train(used, buckets)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` as ``doc`` and ``doc_id``, with score and predicted, for every row.

    Null and empty texts get the score of a text without known terms.  Repeated rows score
    alike; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def rate(column):
        import pandas as pd

        return pd.Series(sent.value.score(list(map(sent.value.places, column))))

    found = docs.select(F.struct("*").alias("doc"), col(id_col).alias("doc_id"), rate(text_of(text_col)).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_civil(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """The documents not predicted toxic, columns unchanged."""
    return score(docs, fit(docs, labels, **columns), **columns).filter("predicted = 0").select("doc.*")
