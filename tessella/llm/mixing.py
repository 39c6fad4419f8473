"""Mixing sources to target weights, with DataFrame functions only.

Sizes are summed by source, each source gets a share of the budget by its weight, and
the share over the source's own size is its repetition rate.  A document is emitted
floor(rate) times, and once more if a draw seeded by its id and text falls under the
fraction.

One draw for each document leaves a source of few or uneven documents well off its
target.  So there are ``SALTS`` draws of each, and a source takes those under the salt
that brings it closest; one aggregate of as many sums finds it.

A share stops at ``max_repeat`` times its source; what is above goes to the others by
weight until none is above.  With sources in order of cap over weight, all up to some
place are at their cap and the rest share one level per unit of weight, so running sums
over the (few) sources find the level; no loop is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, cut, join_small, text_of, word_count

SEED = "mix-2"
#: A draw has as many hexadecimal digits, so the multiples below stay exact in a long.
DRAW_DIGITS = 13
DRAWS = 16**DRAW_DIGITS
SALTS = 64


def draw(first: Column, step: Column, salt: Column) -> Column:
    """Uniform in [0, 1): the ``salt``-th of a row's draws."""
    return F.pmod(first + salt * step, F.lit(DRAWS)) / F.lit(float(DRAWS))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeat: int = 3, share: float = 1.0
) -> DataFrame:
    """``sizes`` (mix_source, source_size) with mix_target, one row per source.

    The weights repeat over the sources in code-point order, a null source last.  The
    table has one row per source however large the corpus is, hence the plain windows.
    """
    by_name = Window.orderBy(F.col("mix_source").asc_nulls_last())
    nth = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weighed = sizes.withColumn("mix_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), nth))
    by_fill = Window.orderBy(
        F.col("source_size") / F.col("mix_weight"), F.col("mix_source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    cap = F.lit(max_repeat) * F.col("source_size")
    placed = weighed.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(share)).alias("mix_budget"),
        (F.sum(cap).over(by_fill) - cap).alias("capped_before"),
        (F.sum("mix_weight").over(everything) - F.sum("mix_weight").over(by_fill) + F.col("mix_weight")).alias("weight_left"),
    )
    level = (F.col("mix_budget") - F.col("capped_before")) / F.col("weight_left")
    levelled = placed.withColumn("mix_level", F.when(level * F.col("mix_weight") <= cap, level))
    # The first level that fits is the largest of those that do: later ones repeat it.
    level = F.max("mix_level").over(everything)
    return levelled.select(
        "mix_source",
        "source_size",
        F.least(cap.cast("double"), F.coalesce(level * F.col("mix_weight"), cap.cast("double"))).alias("mix_target"),
    )


KEYS = ["mix_source", "mix_id", "digest"]


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, keep: bool) -> DataFrame:
    text = text_of(text_col)
    rows = docs.select(
        *([F.struct("*").alias("doc")] if keep else [word_count(text).alias("size")]),
        col(id_col).alias("mix_id"),
        col(source_col).cast("string").alias("mix_source"),
        F.md5(text.cast("binary")).alias("digest"),
    )
    return rows.withColumn("key_hash", F.xxhash64(*KEYS))


def _numbered(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` with nth, their place from 0 among the rows equal in ``KEYS``.

    Only rows with a hash in ``repeated`` are numbered: those of each partition by
    themselves, then all parts of a group by its counts, so a group that many rows share
    is spread over as many tasks.  ``rows`` is read several times, in the same partitions.
    """
    if repeated.isEmpty():
        return rows.withColumn("nth", F.lit(0).cast("long"))
    same = F.col("key_hash") == F.col("again_hash")
    part = [*KEYS, "part"]
    dealt = join_small(rows.withColumn("part", F.spark_partition_id()), repeated, same, "left_semi")
    before = Window.partitionBy(*KEYS).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*part).agg(F.count("*").alias("own")).withColumn("before", F.coalesce(F.sum("own").over(before), F.lit(0)))
    starts = cut(counts.select(*[F.col(k).alias(f"start_{k}") for k in part], "before"))
    at = F.lit(True)
    for k in part:
        at = at & F.col(k).eqNullSafe(F.col(f"start_{k}"))
    within = dealt.withColumn("own_nth", F.row_number().over(Window.partitionBy(*part).orderBy(F.lit(0))))
    numbered = join_small(within, starts, at).select(*rows.columns, (F.col("before") + F.col("own_nth") - 1).cast("long").alias("nth"))
    return join_small(rows, repeated, same, "left_anti").withColumn("nth", F.lit(0).cast("long")).union(numbered)


def _drawn(rows: DataFrame, seed: str) -> DataFrame:
    parts = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("mix_id").cast("string"), F.lit("null")), F.col("nth").cast("string"), F.col("digest"))
    hashed = rows.withColumn("hash", F.md5(parts.cast("binary")))
    number = lambda at: F.conv(F.substring("hash", at, DRAW_DIGITS), 16, 10).cast("long")
    return hashed.withColumns({"first": number(1), "step": number(1 + DRAW_DIGITS)}).drop("hash")


def _source_rates(drawn: DataFrame, weights: Sequence[int], max_repeat: int, share: float) -> DataFrame:
    """One row per source: rate_source, source_size, target, rate and salt."""
    totals = drawn.groupBy("mix_source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, max_repeat, share)
    rate = F.when(F.col("source_size") > 0, F.col("mix_target") / F.col("source_size")).otherwise(0.0)
    rates = cut(targets.select(F.col("mix_source").alias("rate_source"), "source_size", F.col("mix_target").alias("target"), rate.alias("rate")))
    fraction = F.col("rate") - F.floor("rate")
    sums = [F.sum(F.when(draw(F.col("first"), F.col("step"), F.lit(s)) < fraction, F.col("size")).otherwise(0)).alias(f"extra_{s}") for s in range(SALTS)]
    extras = join_small(drawn, rates, F.col("mix_source").eqNullSafe(F.col("rate_source"))).groupBy(F.col("mix_source").alias("salt_source")).agg(*sums)
    joined = rates.join(extras, F.col("rate_source").eqNullSafe(F.col("salt_source")))
    off = lambda s: F.abs((F.floor("rate") * F.col("source_size") + F.col(f"extra_{s}")).cast("double") - F.col("target"))
    best = F.array_min(F.array(*[F.struct(off(s).alias("off"), F.lit(s).alias("salt")) for s in range(SALTS)]))
    return cut(joined.select("rate_source", "source_size", "target", "rate", best["salt"].alias("salt")))


def mix_plan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    max_repeat: int = 3,
    share: float = 1.0,
    seed: str = SEED,
    keep: bool = True,
) -> DataFrame:
    """Every document with its source's size and target, and its copies.

    Returns ``doc`` (the row as it came, if ``keep``; so no column of it can clash) or
    ``size``, and ``mix_id``, ``source_size``, ``target``, ``copies``.  Words are counted
    in one pass that leaves numbers only; with ``keep`` a second one reads the rows.

    Nulls and edges: a null text has size 0; null sources form one source, the last; null
    ids draw by their texts; rows alike in source, id and text draw each by their place
    among them; a source of size 0 has target 0 and copies 0; an empty table gives no rows.
    ``docs`` should be a table, as it is read several times.
    """
    sized = cut(_sized(docs, id_col, text_col, source_col, False))
    again = sized.groupBy(F.col("key_hash").alias("again_hash")).agg(F.count("*").alias("n"))
    repeated = cut(again.filter("n > 1").select("again_hash"))
    drawn = _drawn(_numbered(sized, repeated), seed)
    rates = _source_rates(drawn, weights, max_repeat, share)
    if keep:
        drawn = _drawn(_numbered(_sized(docs, id_col, text_col, source_col, True), repeated), seed)
    extra = draw(F.col("first"), F.col("step"), F.col("salt")) < F.col("rate") - F.floor("rate")
    return join_small(drawn, rates, F.col("mix_source").eqNullSafe(F.col("rate_source"))).select(
        "doc" if keep else "size", "mix_id", "source_size", "target", (F.floor("rate") + extra.cast("long")).alias("copies")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document as often as its plan says, columns unchanged."""
    plan = mix_plan(docs, **options)
    return plan.filter("copies > 0").select("doc", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select("doc.*")
