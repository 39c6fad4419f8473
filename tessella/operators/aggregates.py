"""Scorecards, histograms, order statistics, crosstabs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut
from ..schemas import SIDECARS
from .manifest import has_text, has_transcript_entry


def hours(duration: Column) -> Column:
    return F.coalesce(F.sum(duration), F.lit(0.0)) / 3600.0


def when_true(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def counters(flags: Column, merged: bool) -> list[Column]:
    """The scorecard's counters over the flags.

    ``merged``: coverage counts sidecar hits of this run (columns with_<name>); otherwise
    it counts flags that are there.  The language then falls back on empty strings too.
    """
    lid = F.coalesce(F.nullif(flags["lid_top1"], F.lit("")), flags["lid"]) if merged else F.coalesce(flags["lid_top1"], flags["lid"])
    covered = {"tier1": flags["rms_dbfs"], "vad": flags["vad_speech_ratio"], "lid": lid, "dnsmos": flags["dnsmos_ovrl"]}
    found = (lambda n: F.col(f"with_{n}")) if merged else (lambda n: covered[n].isNotNull())
    return [
        when_true(flags["too_short"]).alias("too_short"),
        when_true(flags["too_long"]).alias("too_long"),
        when_true(flags["any_hallucination_flag"]).alias("halluc_flagged"),
        when_true(lid != "hu").alias("lid_not_hu"),
        *[when_true(found(n)).alias(f"with_{n}") for n in covered],
        when_true(flags["is_clipped"]).alias("is_clipped"),
        when_true(flags["silence_ratio"] >= 0.5).alias("silence_high"),
        when_true(flags["vad_speech_ratio"] < 0.3).alias("vad_speech_ratio_lt_0_3"),
        when_true(flags["vad_speech_ratio"] >= 0.7).alias("vad_speech_ratio_ge_0_7"),
        when_true(flags["dnsmos_ovrl"] >= 3.0).alias("dnsmos_ovrl_ge_3"),
        when_true(flags["dnsmos_ovrl"] < 2.0).alias("dnsmos_ovrl_lt_2"),
        F.round(F.avg(flags["dnsmos_ovrl"]), 3).alias("dnsmos_ovrl_mean"),
    ]


def scorecard(manifest: DataFrame, merged: bool = False) -> DataFrame:
    """Per source, and in total where source is null: rows, hours, text, quality counters."""
    text = has_transcript_entry(F.col("transcripts"))
    rows = manifest.withColumn("source", F.coalesce("source", F.lit("unknown")))
    out = rows.rollup("source").agg(
        F.count("*").alias("count"), hours(F.col("duration_sec")).alias("hours"), when_true(text).alias("with_text"), *counters(F.col("quality_flags"), merged)
    )
    return out.withColumn("audio_only", F.when(F.col("source").isNull(), F.col("count") - F.col("with_text")))


def build_stats(manifest: DataFrame) -> DataFrame:
    """Rows, hours and rows with text by source and in total, of a manifest before its flags are merged."""
    q = F.col("quality_flags")
    lid = F.coalesce(F.nullif(q["lid_top1"], F.lit("")), q["lid"])
    return manifest.rollup("source").agg(
        F.count("*").alias("count"), hours(F.col("duration_sec")).alias("hours"), when_true(has_text(F.col("transcripts"))).alias("with_text"), when_true(q["too_short"]).alias("too_short"),
        when_true(q["too_long"]).alias("too_long"), when_true(q["any_hallucination_flag"]).alias("halluc_flagged"), when_true(lid != "hu").alias("lid_not_hu"),
    )


def session_stats(sessions: DataFrame) -> DataFrame:
    return sessions.rollup("source").agg(F.count("*").alias("count"), hours(F.col("duration_sec")).alias("hours"))


def coverage(attached: DataFrame, names: Sequence[str] = tuple(SIDECARS)) -> DataFrame:
    """Per source: rows, and rows in each sidecar (with_<name>)."""
    return attached.groupBy("source").agg(F.count("*").alias("total"), *[when_true(F.col(f"with_{n}")).alias(n) for n in names if f"with_{n}" in attached.columns])


EDGES = (3, 5, 10, 15, 20, 30)


def duration_label(duration: Column, edges: Sequence[float] = EDGES) -> Column:
    """The half-open range a length lies in, as a label."""
    label = F.lit(f"{edges[-1]}+")
    for low, high in reversed(list(zip((0, *edges[:-1]), edges, strict=True))):
        label = F.when(duration < high, F.lit(f"{low}-{high}")).otherwise(label)
    return F.when(duration.isNotNull(), label)


def histogram(df: DataFrame, duration: Column) -> DataFrame:
    """(label, n, percent) of lengths; the share is of all rows with one."""
    counts = df.select(duration_label(duration).alias("label")).filter("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n"))
    return counts.withColumn("percent", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))


def at_rank(df: DataFrame, value: str, ranks: dict[str, Column], group: Sequence[str] = ()) -> DataFrame:
    """Values at ranks from 0, given as expressions of ``n``, the count of values not null.

    Exact, from counts per distinct value: a group's rows are combined before they are
    shuffled, and running sums go over ranges of values first, which are cut where a sample
    of the values says, and within a range then, so neither a group nor the whole is one
    task's work, however its values are spread.
    """
    # Without groups all rows have the key 0, in a form that isn't folded into a cross join.
    keys = list(group) or ["one_"]
    rows = df.filter(F.col(value).isNotNull()).withColumn("v_", F.col(value))
    rows = rows if group else rows.withColumn("one_", F.pmod(F.hash("v_"), F.lit(1)))
    counts = rows.groupBy(*keys, "v_").agg(F.count("*").alias("c_"))
    # Computed once: another sample would cut elsewhere.
    placed = cut(counts.repartitionByRange(*keys, "v_").withColumn("cell_", F.spark_partition_id()))
    earlier = Window.partitionBy(*keys).orderBy("cell_").rowsBetween(Window.unboundedPreceding, -1)
    cells = placed.groupBy(*keys, "cell_").agg(F.sum("c_").alias("sum_")).select(
        *[F.col(k).alias(f"f_{k}") for k in keys], F.col("cell_").alias("f_cell"), F.coalesce(F.sum("sum_").over(earlier), F.lit(0)).alias("before_"), F.sum("sum_").over(Window.partitionBy(*keys)).alias("n")
    )
    match = F.col("cell_") == F.col("f_cell")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"f_{k}"))
    upto = Window.partitionBy(*keys, "cell_").orderBy("v_").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.withColumn("in_cell_", F.sum("c_").over(upto)).join(cells, match).withColumn("upto_", F.col("before_") + F.col("in_cell_"))
    picked = [F.min(F.when(F.col("upto_") > r, F.col("v_"))).alias(name) for name, r in ranks.items()]
    out = summed.groupBy(*keys).agg(F.max("n").alias("n"), *picked)
    return out if group else out.drop("one_")


def quarter_ranks() -> dict[str, Column]:
    """min, p25, median, p75, max at n//4, n//2, 3n//4."""
    n = F.col("n")
    return {"min": F.lit(0), "p25": F.floor(n / 4), "median": F.floor(n / 2), "p75": F.floor(3 * n / 4), "max": n - 1}


def nearest_rank(p: float) -> Column:
    """Rank of a percentile, to the nearest, halves to the even one."""
    return F.bround(F.lit(p / 100.0) * (F.col("n") - 1))


def floor_rank(q: float) -> Column:
    return F.floor(F.lit(q) * F.col("n"))


def distribution(df: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """n, mean and the true median."""
    return df.groupBy(*group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.median(value).alias("median"))


def bucket_totals(df: DataFrame, bucket: str, source: str = "source", duration: str = "duration_sec") -> DataFrame:
    """(bucket, source, n, hours) for each pair that occurs, and per bucket with a null source."""
    totals = [F.count("*").alias("n"), hours(F.col(duration)).alias("hours")]
    pairs = df.groupBy(bucket, source).agg(*totals)
    # From the pairs, so that rows are read once; a null source has a row of its own as well.
    whole = pairs.groupBy(bucket).agg(F.sum("n").alias("n"), F.sum("hours").alias("hours"))
    return pairs.withColumn("of", F.lit("source")).unionByName(whole.select(bucket, F.lit(None).cast(df.schema[source].dataType).alias(source), "n", "hours", F.lit("bucket").alias("of")))


def session_counts(segments: DataFrame, session: str = "event_id") -> DataFrame:
    """Per year, the first four characters of a session's id: sessions, segments, segments a session."""
    rows = segments.groupBy(F.substring(session, 1, 4).alias("year")).agg(F.count_distinct(session).alias("sessions"), F.count("*").alias("segments"))
    return rows.withColumn("per_session", F.col("segments") / F.col("sessions"))


def shares(df: DataFrame, column: str) -> DataFrame:
    """(value, n, percent)."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.withColumn("percent", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))


def gold_share(df: DataFrame, tier: str, bucket: str, gold: str = "GOLD") -> DataFrame:
    """Per bucket: rows, gold ones, percent."""
    rows = df.groupBy(bucket).agg(F.count("*").alias("n"), F.count_if(F.col(tier) == gold).alias("gold"))
    return rows.withColumn("percent", 100.0 * F.col("gold") / F.col("n"))


def transitions(df: DataFrame, before: str, after: str, values: Sequence[str]) -> DataFrame:
    """Counts of rows by two labels, zero where there are none, in the given order."""
    order = F.array_position(F.array(*map(F.lit, values)), F.col(before))
    return df.groupBy(before).pivot(after, list(values)).count().na.fill(0).orderBy(order)


def promoted(df: DataFrame, before: str, after: str, gold: Sequence[str] = ("GOLD", "GOLD-via-kenlm")) -> DataFrame:
    """Rows that weren't gold and are now: count and percent of all."""
    moved = ~F.col(before).isin(*gold) & F.col(after).isin(*gold)
    return df.agg(F.count_if(moved).alias("promoted"), F.count("*").alias("n")).withColumn("percent", 100.0 * F.col("promoted") / F.col("n"))


def cut_rates(audits: DataFrame) -> DataFrame:
    """Per source: clips, errors, clips without speech, and percent of all with each kind of cut."""
    bad, silent = F.col("boundary_audit_error").isNotNull(), F.coalesce("no_speech", F.lit(False))
    heard = lambda c: ~bad & ~silent & F.coalesce(c, F.lit(False))
    start, end, word_start, word_end = (F.coalesce(c, F.lit(False)) for c in ("boundary_cut_start", "boundary_cut_end", "mid_word_cut_start", "mid_word_cut_end"))
    kinds = {"cut_start": start, "cut_end": end, "either_cut": start | end, "both_cut": start & end, "mw_start": word_start, "mw_end": word_end, "mw_either": word_start | word_end}
    return audits.groupBy("source").agg(
        F.count("*").alias("total"), F.count_if(bad).alias("errors"), F.count_if(~bad & silent).alias("no_speech"),
        *[(100.0 * F.count_if(heard(c)) / F.count("*")).alias(f"{n}_pct") for n, c in kinds.items()],
    )


def speech(segments: Column, length: Column) -> Column:
    """Seconds, ratio and number of (start, end) segments of speech."""
    total = F.aggregate(segments, F.lit(0.0), lambda a, s: a + (s["end"] - s["start"]).cast("double"))
    return F.struct(F.size(segments).cast("long").alias("vad_num_segments"), total.alias("vad_speech_sec"), F.when(length > 0, total / length).otherwise(0.0).alias("vad_speech_ratio"))


def foreign_regions(regions: Column, target: str = "hu") -> Column:
    """Regions of other languages: number and seconds; where the target's first begins and last ends."""
    other, own = F.filter(regions, lambda r: r["lang"] != target), F.filter(regions, lambda r: r["lang"] == target)
    return F.struct(
        F.size(other).cast("long").alias("n_foreign_regions"), F.aggregate(other, F.lit(0.0), lambda a, r: a + (r["end"] - r["start"])).alias("foreign_duration_sec"),
        F.get(own, F.lit(0))["start"].alias("first_hu_start_sec"), F.try_element_at(own, F.lit(-1))["end"].alias("last_hu_end_sec"),
    )


def by_parent(df: DataFrame, parent: str, order: Sequence[str]) -> DataFrame:
    """(parent, rows): a parent's rows in order; a parent is one recording, so its rows are few."""
    rest = [c for c in df.columns if c != parent]
    return df.groupBy(parent).agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in rest if c not in order]))).alias("rows"))


def coverage_by_parent(segments: DataFrame, covered: DataFrame, lengths: DataFrame, parent: str, start: str, end: str, length: str) -> DataFrame:
    """Per parent: summed segments, their union, and the recording's length."""
    total = segments.groupBy(parent).agg(F.sum(F.col(end) - F.col(start)).alias("summed"))
    return total.join(covered, parent).join(lengths.select(parent, length), parent, "left")


def storage_estimate(seconds: Column, rate: int = 16_000, width: int = 2, compression: float = 0.1) -> Column:
    """Gigabytes of uncompressed and compressed audio of so many seconds."""
    raw = seconds * rate * width / 1e9
    return F.struct(raw.alias("raw_gb"), (raw * compression).alias("compressed_gb"))


def changed(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rows, rows with an old text, rows whose text changed."""
    return df.agg(F.count("*").alias("total"), F.count(old).alias("with_caption"), F.count_if(F.col(old).isNotNull() & ~F.col(old).eqNullSafe(F.col(new))).alias("changed"))
