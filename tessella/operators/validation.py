"""Checks of a manifest: schema, ranges, agreement with sidecars and with statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.readers import CORRUPT
from .aggregates import hours
from .sampling import SEED, sample

# The range each flag has to lie in.
RANGES = {
    "rms_dbfs": (-250.0, 6.0), "peak_dbfs": (-250.0, 10.0), "silence_ratio": (0.0, 1.01), "vad_speech_ratio": (0.0, 1.5), "vad_num_segments": (0, 10_000),
    "lid_is_hu_prob": (0.0, 1.001), "lid_top1_score": (-1000.0, 1.001), "dnsmos_sig": (-1.0, 5.5), "dnsmos_bak": (-1.0, 5.5), "dnsmos_ovrl": (-1.0, 5.5),
}
TOLERANCE = 1e-6
EXAMPLES = 3


def schema_sanity(checked: DataFrame) -> DataFrame:
    """(rows, bad) of a checked read: malformed lines are bad.

    Spark refuses to read the malformed lines alone, so rows are counted by the first column.
    """
    each = F.pmod(F.hash(checked.columns[0]), F.lit(1)) + 1
    return checked.agg(F.coalesce(F.sum(each), F.lit(0)).cast("long").alias("rows"), F.count(CORRUPT).alias("bad"))


def range_violations(df: DataFrame, bounds: Mapping[str, tuple[float, float]] = RANGES, key: str = "utterance_id", prefix: str = "quality_flags.") -> DataFrame:
    """(metric, violations, examples): values outside their range, with the first few ids."""
    columns = [F.struct(F.lit(n).alias("metric"), F.col(f"{prefix}{n}").cast("double").alias("value"), F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high")) for n, (low, high) in bounds.items()]
    values = df.select(F.col(key).alias("id"), F.explode(F.array(*columns)).alias("v")).select("id", "v.*").filter("value < low OR value > high")
    # The least ids: a bounded list that combines before the shuffle.
    first = F.slice(F.array_sort(F.collect_list("id")), 1, EXAMPLES)
    counts = values.groupBy("metric").agg(F.count("*").alias("violations"))
    few = values.select("metric", "id", F.row_number().over(_by_metric()).alias("nth")).filter(F.col("nth") <= EXAMPLES).groupBy("metric").agg(first.alias("examples"))
    return counts.join(few, "metric")


def _by_metric():
    from pyspark.sql import Window

    return Window.partitionBy("metric").orderBy("id")


def spot_check(manifest: DataFrame, sidecars: Mapping[str, DataFrame], n: int = 200, seed: int = SEED, key: str = "utterance_id") -> DataFrame:
    """(sidecar, field, compared, different) over a sample of ids; numbers may differ by a little."""
    picked = sample(manifest.select(key, "quality_flags"), key, n, seed)
    own = manifest.schema["quality_flags"].dataType.fieldNames()
    parts = []
    for name, sidecar in sidecars.items():
        fields = [f for f in sidecar.columns if f in own]
        joined = picked.join(sidecar.select(F.col(key).alias("s_key"), F.struct(*fields).alias("s")), F.col(key) == F.col("s_key"))
        for f in fields:
            mine, theirs = F.col("quality_flags")[f], F.col("s")[f]
            numeric = sidecar.schema[f].dataType.typeName() in ("double", "float", "long", "integer")
            differs = F.abs(mine - theirs) > TOLERANCE if numeric else ~mine.eqNullSafe(theirs)
            differs = theirs.isNotNull() & F.coalesce(differs, F.lit(True))
            parts.append(joined.agg(F.lit(name).alias("sidecar"), F.lit(f).alias("field"), F.count(theirs).alias("compared"), F.count_if(differs).alias("different")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def best_worst(df: DataFrame, score: str, key: str, n: int = 5, columns: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows of lowest and of highest score, nulls apart; side is worst or best."""
    known = df.filter(F.col(score).isNotNull()).select(key, score, *columns)
    worst = known.orderBy(score, key).limit(n).withColumn("side", F.lit("worst"))
    best = known.orderBy(F.desc(score), F.desc(key)).limit(n).withColumn("side", F.lit("best"))
    return worst.union(best)


def totals(df: DataFrame, duration: str = "duration_sec") -> DataFrame:
    return df.agg(F.count("*").alias("count"), hours(F.col(duration)).alias("hours"))


def stats_parity(df: DataFrame, count: int, expected_hours: float, tolerance: float = 0.5) -> DataFrame:
    """(count, hours, count_ok, hours_ok) against expected statistics."""
    return totals(df).withColumns({"count_ok": F.col("count") == count, "hours_ok": F.abs(F.round("hours", 2) - expected_hours) <= tolerance})


def source_parity(now: DataFrame, before: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Per source (source, count, hours) of either side: counts exact, hours within a tolerance; a missing side is 0."""
    old = before.select("source", F.col("count").alias("old_count"), F.col("hours").alias("old_hours"))
    joined = now.select("source", "count", "hours").join(old, "source", "full").na.fill(0, ["count", "hours", "old_count", "old_hours"])
    return joined.withColumns({"count_ok": F.col("count") == F.col("old_count"), "hours_ok": F.abs(F.col("hours") - F.col("old_hours")) <= tolerance})


def verdict(manifest: DataFrame, checked: DataFrame, sidecars: Mapping[str, DataFrame], count: int, expected_hours: float) -> dict[str, bool]:
    """The gating checks: A schema, B ranges, D sidecars, F statistics."""
    parity = stats_parity(manifest, count, expected_hours).first()
    return {
        "A": schema_sanity(checked).first()["bad"] == 0,
        "B": range_violations(manifest).isEmpty(),
        "D": spot_check(manifest, sidecars).filter("different > 0").isEmpty() if sidecars else True,
        "F": parity["count_ok"] and parity["hours_ok"],
    }
