"""Reproducible sampling and splits; the order of a sample is a hash of seed and id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 42


def shuffled(key: Column, seed: int = SEED) -> Column:
    """A sort key that shuffles, the same on any engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def sample(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """``n`` rows; a top-k, so nothing is sorted whole."""
    return df.orderBy(shuffled(F.col(key), seed), key).limit(n)


def until_quota(df: DataFrame, group: str, key: str, size: str, targets: Mapping[str, float] | float, seed: int = SEED, buckets: int = 256) -> DataFrame:
    """Rows of each group in shuffled order until their sizes reach the group's target; the row that crosses it is in.

    Running sums are kept per bucket of the shuffled order and added up over buckets, so a
    group that holds most rows is spread over ``buckets`` tasks.  Groups without a target
    have no rows; a null size counts as 0.
    """
    if isinstance(targets, Mapping):
        wanted = F.coalesce(*[F.when(F.col(group) == g, F.lit(float(t))) for g, t in targets.items()], F.lit(None).cast("double"))
    else:
        wanted = F.lit(float(targets))
    rows = df.withColumns({"order_": shuffled(F.col(key), seed), "size_": F.coalesce(F.col(size), F.lit(0)), "target_": wanted}).filter("target_ IS NOT NULL")
    rows = rows.withColumn("bucket_", F.conv(F.substring("order_", 1, 2), 16, 10).cast("int") % buckets if buckets < 256 else F.conv(F.substring("order_", 1, 2), 16, 10).cast("int"))
    earlier = Window.partitionBy("g_").orderBy("b_").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(F.col(group).alias("g_"), F.col("bucket_").alias("b_")).agg(F.sum("size_").alias("sum_"))
    sums = sums.select("g_", "b_", F.coalesce(F.sum("sum_").over(earlier), F.lit(0)).alias("before_"))
    within = Window.partitionBy(group, "bucket_").orderBy("order_", key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumn("run_", F.sum("size_").over(within)).join(sums, F.col(group).eqNullSafe(F.col("g_")) & (F.col("bucket_") == F.col("b_")))
    return summed.filter(F.col("before_") + F.col("run_") - F.col("size_") < F.col("target_")).select(*df.columns)


def stratified(df: DataFrame, group: str, key: str, outlier: Column, per_group: int, share: float, random_only: Sequence[str] = (), seed: int = SEED) -> DataFrame:
    """``df`` with bucket: per group outliers up to a share, normal rows for the rest.

    Missing outliers are made up by normal rows; groups in ``random_only`` are drawn from
    all their rows.
    """
    target = round(per_group * share)
    plain = F.col(group).isin(*random_only) if random_only else F.lit(False)
    bucket = F.when(plain, "random").when(F.coalesce(outlier, F.lit(False)), "outlier").otherwise("normal")
    rows = df.withColumns({"bucket": bucket, "order_": shuffled(F.col(key), seed)})
    nth = F.row_number().over(Window.partitionBy(group, "bucket").orderBy("order_", key))
    # No quota is above per_group, so the rank limit is pushed below the shuffle.
    first = rows.withColumn("nth_", nth).filter(F.col("nth_") <= per_group)
    outliers = rows.filter("bucket = 'outlier'").groupBy(F.col(group).alias("g_")).agg(F.least(F.count("*"), F.lit(target)).alias("found_"))
    quota = F.when(F.col("bucket") == "random", per_group).when(F.col("bucket") == "outlier", target).otherwise(per_group - F.coalesce("found_", F.lit(0)))
    return first.join(outliers, F.col(group).eqNullSafe(F.col("g_")), "left").filter(F.col("nth_") <= quota).select(*df.columns, "bucket")


BUCKETS = ("outlier", "normal", "random")


def in_order(df: DataFrame, *orders: tuple[str, Sequence[str]], then: Sequence[str] = ()) -> DataFrame:
    """Sorted by given orders of values, others last, and then by columns."""
    keys = [F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, values)), F.col(c)), F.lit(0)), F.lit(1 << 30)) for c, values in orders]
    return df.orderBy(*keys, *then)


def is_outlier(flags: Column) -> Column:
    """Clipped, very quiet, or mostly silent."""
    return F.coalesce(flags["is_clipped"], F.lit(False)) | F.coalesce(flags["rms_dbfs"] < -45, F.lit(False)) | F.coalesce(flags["silence_ratio"] > 0.6, F.lit(False))


def test_criterion(source: Column, split: Column, extra: Sequence[tuple[str, Column]] = ()) -> Column:
    """Why a row is held out for testing; null if it isn't."""
    found = F.when((source == "voxpopuli_hu_labeled") & (split == "test"), "vp_labeled_hf_test")
    for label, condition in extra:
        found = F.coalesce(found, F.when(condition, label))
    return found


def dev_eligible(source: Column, status: Column) -> Column:
    """Read-speech clips have to be validated."""
    return F.coalesce((source != "common_voice_25_0_hu") | (status == "validated"), F.lit(False))


def test_set(lean: DataFrame) -> DataFrame:
    criterion = test_criterion(F.col("source"), F.col("quality_flags.hf_split"))
    held = lean.withColumn("criterion_", criterion).filter("criterion_ IS NOT NULL")
    return stamp(held, set_membership=F.lit("test"), test_criterion=F.col("criterion_")).drop("criterion_")


def train_set(lean: DataFrame, test_ids: DataFrame) -> DataFrame:
    """Everything but the test rows, so the two can't share one."""
    return stamp(lean.join(test_ids.select("utterance_id"), "utterance_id", "left_anti"), set_membership=F.lit("train"))


def dev_set(train: DataFrame, hours: Mapping[str, float], seed: int = SEED) -> DataFrame:
    pool = train.filter(dev_eligible(F.col("source"), F.col("quality_flags.cv25_status")))
    chosen = until_quota(pool, "source", "utterance_id", "duration_sec", {s: 3600.0 * h for s, h in hours.items()}, seed)
    return stamp(chosen, set_membership=F.lit("dev"))


def smoke_set(lean: DataFrame, per_source: int, share: float, random_only: Sequence[str] = (), seed: int = SEED) -> DataFrame:
    chosen = stratified(lean, "source", "utterance_id", is_outlier(F.col("quality_flags")), per_source, share, random_only, seed)
    return stamp(chosen, smoke_bucket=F.col("bucket")).drop("bucket")


def stamp(df: DataFrame, flags: str = "quality_flags", **values: Column) -> DataFrame:
    """Set fields of the flags struct."""
    out = F.col(flags)
    for name, value in values.items():
        out = out.withField(name, value)
    return df.withColumn(flags, out)
