"""Resumable scoring: what is done is skipped, what is new is appended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merging import pending
from ..sources.readers import exists


def append_new(work: DataFrame, scored: Callable[[DataFrame], DataFrame], path: str, key: str = "utterance_id", force: bool = False, retry_errors: str | None = None) -> None:
    """Score work whose key the table at ``path`` lacks and append the rows.

    Error rows count as done; ``retry_errors`` names the column whose rows don't.
    ``force`` scores everything anew.
    """
    spark = work.sparkSession
    if force or not exists(spark, path):
        scored(work).write.mode("overwrite").parquet(path)
        return
    done = spark.read.parquet(path)
    if retry_errors:
        done = done.filter(F.col(retry_errors).isNull())
    scored(pending(work, done.select(key).distinct(), key)).write.mode("append").parquet(path)


def follow(spark: SparkSession, source: str, schema: T.StructType, scored: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, per_trigger: int = 1000, kind: str = "parquet") -> int:
    """Score files that have come since the last run and append the rows; returns how many there are.

    Spark's checkpoint keeps which files are done.  A batch is written to a folder of its
    own number, so a batch that is run again replaces its rows and doesn't add to them.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(kind).load(source)
    before = _count(spark, path)

    def write(batch: DataFrame, number: int) -> None:
        scored(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return _count(spark, path) - before


def _count(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(path).count() if exists(spark, path) else 0


def windowed_counts(events: DataFrame, time: str, key: str, window: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts by event-time windows; works on a stream, with late rows dropped, and on a table."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    counts = rows.groupBy(F.window(time, window, slide or window).alias("w"), key).agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n")


def unit_done(spark: SparkSession, units: DataFrame, done_path: str, key: str) -> DataFrame:
    """Units of work without an entry in the table of finished ones."""
    if not exists(spark, done_path):
        return units
    return pending(units, spark.read.parquet(done_path).select(key).distinct(), key)
