"""The driver's tables in the roles of manifests, sidecars, timelines and signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import manifest as m


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a manifest, labels as its sidecar: characters stand for seconds."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    n, tenth = F.col("n_chars"), (F.col("doc_id") % 10) / 10.0
    flags = {
        "too_short": n < 200,
        "too_long": n >= 5000,
        "any_hallucination_flag": F.col("toxic") == 1,
        "lid_top1": F.when(F.col("doc_id") % 3 != 0, F.col("lang")),
        "lid": F.when(F.col("doc_id") % 3 == 0, F.col("lang")),
        "is_clipped": F.col("quality") == 0,
        "silence_ratio": tenth,
        "vad_speech_ratio": 1.0 - tenth,
        "rms_dbfs": -(F.col("doc_id") % 60).cast("double"),
        "dnsmos_ovrl": (F.col("quality") + F.col("toxic") + 1).cast("double"),
        "foreign_prefix_sec": F.when(F.col("doc_id") % 4 != 0, (F.col("doc_id") % 4 - 1).cast("double")),
        "whole_non_hu": F.when(F.col("doc_id") % 5 != 0, F.col("lang") == "de"),
    }
    return m.rows(
        docs, schemas.MANIFEST, flags, utterance_id=F.col("doc_id").cast("string"), source=F.col("source"), source_item_id=F.concat_ws("/", "source", "doc_id"), duration_sec=n,
        audio_path=F.concat(F.lit("/data/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".wav")), language=F.col("lang"),
        transcripts=m.structure(schemas.TRANSCRIPTS, source_caption=F.col("text")), register="read", domain="web", license="CC0-1.0", segmentation_status="merged",
    )


#: The same as SQL.
MANIFEST_SQL = """
manifest AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS utterance_id, d.doc_id, d.source, d.lang AS language, CAST(d.n_chars AS DOUBLE) AS duration_sec, d.text AS source_caption,
    '/data/' || d.source || '/' || d.doc_id || '.wav' AS audio_path, d.source || '/' || d.doc_id AS source_item_id,
    d.n_chars < 200 AS too_short, d.n_chars >= 5000 AS too_long, l.toxic = 1 AS any_hallucination_flag,
    CASE WHEN d.doc_id % 3 <> 0 THEN d.lang END AS lid_top1, CASE WHEN d.doc_id % 3 = 0 THEN d.lang END AS lid, l.quality = 0 AS is_clipped,
    CAST(d.doc_id % 10 AS DOUBLE) / 10.0::DOUBLE AS silence_ratio, 1.0::DOUBLE - CAST(d.doc_id % 10 AS DOUBLE) / 10.0::DOUBLE AS vad_speech_ratio, -CAST(d.doc_id % 60 AS DOUBLE) AS rms_dbfs,
    CAST(l.quality + l.toxic + 1 AS DOUBLE) AS dnsmos_ovrl,
    CASE WHEN d.doc_id % 4 <> 0 THEN CAST(d.doc_id % 4 - 1 AS DOUBLE) END AS foreign_prefix_sec, CASE WHEN d.doc_id % 5 <> 0 THEN d.lang = 'de' END AS whole_non_hu
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as intervals (event_id, user_id, s, e, label) in whole seconds on their user's timeline."""
    events = table(spark, sf_dir, "events")
    # From the fields of the naive timestamp, so that no time zone takes part.
    day = F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    start = day * 86_400 + F.hour("ts") * 3_600 + F.minute("ts") * 60 + F.second("ts")
    return events.select("event_id", "user_id", start.alias("s"), (start + F.ceil("value")).alias("e"), F.col("event_type").alias("label"))


TIMELINE_SQL = """
timeline AS (
  SELECT event_id, user_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS s, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) + CAST(ceil(value) AS BIGINT) AS e, event_type AS label FROM events
)"""
