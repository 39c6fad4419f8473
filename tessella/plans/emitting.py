"""Queries of emitted rows, of sidecar bookkeeping, and of aggregates within arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as ag
from ..operators import consensus as cs
from ..operators import intervals as iv
from ..operators import manifest as m
from ..operators import merging, sampling, scorers
from ..functions import text as tx
from .analytics import distance_sql
from .tables import MANIFEST_SQL, TIMELINE_SQL, manifest, table, timeline

QUERIES, ORACLES = {}, {}


def register(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return keep


def order_chunks(spark, sf):
    """Line items as chunks of the recording that their order stands for."""
    start = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        F.lit(None).cast("string").alias("session_id"), F.col("l_orderkey").cast("string").alias("file_id"), F.col("l_linenumber").alias("chunk_index"),
        F.concat(F.lit("/r/c/"), F.col("l_orderkey").cast("string"), F.lit(".ogg")).alias("audio_path"), start.alias("start_sec"), (start * 2).alias("end_sec"), start.alias("duration_sec"),
        F.concat(F.lit("/r/p/"), F.col("l_returnflag"), F.lit(".mp3")).alias("parent_file_path"), F.lit(60.0).alias("parent_file_duration_sec"),
    )


CHUNK_ROWS = """SELECT 'librivox_hu/' || l_orderkey || '_' || lpad(CAST(l_linenumber AS VARCHAR), 6, '0') AS utterance_id, 'librivox_hu' AS source, 'c/' || l_orderkey || '.ogg' AS relative_audio_path, l_quantity AS duration_sec,
  l_quantity * 2 AS segment_end_sec, 'PD' AS license, 'LibriVox HU chapter (PD, chunked from ' || l_returnflag || '.mp3)' AS attribution, 'chunked' AS segmentation_status FROM lineitem WHERE l_quantity BETWEEN 3 AND 30"""


@register("emit_chunks", CHUNK_ROWS)
def emit_chunks(spark, sf):
    rows = m.chunks(order_chunks(spark, sf), "librivox_hu", "/r")
    return rows.select("utterance_id", "source", "relative_audio_path", "duration_sec", "segment_end_sec", "license", "attribution", "segmentation_status")


@register(
    "emit_pseudo_labels",
    """WITH t AS (SELECT o_orderkey || '-x_hu_' || o_custkey AS uid, trim(o_orderpriority) AS text, o_orderkey % 3 = 0 AS bad, CASE WHEN o_orderkey % 5 = 0 THEN 'sk' ELSE 'hu' END AS lid, o_orderkey % 50 + 0.5::DOUBLE AS len, CAST(o_custkey AS DOUBLE) AS begin_, o_orderkey % 7 = 0 AS aligned FROM orders)
    SELECT 'mosel/' || uid AS utterance_id, split_part(uid, '_hu_', 1) || '_hu' AS parent_session_id, text, CASE WHEN aligned THEN 1.5::DOUBLE ELSE len END AS duration_sec, CASE WHEN aligned THEN 10::DOUBLE ELSE begin_ END AS segment_start_sec,
      CASE WHEN aligned THEN 11.5::DOUBLE ELSE begin_ + len END AS segment_end_sec, '/seg/' || substr(uid, 1, 4) || '/' || uid || '.ogg' AS audio_path, bad AS any_hallucination_flag, lid = 'hu' AS lid_is_hu FROM t""",
)
def emit_pseudo_labels(spark, sf):
    key = F.col("o_orderkey")
    uid = F.concat(key.cast("string"), F.lit("-x_hu_"), F.col("o_custkey").cast("string"))
    tsv = table(spark, sf, "orders").select(
        uid.alias("id"), F.concat(F.lit(" "), "o_orderpriority").alias("text"), F.when(key % 5 == 0, "sk").otherwise("hu").alias("lid"), F.when(key % 3 == 0, "True").otherwise("False").alias("hall_long_word"),
        (key % 50 + 0.5).cast("string").alias("duration"), F.col("o_custkey").cast("string").alias("offset"), (key % 7 == 0).alias("aligned"),
    )
    bounds = tsv.filter("aligned").select(F.col("id").alias("uid"), F.lit(10.0).alias("start_sec"), F.lit(11.5).alias("end_sec"))
    rows = m.pseudo_labels(tsv, bounds, "mosel_hu_voxpopuli", "/seg", "/r")
    return rows.select(
        "utterance_id", "parent_session_id", F.col("transcripts.whisper_large_v3_pseudo").alias("text"), "duration_sec", "segment_start_sec", "segment_end_sec", "audio_path", "quality_flags.any_hallucination_flag", "quality_flags.lid_is_hu"
    )


@register(
    "emit_common_voice",
    """WITH c AS (SELECT c_custkey AS k, 'c' || c_custkey AS stem, CASE WHEN c_custkey % 3 = 0 THEN 'validated' WHEN c_custkey % 2 = 0 THEN 'invalidated' ELSE 'unknown' END AS status FROM customer)
    SELECT 'common_voice_25_0_hu/' || stem AS utterance_id, (k % 9 + 1) * 1000 / 1000.0::DOUBLE AS duration_sec, status AS cv25_status, CASE WHEN k % 4 = 0 THEN 'train' WHEN k % 5 = 0 THEN 'dev' END AS cv25_split, k % 11 = 0 AS cv25_reported,
      CASE WHEN status = 'unknown' THEN 0 ELSE CAST(k % 6 AS INTEGER) END AS up_votes, CASE WHEN status = 'unknown' THEN NULL ELSE status || ' text' END AS caption FROM c""",
)
def emit_common_voice(spark, sf):
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit(".mp3")).alias("path"))
    voted = lambda name, by: base.filter(F.col("k") % by == 0).select("path", F.lit(f"{name} text").alias("sentence"), (F.col("k") % 6).cast("string").alias("up_votes"), F.lit("x").alias("down_votes"))
    part = lambda by: base.filter(F.col("k") % by == 0).select("path")
    durations = base.select(F.col("path").alias("clip"), ((F.col("k") % 9 + 1) * 1000).alias("duration_ms"))
    rows = m.common_voice(durations, {"validated": voted("validated", 3), "invalidated": voted("invalidated", 2)}, {"train": part(4), "dev": part(5)}, part(11), "/clips")
    return rows.select("utterance_id", "duration_sec", "quality_flags.cv25_status", "quality_flags.cv25_split", "quality_flags.cv25_reported", "quality_flags.up_votes", F.col("transcripts.source_caption").alias("caption"))


@register(
    "caption_outliers",
    """WITH c AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) * 100 - 300 AS len, CASE WHEN l_orderkey % 4 = 0 THEN 0 WHEN l_orderkey % 4 = 1 THEN NULL ELSE 20 END AS video FROM lineitem)
    SELECT l_orderkey, l_linenumber FROM c WHERE len > 0 AND (video IS NULL OR video <= 0 OR len <= 2200)""",
)
def caption_outliers(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("audio_id"), "l_linenumber", F.lit(0).alias("start_cs"), (F.col("l_quantity").cast("long") * 100 - 300).alias("end_cs"))
    lengths = rows.select("audio_id").distinct().filter("audio_id % 4 <> 1").withColumn("video_sec", F.when(F.col("audio_id") % 4 == 0, 0.0).otherwise(20.0))
    return iv.drop_outliers(rows, lengths).select(F.col("audio_id").alias("l_orderkey"), "l_linenumber")


@register(
    "flagged_for_second_pass",
    "SELECT DISTINCT user_id FROM events WHERE event_type <> 'view' EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 120",
)
def flagged_for_second_pass(spark, sf):
    events = table(spark, sf, "events")
    region = F.when((F.col("event_type") == "purchase") & (F.col("value") > 120), F.array(F.struct(F.lit(0.0).alias("start"), F.lit(1.0).alias("end"), F.lit("hu").alias("lang"))))
    purity = events.select("user_id", (F.col("event_type") != "view").alias("needs_pass2"), region.alias("language_regions"))
    return merging.flagged_without_regions(purity, "user_id")


@register(
    "newest_files",
    """WITH f AS (SELECT n_regionkey AS r, max(n_nationkey) AS k FROM nation GROUP BY n_regionkey)
    SELECT r_regionkey, '/raw/' || lpad(CAST(k AS VARCHAR), 4, '0') || '/r' || r_regionkey || '.ogg' AS resolved_path FROM region LEFT JOIN f ON r = r_regionkey""",
)
def newest_files(spark, sf):
    name = lambda key: F.concat(F.lit("/r"), F.col(key).cast("string"), F.lit(".ogg"))
    listing = table(spark, sf, "nation").select(F.concat(F.lit("/raw/"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0"), name("n_regionkey")).alias("path"))
    wanted = table(spark, sf, "region").select("r_regionkey", F.concat(F.lit("raw/*"), name("r_regionkey")).alias("parent_audio_path"))
    return merging.newest_files(wanted, listing).select("r_regionkey", "resolved_path")


@register(
    "coverage_by_parent",
    f"""WITH {TIMELINE_SQL}, r AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM timeline)
    SELECT user_id, CAST(sum(e - s) AS BIGINT) AS summed, CAST(sum(greatest(0, e - greatest(s, coalesce(pm, s)))) AS BIGINT) AS covered, max(e) AS d FROM r GROUP BY user_id""",
)
def coverage_by_parent(spark, sf):
    events = timeline(spark, sf)
    covered = iv.union_length(events, "user_id", "s", "e", "event_id").select("user_id", F.col("covered").cast("long").alias("covered"))
    return ag.coverage_by_parent(events, covered, events.groupBy("user_id").agg(F.max("e").alias("d")), "user_id", "s", "e", "d")


PARTS_SQL = "p AS (SELECT l_orderkey, l_linenumber AS i, l_quantity AS s, l_quantity + l_linenumber AS e, CASE l_returnflag WHEN 'R' THEN 'hu' ELSE l_returnflag END AS lang FROM lineitem)"


def parts(spark, sf):
    part = F.struct(
        F.col("l_linenumber").alias("i"), F.col("l_quantity").alias("start"), (F.col("l_quantity") + F.col("l_linenumber")).alias("end"), F.when(F.col("l_returnflag") == "R", "hu").otherwise(F.col("l_returnflag")).alias("lang"),
    )
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(part)).alias("x"))


@register(
    "foreign_regions",
    f"""WITH {PARTS_SQL} SELECT l_orderkey, count(*) FILTER (WHERE lang <> 'hu') AS n_foreign_regions, coalesce(sum(e - s) FILTER (WHERE lang <> 'hu'), 0) AS foreign_duration_sec,
      arg_min(s, i * 1000 + s) FILTER (WHERE lang = 'hu') AS first_hu_start_sec, arg_max(e, i * 1000 + s) FILTER (WHERE lang = 'hu') AS last_hu_end_sec FROM p GROUP BY l_orderkey""",
)
def foreign_regions(spark, sf):
    return parts(spark, sf).select("l_orderkey", ag.foreign_regions(F.col("x")).alias("f")).select("l_orderkey", "f.*")


@register(
    "speech_totals",
    f"WITH {PARTS_SQL} SELECT l_orderkey, count(*) AS vad_num_segments, CAST(sum(e - s) AS DOUBLE) AS vad_speech_sec, CAST(sum(e - s) AS DOUBLE) / 64.0::DOUBLE AS vad_speech_ratio FROM p GROUP BY l_orderkey",
)
def speech_totals(spark, sf):
    return parts(spark, sf).select("l_orderkey", ag.speech(F.col("x"), F.lit(64.0)).alias("s")).select("l_orderkey", "s.*")


@register("rows_by_parent", f"WITH {PARTS_SQL} SELECT l_orderkey, CAST(count(*) AS INTEGER) AS n, arg_min(s, i * 1000 + s) AS first FROM p GROUP BY l_orderkey")
def rows_by_parent(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return ag.by_parent(rows, "l_orderkey", ["l_linenumber", "l_quantity"]).select("l_orderkey", F.size("rows").alias("n"), F.get("rows", F.lit(0))["l_quantity"].alias("first"))


@register(
    "custom_order",
    """WITH r AS (SELECT n_nationkey, CASE n_regionkey WHEN 3 THEN 1 WHEN 1 THEN 2 ELSE 9 END AS k, n_name FROM nation)
    SELECT n_nationkey, CAST(row_number() OVER (ORDER BY k, n_name) AS INTEGER) AS place FROM r""",
)
def custom_order(spark, sf):
    from pyspark.sql import Window

    nations = sampling.in_order(table(spark, sf, "nation"), ("n_regionkey", [3, 1]), then=["n_name"])
    numbered = nations.withColumn("at", F.monotonically_increasing_id())
    return numbered.select("n_nationkey", F.row_number().over(Window.orderBy("at")).alias("place"))


@register("storage_estimate", "SELECT c_custkey, c_acctbal * 16000 * 2 / 1e9::DOUBLE AS raw_gb FROM customer")
def storage_estimate(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", ag.storage_estimate(F.col("c_acctbal")).alias("g")).select("c_custkey", "g.raw_gb")


@register(
    "second_pass_cascade",
    f"WITH {MANIFEST_SQL} SELECT utterance_id, language <> 'hu' OR vad_speech_ratio < 0.85::DOUBLE AS needs_pass2 FROM manifest",
)
def second_pass_cascade(spark, sf):
    rows = manifest(spark, sf)
    return rows.select("utterance_id", scorers.needs_second(F.col("language"), F.col("quality_flags.vad_speech_ratio")).alias("needs_pass2"))


@register(
    "purity_first_pass",
    f"""WITH {TIMELINE_SQL}, r AS (SELECT user_id, label, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) AS rn FROM timeline), f AS (SELECT * FROM r WHERE rn <= 5)
    SELECT CAST(user_id AS VARCHAR) AS utterance_id, arg_min(label, rn) AS first_window_top1, coalesce(min(CASE WHEN label = 'click' THEN rn END) - 1, count(*)) AS n_non_hu_windows, count(*) AS n_windows_scanned FROM f GROUP BY user_id""",
)
def purity_first_pass(spark, sf):
    ordered = timeline(spark, sf).groupBy("user_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("s", "event_id", "label"))), 1, 5).alias("x"))
    windows = F.transform("x", lambda v: F.when(v["label"] == "click", "hu").otherwise(v["label"]))
    found = scorers.purity_first(ordered.select(F.col("user_id").cast("string").alias("utterance_id"), F.lit("hu").alias("whole_top1"), F.lit(0.9).alias("whole_prob"), windows.alias("windows")))
    first = F.when(F.col("first_window_top1") == "hu", "click").otherwise(F.col("first_window_top1"))
    return found.select("utterance_id", first.alias("first_window_top1"), "n_non_hu_windows", "n_windows_scanned")


NORMALIZED = (
    "trim(regexp_replace(regexp_replace(" + "replace(" * len(tx.SYMBOLS) + "lower(text)" + "".join(f", '{s}', ' {w} ')" for s, w in tx.SYMBOLS.items()) + r", '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
)


@register(
    "pillar_rows",
    f"""WITH RECURSIVE t AS (SELECT conv_id || '-' || turn AS utterance_id, role, lower(text) AS caption, {NORMALIZED} AS normalized FROM conversations), {distance_sql("caption", "normalized")}
    SELECT utterance_id, role AS source, normalized, CASE WHEN coalesce(caption, '') <> '' THEN rate END AS ref_wer FROM e""",
)
def pillar_rows(spark, sf):
    """Conversations have no numbers, so their normalization has SQL."""
    rows = table(spark, sf, "conversations")
    name = F.concat_ws("-", "conv_id", "turn")
    meta = rows.select(name.alias("file"), name.alias("utterance_id"), F.col("role").alias("source"), F.lower("text").alias("normalized_caption"))
    return cs.pillar(rows.select(name.alias("file"), F.col("text").alias("raw")), meta).select("utterance_id", "source", "normalized", "ref_wer")


@register("rows_by_locality", f"WITH {MANIFEST_SQL} SELECT utterance_id, source, audio_path, TRUE AS together FROM manifest")
def rows_by_locality(spark, sf):
    """together: the row before it in its partition, if any, is of its source or the last of another."""
    from pyspark.sql import Window

    sorted_ = merging.by_locality(manifest(spark, sf).select("utterance_id", "source", "audio_path"), "source", "utterance_id")
    at = sorted_.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    span = F.max("at").over(Window.partitionBy("source")) - F.min("at").over(Window.partitionBy("source")) + 1
    return at.select("utterance_id", "source", "audio_path", (span == F.count("*").over(Window.partitionBy("source"))).alias("together"))
