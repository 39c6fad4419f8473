"""Queries of the interval algebra, sampling, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as iv
from ..operators import manifest as m
from ..operators import merging, sampling
from ..sources import readers
from .tables import MANIFEST_SQL, TIMELINE_SQL, manifest, table, timeline

QUERIES, ORACLES = {}, {}
GAP, SPAN = 3600, 14_400


def register(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return keep


def greedy_sql(source: str, parent: str, gap: float, span: float, order: str) -> str:
    """CTEs ending in ``grouped``: rows of ``source`` (parent, s, e, order) with gs and g."""
    return f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY {parent} ORDER BY s, {order}) AS rn FROM {source}),
grouped AS (
  SELECT *, s AS gs, 1 AS g FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.*, CASE WHEN r.s - p.e <= {gap} AND r.e - p.gs <= {span} THEN p.gs ELSE r.s END,
    CASE WHEN r.s - p.e <= {gap} AND r.e - p.gs <= {span} THEN p.g ELSE p.g + 1 END
  FROM grouped p JOIN ranked r ON r.{parent} = p.{parent} AND r.rn = p.rn + 1
)"""


GREEDY = f"WITH RECURSIVE {TIMELINE_SQL},{greedy_sql('timeline', 'user_id', GAP, SPAN, 'event_id')}"


@register(
    "greedy_merge",
    f"{GREEDY} SELECT user_id, min(gs) AS gs, arg_max(e, rn) AS ge, CAST(count(*) AS INTEGER) AS n, arg_min(event_id, rn) AS first_id, arg_max(event_id, rn) AS last_id FROM grouped GROUP BY user_id, g",
)
def greedy_merge(spark, sf):
    return iv.merged_groups(timeline(spark, sf), "user_id", "s", "e", GAP, SPAN, "event_id")


@register("greedy_members", f"{GREEDY} SELECT user_id, event_id, CAST(g - 1 AS BIGINT) AS group_no FROM grouped")
def greedy_members(spark, sf):
    return iv.greedy_groups(timeline(spark, sf), "user_id", "s", "e", GAP, SPAN, "event_id").select("user_id", "event_id", "group_no")


CAPTIONS_SQL = """
captions AS (SELECT l_orderkey AS audio_id, l_linenumber AS seg, CAST(l_quantity AS BIGINT) * 100 AS s, CAST(l_quantity AS BIGINT) * 100 + CAST(l_linenumber AS BIGINT) * 150 AS e FROM lineitem)"""


@register(
    "caption_merge",
    f"""WITH RECURSIVE {CAPTIONS_SQL},{greedy_sql("captions", "audio_id", 100, 3000, "seg")},
    made AS (SELECT audio_id, arg_min(seg, rn) AS first, arg_max(seg, rn) AS last, min(gs) AS s, arg_max(e, rn) AS e, count(*) AS n, string_agg('w' || seg, ' ' ORDER BY rn) AS text FROM grouped GROUP BY audio_id, g)
    SELECT audio_id || '-' || lpad(CAST(first AS VARCHAR), 5, '0') || '-' || lpad(CAST(last AS VARCHAR), 5, '0') AS merged_utt_id, s / 100.0::DOUBLE AS start_sec, e / 100.0::DOUBLE AS end_sec, text, CAST(n AS INTEGER) AS n
    FROM made WHERE e - s BETWEEN 300 AND 3000""",
)
def caption_merge(spark, sf):
    start = F.col("l_quantity").cast("long") * 100
    captions = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("audio_id"), F.col("l_linenumber").alias("seg"), start.alias("start_cs"), (start + F.col("l_linenumber").cast("long") * 150).alias("end_cs"),
        F.concat(F.lit("w"), F.col("l_linenumber").cast("string")).alias("text"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("utt_id"),
    )
    return iv.merge_captions(captions).select("merged_utt_id", "start_sec", "end_sec", "text", F.size("merged_from").alias("n"))


SPLIT_SQL = """
pieces AS (
  SELECT user_id, event_id, i AS part, s + i * 30.0::DOUBLE AS s, least(CAST(e AS DOUBLE), s + (i + 1) * 30.0::DOUBLE) AS e
  FROM (SELECT *, unnest(range(CAST(ceil((e - s) / 30.0::DOUBLE) AS BIGINT))) AS i FROM timeline WHERE e > s)
)"""


@register("hard_split", f"WITH {TIMELINE_SQL},{SPLIT_SQL} SELECT user_id, event_id, CAST(part AS INTEGER) AS part, s, e FROM pieces")
def hard_split(spark, sf):
    return iv.hard_split(timeline(spark, sf)).select("user_id", "event_id", "part", F.col("s").cast("double").alias("s"), F.col("e").cast("double").alias("e"))


@register(
    "chunk_merge",
    f"""WITH RECURSIVE {TIMELINE_SQL},{SPLIT_SQL},{greedy_sql("pieces", "user_id", 1.0, 30.0, "event_id, part")},
    made AS (SELECT user_id, g, min(gs) AS s, arg_max(e, rn) AS e, count(*) AS n, min(rn) AS first_rn FROM grouped GROUP BY user_id, g)
    SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY s, first_rn) - 1 AS INTEGER) AS chunk_index, s, e, CAST(n AS INTEGER) AS n FROM made WHERE e - s >= 3""",
)
def chunk_merge(spark, sf):
    rows = timeline(spark, sf).withColumns({"s": F.col("s").cast("double"), "e": F.col("e").cast("double")}).drop("label")
    return iv.chunk(rows, "user_id", order="event_id")


@register(
    "interval_union",
    f"""WITH {TIMELINE_SQL}, r AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM timeline)
    SELECT user_id, CAST(sum(greatest(0, e - greatest(s, coalesce(pm, s)))) AS BIGINT) AS covered FROM r GROUP BY user_id""",
)
def interval_union(spark, sf):
    return iv.union_length(timeline(spark, sf), "user_id", "s", "e", "event_id").select("user_id", F.col("covered").cast("long").alias("covered"))


@register(
    "gap_complement",
    f"""WITH {TIMELINE_SQL}, ends AS (SELECT user_id, max(e) + 1000 AS d FROM timeline GROUP BY user_id),
    a AS (SELECT user_id, s, e, event_id, 0 AS k FROM timeline UNION ALL SELECT user_id, d, d, NULL, 1 FROM ends),
    r AS (SELECT *, coalesce(max(e) OVER (PARTITION BY user_id ORDER BY k, s, e, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM a)
    SELECT user_id, CAST(c AS BIGINT) AS gap_start, CAST(s AS BIGINT) AS gap_end FROM r WHERE s - c >= 3""",
)
def gap_complement(spark, sf):
    events = timeline(spark, sf)
    lengths = events.groupBy("user_id").agg((F.max("e") + 1000).alias("d"))
    return iv.gaps(events, lengths, "user_id", "s", "e", "event_id", "d")


@register(
    "padded_intervals",
    """SELECT l_orderkey, l_linenumber, greatest(0.0::DOUBLE, l_quantity - 0.2::DOUBLE) AS s, least(40.0::DOUBLE, l_quantity + l_linenumber + 0.2::DOUBLE) AS e FROM lineitem
    WHERE least(40.0::DOUBLE, l_quantity + l_linenumber + 0.2::DOUBLE) - greatest(0.0::DOUBLE, l_quantity - 0.2::DOUBLE) >= 3""",
)
def padded_intervals(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("s"), (F.col("l_quantity") + F.col("l_linenumber")).alias("e"), F.lit(40.0).alias("d"))
    return iv.pad(rows).drop("d")


@register(
    "neighbour_bounds",
    f"""WITH {TIMELINE_SQL}, w AS (SELECT *, lag(e) OVER k AS pe, lead(s) OVER k AS ns, row_number() OVER k AS rn FROM timeline WINDOW k AS (PARTITION BY user_id ORDER BY s, event_id))
    SELECT event_id, greatest(0::DOUBLE, least(500::DOUBLE, CASE WHEN rn = 1 THEN CAST(s AS DOUBLE) ELSE greatest(0, s - pe)::DOUBLE END - 0.001::DOUBLE)) AS max_left,
      greatest(0::DOUBLE, least(500::DOUBLE, CASE WHEN ns IS NULL THEN 1000::DOUBLE ELSE greatest(0, ns - e)::DOUBLE END - 0.001::DOUBLE)) AS max_right FROM w""",
)
def neighbour_bounds(spark, sf):
    return iv.neighbour_bounds(timeline(spark, sf), "user_id", "s", "e", "event_id", 500.0).select("event_id", "max_left", "max_right")


@register(
    "region_islands",
    f"""WITH {TIMELINE_SQL}, ends AS (SELECT user_id, max(s) + 1.0::DOUBLE AS d FROM timeline GROUP BY user_id),
    w AS (SELECT t.*, d, lag(label) OVER k AS pl, lag(s) OVER k AS ps FROM timeline t JOIN ends USING (user_id) WINDOW k AS (PARTITION BY user_id ORDER BY s, event_id)),
    b AS (SELECT *, CASE WHEN ps IS NULL THEN 0::DOUBLE ELSE least((ps + 1.0::DOUBLE + s) / 2, d) END AS st FROM w WHERE ps IS NULL OR label <> pl)
    SELECT user_id, st AS start, coalesce(lead(st) OVER (PARTITION BY user_id ORDER BY s, event_id), d) AS "end", label FROM b""",
)
def region_islands(spark, sf):
    events = timeline(spark, sf)
    ends = events.groupBy("user_id").agg((F.max("s") + 1.0).alias("d"))
    return iv.regions(events.join(ends, "user_id"), "user_id", "s", "label", "d", "event_id")


@register(
    "leading_run",
    f"""WITH {TIMELINE_SQL}, r AS (SELECT user_id, label, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) AS rn FROM timeline)
    SELECT user_id, CAST(coalesce(min(CASE WHEN label = 'purchase' THEN rn END) - 1, count(*)) AS INTEGER) AS run FROM r GROUP BY user_id""",
)
def leading_run(spark, sf):
    labels = timeline(spark, sf).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("s", "event_id", "label"))).alias("x"))
    return labels.select("user_id", iv.leading_run(F.transform("x", lambda v: v["label"]), "purchase").alias("run"))


@register(
    "nearest_silence",
    """WITH v AS (SELECT o_orderkey, o_totalprice / 10000.0::DOUBLE AS b, [2.0::DOUBLE, 5.0::DOUBLE, 5.5::DOUBLE, 9.0::DOUBLE, 21.0::DOUBLE] AS mids FROM orders),
    u AS (SELECT o_orderkey, b, unnest(mids) AS m, unnest(range(5)) AS i FROM v),
    n AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY abs(m - b), i) AS rn FROM u)
    SELECT o_orderkey, CASE WHEN abs(m - b) <= 0.75::DOUBLE THEN m ELSE b END AS snapped FROM n WHERE rn = 1""",
)
def nearest_silence(spark, sf):
    mids = F.array(*map(F.lit, (2.0, 5.0, 5.5, 9.0, 21.0)))
    return table(spark, sf, "orders").select("o_orderkey", iv.snap(F.col("o_totalprice") / 10000.0, mids).alias("snapped"))


@register(
    "segments_in_window",
    """WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity AS s, l_quantity + l_linenumber AS e FROM lineitem)
    SELECT l_orderkey, (SELECT arg_min(s, l_linenumber * 1000 + s) FROM l i WHERE i.l_orderkey = o.l_orderkey AND s BETWEEN 10 AND 30) AS first_start,
      (SELECT arg_max(e, l_linenumber * 1000 + s) FROM l i WHERE i.l_orderkey = o.l_orderkey AND e BETWEEN 10 AND 30) AS last_end FROM (SELECT DISTINCT l_orderkey FROM l) o""",
)
def segments_in_window(spark, sf):
    part = F.struct("l_linenumber", F.col("l_quantity").alias("start"), (F.col("l_quantity") + F.col("l_linenumber")).alias("end"))
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(part)).alias("x"))
    return rows.select("l_orderkey", iv.first_start(F.col("x"), F.lit(10), F.lit(30)).alias("first_start"), iv.last_end(F.col("x"), F.lit(10), F.lit(30)).alias("last_end"))


@register(
    "drop_overlaps",
    f"""WITH RECURSIVE {TIMELINE_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) AS rn FROM timeline),
    k AS (SELECT user_id, event_id, s, e, rn, e AS reach, TRUE AS kept FROM r WHERE rn = 1
      UNION ALL SELECT r.user_id, r.event_id, r.s, r.e, r.rn, CASE WHEN r.s >= k.reach THEN r.e ELSE k.reach END, r.s >= k.reach FROM k JOIN r ON r.user_id = k.user_id AND r.rn = k.rn + 1)
    SELECT user_id, event_id, s, e FROM k WHERE kept""",
)
def drop_overlaps(spark, sf):
    return iv.drop_overlaps(timeline(spark, sf), "user_id", "s", "e", "event_id")


@register(
    "windows_of_clips",
    """SELECT l_orderkey, l_linenumber, len(range(0, CAST(greatest(l_quantity * 10 - 10, 0) AS BIGINT) + 1, 5)) AS hops, len(list_filter([0, 10, 20, 30, 40], lambda x: CAST(l_quantity * 10 AS BIGINT) - x >= 5)) AS steps FROM lineitem""",
)
def windows_of_clips(spark, sf):
    n = (F.col("l_quantity") * 10).cast("int")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.size(iv.hopping(n, 10, 5)).cast("long").alias("hops"), F.size(iv.tumbling(n, 10, 5, 5)).cast("long").alias("steps"))


def _order(key: str) -> str:
    return f"md5('42:' || {key})"


@register(
    "quota_sample",
    f"""WITH r AS (SELECT doc_id, source, n_chars, sum(n_chars) OVER (PARTITION BY source ORDER BY {_order("doc_id")}, doc_id ROWS UNBOUNDED PRECEDING) AS cum FROM documents)
    SELECT doc_id, source, n_chars FROM r WHERE cum - n_chars < 20000""",
)
def quota_sample(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return sampling.until_quota(docs, "source", "doc_id", "n_chars", 20_000)


@register(
    "stratified_topup",
    f"""WITH {MANIFEST_SQL}, b AS (SELECT utterance_id, source, CASE WHEN source = 'src3' THEN 'random' WHEN coalesce(is_clipped, FALSE) OR rms_dbfs < -45 OR silence_ratio > 0.6::DOUBLE THEN 'outlier' ELSE 'normal' END AS bucket FROM manifest),
    n AS (SELECT *, row_number() OVER (PARTITION BY source, bucket ORDER BY {_order("utterance_id")}, utterance_id) AS nth, count(*) FILTER (WHERE bucket = 'outlier') OVER (PARTITION BY source) AS outliers FROM b)
    SELECT utterance_id, source, bucket FROM n WHERE nth <= CASE bucket WHEN 'random' THEN 20 WHEN 'outlier' THEN 16 ELSE 20 - least(outliers, 16) END""",
)
def stratified_topup(spark, sf):
    df = manifest(spark, sf).select("utterance_id", "source", "quality_flags")
    return sampling.stratified(df, "source", "utterance_id", sampling.is_outlier(F.col("quality_flags")), 20, 0.8, ["src3"]).select("utterance_id", "source", "bucket")


@register("seeded_sample", f"SELECT doc_id, source FROM documents ORDER BY {_order('doc_id')}, doc_id LIMIT 100")
def seeded_sample(spark, sf):
    return sampling.sample(table(spark, sf, "documents").select("doc_id", "source"), "doc_id", 100)


# Joins


@register(
    "sidecar_merge_lastwins",
    """WITH v1 AS (SELECT user_id, arg_max(event_type, event_id) AS kind, arg_max(value, event_id) AS value FROM events WHERE event_id % 2 = 0 GROUP BY user_id),
    v2 AS (SELECT user_id, arg_max(event_type, event_id) AS kind FROM events WHERE event_id % 3 = 0 AND event_type <> 'error' GROUP BY user_id)
    SELECT c_custkey, coalesce(v2.kind, v1.kind) AS whole_clip_top1, v1.value AS whole_clip_hu_prob, v1.user_id IS NOT NULL AS with_v1, v2.user_id IS NOT NULL AS with_v2
    FROM customer LEFT JOIN v1 ON c_custkey = v1.user_id LEFT JOIN v2 ON c_custkey = v2.user_id""",
)
def sidecar_merge_lastwins(spark, sf):
    from .. import schemas

    events = table(spark, sf, "events")
    entry = events.select(F.col("user_id").alias("c_custkey"), "event_id", F.col("event_type").alias("whole_clip_top1"), F.col("value").alias("whole_clip_hu_prob"))
    v1 = readers.last_wins(entry.filter("event_id % 2 = 0"), "c_custkey", "event_id")
    v2 = readers.last_wins(entry.filter("event_id % 3 = 0 AND whole_clip_top1 <> 'error'").drop("whole_clip_hu_prob"), "c_custkey", "event_id")
    rows = table(spark, sf, "customer").select("c_custkey", m.structure(schemas.FLAGS).alias("quality_flags"))
    merged = merging.merge_flags(rows, {"v1": v1, "v2": v2}, key="c_custkey")
    return merged.select("c_custkey", "quality_flags.whole_clip_top1", "quality_flags.whole_clip_hu_prob", "with_v1", "with_v2")


@register(
    "override_join",
    f"""WITH {MANIFEST_SQL} SELECT utterance_id, CASE WHEN source = 'src1' AND l.doc_id IS NOT NULL THEN '/cut/' || m.doc_id ELSE audio_path END AS audio_path,
      CASE WHEN source = 'src1' AND l.doc_id IS NOT NULL THEN 'ogg' END AS codec FROM manifest m LEFT JOIN labels l ON m.doc_id = l.doc_id""",
)
def override_join(spark, sf):
    cut = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("utterance_id"), F.concat(F.lit("/cut/"), F.col("doc_id").cast("string")).alias("audio_path"))
    return m.override_audio(manifest(spark, sf), cut, "src1", standalone=True).select("utterance_id", "audio_path", "codec")


@register(
    "priority_lookup",
    """WITH r AS (SELECT doc_id AS path, 'validated' AS status, 0 AS k, quality AS score FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 'invalidated', 1, toxic FROM labels WHERE toxic = 1
      UNION ALL SELECT doc_id, 'other', 2, 7 FROM documents WHERE doc_id % 2 = 0)
    SELECT path, arg_min(status, k) AS status, arg_min(score, k) AS score FROM r GROUP BY path""",
)
def priority_lookup(spark, sf):
    labels, docs = table(spark, sf, "labels"), table(spark, sf, "documents")
    path = F.col("doc_id").alias("path")
    return m.prioritized(
        {
            "validated": labels.filter("quality = 1").select(path, F.col("quality").alias("score")),
            "invalidated": labels.filter("toxic = 1").select(path, F.col("toxic").alias("score")),
            "other": docs.filter("doc_id % 2 = 0").select(path, F.lit(7).alias("score")),
        },
        "path", "status",
    )


@register("pending_work", "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def pending_work(spark, sf):
    return merging.pending(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), "doc_id")


@register("scope_semi", "SELECT doc_id, source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1)")
def scope_semi(spark, sf):
    return merging.within(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels").filter("toxic = 1"), "doc_id")


@register(
    "train_split",
    f"WITH {MANIFEST_SQL} SELECT utterance_id, 'train' AS set_membership FROM manifest m WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = m.doc_id AND quality = 0)",
)
def train_split(spark, sf):
    held = table(spark, sf, "labels").filter("quality = 0").select(F.col("doc_id").cast("string").alias("utterance_id"))
    return sampling.train_set(manifest(spark, sf), held).select("utterance_id", "quality_flags.set_membership")


@register(
    "version_diff",
    """WITH a AS (SELECT user_id, CAST(sum(event_id) AS BIGINT) AS v FROM events WHERE event_type = 'error' GROUP BY user_id), b AS (SELECT user_id, CAST(sum(event_id) AS BIGINT) AS v FROM events WHERE event_type = 'signup' GROUP BY user_id)
    SELECT coalesce(a.user_id, b.user_id) AS user_id, CASE WHEN a.user_id IS NULL THEN 'only_b' WHEN b.user_id IS NULL THEN 'only_a' ELSE 'common' END AS side, a.v AS a_value, b.v AS b_value FROM a FULL JOIN b ON a.user_id = b.user_id""",
)
def version_diff(spark, sf):
    events = table(spark, sf, "events")
    return merging.compare_versions(events.filter("event_type = 'error'"), events.filter("event_type = 'signup'"), "user_id", "event_id")


@register("common_ids", "SELECT DISTINCT user_id FROM events WHERE event_type = 'error' INTERSECT SELECT user_id FROM events WHERE event_type = 'purchase'")
def common_ids(spark, sf):
    events = table(spark, sf, "events")
    ids = lambda kind: events.filter(F.col("event_type") == kind).select("user_id")
    return ids("error").intersect(ids("purchase"))


@register(
    "union_manifests",
    "SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, CAST(NULL AS VARCHAR) AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
)
def union_manifests(spark, sf):
    a = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    b = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    return m.union(a, b)


@register(
    "canonical_variant",
    """WITH f AS (SELECT p_partkey, p_partkey // 5 AS base, p_partkey % 2 = 1 AS low, CASE p_partkey % 3 WHEN 0 THEN '.mp3' WHEN 1 THEN '.ogg' ELSE '.flac' END AS ext FROM part),
    r AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY low, CASE ext WHEN '.flac' THEN 5 WHEN '.mp3' THEN 2 ELSE 1 END DESC, p_partkey) AS rn FROM f)
    SELECT p_partkey, 't' || base AS base, 't' || base || CASE WHEN low THEN '_64kb' ELSE '' END || ext AS name FROM r WHERE rn = 1""",
)
def canonical_variant(spark, sf):
    key = F.col("p_partkey")
    ext = F.element_at(F.array(F.lit(".mp3"), F.lit(".ogg"), F.lit(".flac")), (key % 3 + 1).cast("int"))
    name = F.concat(F.lit("t"), F.expr("cast(p_partkey div 5 as string)"), F.when(key % 2 == 1, "_64kb").otherwise(""), ext)
    rows = table(spark, sf, "part").select("p_partkey", name.alias("name"), key.alias("position"))
    return readers.canonical_variants(rows).select("p_partkey", "base", "name")


@register(
    "parent_lookup",
    "SELECT s_suppkey, n_name AS title, coalesce(n_name, s_name) AS shown FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_nationkey < 20",
)
def parent_lookup(spark, sf):
    files = table(spark, sf, "supplier").select("s_suppkey", "s_name", F.concat_ws("/", F.lit("/a"), "s_nationkey", F.lit("x.mp3")).alias("path"))
    items = table(spark, sf, "nation").filter("n_nationkey < 20").select(F.col("n_nationkey").cast("string").alias("identifier"), F.col("n_name").alias("title"))
    return merging.lookup_parent(files, items, "path", "identifier").select("s_suppkey", "title", merging.either(F.col("title"), F.col("s_name")).alias("shown"))
