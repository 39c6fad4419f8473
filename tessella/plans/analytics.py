"""Queries of scorecards, statistics, validation, text, consensus and signals."""

from __future__ import annotations

from pyspark.sql import functions as F


from ..functions import signal
from ..functions import text as tx
from ..operators import aggregates as ag
from ..operators import consensus as cs
from ..operators import manifest as m
from ..operators import scorers, validation
from ..runtime import spread
from ..streaming import incremental
from .tables import MANIFEST_SQL, TIMELINE_SQL, manifest, table

WITH = f"WITH {MANIFEST_SQL}"
QUERIES, ORACLES = {}, {}


def register(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return keep


@register(
    "source_scorecard",
    """SELECT source, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars, count(l.doc_id) AS labelled, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic,
      count(*) FILTER (WHERE n_chars < 200) AS too_short, count(*) FILTER (WHERE n_chars >= 5000) AS too_long, CAST(sum(quality) AS DOUBLE) / count(quality) AS quality_mean
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY source""",
)
def source_scorecard(spark, sf):
    """Labels joined to documents and summed up by source: one pass over two columns of each."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    rows = docs.join(table(spark, sf, "labels").withColumnRenamed("doc_id", "l_id"), F.col("doc_id") == F.col("l_id"), "left")
    return rows.groupBy("source").agg(
        F.count("*").alias("documents"), F.sum("n_chars").alias("chars"), F.count("l_id").alias("labelled"), F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("toxic") == 1).alias("toxic"),
        F.count_if(F.col("n_chars") < 200).alias("too_short"), F.count_if(F.col("n_chars") >= 5000).alias("too_long"), (F.sum("quality") / F.count("quality")).alias("quality_mean"),
    )


SCORES = """count(*) AS count, sum(duration_sec) / 3600.0::DOUBLE AS hours, count(source_caption) AS with_text, count(*) FILTER (WHERE too_short) AS too_short, count(*) FILTER (WHERE too_long) AS too_long,
  count(*) FILTER (WHERE any_hallucination_flag) AS halluc_flagged, count(*) FILTER (WHERE coalesce(lid_top1, lid) <> 'hu') AS lid_not_hu, count(rms_dbfs) AS with_tier1, count(vad_speech_ratio) AS with_vad,
  count(coalesce(lid_top1, lid)) AS with_lid, count(dnsmos_ovrl) AS with_dnsmos, count(*) FILTER (WHERE is_clipped) AS is_clipped, count(*) FILTER (WHERE silence_ratio >= 0.5::DOUBLE) AS silence_high,
  count(*) FILTER (WHERE vad_speech_ratio < 0.3::DOUBLE) AS vad_speech_ratio_lt_0_3, count(*) FILTER (WHERE vad_speech_ratio >= 0.7::DOUBLE) AS vad_speech_ratio_ge_0_7,
  count(*) FILTER (WHERE dnsmos_ovrl >= 3) AS dnsmos_ovrl_ge_3, count(*) FILTER (WHERE dnsmos_ovrl < 2) AS dnsmos_ovrl_lt_2"""


@register("scorecard_rollup", f"{WITH} SELECT source, {SCORES}, CASE WHEN source IS NULL THEN count(*) - count(source_caption) END AS audio_only FROM manifest GROUP BY ROLLUP (source)")
def scorecard_rollup(spark, sf):
    return ag.scorecard(manifest(spark, sf)).drop("dnsmos_ovrl_mean")


@register(
    "build_stats",
    f"""{WITH} SELECT source, count(*) AS count, sum(duration_sec) / 3600.0::DOUBLE AS hours, count(*) FILTER (WHERE source_caption <> '') AS with_text, count(*) FILTER (WHERE too_short) AS too_short,
      count(*) FILTER (WHERE too_long) AS too_long, count(*) FILTER (WHERE any_hallucination_flag) AS halluc_flagged, count(*) FILTER (WHERE coalesce(lid_top1, lid) <> 'hu') AS lid_not_hu FROM manifest GROUP BY ROLLUP (source)""",
)
def build_stats(spark, sf):
    return ag.build_stats(manifest(spark, sf))


@register("session_stats", f"{WITH} SELECT source, count(*) AS count, sum(duration_sec) / 3600.0::DOUBLE AS hours FROM manifest GROUP BY ROLLUP (source)")
def session_stats(spark, sf):
    return ag.session_stats(manifest(spark, sf))


@register("sidecar_coverage", "SELECT source, count(*) AS total, count(l.doc_id) AS labels, count(*) FILTER (WHERE d.doc_id % 2 = 0) AS even FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY source")
def sidecar_coverage(spark, sf):
    from ..operators.merging import attach

    docs = table(spark, sf, "documents").select("doc_id", "source")
    even = docs.filter("doc_id % 2 = 0").select("doc_id", F.lit(1).alias("one"))
    return ag.coverage(attach(docs, {"labels": table(spark, sf, "labels"), "even": even}, "doc_id"), ("labels", "even"))


@register(
    "duration_histogram",
    """WITH b AS (SELECT CASE WHEN x < 3 THEN '0-3' WHEN x < 5 THEN '3-5' WHEN x < 10 THEN '5-10' WHEN x < 15 THEN '10-15' WHEN x < 20 THEN '15-20' WHEN x < 30 THEN '20-30' ELSE '30+' END AS label FROM (SELECT o_totalprice / 10000 AS x FROM orders))
    SELECT label, count(*) AS n, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percent FROM b GROUP BY label""",
)
def duration_histogram(spark, sf):
    return ag.histogram(table(spark, sf, "orders"), F.col("o_totalprice") / 10000)


RANKED = "WITH r AS (SELECT {g}{v} AS v, row_number() OVER ({p}ORDER BY {v}) - 1 AS i, count(*) OVER ({q}) AS n FROM {t} WHERE {v} IS NOT NULL)"


@register(
    "quartiles",
    RANKED.format(g="", v="l_extendedprice", p="", q="", t="lineitem")
    + " SELECT max(n) AS n, min(v) AS min, max(CASE WHEN i = n // 4 THEN v END) AS p25, max(CASE WHEN i = n // 2 THEN v END) AS median, max(CASE WHEN i = 3 * n // 4 THEN v END) AS p75, max(v) AS max FROM r",
)
def quartiles(spark, sf):
    return ag.at_rank(table(spark, sf, "lineitem"), "l_extendedprice", ag.quarter_ranks())


@register(
    "pct_nearest_rank",
    RANKED.format(g="source, ", v="n_chars", p="PARTITION BY source ", q="PARTITION BY source", t="documents")
    + " SELECT source, max(n) AS n, max(CASE WHEN i = round_even(0.25::DOUBLE * (n - 1), 0) THEN v END) AS p25, max(CASE WHEN i = round_even(0.5::DOUBLE * (n - 1), 0) THEN v END) AS p50, max(CASE WHEN i = round_even(0.9::DOUBLE * (n - 1), 0) THEN v END) AS p90 FROM r GROUP BY source",
)
def pct_nearest_rank(spark, sf):
    return ag.at_rank(table(spark, sf, "documents"), "n_chars", {f"p{p}": ag.nearest_rank(p) for p in (25, 50, 90)}, ["source"])


@register(
    "pct_floor_index",
    RANKED.format(g="event_type, ", v="value", p="PARTITION BY event_type ", q="PARTITION BY event_type", t="events")
    + " SELECT event_type, max(n) AS n, max(CASE WHEN i = floor(0.1::DOUBLE * n) THEN v END) AS p10, max(CASE WHEN i = floor(0.9::DOUBLE * n) THEN v END) AS p90 FROM r GROUP BY event_type",
)
def pct_floor_index(spark, sf):
    return ag.at_rank(table(spark, sf, "events"), "value", {"p10": ag.floor_rank(0.1), "p90": ag.floor_rank(0.9)}, ["event_type"])


@register("median_by_group", "SELECT source, count(n_chars) AS n, avg(n_chars) AS mean, median(n_chars) AS median FROM documents GROUP BY source")
def median_by_group(spark, sf):
    return ag.distribution(table(spark, sf, "documents"), "n_chars", ["source"])


@register(
    "sessions_by_year",
    "SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, count(DISTINCT o_custkey) AS sessions, count(*) AS segments, CAST(count(*) AS DOUBLE) / count(DISTINCT o_custkey) AS per_session FROM orders GROUP BY 1",
)
def sessions_by_year(spark, sf):
    orders = table(spark, sf, "orders")
    return ag.session_counts(orders.select(F.concat_ws("-", F.year("o_orderdate").cast("string"), "o_custkey").alias("event_id")))


PRICE_TIER = "CASE WHEN {0} <= 0.02::DOUBLE THEN 'GOLD' WHEN {0} <= 0.05::DOUBLE THEN 'HIGH' WHEN {0} <= 0.10::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END"


def tiered(spark, sf):
    items = table(spark, sf, "lineitem")
    return items.select(cs.tier(F.col("l_discount")).alias("raw"), cs.tier(F.col("l_tax")).alias("final"), cs.duration_bucket(F.col("l_quantity")).alias("bucket"))


TIERED = f"WITH t AS (SELECT {PRICE_TIER.format('l_discount')} AS raw, {PRICE_TIER.format('l_tax')} AS final, CASE WHEN l_quantity IS NULL THEN 'unknown' WHEN l_quantity < 5 THEN '<5s' WHEN l_quantity < 10 THEN '5-10s' WHEN l_quantity < 20 THEN '10-20s' ELSE '20-30s' END AS bucket FROM lineitem)"


@register("tier_shares", f"{TIERED} SELECT raw AS value, count(*) AS n, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percent FROM t GROUP BY raw")
def tier_shares(spark, sf):
    return ag.shares(tiered(spark, sf), "raw")


@register("tier_crosstab", f"{TIERED} SELECT raw, " + ", ".join(f"count(*) FILTER (WHERE final = '{t}') AS \"{t}\"" for t in cs.TIER_NAMES) + " FROM t GROUP BY raw")
def tier_crosstab(spark, sf):
    return ag.transitions(tiered(spark, sf), "raw", "final", cs.TIER_NAMES)


@register("gold_by_bucket", f"{TIERED} SELECT bucket, count(*) AS n, count(*) FILTER (WHERE raw = 'GOLD') AS gold, 100.0::DOUBLE * count(*) FILTER (WHERE raw = 'GOLD') / count(*) AS percent FROM t GROUP BY bucket")
def gold_by_bucket(spark, sf):
    return ag.gold_share(tiered(spark, sf), "raw", "bucket")


@register("promotions", f"{TIERED} SELECT count(*) FILTER (WHERE raw <> 'GOLD' AND final = 'GOLD') AS promoted, count(*) AS n, 100.0::DOUBLE * count(*) FILTER (WHERE raw <> 'GOLD' AND final = 'GOLD') / count(*) AS percent FROM t")
def promotions(spark, sf):
    return ag.promoted(tiered(spark, sf), "raw", "final")


@register(
    "adjudicated_tiers",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount * 10 = 0 THEN 'GOLD' WHEN l_discount * 10 > 0.5::DOUBLE THEN 'LOW' WHEN l_linenumber % 4 = 0 AND l_linenumber > 0 THEN 'GOLD-via-kenlm'
      WHEN l_linenumber % 4 = 1 THEN 'HIGH' WHEN l_linenumber % 4 >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS tier FROM lineitem""",
)
def adjudicated_tiers(spark, sf):
    nth = F.col("l_linenumber")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", cs.adjudicated_tier(F.col("l_discount") * 10, nth, nth % 4).alias("tier"))


@register(
    "cut_rates",
    """WITH a AS (SELECT event_type AS source, CASE WHEN event_id % 17 = 0 THEN 'bad' END AS err, event_id % 13 = 0 AS ns, event_id % 2 = 0 AS cs, event_id % 3 = 0 AS ce, event_id % 4 = 0 AS ms, event_id % 6 = 0 AS me FROM events)
    SELECT source, count(*) AS total, count(err) AS errors, count(*) FILTER (WHERE err IS NULL AND ns) AS no_speech, """
    + ", ".join(
        f"100.0::DOUBLE * count(*) FILTER (WHERE err IS NULL AND NOT ns AND ({c})) / count(*) AS {n}_pct"
        for n, c in {"cut_start": "cs", "cut_end": "ce", "either_cut": "cs OR ce", "both_cut": "cs AND ce", "mw_start": "ms", "mw_end": "me", "mw_either": "ms OR me"}.items()
    )
    + " FROM a GROUP BY source",
)
def cut_rates(spark, sf):
    n = F.col("event_id")
    audits = table(spark, sf, "events").select(
        F.col("event_type").alias("source"), F.when(n % 17 == 0, "bad").alias("boundary_audit_error"), (n % 13 == 0).alias("no_speech"), (n % 2 == 0).alias("boundary_cut_start"),
        (n % 3 == 0).alias("boundary_cut_end"), (n % 4 == 0).alias("mid_word_cut_start"), (n % 6 == 0).alias("mid_word_cut_end"),
    )
    return ag.cut_rates(audits)


BOUNDS = {"l_quantity": (2.0, 49.0), "l_discount": (0.0, 0.095), "l_tax": (0.0, 0.2)}


@register(
    "range_violations",
    "WITH v AS (" + " UNION ALL ".join(f"SELECT '{c}' AS metric, l_orderkey * 10 + l_linenumber AS id FROM lineitem WHERE {c} < {lo}::DOUBLE OR {c} > {hi}::DOUBLE" for c, (lo, hi) in BOUNDS.items())
    + ") SELECT metric, count(*) AS violations, array_to_string(list_slice(list_sort(list(id)), 1, 3), ',') AS examples FROM v GROUP BY metric",
)
def range_violations(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("utterance_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    found = validation.range_violations(items, BOUNDS, prefix="")
    return found.withColumn("examples", F.array_join(F.col("examples").cast("array<string>"), ","))


@register("stats_parity", f"{WITH} SELECT count(*) AS count, sum(duration_sec) / 3600.0::DOUBLE AS hours, count(*) = 1000 AS count_ok, abs(round(sum(duration_sec) / 3600.0::DOUBLE, 2) - 670) <= 0.5::DOUBLE AS hours_ok FROM manifest")
def stats_parity(spark, sf):
    return validation.stats_parity(manifest(spark, sf), 1000, 670.0)


@register(
    "source_parity",
    """WITH a AS (SELECT source, count(*) AS count, CAST(sum(n_chars) AS DOUBLE) / 3600 AS hours FROM documents GROUP BY source), b AS (SELECT source, count(*) AS count, CAST(sum(n_chars) AS DOUBLE) / 3600 AS hours FROM documents WHERE doc_id % 50 <> 0 GROUP BY source)
    SELECT coalesce(a.source, b.source) AS source, coalesce(a.count, 0) AS count, coalesce(a.hours, 0) AS hours, coalesce(b.count, 0) AS old_count, coalesce(b.hours, 0) AS old_hours,
      coalesce(a.count, 0) = coalesce(b.count, 0) AS count_ok, abs(coalesce(a.hours, 0) - coalesce(b.hours, 0)) <= 0.05::DOUBLE AS hours_ok FROM a FULL JOIN b ON a.source = b.source""",
)
def source_parity(spark, sf):
    stats = lambda df: df.groupBy("source").agg(F.count("*").alias("count"), (F.sum("n_chars").cast("double") / 3600).alias("hours"))
    docs = table(spark, sf, "documents")
    return validation.source_parity(stats(docs), stats(docs.filter("doc_id % 50 <> 0")))


@register(
    "best_worst",
    """(SELECT c_custkey, c_acctbal, 'worst' AS side FROM customer ORDER BY c_acctbal, c_custkey LIMIT 5) UNION ALL (SELECT c_custkey, c_acctbal, 'best' AS side FROM customer ORDER BY c_acctbal DESC, c_custkey DESC LIMIT 5)""",
)
def best_worst(spark, sf):
    return validation.best_worst(table(spark, sf, "customer"), "c_acctbal", "c_custkey")


@register(
    "spot_check",
    f"""{WITH}, p AS (SELECT * FROM manifest ORDER BY md5('42:' || utterance_id), utterance_id LIMIT 200)
    SELECT 'tier1' AS sidecar, 'rms_dbfs' AS field, count(rms_dbfs) AS compared, 0 AS different FROM p
    UNION ALL SELECT 'tier1', 'silence_ratio', count(silence_ratio), count(*) FILTER (WHERE doc_id % 2 = 0) FROM p""",
)
def spot_check(spark, sf):
    df = manifest(spark, sf)
    sidecar = df.select("utterance_id", "quality_flags.rms_dbfs", (F.col("quality_flags.silence_ratio") + F.when(F.col("utterance_id") % 2 == 0, 1e-3).otherwise(1e-9)).alias("silence_ratio"))
    return validation.spot_check(df, {"tier1": sidecar})


@register("caption_changes", "SELECT count(*) AS total, count(text) AS with_caption, count(*) FILTER (WHERE text <> lower(text)) AS changed FROM documents")
def caption_changes(spark, sf):
    return ag.changed(table(spark, sf, "documents").select("text", F.lower("text").alias("fresh")), "text", "fresh")


# Text and consensus


@register(
    "normalize_text",
    r"""WITH r AS (SELECT item_id, """
    + "replace(" * len(tx.SYMBOLS)
    + "lower(text)"
    + "".join(f", '{s}', ' {w} ')" for s, w in tx.SYMBOLS.items())
    + r""" AS t FROM benchmark) SELECT item_id, trim(regexp_replace(regexp_replace(t, '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS normalized FROM r""",
)
def normalize_text(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", tx.plain_words(F.lower("text")).alias("normalized"))


@register("normalize_hu_full", None)
def normalize_hu_full(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.normalize(F.col("text")).alias("normalized"))


PAIRS = "t AS (SELECT a.conv_id, a.turn, lower(a.text) AS a, lower(b.text) AS b, a.text AS raw FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn - 1)"


def distance_sql(a: str, b: str, rows: str = "t") -> str:
    """Tables w (rows with wa, wb: lists of words) and e (w with edits and rate): each step adds a row of the table of distances."""
    split = lambda c: f"list_filter(string_split(coalesce({c}, ''), ' '), lambda x: x <> '')"
    return f"""w AS MATERIALIZED (SELECT *, row_number() OVER () AS id, {split(a)} AS wa, {split(b)} AS wb FROM {rows}),
    x AS MATERIALIZED (SELECT id, unnest(wa) AS word, unnest(range(1, len(wa) + 1)) AS i FROM w), y AS MATERIALIZED (SELECT id, unnest(wb) AS word, unnest(range(1, len(wb) + 1)) AS j FROM w),
    d AS (SELECT id, 0 AS i, unnest(range(0, len(wb) + 1)) AS j, unnest(range(0, len(wb) + 1)) AS v FROM w
      UNION ALL SELECT id, i, j, min(best - j) OVER (PARTITION BY id ORDER BY j ROWS UNBOUNDED PRECEDING) + j
      FROM (SELECT d.id, x.i, d.j, CASE WHEN d.j = 0 THEN x.i ELSE least(v + 1, lag(v) OVER (PARTITION BY d.id ORDER BY d.j) + CASE WHEN x.word = y.word THEN 0 ELSE 1 END) END AS best
        FROM d JOIN x ON x.id = d.id AND x.i = d.i + 1 LEFT JOIN y ON y.id = d.id AND y.j = d.j)),
    e AS (SELECT w.*, v AS edits, CASE WHEN len(wa) = 0 THEN CASE WHEN len(wb) = 0 THEN 0::DOUBLE ELSE 1::DOUBLE END WHEN len(wb) = 0 THEN 1::DOUBLE ELSE CAST(v AS DOUBLE) / len(wa) END AS rate FROM w JOIN d ON d.id = w.id AND i = len(wa) AND j = len(wb))"""


def turns(spark, sf):
    """Consecutive turns of conversations as two transcriptions of one clip."""
    rows = table(spark, sf, "conversations")
    second = rows.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("b"))
    return spread(rows.select("conv_id", "turn", F.col("text").alias("a")), "conv_id", "turn").join(second, ["conv_id", "turn"])


@register("word_wer", f"WITH RECURSIVE {PAIRS}, {distance_sql('a', 'b')} SELECT conv_id, turn, rate AS wer FROM e")
def word_wer(spark, sf):
    a, b = tx.words(F.lower("a")), tx.words(F.lower("b"))
    return turns(spark, sf).select("conv_id", "turn", tx.wer(a, b).alias("wer"))


@register(
    "short_wer",
    """WITH RECURSIVE w AS (SELECT l_orderkey, l_linenumber, string_split(l_returnflag || ' ' || l_linestatus || ' ' || (l_linenumber % 2), ' ') AS a, string_split(l_linestatus || ' ' || l_returnflag || ' ' || (l_partkey % 2), ' ') AS b FROM lineitem),
    d AS (SELECT l_orderkey, l_linenumber, a, b, 0 AS i, [0, 1, 2, 3] AS p FROM w
      UNION ALL SELECT l_orderkey, l_linenumber, a, b, i + 1, [i + 1, c1, c2, CASE WHEN a[i + 1] = b[3] THEN p[3] ELSE 1 + least(p[4], c2, p[3]) END]
      FROM (SELECT *, CASE WHEN a[i + 1] = b[2] THEN p[2] ELSE 1 + least(p[3], c1, p[2]) END AS c2 FROM (SELECT *, CASE WHEN a[i + 1] = b[1] THEN p[1] ELSE 1 + least(p[2], i + 1, p[1]) END AS c1 FROM d WHERE i < 3)))
    SELECT l_orderkey, l_linenumber, p[4] / 3.0::DOUBLE AS wer FROM d WHERE i = 3""",
)
def short_wer(spark, sf):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    a = F.array(flag, status, (F.col("l_linenumber") % 2).cast("string"))
    b = F.array(status, flag, (F.col("l_partkey") % 2).cast("string"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", tx.wer_short(a, b).alias("wer"))


def pillars(spark, sf):
    rows = turns(spark, sf).withColumn("utterance_id", F.concat_ws("-", "conv_id", "turn"))
    text = lambda c: rows.select("utterance_id", F.lit("conversations").alias("source"), F.lower(c).alias("normalized"))
    return text("a"), text("b"), rows.select("utterance_id", F.length("a").cast("double").alias("duration_sec"))


@register(
    "consensus_tiers",
    f"""WITH RECURSIVE {PAIRS}, {distance_sql('a', 'b')}, c AS (SELECT *, {PRICE_TIER.format('rate')} AS tier, CAST(length(raw) AS DOUBLE) AS len FROM e)
    SELECT conv_id || '-' || turn AS utterance_id, 'conversations' AS source, round_even(rate, 4) AS pairwise_wer, tier AS consensus_tier,
      CASE WHEN len IS NULL THEN 'unknown' WHEN len < 5 THEN '<5s' WHEN len < 10 THEN '5-10s' WHEN len < 20 THEN '10-20s' ELSE '20-30s' END AS duration_bucket, CASE WHEN tier = 'GOLD' THEN a END AS consensus_text FROM c""",
)
def consensus_tiers(spark, sf):
    return cs.consensus(*pillars(spark, sf))


@register("align_opcodes", None)
def align_opcodes(spark, sf):
    codes = cs.opcodes(tx.words(F.lower("a")), tx.words(F.lower("b")))
    return turns(spark, sf).select("conv_id", "turn", F.posexplode(codes).alias("nth", "c")).select("conv_id", "turn", "nth", "c.*")


@register("lm_adjudicate", None)
def lm_adjudicate(spark, sf):
    a, b, _ = pillars(spark, sf)
    rows = spread(a, "utterance_id").join(b.select("utterance_id", F.col("normalized").alias("other")), "utterance_id")
    judged = cs.adjudicated_by_counts(rows, "normalized", "other", table(spark, sf, "conversations").select(F.lower("text").alias("text")), "text")
    return judged.select("utterance_id", "verdict.text", "verdict.resolved", "verdict.unresolved", "verdict.a_wins", "verdict.b_wins")


# Signals

PCM_RATE = 160


def decibels(e: str) -> str:
    return f"20 * log10({e} + 1e-12::DOUBLE)"


SQUARES = "list_reduce(list_prepend(0::DOUBLE, {0}), lambda a, y: a + y * y)"


@register(
    "tier1_signal",
    f"""WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings),
    f AS (SELECT vec_id, x, list_transform(range(0, len(x) // 4), lambda i: 20 * log10(sqrt((x[4 * i + 1] * x[4 * i + 1] + x[4 * i + 2] * x[4 * i + 2] + x[4 * i + 3] * x[4 * i + 3] + x[4 * i + 4] * x[4 * i + 4]) / 4) + 1e-12::DOUBLE)) AS db FROM p)
    SELECT vec_id, round({decibels(f"sqrt({SQUARES.format('x')} / len(x))")}, 6) AS rms_dbfs, round({decibels("list_max(list_transform(x, lambda v: abs(v)))")}, 6) AS peak_dbfs,
      list_max(list_transform(x, lambda v: abs(v))) >= 0.9999::DOUBLE AS is_clipped, CAST(len(list_filter(db, lambda v: v < -40)) AS DOUBLE) / len(db) AS silence_ratio FROM f""",
)
def tier1_signal(spark, sf):
    """Levels rounded, as engines differ in the last digits of a logarithm."""
    found = table(spark, sf, "embeddings").select("vec_id", signal.tier1(F.col("embedding"), PCM_RATE).alias("t"))
    return found.select("vec_id", *[F.round(f"t.{c}", 6).alias(c) for c in ("rms_dbfs", "peak_dbfs")], "t.is_clipped", "t.silence_ratio")


@register("segment_slice", "SELECT vec_id, len(c) AS n, c[1] AS first, c[-1] AS last FROM (SELECT vec_id, list_slice(embedding, 17, 48) AS c FROM embeddings)")
def segment_slice(spark, sf):
    """The samples from 0.1 to 0.3 s."""
    part = signal.clip(F.col("embedding"), F.lit(0.1), F.lit(0.3), PCM_RATE)
    return table(spark, sf, "embeddings").select("vec_id", part.alias("c")).select("vec_id", F.size("c").cast("long").alias("n"), F.get("c", F.lit(0)).alias("first"), F.element_at("c", -1).alias("last"))


@register(
    "edge_audit",
    f"""WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x, list_filter(range(0, len(embedding)), lambda i: abs(embedding[i + 1]) > 0.1) AS s FROM embeddings),
    l AS (SELECT *, len(s) = 0 AS silent, s[1] AS first, len(x) - (s[-1] + 1) AS rest, sqrt({SQUARES.format("list_slice(x, 1, 16)")} / 16) AS h, sqrt({SQUARES.format("list_slice(x, len(x) - 15, len(x))")} / 16) AS t FROM p)
    SELECT vec_id, coalesce(first < 8, FALSE) AS boundary_cut_start, coalesce(rest < 8, FALSE) AS boundary_cut_end, CASE WHEN NOT silent THEN first < 8 AND 20 * log10(h) > -25 END AS mid_word_cut_start,
      CASE WHEN NOT silent THEN rest < 8 AND 20 * log10(t) > -25 END AS mid_word_cut_end, CASE WHEN NOT silent THEN first * 1000.0::DOUBLE / 160 END AS first_speech_offset_ms, CASE WHEN NOT silent THEN rest * 1000.0::DOUBLE / 160 END AS last_speech_to_end_ms,
      CASE WHEN NOT silent THEN round(20 * log10(h), 6) END AS start_100ms_rms_dbfs, CASE WHEN NOT silent THEN round(20 * log10(t), 6) END AS end_100ms_rms_dbfs, len(s) AS n_speech_segments, CASE WHEN silent THEN TRUE END AS no_speech FROM l""",
)
def edge_audit(spark, sf):
    loud = F.filter(F.transform("embedding", lambda x, i: F.when(F.abs(x) > F.lit(0.1).cast("float"), i)), lambda i: i.isNotNull())
    speech = F.transform(loud, lambda i: F.struct(i.alias("start"), (i + 1).alias("end")))
    found = table(spark, sf, "embeddings").select("vec_id", signal.edges(F.col("embedding"), speech, PCM_RATE).alias("e")).select("vec_id", "e.*")
    return found.withColumns({c: F.round(c, 6) for c in ("start_100ms_rms_dbfs", "end_100ms_rms_dbfs")})


#: Samples of a part of the clips below; four of the scorers' frames, a tenth of a second.
PART = 1600
LOUD = "l AS (SELECT vec_id, unnest(range(0, 8)) AS g, embedding FROM embeddings), k AS (SELECT vec_id, g FROM l WHERE embedding[g + 1] > 0)"


def clips(spark, sf):
    """Eight parts of 25 repeats of the vector each, the ones at which it isn't positive silent: 0.8 s."""
    part = lambda g: F.transform(F.flatten(F.array_repeat("embedding", PART // 64)), lambda x: F.when(F.get("embedding", F.lit(g)) > 0, x).otherwise(F.lit(0.0).cast("float")))
    return table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("utterance_id"), F.concat(*map(part, range(8))).alias("pcm"))


@register(
    "scored_clips",
    f"""WITH {LOUD}, m AS (SELECT *, CASE WHEN g - lag(g) OVER (PARTITION BY vec_id ORDER BY g) <= 3 THEN 0 ELSE 1 END AS new FROM k),
    n AS (SELECT *, sum(new) OVER (PARTITION BY vec_id ORDER BY g ROWS UNBOUNDED PRECEDING) AS seg FROM m), s AS (SELECT vec_id, seg, max(g) - min(g) + 1 AS parts FROM n GROUP BY vec_id, seg)
    SELECT CAST(e.vec_id AS VARCHAR) AS utterance_id, round(coalesce(sum(parts), 0) * 1600.0::DOUBLE / 12800, 4) AS vad_speech_ratio, count(parts) AS vad_num_segments, round(coalesce(sum(parts), 0) * 1600.0::DOUBLE / 16000, 3) AS vad_speech_sec, NULL AS vad_error
    FROM embeddings e LEFT JOIN s ON s.vec_id = e.vec_id GROUP BY e.vec_id""",
)
def scored_clips(spark, sf):
    return scorers.score(clips(spark, sf), scorers.SCORERS["vad"])


@register(
    "language_scores",
    """WITH p AS (SELECT vec_id, list_transform(range(0, 12800), lambda i: CASE WHEN embedding[i // 1600 + 1] > 0 THEN embedding[i % 64 + 1] < 0 ELSE FALSE END) AS neg FROM embeddings),
    r AS (SELECT vec_id, round_even(1 / (1 + exp((CAST(len(list_filter(range(1, 12800), lambda i: neg[i] <> neg[i + 1])) AS DOUBLE) / 12799 - 0.5) * 20)), 4) AS p FROM p)
    SELECT CAST(vec_id AS VARCHAR) AS utterance_id, CASE WHEN p >= 0.5 THEN 'hu' ELSE 'xx' END AS lid_top1, round_even(greatest(p, 1 - p), 4) AS lid_top1_score, p AS lid_is_hu_prob FROM r""",
)
def language_scores(spark, sf):
    return scorers.score(clips(spark, sf), scorers.SCORERS["lid"]).select("utterance_id", "lid_top1", "lid_top1_score", "lid_is_hu_prob")


@register(
    "level_scores",
    f"""WITH {LOUD}, s AS (SELECT e.vec_id, round_even(CAST(360 - 4 * count(g) AS DOUBLE) / 360, 4) AS r FROM embeddings e LEFT JOIN k ON k.vec_id = e.vec_id GROUP BY e.vec_id)
    SELECT CAST(vec_id AS VARCHAR) AS utterance_id, round_even(1 + 4 * (1 - r), 3) AS dnsmos_sig, 5.0::DOUBLE AS dnsmos_bak, round_even((1 + 4 * (1 - r) + 5) / 2, 3) AS dnsmos_ovrl FROM s""",
)
def level_scores(spark, sf):
    return scorers.score(clips(spark, sf), scorers.SCORERS["dnsmos"]).select("utterance_id", "dnsmos_sig", "dnsmos_bak", "dnsmos_ovrl")


@register("orchestrated_scores", "SELECT metric, count(*) AS n FROM embeddings, (VALUES ('tier1'), ('lid')) AS m(metric) WHERE metric <> 'lid' OR label <> 0 GROUP BY metric")
def orchestrated_scores(spark, sf):
    """Two metrics of four; one of them has scored the clips of a label before."""
    done = table(spark, sf, "embeddings").filter("label = 0").select(F.col("vec_id").cast("string").alias("utterance_id"))
    found = scorers.run_all(clips(spark, sf), {"lid": done}, only=("tier1", "lid", "vad"), skip=("vad",))
    rows = [df.select("utterance_id", F.lit(name).alias("metric")) for name, df in found.items()]
    return rows[0].union(rows[1]).groupBy("metric").agg(F.count("*").alias("n"))


@register(
    "windowed_counts",
    "SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n FROM events GROUP BY 1, 2, 3",
)
def windowed_counts(spark, sf):
    events = table(spark, sf, "events")
    counts = incremental.windowed_counts(events, "ts", "event_type", "1 day")
    return counts.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@register(
    "purity_regions",
    f"""WITH {TIMELINE_SQL}, f AS (SELECT user_id, min(s) AS f, max(e) AS l FROM timeline GROUP BY user_id),
    w AS (SELECT user_id, CAST(s - f AS DOUBLE) AS t, label, CAST(l - f AS DOUBLE) AS d FROM timeline JOIN f USING (user_id)),
    k AS (SELECT DISTINCT user_id, t, label, d FROM w), g AS (SELECT *, lag(label) OVER o AS pl, lag(t) OVER o AS pt FROM k WINDOW o AS (PARTITION BY user_id ORDER BY t)),
    b AS (SELECT *, CASE WHEN pt IS NULL THEN 0::DOUBLE ELSE least((pt + 1.0::DOUBLE + t) / 2, d) END AS st FROM g WHERE pt IS NULL OR label <> pl),
    r AS (SELECT user_id, st, lead(st) OVER o AS en, d, label, row_number() OVER o AS nth FROM b WINDOW o AS (PARTITION BY user_id ORDER BY t)),
    m AS (SELECT user_id, t AS seg, lag(t + 1) OVER (PARTITION BY user_id ORDER BY t) AS before, row_number() OVER (PARTITION BY user_id ORDER BY t) AS i, d FROM w),
    mids AS (SELECT user_id, i, (coalesce(before, 0) + seg) / 2 AS m FROM m WHERE seg > coalesce(before, 0) + 0.05::DOUBLE UNION ALL SELECT user_id, 1000000000, (max(seg) + 1 + max(d)) / 2 FROM m GROUP BY user_id HAVING max(d) > max(seg) + 1 + 0.05::DOUBLE),
    n AS (SELECT r.user_id, nth, m, row_number() OVER (PARTITION BY r.user_id, nth ORDER BY abs(m - en), i) AS rn FROM r JOIN mids ON mids.user_id = r.user_id WHERE en IS NOT NULL),
    ends AS (SELECT r.*, CASE WHEN en IS NULL THEN d WHEN m IS NOT NULL AND abs(m - en) <= 0.75::DOUBLE THEN m ELSE en END AS bound FROM r LEFT JOIN n ON n.user_id = r.user_id AND n.nth = r.nth AND rn = 1)
    SELECT CAST(user_id AS VARCHAR) AS utterance_id, round_even(CASE WHEN nth = 1 THEN st ELSE lag(bound) OVER (PARTITION BY user_id ORDER BY nth) END, 3) AS "start", round_even(bound, 3) AS "end", label AS lang,
      CAST(count(*) OVER (PARTITION BY user_id) AS BIGINT) AS n_foreign_regions FROM ends""",
)
def purity_regions(spark, sf):
    """Labels of one second in the order of their events, which the SQL leaves open."""
    from .tables import timeline

    events = timeline(spark, sf)
    first = events.groupBy("user_id").agg(F.min("s").alias("from_"), F.max("e").alias("to_"))
    windows = events.join(first, "user_id").select("event_id", F.col("user_id").cast("string").alias("utterance_id"), (F.col("s") - F.col("from_")).cast("double").alias("t"), F.col("label").alias("lang"), (F.col("to_") - F.col("from_")).cast("double").alias("d"))
    speech = windows.groupBy("utterance_id").agg(F.array_sort(F.collect_list(F.struct(F.col("t").alias("start"), (F.col("t") + 1).alias("end")))).alias("segments"))
    found = scorers.purity_second(windows, speech, "event_id")
    return found.select("utterance_id", F.inline("language_regions"), "n_foreign_regions")


@register(
    "lean_rows",
    f"""{WITH} SELECT utterance_id, source, source_caption, 'CC0-1.0' AS license, duration_sec, rms_dbfs, too_short FROM manifest""",
)
def lean_rows(spark, sf):
    """Without the caption that is normalized anew, which has number words; ``normalize_text`` has SQL for the rest of that."""
    return m.lean(manifest(spark, sf)).select("utterance_id", "source", "transcripts.source_caption", "license", "duration_sec", "quality_flags.rms_dbfs", "quality_flags.too_short")
