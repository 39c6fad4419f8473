"""Queries of the browse surface and of row projections."""

from __future__ import annotations

from pyspark.sql import functions as F


from ..operators import browse, sampling
from ..operators import manifest as m
from .tables import MANIFEST_SQL, manifest, table

WITH = f"WITH {MANIFEST_SQL}"
QUERIES, ORACLES = {}, {}


def register(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return keep


@register("corpus_stats", f"{WITH} SELECT count(*) AS rows, round(coalesce(sum(duration_sec), 0) / 3600.0::DOUBLE, 2) AS hours FROM manifest")
def corpus_stats(spark, sf):
    return browse.stats(manifest(spark, sf))


@register("facet_sources", "SELECT source AS value, count(*) AS count FROM documents GROUP BY source")
def facet_sources(spark, sf):
    return browse.facet(table(spark, sf, "documents"), "source")


@register("facet_lang_desc", "SELECT lang AS value, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def facet_lang_desc(spark, sf):
    return browse.facet(table(spark, sf, "documents"), "lang", by_count=True)


def page(spark, sf, **request):
    return browse.rows(manifest(spark, sf), browse.RowsRequest(**request))[0]


DEFAULTS = "utterance_id, source, duration_sec, audio_path, source_caption AS \"transcripts.source_caption\", CAST(NULL AS VARCHAR) AS refined_audio_path, CAST(NULL AS BIGINT) AS parquet_row_index"


@register("browse_page", f"{WITH} SELECT {DEFAULTS} FROM manifest ORDER BY utterance_id ASC LIMIT 50 OFFSET 50")
def browse_page(spark, sf):
    return page(spark, sf, page=2)


@register(
    "browse_filtered",
    f"""{WITH} SELECT utterance_id, source, duration_sec, dnsmos_ovrl AS "quality_flags.dnsmos_ovrl", audio_path, CAST(NULL AS VARCHAR) AS refined_audio_path, CAST(NULL AS BIGINT) AS parquet_row_index
    FROM manifest WHERE source IN ('src1', 'src2', 'src3') AND duration_sec >= 100 AND duration_sec <= 4000 AND dnsmos_ovrl >= 1 AND is_clipped = FALSE
    ORDER BY duration_sec DESC NULLS LAST, utterance_id LIMIT 200""",
)
def browse_filtered(spark, sf):
    return page(
        spark, sf, columns=["utterance_id", "duration_sec", "quality_flags.dnsmos_ovrl", "no.such"], sources=["src1", "src2", "src3"], minimum={"duration_sec": "100", "quality_flags.dnsmos_ovrl": 1, "missing": 3},
        maximum={"duration_sec": 4000}, equal={"quality_flags.is_clipped": "false"}, sort="duration_sec", direction="desc", page_size=999,
    )


@register("browse_search", f"{WITH} SELECT {DEFAULTS} FROM manifest WHERE utterance_id ILIKE '%th%ing%' OR source_caption ILIKE '%th%ing%' ORDER BY utterance_id LIMIT 100")
def browse_search(spark, sf):
    return page(spark, sf, search=" th%ing ", page_size=100, sort="quality_flags")


@register("browse_total", f"{WITH} SELECT count(*) AS total FROM manifest WHERE lid_top1 = 'en' AND vad_speech_ratio <= 0.5::DOUBLE")
def browse_total(spark, sf):
    return browse.rows(manifest(spark, sf), browse.RowsRequest(equal={"quality_flags.lid_top1": "en"}, maximum={"quality_flags.vad_speech_ratio": 0.5}))[1]


@register("browse_nulls_last", f"{WITH} SELECT {DEFAULTS} FROM manifest ORDER BY dnsmos_ovrl DESC NULLS LAST, utterance_id LIMIT 200")
def browse_nulls_last(spark, sf):
    return page(spark, sf, sort="quality_flags.dnsmos_ovrl", direction="desc", page_size=200)


@register("row_detail", f"{WITH} SELECT utterance_id, source, language, duration_sec, audio_path FROM manifest WHERE utterance_id = '42' LIMIT 1")
def row_detail(spark, sf):
    return browse.row(manifest(spark, sf), "42").select("utterance_id", "source", "language", "duration_sec", "audio_path")


@register("sort_guard", "SELECT * FROM (VALUES ('duration_sec', 'duration_sec'), ('quality_flags', 'utterance_id'), ('quality_flags.rms_dbfs', 'quality_flags.rms_dbfs'), ('x; DROP TABLE y', 'utterance_id')) t(asked, used)")
def sort_guard(spark, sf):
    df = manifest(spark, sf)
    return spark.createDataFrame([(a, browse.sort_column(df, a)) for a in ("duration_sec", "quality_flags", "quality_flags.rms_dbfs", "x; DROP TABLE y")], "asked string, used string")


def flat(spark, sf):
    return m.flatten(manifest(spark, sf))


@register(
    "tri_state_filters",
    f"""{WITH} SELECT utterance_id, 'halluc_no' AS filter FROM manifest WHERE any_hallucination_flag = FALSE OR any_hallucination_flag IS NULL
    UNION ALL SELECT utterance_id, 'clipped_no' FROM manifest WHERE is_clipped = FALSE
    UNION ALL SELECT utterance_id, 'halluc_yes' FROM manifest WHERE any_hallucination_flag
    UNION ALL SELECT utterance_id, 'text_no' FROM manifest WHERE source_caption IS NULL OR source_caption = ''""",
)
def tri_state_filters(spark, sf):
    df = flat(spark, sf)
    choices = {"halluc_no": {"halluc": "no"}, "clipped_no": {"is_clipped": "no"}, "halluc_yes": {"halluc": "yes"}, "text_no": {"has_text": "no"}}
    return m.union(*[df.filter(browse.flat_where(df, a)).select("utterance_id", F.lit(n).alias("filter")) for n, a in choices.items()])


@register(
    "lid_filter",
    f"""{WITH} SELECT utterance_id, coalesce(lid_top1, lid) AS qf_lid FROM manifest WHERE coalesce(lid_top1, lid) IS NOT NULL AND coalesce(lid_top1, lid) <> 'hu' AND duration_sec >= 300""",
)
def lid_filter(spark, sf):
    df = flat(spark, sf)
    return df.filter(browse.flat_where(df, {"lid": "non_hu", "duration_min": "300"})).select("utterance_id", "qf_lid")


@register(
    "foreign_filter",
    f"""{WITH} SELECT utterance_id, 'clean_hu' AS filter FROM manifest WHERE (foreign_prefix_sec IS NULL OR foreign_prefix_sec = 0) AND (whole_non_hu IS NULL OR whole_non_hu = FALSE)
    UNION ALL SELECT utterance_id, 'any_foreign' FROM manifest WHERE foreign_prefix_sec > 0 OR whole_non_hu = TRUE
    UNION ALL SELECT utterance_id, 'prefix_2' FROM manifest WHERE foreign_prefix_sec > 0 AND foreign_prefix_sec >= 2""",
)
def foreign_filter(spark, sf):
    df = flat(spark, sf)
    choices = {"clean_hu": {"foreign": "clean_hu"}, "any_foreign": {"foreign": "any_foreign"}, "prefix_2": {"foreign": "with_prefix", "foreign_prefix_min": 2}}
    return m.union(*[df.filter(browse.flat_where(df, a)).select("utterance_id", F.lit(n).alias("filter")) for n, a in choices.items()])


@register(
    "flat_page",
    f"""{WITH} SELECT utterance_id, source, duration_sec, dnsmos_ovrl AS qf_dnsmos_ovrl, vad_speech_ratio AS qf_vad_speech_ratio, coalesce(lid_top1, lid) AS qf_lid, is_clipped AS qf_is_clipped, audio_path
    FROM manifest WHERE source_caption ILIKE '%ation%' AND vad_speech_ratio >= 0.5::DOUBLE ORDER BY duration_sec DESC NULLS LAST, utterance_id LIMIT 50""",
)
def flat_page(spark, sf):
    shown, _ = browse.flat_rows(flat(spark, sf), {"q": "ation", "vad_min": 0.5, "sort": "duration_sec", "dir": "desc"})
    return shown.select("utterance_id", "source", "duration_sec", "qf_dnsmos_ovrl", "qf_vad_speech_ratio", "qf_lid", "qf_is_clipped", "audio_path")


@register(
    "flatten_manifest",
    f"""{WITH} SELECT utterance_id, source, duration_sec, coalesce(source_caption, '') <> '' AS has_text, coalesce(lid_top1, lid) AS qf_lid, too_short AS qf_too_short, too_long AS qf_too_long,
      rms_dbfs AS qf_rms_dbfs, is_clipped AS qf_is_clipped, silence_ratio AS qf_silence_ratio, any_hallucination_flag AS qf_any_hallucination_flag, foreign_prefix_sec AS qf_foreign_prefix_sec FROM manifest""",
)
def flatten_manifest(spark, sf):
    return flat(spark, sf).select(
        "utterance_id", "source", "duration_sec", "has_text", "qf_lid", "qf_too_short", "qf_too_long", "qf_rms_dbfs", "qf_is_clipped", "qf_silence_ratio", "qf_any_hallucination_flag", "qf_foreign_prefix_sec"
    )


@register(
    "text_preview",
    r"""WITH t AS (SELECT doc_id, replace(trim(coalesce(text, ''), E' \t\n\r\f' || chr(11)), chr(10), ' ') AS line FROM documents)
    SELECT doc_id, CASE WHEN length(line) > 80 THEN substr(line, 1, 79) || '…' ELSE line END AS preview FROM t""",
)
def text_preview(spark, sf):
    return table(spark, sf, "documents").select("doc_id", m.preview(F.col("text")).alias("preview"))


@register("flags_json_sorted", """SELECT doc_id, '{"lang":"' || lang || '","n_chars":"' || n_chars || '","source":"' || source || '"}' AS flags FROM documents""")
def flags_json_sorted(spark, sf):
    flags = F.create_map(F.lit("source"), F.col("source"), F.lit("n_chars"), F.col("n_chars").cast("string"), F.lit("lang"), F.col("lang"))
    return table(spark, sf, "documents").select("doc_id", m.sorted_json(flags).alias("flags"))


URL_SQL = "CASE s_suppkey % 6 WHEN 0 THEN 'HTTP://creativecommons.org/licenses/by-sa/4.0/' WHEN 1 THEN 'https://creativecommons.org/licenses/by/3.0' WHEN 2 THEN 'https://creativecommons.org/publicdomain/zero/1.0/' WHEN 3 THEN NULL WHEN 4 THEN 'https://example.org/terms' ELSE 'https://creativecommons.org/licenses/publicdomain/' END"


@register(
    "license_case",
    f"""WITH u AS (SELECT s_suppkey, lower({URL_SQL}) AS url FROM supplier)
    SELECT s_suppkey, CASE {" ".join(f"WHEN contains(url, '{stem}') THEN '{name}'" for stem, name in m.LICENSES)} ELSE 'CC-BY' END AS license FROM u""",
)
def license_case(spark, sf):
    suppliers = table(spark, sf, "supplier")
    return suppliers.select("s_suppkey", m.license_of(F.expr(URL_SQL), F.lit("CC-BY")).alias("license"))


@register(
    "source_url",
    """WITH c AS (SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'yodas2_hu000' WHEN 1 THEN 'librivox_hu' WHEN 2 THEN 'podcasts_hu_cc' WHEN 3 THEN 'voxpopuli_hu_labeled' WHEN 4 THEN 'voxpopuli_resegmented' WHEN 5 THEN 'common_voice_25_0_hu' ELSE 'other' END AS src,
      CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE '' END AS item, CASE WHEN c_custkey % 3 = 0 THEN '2009-' || c_name ELSE c_name END AS session FROM customer),
    n AS (SELECT *, CASE WHEN item <> '' THEN item ELSE session END AS it, substr(session, 1, 4) AS year FROM c)
    SELECT c_custkey, CASE WHEN src = 'yodas2_hu000' THEN 'https://www.youtube.com/watch?v=' || it WHEN src IN ('librivox_hu', 'podcasts_hu_cc') THEN 'https://archive.org/details/' || it
      WHEN src = 'voxpopuli_hu_labeled' THEN 'https://huggingface.co/datasets/facebook/voxpopuli'
      WHEN src = 'voxpopuli_resegmented' AND regexp_full_match(year, '[0-9]+') THEN 'https://dl.fbaipublicfiles.com/voxpopuli/audios/hu_' || year || '.tar'
      WHEN src = 'common_voice_25_0_hu' THEN 'https://commonvoice.mozilla.org/datasets' END AS url FROM n""",
)
def source_url(spark, sf):
    names = ["yodas2_hu000", "librivox_hu", "podcasts_hu_cc", "voxpopuli_hu_labeled", "voxpopuli_resegmented", "common_voice_25_0_hu", "other"]
    key = F.col("c_custkey")
    source = F.element_at(F.array(*map(F.lit, names)), (key % 7 + 1).cast("int"))
    item = F.when(key % 2 == 0, F.col("c_name")).otherwise("")
    session = F.when(key % 3 == 0, F.concat(F.lit("2009-"), "c_name")).otherwise(F.col("c_name"))
    return table(spark, sf, "customer").select("c_custkey", m.source_url(source, item, session).alias("url"))


@register(
    "split_from_name",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'test' WHEN 1 THEN 'dev' WHEN 2 THEN 'train' END AS split FROM part""",
)
def split_from_name(spark, sf):
    start = F.element_at(F.array(*map(F.lit, ["Test-", "validation-", "train-", "other-"])), (F.col("p_partkey") % 4 + 1).cast("int"))
    return table(spark, sf, "part").select("p_partkey", m.split_of_file(F.concat(F.lit("/a/train-b/"), start, F.lit("00000-of-00001.parquet"))).alias("split"))


@register(
    "parse_composite_id",
    """SELECT l_orderkey, l_linenumber, 'v-' || l_partkey AS video_id, l_orderkey / 100.0::DOUBLE AS start_sec, (l_orderkey + l_linenumber) / 100.0::DOUBLE AS end_sec FROM lineitem""",
)
def parse_composite_id(spark, sf):
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    start, nth = F.col("l_orderkey"), F.col("l_linenumber")
    uid = F.concat_ws("-", F.concat(F.lit("v-"), F.col("l_partkey").cast("string")), pad(nth, 5), pad(start, 8), pad(start + nth, 8))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", m.parse_id(uid).alias("p")).select("l_orderkey", "l_linenumber", "p.*")


@register(
    "session_ids",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey || '-PLENARY_hu' ELSE CAST(l_orderkey AS VARCHAR) END AS session,
      '/data/' || regexp_replace(l_orderkey || ' ' || l_returnflag || '/' || l_linenumber, '[^A-Za-z0-9._-]+', '_', 'g') AS path FROM lineitem""",
)
def session_ids(spark, sf):
    order, nth = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    uid = F.when(F.col("l_linenumber") % 2 == 0, F.concat(order, F.lit("-PLENARY_hu_"), nth)).otherwise(F.concat_ws("-", order, nth))
    name = m.safe_name(F.concat(order, F.lit(" "), F.col("l_returnflag"), F.lit("/"), nth))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", m.session_of(uid).alias("session"), F.concat(F.lit("/data/"), name).alias("path"))


@register("relative_paths", f"{WITH} SELECT utterance_id, source || '/' || utterance_id || '.wav' AS path FROM manifest")
def relative_paths(spark, sf):
    return manifest(spark, sf).select("utterance_id", m.relative(F.col("audio_path"), "/data").alias("path"))


@register("duration_window", "SELECT o_orderkey, o_totalprice / 10000 AS seconds FROM orders WHERE o_totalprice / 10000 BETWEEN 3 AND 30")
def duration_window(spark, sf):
    seconds = F.col("o_totalprice") / 10000
    return table(spark, sf, "orders").select("o_orderkey", seconds.alias("seconds")).filter(m.acceptable(F.col("seconds"), unknown=False))


@register("too_short_long", "SELECT l_orderkey, l_linenumber, l_quantity > 0 AND l_quantity < 1 AS too_short, l_quantity >= 30 AS too_long FROM lineitem")
def too_short_long(spark, sf):
    q = F.col("l_quantity")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", m.too_short(q).alias("too_short"), m.too_long(q).alias("too_long"))


@register("outlier_flag", f"{WITH} SELECT utterance_id, coalesce(is_clipped, FALSE) OR coalesce(rms_dbfs < -45, FALSE) OR coalesce(silence_ratio > 0.6::DOUBLE, FALSE) AS outlier FROM manifest")
def outlier_flag(spark, sf):
    return manifest(spark, sf).select("utterance_id", sampling.is_outlier(F.col("quality_flags")).alias("outlier"))


@register("score_class", f"{WITH} SELECT utterance_id, CASE WHEN dnsmos_ovrl IS NULL THEN 'na' WHEN dnsmos_ovrl >= 3 THEN 'good' WHEN dnsmos_ovrl >= 2 THEN 'warn' ELSE 'bad' END AS class FROM manifest")
def score_class(spark, sf):
    return manifest(spark, sf).select("utterance_id", browse.score_class(F.col("quality_flags.dnsmos_ovrl"), 3.0, 2.0).alias("class"))


@register("keep_sources", f"{WITH} SELECT utterance_id, source FROM manifest WHERE source NOT IN ('src0', 'src1') OR source IS NULL")
def keep_sources(spark, sf):
    return m.keep_sources(manifest(spark, sf), ("src0", "src1")).select("utterance_id", "source")


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END"


@register("described_schema", " UNION ALL ".join(f"SELECT '{t}' AS tab, column_name AS name, {TYPES} AS type, 0 AS subfields FROM (DESCRIBE {t})" for t in TABLES))
def described_schema(spark, sf):
    """All tables; structs are in the tests."""
    found = [{"tab": n, **c} for n in TABLES for c in browse.describe(table(spark, sf, n))]
    return spark.createDataFrame([(c["tab"], c["name"], c["type"], len(c["subfields"])) for c in found], "tab string, name string, type string, subfields int")


