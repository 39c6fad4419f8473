"""Queries of readers and writers: tables written in each form to the shared folder, and read back."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import aggregates as ag
from ..operators import validation
from ..runtime import cut, shared_dir
from ..sources import readers as r
from ..sources import writers as w
from .tables import table

QUERIES, ORACLES = {}, {}


def register(name: str, sql: str):
    def keep(function):
        QUERIES[name], ORACLES[name] = function, sql
        return function

    return keep


def through(spark: SparkSession, kind: str, write: Callable[[str], object], read: Callable[[str], DataFrame]) -> DataFrame:
    """What ``read`` finds at a fresh path that ``write`` has written to; nothing is left there."""
    path = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    write(path)
    found = cut(read(path))
    w.remove_folders(spark, path)
    return found


def lines(df: DataFrame, *columns: str | Column, sep: str = "\t") -> DataFrame:
    """Rows as lines of cells; a null cell is empty."""
    return df.select(F.array_join(F.array(*[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]), sep).alias("value"))


def constant(df: DataFrame, value: str) -> DataFrame:
    """A line for each row, all alike."""
    return df.select(F.lit(value).alias("value"))


def as_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("value"))


DOCUMENT = schemas.schema("doc_id bigint, text string, lang string, source string, n_chars bigint")
LABEL = schemas.schema("utterance_id string, quality int, toxic int")


@register("jsonl_strict", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def jsonl_strict(spark, sf):
    """Null fields are left out and come back as nulls."""
    docs = table(spark, sf, "documents")
    return through(spark, "jsonl", lambda p: w.jsonl(docs, p), lambda p: r.jsonl(spark, p, DOCUMENT))


@register("jsonl_blank_lines", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def jsonl_blank_lines(spark, sf):
    """A blank line and one of spaces after each row."""
    docs = as_json(table(spark, sf, "documents")).select(F.concat("value", F.lit("\n\n  ")).alias("value"))
    return through(spark, "jsonl", lambda p: docs.write.text(p), lambda p: r.jsonl(spark, p, DOCUMENT))


def entries(spark, sf) -> DataFrame:
    return table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("utterance_id"), "quality", "toxic")


@register("jsonl_tolerant", "SELECT CAST(doc_id AS VARCHAR) AS utterance_id, quality, toxic FROM labels")
def jsonl_tolerant(spark, sf):
    """Older entries of each key come first, then broken lines, lines without a key and without values."""
    rows = entries(spark, sf)
    older = as_json(rows.select("utterance_id", F.lit(7).alias("quality"), F.lit(7).alias("toxic")))
    bad = as_json(rows).select(F.expr("left(value, length(value) - 2)").alias("value")).union(as_json(rows.select("quality"))).union(as_json(rows.select("utterance_id")))
    return through(spark, "sidecar", lambda p: older.union(bad).union(as_json(rows)).union(bad).write.text(p), lambda p: r.jsonl_tolerant(spark, p, LABEL))


@register("done_ids", "SELECT CAST(doc_id AS VARCHAR) AS utterance_id FROM labels")
def done_ids(spark, sf):
    """Error rows count as done, a repeated id counts once, broken lines not at all."""
    rows = entries(spark, sf)
    failed = as_json(rows.filter("toxic = 1").select("utterance_id", F.lit("timeout").alias("vad_error")))
    return through(spark, "sidecar", lambda p: as_json(rows).union(failed).union(constant(rows, '{"utterance_id": "x')).write.text(p), lambda p: r.done_ids(spark, p))


@register("schema_sanity", "SELECT count(*) * 2 AS rows, count(*) FILTER (WHERE toxic = 1) + count(*) FILTER (WHERE toxic <> 1) AS bad FROM labels")
def schema_sanity(spark, sf):
    """As many broken lines as sound ones."""
    rows = entries(spark, sf)
    broken = constant(rows.filter("toxic = 1"), "{").union(constant(rows.filter("toxic <> 1"), '{"quality": [}'))
    return through(spark, "jsonl", lambda p: as_json(rows).union(broken).write.text(p), lambda p: validation.schema_sanity(r.jsonl_checked(spark, p, LABEL)))


@register("rows_by_position", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal < 0")
def rows_by_position(spark, sf):
    """Rows are looked up by the place in their shard that an index of them noted."""
    customers = table(spark, sf, "customer")

    def read(path: str) -> DataFrame:
        index = cut(r.parquet_rows(spark, path, ["c_acctbal"]).filter("c_acctbal < 0").select("shard", "row_index"))
        return r.rows_at(index, r.parquet_rows(spark, path, ["c_custkey", "c_name"])).select("c_custkey", "c_name")

    return through(spark, "shards", lambda p: customers.repartitionByRange(4, "c_custkey").write.parquet(p), read)


@register("tsv_map", "SELECT CAST(p_partkey AS VARCHAR) AS path, p_name AS sentence, p_brand AS brand FROM part")
def tsv_map(spark, sf):
    """A header in each file; the later of two lines of a key wins; short lines and lines of nothing are passed over or filled."""
    parts = table(spark, sf, "part")
    header = spark.createDataFrame([("path\tunused\tsentence\tbrand",)], "value string").coalesce(1)
    older = lines(parts, "p_partkey", F.lit("old"))
    return through(spark, "tsv", lambda p: header.union(older).union(constant(parts, "")).union(lines(parts, "p_partkey", F.lit("x"), "p_name", "p_brand")).write.text(p), lambda p: r.tsv_map(spark, p, "path", ["sentence", "brand", "missing"]).select("path", "sentence", "brand"))


@register("tsv_keys", "SELECT DISTINCT p_type AS path FROM part")
def tsv_keys(spark, sf):
    parts = table(spark, sf, "part")
    header = spark.createDataFrame([("brand\tpath",)], "value string").coalesce(1)
    return through(spark, "tsv", lambda p: header.union(lines(parts, "p_brand", "p_type")).write.text(p), lambda p: r.tsv_keys(spark, p))


@register("tsv_millis", "SELECT 'd' || doc_id || '.mp3' AS clip, n_chars AS duration_ms FROM documents WHERE lang <> 'de'")
def tsv_millis(spark, sf):
    """Lines without digits in the second cell, such as headers, are left out."""
    docs = table(spark, sf, "documents")
    cell = F.when(F.col("lang") != "de", F.col("n_chars").cast("string")).otherwise("n/a")
    return through(spark, "tsv", lambda p: lines(docs, F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".mp3")), cell, "source").write.text(p), lambda p: r.tsv_millis(spark, p))


@register("tsv_quoted", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents")
def tsv_quoted(spark, sf):
    """Texts with line breaks, tabs and quotes, of any length."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang")
    return through(spark, "tsv", lambda p: w.quoted(docs, p), lambda p: r.tsv_quoted(spark, p, docs.schema))


@register(
    "alignment",
    """SELECT user_id || '_hu' AS event_id, CAST(event_id AS VARCHAR) AS segment_no, user_id || '_hu_' || event_id AS uid, value AS start_sec, value + 1 AS end_sec
    FROM events WHERE event_type NOT IN ('click', 'view')""",
)
def alignment(spark, sf):
    """Gzip files; other languages' events, and those without a numeric bound, are left out."""
    kind, name = F.col("event_type"), F.col("user_id").cast("string")
    rows = table(spark, sf, "events").select(
        F.concat(name, F.when(kind == "click", "_de").otherwise("_hu")).alias("event_id"), F.col("event_id").cast("string").alias("segment_no"),
        F.when(kind == "view", "?").otherwise(F.col("value").cast("string")).alias("start"), (F.col("value") + 1).cast("string").alias("end"),
    )
    return through(spark, "alignment", lambda p: rows.write.options(sep="\t", header=True, compression="gzip").csv(p), lambda p: r.alignment(spark, p))


@register("transcriptions", "SELECT conv_id || '-' || turn || '.wav' AS file, CASE WHEN role = 'user' THEN text ELSE 'greedy ' || text END AS raw FROM conversations")
def transcriptions(spark, sf):
    """The better transcription where there is one."""
    rows = table(spark, sf, "conversations").select(
        F.concat(F.concat_ws("-", "conv_id", "turn"), F.lit(".wav")).alias("file"), F.lit("other").alias("duration"), F.concat(F.lit("greedy "), "text").alias("transcription_greedy"),
        F.when(F.col("role") == "user", F.col("text")).otherwise("").alias("transcription_beam"),
    )
    return through(spark, "csv", lambda p: w.quoted(rows, p, ","), lambda p: r.transcriptions(spark, p))


@register("key_values", "SELECT 'o' || o_orderkey AS uid, o_orderpriority AS value FROM orders")
def key_values(spark, sf):
    orders = table(spark, sf, "orders")
    return through(spark, "text", lambda p: lines(orders, F.concat(F.lit("o"), F.col("o_orderkey").cast("string")), "o_orderpriority", sep=" ").write.text(p), lambda p: r.key_values(spark, p))


@register("key_numbers", "SELECT 'o' || o_orderkey AS uid, o_totalprice AS value FROM orders WHERE o_orderstatus <> 'P'")
def key_numbers(spark, sf):
    """Values that aren't numbers are dropped."""
    value = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    rows = lines(table(spark, sf, "orders"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")), value, sep=" ")
    return through(spark, "text", lambda p: rows.union(constant(rows, " ")).write.text(p), lambda p: r.key_values(spark, p, "double"))


#: Recordings in a file of captions.
CAPTION_FILE = 64


@register("captions", "SELECT CAST(conv_id AS VARCHAR) AS audio_id, conv_id || '-' || turn AS utt_id, text FROM conversations WHERE text IS NOT NULL")
def captions(spark, sf):
    """Files with an array of recordings, each with its captions by id."""
    rows = table(spark, sf, "conversations").filter("text IS NOT NULL")
    own = F.map_from_entries(F.collect_list(F.struct(F.concat_ws("-", "conv_id", "turn"), "text")))
    each = rows.groupBy("conv_id").agg(own.alias("text")).select(F.floor(F.col("conv_id") / CAPTION_FILE).alias("file"), F.struct(F.col("conv_id").cast("string").alias("audio_id"), "text").alias("x"))
    files = each.groupBy("file").agg(F.to_json(F.collect_list("x")).alias("value")).select("value")
    return through(spark, "captions", lambda p: files.write.option("maxRecordsPerFile", 1).text(p), lambda p: r.captions(spark, p))


@register(
    "registry",
    """SELECT r_name AS source, NULL AS item, 'license' AS attribute, 'R' || r_regionkey AS value FROM region
    UNION ALL SELECT r_name, n_name, 'identifier', n_name FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT r_name, n_name, 'nation', CAST(n_nationkey AS VARCHAR) FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def registry(spark, sf):
    """The few regions as sources and their nations as items."""
    import yaml

    nations, sources = table(spark, sf, "nation").collect(), {}
    for region in table(spark, sf, "region").collect():
        items = [{"identifier": n["n_name"], "nation": n["n_nationkey"]} for n in nations if n["n_regionkey"] == region["r_regionkey"]]
        sources[region["r_name"]] = {"license": f"R{region['r_regionkey']}", "items": items}
    return through(spark, "registry", lambda p: w.text_file(spark, p, yaml.safe_dump({"sources": sources})), lambda p: r.registry(spark, p))


@register("file_discovery", "SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS folder, TRUE AS filled FROM customer")
def file_discovery(spark, sf):
    """Folders at any depth, by the names of their files."""
    customers = table(spark, sf, "customer").select("c_nationkey", "c_custkey")
    folder = F.regexp_extract("path", r"c_nationkey=(\d+)/[^/]*$", 1)
    read = lambda p: r.files(spark, p, "*.parquet").groupBy(folder.alias("folder")).agg((F.min("length") > 0).alias("filled"))
    return through(spark, "folders", lambda p: customers.repartition("c_nationkey").write.partitionBy("c_nationkey").parquet(p), read)


@register("uid_list", "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS utterance_id FROM orders")
def uid_list(spark, sf):
    """Ids of many rows each, among blank lines, read from what the writer of id lists wrote."""
    ids = table(spark, sf, "orders").select(F.explode(F.array(F.col("o_custkey").cast("string"), F.lit(" "))).alias("utterance_id"))
    return through(spark, "ids", lambda p: w.uids(ids, p), lambda p: r.uid_list(spark, p))


@register("published_twice", "SELECT s_suppkey, s_name FROM supplier")
def published_twice(spark, sf):
    """The second publication replaces the first as a whole."""
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name")

    def write(path: str) -> None:
        w.publish(rows.union(rows).withColumn("s_name", F.lit("old")), path, "parquet")
        w.publish(rows, path, "parquet")

    return through(spark, "published", write, lambda p: spark.read.parquet(p))


@register("appended_sidecar", "SELECT CAST(doc_id AS VARCHAR) AS utterance_id, quality, toxic FROM labels")
def appended_sidecar(spark, sf):
    """Two runs' rows, one after the other."""
    rows = entries(spark, sf)

    def write(path: str) -> None:
        w.append_sidecar(rows.filter("toxic = 1"), path)
        w.append_sidecar(rows.filter("toxic <> 1"), path)

    return through(spark, "sidecar", write, lambda p: r.jsonl(spark, p, LABEL))


@register("parquet_forms", "SELECT doc_id, lang, source, form FROM documents, (VALUES ('flat'), ('nested'), ('single')) AS f(form)")
def parquet_forms(spark, sf):
    """The three ways to write Parquet; the nested one with a struct."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    forms = {"flat": (w.flat_parquet, docs), "nested": (w.nested_parquet, docs.select("doc_id", F.struct("lang", "source").alias("s"))), "single": (w.single_parquet, docs)}
    write = lambda p: [f(df, f"{p}/{n}") for n, (f, df) in forms.items()]
    back = {"nested": ["doc_id", "s.lang", "s.source"]}

    def read(path: str) -> DataFrame:
        out = None
        for n in forms:
            rows = spark.read.parquet(f"{path}/{n}").select(*back.get(n, docs.columns), F.lit(n).alias("form"))
            out = rows if out is None else out.union(rows)
        return out

    return through(spark, "parquet", write, read)


STATISTICS = """SELECT source, count(*) AS count, round(sum(n_chars) / 3600.0::DOUBLE, 2) AS hours FROM documents GROUP BY ROLLUP (source)"""


def statistics(spark, sf) -> DataFrame:
    return ag.session_stats(table(spark, sf, "documents").select("source", F.col("n_chars").alias("duration_sec")))


def parsed(spark: SparkSession, path: str) -> DataFrame:
    """(source, count, hours) of a statistics file's sections."""
    section = json.loads(w.read_text(spark, path))["manifest"]
    rows = [(None, section["total"]), *section["by_source"].items()]
    return spark.createDataFrame([(s, v["count"], float(v["hours"])) for s, v in rows], "source string, count long, hours double")


@register("statistics_file", STATISTICS)
def statistics_file(spark, sf):
    """One row for each source comes to the driver, in both directions."""
    document = w.stats_document(statistics(spark, sf))
    return through(spark, "stats", lambda p: w.stats(spark, p, document), lambda p: parsed(spark, p))


@register("backup_once", f"SELECT source, count, hours, which FROM ({STATISTICS}), (VALUES ('first'), ('last')) AS w(which) WHERE which = 'last' OR source IS NULL")
def backup_once(spark, sf):
    """The first backup is kept; the second of two later ones isn't made."""
    rows = statistics(spark, sf)
    first, last = w.stats_document(rows.filter("source IS NULL")), w.stats_document(rows)

    def write(path: str) -> None:
        w.stats(spark, f"{path}/stats.json", first)
        made = w.backup_once(spark, f"{path}/stats.json")
        w.stats(spark, f"{path}/stats.json", last)
        if not made or w.backup_once(spark, f"{path}/stats.json"):
            raise RuntimeError("a backup was left out or replaced")

    read = lambda p: parsed(spark, f"{p}/stats.json.bak").withColumn("which", F.lit("first")).union(parsed(spark, f"{p}/stats.json").withColumn("which", F.lit("last")))
    return through(spark, "stats", write, read)


@register("markdown_report", "SELECT lang, CAST(count(*) AS VARCHAR) AS n FROM documents GROUP BY lang")
def markdown_report(spark, sf):
    """The rows of a report's table, found in its text."""
    counts = table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    cells = F.split(F.expr("trim(both '|' from value)"), r"\|")
    read = lambda p: spark.read.text(p).filter("value LIKE '| %' AND value NOT LIKE '| lang %'").select(F.nullif(F.trim(cells[0]), F.lit("")).alias("lang"), F.trim(cells[1]).alias("n"))
    return through(spark, "report", lambda p: w.text_file(spark, p, w.markdown_report("Documents", {"By language": counts})), read)


@register("first_present", "SELECT s_suppkey, 'newer' AS generation FROM supplier")
def first_present(spark, sf):
    """The newer of two generations of a table, and the older where the newer is missing."""
    rows = table(spark, sf, "supplier").select("s_suppkey")

    def read(path: str) -> DataFrame:
        newer, older, missing = f"{path}/v2", f"{path}/v1", f"{path}/v3"
        if r.first_present(spark, missing, older) != older or r.first_present(spark, missing) is not None:
            raise RuntimeError("the older generation wasn't found")
        return spark.read.parquet(r.first_present(spark, newer, older))

    def write(path: str) -> None:
        for name, generation in (("v1", "older"), ("v2", "newer")):
            rows.withColumn("generation", F.lit(generation)).write.parquet(f"{path}/{name}")

    return through(spark, "generations", write, read)
