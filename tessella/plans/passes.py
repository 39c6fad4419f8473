"""Queries of second passes, runs that go on where others ended, emitters, and encoded audio."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import signal
from ..operators import aggregates as ag
from ..operators import consensus as cs
from ..operators import manifest as m
from ..operators import merging, sampling
from ..sources import readers as r
from ..sources import writers as w
from ..streaming import incremental
from .files import through
from .tables import table

ORACLES, QUERIES = {}, {}


def keep(name: str, sql: str):
    """As ``files.register``, into this module's tables."""

    def inner(function):
        QUERIES[name], ORACLES[name] = function, sql
        return function

    return inner


@keep("second_pass", "SELECT d.doc_id, d.source, l.toxic AS bucket, l.quality AS weight FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def second_pass(spark, sf):
    """The labelled documents, with what the selection knows of them; each was selected twice."""
    selection = table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("bucket"), F.col("quality").alias("weight"))
    again = selection.withColumn("bucket", F.col("bucket") + 1)
    return merging.second_pass(table(spark, sf, "documents").select("doc_id", "source"), again.union(selection), "bucket", "weight", key="doc_id")


@keep(
    "bucket_totals",
    """WITH p AS (SELECT event_type AS bucket, CAST(user_id % 7 AS VARCHAR) AS source, floor(value) AS sec FROM events)
    SELECT bucket, source, count(*) AS n, sum(sec) / 3600.0::DOUBLE AS hours, 'source' AS of FROM p GROUP BY bucket, source UNION ALL SELECT bucket, NULL, count(*), round(sum(sec) / 3600.0::DOUBLE, 6), 'bucket' FROM p GROUP BY bucket""",
)
def bucket_totals(spark, sf):
    """The buckets' sums are rounded, as they add up sums of sources."""
    rows = table(spark, sf, "events").select(F.col("event_type").alias("bucket"), (F.col("user_id") % 7).cast("string").alias("source"), F.floor("value").cast("double").alias("duration_sec"))
    return ag.bucket_totals(rows, "bucket").withColumn("hours", F.when(F.col("of") == "bucket", F.round("hours", 6)).otherwise(F.col("hours")))


@keep("pending_outputs", "SELECT s_suppkey FROM supplier WHERE s_acctbal < 1000")
def pending_outputs(spark, sf):
    """Suppliers whose file is missing or empty."""
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    name = F.concat(F.col("s_suppkey").cast("string"), F.lit(".ogg"))
    listing = rows.filter("s_acctbal >= 0").select(F.concat(F.lit("/out/x/"), name).alias("path"), F.when(F.col("s_acctbal") < 1000, 0).otherwise(5).alias("length"))
    return merging.without_output(rows, listing, name).select("s_suppkey")


#: path, and its place below /data/set.
PATHS = {"a/b.ogg": "a/b.ogg", "../x": None, "/data/set/x/../y": "y", "/data/sets/x": None, ".//a/./b": "a/b", "a/../../set/c": "c", "/data/set": None, "": None, "/data/set/../set/d": "d", "../../data/set/e/": "e"}


@keep(
    "sandboxed_paths",
    f"SELECT o_orderkey, CASE o_orderkey % {len(PATHS)} " + " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(PATHS.values())) + " END AS place FROM orders",
)
def sandboxed_paths(spark, sf):
    path = F.get(F.array(*map(F.lit, PATHS)), (F.col("o_orderkey") % len(PATHS)).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", m.within_root(path, "/data/set/").alias("place"))


@keep("safe_names", "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g') AS safe, replace(url, '/', '__') AS file_id FROM pages")
def safe_names(spark, sf):
    return table(spark, sf, "pages").select("page_id", m.safe_name(F.col("url")).alias("safe"), m.file_id(F.col("url")).alias("file_id"))


@keep("dev_eligible", "SELECT c_custkey, c_mktsegment <> 'BUILDING' OR coalesce(c_acctbal > 0, FALSE) AS eligible FROM customer")
def dev_eligible(spark, sf):
    source = F.when(F.col("c_mktsegment") == "BUILDING", m.COMMON_VOICE).otherwise(F.col("c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", sampling.dev_eligible(source, F.when(F.col("c_acctbal") > 0, "validated")).alias("eligible"))


@keep("added_criteria", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'vp_labeled_hf_test' WHEN o_orderpriority LIKE '1%' THEN 'urgent' END AS criterion FROM orders")
def added_criteria(spark, sf):
    """A criterion of one's own after the built-in one."""
    source = F.when(F.col("o_orderstatus") == "F", "voxpopuli_hu_labeled").otherwise("other")
    found = sampling.test_criterion(source, F.lit("test"), [("urgent", F.col("o_orderpriority").startswith("1"))])
    return table(spark, sf, "orders").select("o_orderkey", found.alias("criterion"))


@keep(
    "inspected_spans",
    """WITH s AS (SELECT CAST(user_id AS VARCHAR) AS utterance_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS nth, event_type AS a, CAST(event_id AS VARCHAR) AS b FROM events)
    SELECT utterance_id, nth, a, b FROM s ORDER BY md5('42:' || utterance_id || ':' || nth), utterance_id, nth LIMIT 20""",
)
def inspected_spans(spark, sf):
    """Events as the spans of their user; the sample is a listing of 20."""
    span = F.struct("event_id", F.lit("replace").alias("op"), F.col("event_type").alias("a"), F.col("event_id").cast("string").alias("b"))
    rows = table(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("utterance_id")).agg(F.struct(F.array_sort(F.collect_list(span)).alias("spans")).alias("verdict"))
    return cs.inspect(rows).select("utterance_id", "nth", "a", "b")


@keep("remerged_flags", "SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic, l.doc_id IS NOT NULL AS hit FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def remerged_flags(spark, sf):
    """Merging what is merged already changes nothing."""
    flags = F.struct(F.lit(-1).alias("quality"), F.lit(-1).alias("toxic"))
    rows, sidecar = table(spark, sf, "documents").select("doc_id", flags.alias("quality_flags")), table(spark, sf, "labels")
    once = merging.merge_flags(rows, {"labels": sidecar}, key="doc_id").drop("with_labels")
    return merging.merge_flags(once, {"labels": sidecar}, key="doc_id").select("doc_id", "quality_flags.*", F.col("with_labels").alias("hit"))


# Runs


def scored(run: int, fails: bool):
    """Scores of a run; some of the first run's are errors."""
    error = F.when((F.col("value") > 50) & F.lit(fails), "timeout")
    return lambda df: df.select("utterance_id", F.lit(run).alias("run"), error.alias("error"))


def work(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(F.col("event_id").cast("string").alias("utterance_id"), "value", "event_type")


FIRST = "event_type = 'click'"


@keep("resumed_scores", f"SELECT CAST(event_id AS VARCHAR) AS utterance_id, CASE WHEN {FIRST} THEN 1 ELSE 2 END AS run, CASE WHEN {FIRST} AND value > 50 THEN 'timeout' END AS error FROM events")
def resumed_scores(spark, sf):
    """The second run scores what the first didn't; the first's errors stay."""
    rows = work(spark, sf)

    def write(path: str) -> None:
        incremental.append_new(rows.filter(FIRST), scored(1, True), path)
        incremental.append_new(rows, scored(2, False), path)

    return through(spark, "scores", write, lambda p: spark.read.parquet(p))


@keep("forced_scores", "SELECT CAST(event_id AS VARCHAR) AS utterance_id, 2 AS run, NULL AS error FROM events")
def forced_scores(spark, sf):
    """A forced run scores everything anew."""
    rows = work(spark, sf)

    def write(path: str) -> None:
        incremental.append_new(rows.filter(FIRST), scored(1, True), path)
        incremental.append_new(rows, scored(2, False), path, force=True)

    return through(spark, "scores", write, lambda p: spark.read.parquet(p))


@keep("retried_errors", f"SELECT CAST(event_id AS VARCHAR) AS utterance_id, CASE WHEN {FIRST} AND value <= 50 THEN 1 ELSE 2 END AS run FROM events")
def retried_errors(spark, sf):
    """The opposite of the default: rows with an error are scored again."""
    rows = work(spark, sf)

    def write(path: str) -> None:
        incremental.append_new(rows.filter(FIRST), scored(1, True), path)
        incremental.append_new(rows, scored(2, False), path, retry_errors="error")

    return through(spark, "scores", write, lambda p: spark.read.parquet(p).filter("error IS NULL").select("utterance_id", "run"))


@keep("followed_files", "SELECT s_suppkey, s_name FROM supplier")
def followed_files(spark, sf):
    """Four files, one a micro-batch, and nothing more when it is run again."""
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name")

    def write(path: str) -> None:
        rows.repartitionByRange(4, "s_suppkey").write.parquet(f"{path}/in")
        follow = lambda: incremental.follow(spark, f"{path}/in", rows.schema, lambda df: df, f"{path}/out", f"{path}/state", per_trigger=1)
        follow()
        if follow():
            raise RuntimeError("files were scored twice")

    return through(spark, "stream", write, lambda p: spark.read.parquet(f"{p}/out").select("s_suppkey", "s_name"))


@keep("unfinished_units", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 2")
def unfinished_units(spark, sf):
    """Units of work without an entry among the finished ones."""
    units = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return through(spark, "done", lambda p: units.filter("n_regionkey = 2").select("n_nationkey").write.parquet(p), lambda p: incremental.unit_done(spark, units, p, "n_nationkey").select("n_nationkey", "n_name"))


# Emitters

ITEMS = """items AS (SELECT o_orderkey AS k, CAST(o_custkey % 50 + 1 AS DOUBLE) AS sec, CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'N' ELSE 'R' END AS kind, o_orderpriority < '3' AS gold FROM orders)"""


def items(spark, sf) -> DataFrame:
    """Orders as clips of 1 to 50 s."""
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 50 + 1).cast("double").alias("sec"), F.when(status == "F", "A").when(status == "O", "N").otherwise("R").alias("kind"), (F.col("o_orderpriority") < "3").alias("gold")
    )


@keep(
    "emit_web_segments",
    f"""WITH {ITEMS}, w AS (SELECT *, 'v' || k || '-00001-' || lpad(CAST(CAST(sec * 100 AS BIGINT) AS VARCHAR), 8, '0') || '-' || lpad(CAST(CAST(sec * 200 AS BIGINT) AS VARCHAR), 8, '0') AS uid FROM items)
    SELECT uid AS utterance_id, 'v' || k AS source_item_id, 'w/' || uid || '.wav' AS relative_audio_path, CASE WHEN kind = 'A' THEN 7.5::DOUBLE ELSE sec END AS duration_sec, sec AS segment_start_sec, 'cap ' || kind AS caption,
      'YouTube video v' || k || ' (CC-BY, YODAS hu000 manual caption)' AS attribution FROM w WHERE kind <> 'N'""",
)
def emit_web_segments(spark, sf):
    """Segment files with a caption; where no length is listed, it follows from the id."""
    hundredths = lambda by: F.lpad((F.col("sec") * by).cast("long").cast("string"), 8, "0")
    uid = F.concat_ws("-", F.concat(F.lit("v"), F.col("k").cast("string")), F.lit("00001"), hundredths(100), hundredths(200))
    rows = items(spark, sf).select(uid.alias("uid"), "kind")
    wavs = rows.select(F.concat(F.lit("/r/w/"), "uid", F.lit(".wav")).alias("path"))
    texts = rows.filter("kind <> 'N'").select("uid", F.concat(F.lit("cap "), "kind").alias("value"))
    listed = rows.filter("kind = 'A'").select("uid", F.lit(7.5).alias("value"))
    found = m.web_segments(wavs, texts, listed, "/r")
    return found.select("utterance_id", "source_item_id", "relative_audio_path", "duration_sec", "segment_start_sec", F.col("transcripts.source_caption").alias("caption"), "attribution")


@keep(
    "emit_merged_captions",
    """SELECT o_orderkey || '-00001-00002' AS utterance_id, CAST(o_orderkey AS VARCHAR) AS source_item_id, '/r/a/' || o_orderkey || '.wav' AS audio_path, 5.0::DOUBLE AS duration_sec, 1.0::DOUBLE AS segment_start_sec, o_orderpriority AS caption, 2 AS merged
    FROM orders WHERE o_orderstatus <> 'P'""",
)
def emit_merged_captions(spark, sf):
    """Clips whose recording has a file, under the first of two paths."""
    orders, key = table(spark, sf, "orders"), F.col("o_orderkey").cast("string")
    merged = orders.select(
        key.alias("audio_id"), F.concat(key, F.lit("-00001-00002")).alias("merged_utt_id"), F.lit(1.0).alias("start_sec"), F.lit(6.0).alias("end_sec"), F.lit(5.0).alias("duration_sec"),
        F.col("o_orderpriority").alias("text"), F.array(F.lit("x"), F.lit("y")).alias("merged_from"), F.lit(9.0).alias("video_duration_sec"),
    )
    wavs = orders.filter("o_orderstatus <> 'P'").select(F.explode(F.array(*[F.concat(F.lit(f"/r/{d}/"), key, F.lit(".wav")) for d in "ab"])).alias("path"))
    found = m.merged_captions(merged, wavs, "/r")
    return found.select("utterance_id", "source_item_id", "audio_path", "duration_sec", "segment_start_sec", F.col("transcripts.source_caption").alias("caption"), F.size("quality_flags.merged_from").alias("merged"))


@keep(
    "emit_labeled",
    f"""WITH {ITEMS} SELECT 'voxpopuli_hu_labeled/' || k AS utterance_id, CASE WHEN kind = 'N' THEN NULL ELSE sec END AS duration_sec, CASE WHEN gold THEN 'test' ELSE 'validation' END AS split, CASE WHEN gold THEN 'HIGH' ELSE 'UNKNOWN' END AS confidence_level
    FROM items WHERE kind = 'N' OR sec BETWEEN 3 AND 30""",
)
def emit_labeled(spark, sf):
    """Rows of shards, of acceptable or unknown length."""
    rows = items(spark, sf).withColumn("audio_id", F.col("k").cast("string"))
    shards = rows.select(
        "audio_id", F.lit("t").alias("raw_text"), F.lit("t").alias("normalized_text"), F.col("gold").alias("is_gold_transcript"), F.lit("f").alias("gender"), F.lit("s").alias("speaker_id"),
        F.when(F.col("gold"), "/r/test-0.parquet").otherwise("/r/validation-0.parquet").alias("path"), F.col("k").cast("int").alias("row_index"),
    )
    durations = rows.filter("kind <> 'N'").select("audio_id", F.col("sec").alias("duration_sec"))
    return m.labeled(shards, durations, "/r").select("utterance_id", "duration_sec", "split", "confidence_level")


def probed(spark, sf, path) -> DataFrame:
    info = F.struct(F.lit("mp3").alias("codec"), F.lit(44_100).cast("long").alias("sample_rate"), F.lit(2).cast("long").alias("channels"), F.when(F.col("p_size") > 10, F.col("p_size").cast("double")).otherwise(0.0).alias("duration_sec"))
    return table(spark, sf, "part").select(path.alias("path"), info.alias("info"), "p_partkey", "p_brand", "p_type")


@keep(
    "emit_archive_files",
    """SELECT p_brand || '/' || p_partkey AS utterance_id, p_brand AS source_item_id, CAST(p_size AS DOUBLE) AS duration_sec, CASE WHEN p_brand < 'Brand#2' THEN 'CC-BY-4.0' ELSE 'CC-BY' END AS license, coalesce(CASE WHEN p_brand < 'Brand#3' THEN 'Title of ' || p_brand END, p_brand) || ' (archive.org: ' || p_brand || ')' AS attribution
    FROM part WHERE p_size > 10""",
)
def emit_archive_files(spark, sf):
    """Files under their item's folder; an item may lack an entry, an entry a licence."""
    path = F.concat(F.lit("/r/"), "p_brand", F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".mp3"))
    brand = F.col("p_brand")
    items = table(spark, sf, "part").select("p_brand").distinct().filter(brand < "Brand#3").select(
        brand.alias("identifier"), F.concat(F.lit("Title of "), brand).alias("title"), F.when(brand < "Brand#2", "https://creativecommons.org/licenses/by/4.0/").otherwise("").alias("license_url")
    )
    found = m.archive_files(probed(spark, sf, path), items, "librivox_hu", "CC-BY (varies)", "audiobook", "read", "/r")
    return found.select("utterance_id", "source_item_id", "duration_sec", "license", "attribution")


@keep("emit_sessions", "SELECT 'voxpopuli_hu_unlabeled/' || p_partkey AS utterance_id, p_type AS year, CAST(p_size AS DOUBLE) AS duration_sec, 'European Parliament ' || p_type || ' HU (VoxPopuli unlabeled, CC0)' AS attribution FROM part WHERE p_size > 10")
def emit_sessions(spark, sf):
    path = F.concat(F.lit("/r/"), "p_type", F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".ogg"))
    return m.sessions(probed(spark, sf, path), "/r").select("utterance_id", "quality_flags.year", "duration_sec", "attribution")


@keep("emit_resegmented", "SELECT 'o' || o_orderkey AS utterance_id, '20' || (10 + o_custkey % 10) || '-' || o_custkey AS source_item_id, o_totalprice AS duration_sec, 'https://dl.fbaipublicfiles.com/voxpopuli/audios/hu_20' || (10 + o_custkey % 10) || '.tar' AS source_url, 16000 AS sample_rate FROM orders")
def emit_resegmented(spark, sf):
    parent = F.concat(F.lit("20"), (10 + F.col("o_custkey") % 10).cast("string"), F.lit("-"), F.col("o_custkey").cast("string"))
    none = lambda kind: F.lit(None).cast(kind)
    sidecar = table(spark, sf, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("utterance_id"), parent.alias("parent_session_id"), F.lit("/r/x.ogg").alias("audio_path"), none("string").alias("audio_format"),
        none("int").alias("sample_rate"), none("int").alias("channels"), F.col("o_totalprice").alias("duration_sec"), F.lit(0.0).alias("segment_start_sec"), F.lit(1.0).alias("segment_end_sec"), F.lit(0.2).alias("padding_sec"),
    )
    return m.resegmented(sidecar).select("utterance_id", "source_item_id", "duration_sec", "source_url", "sample_rate")


# Encoded audio

RATE = 160


@keep(
    "wav_files",
    """WITH q AS (SELECT list_transform(embedding, lambda x: CAST(round_even(greatest(-1, least(1, CAST(x AS DOUBLE))) * 32767, 0) AS DOUBLE) / 32768) AS x FROM embeddings)
    SELECT 'pcm_s16le' AS codec, 160 AS sample_rate, 1 AS channels, 0.4::DOUBLE AS duration_sec, 32 AS n, x[1] AS first, x[3] AS second, x[63] AS last FROM q""",
)
def wav_files(spark, sf):
    """Each vector written as a WAV file, probed, and decoded at half its rate."""
    content = signal.encode_wav(RATE)(F.col("embedding"))
    files = table(spark, sf, "embeddings").select(content.cast("string").alias("value"))

    def read(path: str) -> DataFrame:
        # Small files are packed by their cost to open into tasks of some 30 each; these are put together.
        rows = r.binary_files(spark, path, "part-*").coalesce(8 * spark.sparkContext.defaultParallelism)
        at = lambda i: F.get("pcm", F.lit(i)).cast("double")
        found = r.audio(r.probed(rows), rate=RATE // 2)
        return found.select("info.*", F.size("pcm").alias("n"), at(0).alias("first"), at(1).alias("second"), at(31).alias("last"))

    return through(spark, "wav", lambda p: w.one_file_each(files, p), read)


@keep("encoded_clips", "SELECT 'c' || vec_id || '_x.wav' AS name, 44 + 2 * len(embedding) AS bytes FROM embeddings")
def encoded_clips(spark, sf):
    """Clips as rows of a name and a file's bytes."""
    rows = table(spark, sf, "embeddings").select(F.concat(F.lit("c"), F.col("vec_id").cast("string"), F.lit("/x")).alias("utterance_id"), F.col("embedding").alias("pcm"))
    return through(spark, "clips", lambda p: w.wav_clips(rows, p, RATE), lambda p: spark.read.parquet(p).select("name", F.octet_length("bytes").cast("long").alias("bytes")))
