"""Readers: JSONL in three strictness levels, TSV and CSV variants, key-value text, media."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import ship
from .writers import QUOTED

CORRUPT = "_corrupt_record"
#: A line's place among all lines of its input, whatever tasks read it.
ORDINAL = "line_ordinal"


def jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Strict: a malformed line fails the read; blank lines are passed over."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def jsonl_checked(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Every line, a malformed one as nulls with its text in ``_corrupt_record``."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def jsonl_tolerant(spark: SparkSession, path: str | list[str], schema: T.StructType, key: str = "utterance_id") -> DataFrame:
    """Malformed lines and lines without a key are dropped; the last line of each key wins.

    A line that holds none of the other fields doesn't replace an earlier one.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = numbered_lines(spark, path)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = lines.select(F.from_json("value", full, options).alias("r"), ORDINAL).filter(F.col(f"r.{CORRUPT}").isNull()).select("r.*", ORDINAL).drop(CORRUPT)
    values = [f for f in schema.fieldNames() if f != key]
    held = F.coalesce(*[F.col(v).isNotNull() & F.lit(True) for v in values]) if len(values) == 1 else F.greatest(*[F.col(v).isNotNull() for v in values])
    return last_wins(rows.filter(F.col(key).isNotNull() & (F.col(key) != "") & held), key, ORDINAL)


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value`` and its ordinal: by file, split and place in the split."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    return spark.read.text(path).select("value", place.alias(ORDINAL)).filter(F.trim("value") != "")


def last_wins(df: DataFrame, key: str | Sequence[str], ordinal: str) -> DataFrame:
    """One row per key: the one with the highest ordinal; combines before it shuffles."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in (*keys, ordinal)]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordinal).alias("row")).select(*keys, "row.*")


def done_ids(spark: SparkSession, path: str, key: str = "utterance_id") -> DataFrame:
    """The ids a sidecar already holds, error rows included; malformed lines are ignored."""
    ids = jsonl_checked(spark, path, T.StructType([T.StructField(key, T.StringType())]))
    return ids.filter(F.col(key).isNotNull()).select(key).distinct()


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def _header(spark: SparkSession, path: str) -> list[str]:
    """The cells of the first line of the first file by name; a scan of several takes the largest first."""
    first = spark.read.format("binaryFile").load(path).filter("length > 0").agg(F.min("path")).first()[0]
    lines = spark.read.text(first).limit(1).collect() if first else []
    return lines[0]["value"].split("\t") if lines else []


def tsv_map(spark: SparkSession, path: str, key: str, columns: Sequence[str]) -> DataFrame:
    """A TSV without quoting as (key, columns): the last line of a key wins.

    Cells a short line lacks are empty; a line that lacks the key is passed over; a missing
    file, or one without the key column, has no rows; unknown columns are left out.
    """
    wanted = T.StructType([T.StructField(c, T.StringType()) for c in (key, *columns)])
    if not exists(spark, path) or key not in (header := _header(spark, path)):
        return spark.createDataFrame([], wanted)
    cells = numbered_lines(spark, path).filter(F.col("value") != "\t".join(header)).select(F.split("value", "\t", -1).alias("c"), ORDINAL)
    cell = lambda name: F.coalesce(F.get("c", F.lit(header.index(name))), F.lit(""))
    rows = cells.filter(F.size("c") > header.index(key)).select(cell(key).alias(key), *[cell(c).alias(c) for c in columns if c in header], ORDINAL)
    return last_wins(rows, key, ORDINAL) if len(rows.columns) > 2 else rows.select(key).distinct()


def tsv_keys(spark: SparkSession, path: str, key: str = "path") -> DataFrame:
    """The distinct values of a TSV's key column, by default of its first column."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"`{key}` string")
    header = _header(spark, path)
    at = header.index(key) if key in header else 0
    cells = spark.read.text(path).filter(F.col("value") != "\t".join(header)).select(F.split("value", "\t", -1).alias("c"))
    return cells.filter(F.size("c") > at).select(F.get("c", F.lit(at)).alias(key)).distinct()


def tsv_millis(spark: SparkSession, path: str) -> DataFrame:
    """(clip, duration_ms) of lines whose second cell is digits."""
    cells = spark.read.text(path).select(F.split("value", "\t", -1).alias("c")).filter((F.size("c") >= 2) & F.get("c", F.lit(1)).rlike("^[0-9]+$"))
    return cells.select(F.get("c", F.lit(0)).alias("clip"), F.get("c", F.lit(1)).cast("long").alias("duration_ms"))


def tsv_quoted(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A quoted TSV with a header and cells of any length; a cell without anything is null, one of two quotes an empty text."""
    # Nulls are told apart from empty texts by a value that no cell has.
    reader = spark.read.options(sep="\t", multiLine=True, maxCharsPerColumn=-1, nullValue=uuid.uuid4().hex, **QUOTED)
    return (reader.schema(schema) if schema else reader).csv(path)


def alignment(spark: SparkSession, path: str, suffix: str = "_hu") -> DataFrame:
    """(event_id, segment_no, uid, start_sec, end_sec) of events with the suffix and numeric bounds."""
    rows = spark.read.option("sep", "\t").option("header", True).csv(path)
    bounds = [F.col(c).try_cast("double").alias(f"{c}_sec") for c in ("start", "end")]
    uid = F.concat_ws("_", "event_id", "segment_no")
    return rows.filter(F.col("event_id").endswith(suffix)).select("event_id", "segment_no", uid.alias("uid"), *bounds).dropna(subset=["start_sec", "end_sec"])


#: In order of preference.
TRANSCRIPTION_COLUMNS = ("transcription_kenlm", "transcription_beam", "transcription_greedy", "transcription")


def transcriptions(spark: SparkSession, path: str) -> DataFrame:
    """(file, raw): the first transcription column of a CSV that isn't empty."""
    rows = spark.read.options(multiLine=True, **QUOTED).csv(path)
    found = [F.nullif(F.col(c), F.lit("")) for c in TRANSCRIPTION_COLUMNS if c in rows.columns]
    return rows.select("file", F.coalesce(*found, F.lit("")).alias("raw"))


def key_values(spark: SparkSession, path: str, kind: str = "string") -> DataFrame:
    """(uid, value) of lines ``key rest``; values that don't parse as ``kind`` are dropped."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    uid, rest = F.split_part("value", F.lit(" "), F.lit(1)), F.trim(F.regexp_extract("value", r"^[^ ]* (.*)$", 1))
    rows = lines.select(uid.alias("uid"), rest.alias("value"))
    return rows if kind == "string" else rows.select("uid", F.col("value").try_cast(kind).alias("value")).filter("value IS NOT NULL")


def captions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(audio_id, utt_id, text) of JSON array files of {audio_id, text: {utt_id: text}}."""
    schema = T.StructType().add("audio_id", "string").add("text", T.MapType(T.StringType(), T.StringType()))
    return spark.read.schema(schema).option("multiLine", True).json(path).select("audio_id", F.explode("text").alias("utt_id", "text"))


def registry(spark: SparkSession, path: str) -> DataFrame:
    """(source, item, attribute, value) of a YAML registry of sources; a small driver-side file."""
    import yaml

    text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
    rows = []
    for source, entry in (yaml.safe_load(text) or {}).get("sources", {}).items():
        for name, value in entry.items():
            if name == "items":
                rows += [(source, item.get("identifier"), k, None if v is None else str(v)) for item in value or [] for k, v in item.items()]
            else:
                rows.append((source, None, name, None if value is None else str(value)))
    return spark.createDataFrame(rows, "source string, item string, attribute string, value string")


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length) of files under a folder at any depth; contents aren't read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return listing.select("path", "length")


def uid_list(spark: SparkSession, path: str) -> DataFrame:
    """(utterance_id) of a text file's lines that aren't blank; a missing file has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], "utterance_id string")
    return spark.read.text(path).select(F.trim("value").alias("utterance_id")).filter("utterance_id <> ''").distinct()


def parquet_rows(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """``columns`` with shard (file name) and row_index, a row's place in its shard."""
    shards = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return shards.select(*columns, F.col("_metadata.file_name").alias("shard"), F.col("_metadata.row_index").alias("row_index"))


def rows_at(wanted: DataFrame, shards: DataFrame) -> DataFrame:
    """Rows of ``parquet_rows`` at the (shard, row_index) pairs of ``wanted``."""
    return shards.join(wanted, ["shard", "row_index"])


WAV_INFO = T.StructType().add("codec", "string").add("sample_rate", "long").add("channels", "long").add("duration_sec", "double")


def binary_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, content) of files under a folder at any depth."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "content")


def probe(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, info) of audio files from their headers; info is null where they can't be read."""
    return probed(binary_files(spark, path, glob)).drop("content")


def probed(rows: DataFrame) -> DataFrame:
    """``rows`` (path, content) with the files' info, in one pass for what else reads the content."""
    ship(rows.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from ..functions import media

        kind = pa.struct([("codec", pa.string()), ("sample_rate", pa.int64()), ("channels", pa.int64()), ("duration_sec", pa.float64())])
        for batch in batches:
            found = [media.probe(bytes(content.as_buffer())) for content in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], ["path", "content", "info"])

    return rows.select("path", "content").mapInArrow(run, T.StructType().add("path", "string").add("content", "binary").add("info", WAV_INFO))


def audio(rows: DataFrame, content: str = "content", rate: int = 16_000) -> DataFrame:
    """``rows`` with pcm (mono floats at ``rate``) in place of encoded bytes; null where they can't be decoded.

    Codecs other than WAV are decoded by what ``functions.media.DECODERS`` has in the worker.
    """
    from ..functions import media

    ship(rows.sparkSession)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(column):
        import pandas as pd

        return pd.Series([None if x is None else media.decode(bytes(x), rate) for x in column])

    return rows.withColumn("pcm", run(F.col(content))).drop(content)


#: Preference of file types, the highest first.
EXTENSIONS = {".flac": 5, ".wav": 4, ".opus": 3, ".mp3": 2, ".ogg": 1, ".m4a": 1}
BITRATE = r"_(?:\d+kb(?:ps)?|VBR|vbr)$"


def canonical_variants(listing: DataFrame, name: str = "name", group: Sequence[str] = ()) -> DataFrame:
    """One file per title: no bitrate variant if there is another, then the preferred type, then the first.

    ``listing`` has a ``position`` for ties; files of other types are left out.
    """
    suffix = F.lower(F.regexp_extract(name, r"(\.[^./]+)$", 1))
    stem = F.regexp_replace(F.regexp_extract(name, r"([^/]*)$", 1), r"\.[^./]+$", "")
    rank = F.coalesce(*[F.when(suffix == e, F.lit(r)) for e, r in EXTENSIONS.items()])
    rows = listing.withColumn("rank_", rank).filter("rank_ IS NOT NULL").withColumn("base", F.regexp_replace(stem, BITRATE, "")).withColumn("variant_", stem.rlike(BITRATE))
    best = Window.partitionBy(*group, "base").orderBy("variant_", F.desc("rank_"), "position")
    return rows.withColumn("nth_", F.row_number().over(best)).filter("nth_ = 1").drop("nth_", "rank_", "variant_")


def first_present(spark: SparkSession, *paths: str) -> str | None:
    """The first path that exists: a newer generation of a table, or the one before."""
    return next((p for p in paths if exists(spark, p)), None)
