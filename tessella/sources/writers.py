"""Writers: atomic publication, appended sidecars, Parquet variants, small driver-side files."""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def at(spark: SparkSession, path: str):
    """The file system and the path object of a path."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def publish(df: DataFrame, path: str, kind: str = "json", **options: str) -> None:
    """Write beside ``path``, then put it in place: readers see the old data or the new."""
    spark = df.sparkSession
    staged = f"{path}.tmp-{uuid.uuid4().hex}"
    df.write.format(kind).options(**options).save(staged)
    replace(spark, staged, path)


def replace(spark: SparkSession, staged: str, path: str) -> None:
    """Rename ``staged`` to ``path``, over what is there."""
    fs, old = at(spark, path)
    _, new = at(spark, staged)
    _, aside = at(spark, f"{path}.old-{uuid.uuid4().hex}")
    had = fs.exists(old)
    if had and not fs.rename(old, aside):
        raise OSError(f"{path} can't be moved aside")
    if not fs.rename(new, old):
        if had:
            fs.rename(aside, old)
        raise OSError(f"{path} can't be put in place")
    if had:
        fs.delete(aside, True)


def jsonl(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """JSON lines without null fields; with ``order`` sorted over all files."""
    publish(df.orderBy(*order) if order else df, path, "json", ignoreNullFields="true")


def append_sidecar(df: DataFrame, path: str) -> None:
    """Append scored rows; a failed run leaves what earlier runs wrote."""
    df.write.mode("append").option("ignoreNullFields", "true").json(path)


def flat_parquet(df: DataFrame, path: str) -> None:
    publish(df, path, "parquet", compression="snappy")


def nested_parquet(df: DataFrame, path: str) -> None:
    publish(df, path, "parquet", compression="zstd")


def single_parquet(df: DataFrame, path: str) -> None:
    """One file, for sets small enough to hand around."""
    publish(df.coalesce(1), path, "parquet")


def uids(df: DataFrame, path: str, key: str = "utterance_id") -> None:
    publish(df.select(F.col(key).cast("string").alias("value")), path, "text")


#: More than the number of folders from which on Spark lists them by tasks.
FOLDERS = 64


def one_file_each(df: DataFrame, path: str) -> None:
    """Each value a file of its own, below as many folders as tasks write.

    A table of small rows is one task's to read, but files take their time by number: writing is
    spread over tasks, which put their files in place themselves, and listing over folders.
    """
    spread = df.repartition(FOLDERS).withColumn("folder", F.spark_partition_id())
    spread.write.partitionBy("folder").options(**{"maxRecordsPerFile": 1, "mapreduce.fileoutputcommitter.algorithm.version": 2}).text(path)


def remove_folders(spark: SparkSession, path: str) -> None:
    """Delete a folder with many files, the folders in it side by side."""
    fs, jvm_path = at(spark, path)
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda status: fs.delete(status.getPath(), True), fs.listStatus(jvm_path)))
    fs.delete(jvm_path, True)


#: Quotes doubled; a NUL before a quote is a character like any other.
QUOTED = {"header": True, "quote": '"', "escape": '"', "charToEscapeQuoteEscaping": '"'}


def quoted(df: DataFrame, path: str, sep: str = "\t") -> None:
    """A quoted TSV or CSV of two columns or more: a null is nothing, an empty text two quotes, and spaces around a text are kept."""
    df.write.options(sep=sep, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **QUOTED).csv(path)


def text_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written whole and put in place by a rename."""
    staged = f"{path}.tmp-{uuid.uuid4().hex}"
    fs, jvm_path = at(spark, staged)
    out = fs.create(jvm_path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    replace(spark, staged, path)


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())


def stats_document(totals: DataFrame, section: str = "manifest", version: int = 5, before: dict | None = None) -> dict:
    """The statistics document from a scorecard with a total row (source null).

    Other sections of ``before`` are kept.  One row per source comes to the driver.
    """
    rows = [r.asDict() for r in totals.collect()]
    drop = lambda r: {k: round(v, 2) if k == "hours" and v is not None else v for k, v in r.items() if k != "source" and v is not None}
    total = next((drop(r) for r in rows if r["source"] is None), {})
    by_source = {r["source"]: drop(r) for r in sorted(rows, key=lambda r: r["source"] or "") if r["source"] is not None}
    return {**(before or {}), "schema_version": version, section: {"total": total, "by_source": by_source}}


def stats(spark: SparkSession, path: str, document: dict) -> None:
    text_file(spark, path, json.dumps(document, indent=2, ensure_ascii=False))


def backup_once(spark: SparkSession, path: str, suffix: str = ".bak") -> bool:
    """Rename ``path`` to a backup unless there is one already; whether it did."""
    fs, source = at(spark, path)
    _, target = at(spark, path + suffix)
    return bool(fs.exists(source) and not fs.exists(target) and fs.rename(source, target))


def markdown_report(title: str, tables: dict[str, DataFrame], rows: int = 50) -> str:
    """Sections with a table each, of small aggregates; ``rows`` at most of each."""
    parts = [f"# {title}"]
    for name, df in tables.items():
        lines = [f"## {name}", "| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
        lines += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in df.limit(rows).collect()]
        parts.append("\n".join(lines))
    return "\n\n".join(parts) + "\n"


def wav_clips(df: DataFrame, path: str, rate: int = 16_000) -> DataFrame:
    """Encode ``pcm`` of (utterance_id, pcm) as WAV bytes and write (name, bytes) as Parquet.

    Returns what was written.  A row stands for a file, so any store will do.
    """
    from ..functions.signal import encode_wav

    name = F.concat(F.regexp_replace("utterance_id", r"[^A-Za-z0-9._-]+", "_"), F.lit(".wav"))
    clips = df.select("utterance_id", name.alias("name"), encode_wav(rate)(F.col("pcm")).alias("bytes"))
    clips.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def stage(df: DataFrame, folder: str, audio: str = "audio_path", reference: str = "text", key: str = "utterance_id") -> int:
    """A local folder of links to a set's audio, and ground_truth.jsonl with the reference texts; returns their number.

    For a tool that wants a plain folder, on one machine: rows come one after the other.
    Links are named by key and suffix; a row without audio, or whose link would clash, is
    an error, and the folder appears only when all is there.
    """
    import os
    import re
    import shutil

    staged, n = f"{folder.rstrip('/')}.tmp-{uuid.uuid4().hex}", 0
    os.makedirs(staged)
    try:
        with open(f"{staged}/ground_truth.jsonl", "w", encoding="utf-8") as out:
            for r in df.select(F.col(key).cast("string").alias("k"), F.col(audio).alias("a"), F.col(reference).alias("t")).orderBy("k").toLocalIterator():
                if not r["k"] or not r["a"]:
                    raise ValueError(f"{r['k']!r} has no audio or no name")
                name = re.sub(r"[^A-Za-z0-9._-]+", "_", r["k"]) + os.path.splitext(r["a"])[1]
                os.symlink(r["a"], f"{staged}/{name}")
                out.write(json.dumps({"utterance_id": r["k"], "file": name, "text": r["t"] or ""}, ensure_ascii=False) + "\n")
                n += 1
        if os.path.isdir(folder):
            shutil.rmtree(folder)
        os.rename(staged, folder)
    finally:
        shutil.rmtree(staged, ignore_errors=True)
    return n
