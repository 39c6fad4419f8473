"""Joins of manifests with sidecars and with each other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas


def merge_flags(manifest: DataFrame, sidecars: Mapping[str, DataFrame], flags: str = "quality_flags", key: str = "utterance_id") -> DataFrame:
    """Left joins in order; what a sidecar holds replaces what was there, what it lacks stays.

    Sidecars have one row per key.  ``flags`` is a struct, and only its own fields are
    merged; with_<name> tells which sidecars a row was in.
    """
    own = manifest.schema[flags].dataType.fieldNames()
    out = manifest.withColumn(flags, F.coalesce(F.col(flags), F.lit(None).cast(manifest.schema[flags].dataType)))
    for name, sidecar in sidecars.items():
        fields = [f for f in sidecar.columns if f != key and f in own]
        entry = sidecar.select(F.col(key).alias("s_key"), F.struct(*fields).alias("s"))
        current = F.col(flags)
        merged = F.struct(*[(F.coalesce(F.col("s")[f], current[f]) if f in fields else current[f]).alias(f) for f in own])
        out = out.join(entry, F.col(key) == F.col("s_key"), "left").withColumns({flags: merged, f"with_{name}": F.col("s_key").isNotNull()}).drop("s_key", "s")
    return out


def merge_passes(purity: DataFrame, key: str = "utterance_id") -> DataFrame:
    """Both passes of a two-pass sidecar in one row, field by field; the last value of a field wins."""
    return purity.groupBy(key).agg(*[F.last(c, ignorenulls=True).alias(c) for c in purity.columns if c != key])


def attach(rows: DataFrame, sidecars: Mapping[str, DataFrame], key: str = "utterance_id") -> DataFrame:
    """Left joins of all sidecar columns; with_<name> tells the hits."""
    for name, sidecar in sidecars.items():
        entry = sidecar.withColumnRenamed(key, "s_key")
        rows = rows.join(entry, F.col(key) == F.col("s_key"), "left").withColumn(f"with_{name}", F.col("s_key").isNotNull()).drop("s_key")
    return rows


def pending(work: DataFrame, done: DataFrame, key: str = "utterance_id") -> DataFrame:
    """Work that isn't done."""
    return work.join(done.select(key), key, "left_anti")


def within(rows: DataFrame, scope: DataFrame, key: str = "utterance_id") -> DataFrame:
    return rows.join(scope.select(key), key, "left_semi")


def second_pass(manifest: DataFrame, selection: DataFrame, *carried: str, key: str = "utterance_id") -> DataFrame:
    """Rows of a selection for another pass, with columns of the selection carried over.

    A key that was selected twice goes once, with the least of its carried values; the
    rows that come are those that the manifest still has.
    """
    chosen = selection.groupBy(key).agg(F.min(F.struct(*carried)).alias("c_")).select(F.col(key).alias("c_key"), *[F.col(f"c_.{c}").alias(f"c_{c}") for c in carried])
    kept = [c for c in manifest.columns if c not in carried]
    return manifest.join(chosen, F.col(key) == F.col("c_key")).select(*kept, *[F.col(f"c_{c}").alias(c) for c in carried])


def without_output(work: DataFrame, listing: DataFrame, name: Column) -> DataFrame:
    """Work whose output file, by ``name``, isn't among listed paths or is empty there."""
    made = listing.filter("length > 0").select(F.substring_index("path", "/", -1).alias("made_")).distinct()
    return work.join(made, name == F.col("made_"), "left_anti")


def to_score(manifest: DataFrame, done: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    """Rows with standalone audio, of the given sources, that aren't scored."""
    rows = manifest.filter("audio_path IS NOT NULL AND NOT endswith(audio_path, '.parquet')")
    if sources:
        rows = rows.filter(F.col("source").isin(*sources))
    return pending(rows, done)


def compare_versions(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """(key, side, a_value, b_value): every key of either version; side is common, only_a or only_b."""
    left = a.groupBy(key).agg(F.sum(value).alias("a_value"), F.lit(True).alias("in_a"))
    right = b.groupBy(key).agg(F.sum(value).alias("b_value"), F.lit(True).alias("in_b"))
    side = F.when(F.col("in_a") & F.col("in_b"), "common").when(F.col("in_a"), "only_a").otherwise("only_b")
    return left.join(right, key, "full").select(key, side.alias("side"), "a_value", "b_value")


def flagged_without_regions(purity: DataFrame, key: str = "utterance_id") -> DataFrame:
    """Keys that a first pass flagged and no second pass has analysed."""
    flagged = purity.filter("needs_pass2").select(key).distinct()
    return flagged.join(purity.filter("language_regions IS NOT NULL").select(key).distinct(), key, "left_anti")


def newest_files(wanted: DataFrame, listing: DataFrame, path: str = "parent_audio_path") -> DataFrame:
    """``wanted`` with resolved_path: for ``prefix/*/name`` the file in the last folder that has it."""
    folder, name = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1), F.regexp_extract("path", r"([^/]+)$", 1)
    newest = listing.select(name.alias("l_name"), folder.alias("folder"), F.col("path").alias("l_path")).groupBy("l_name").agg(F.max_by("l_path", "folder").alias("l_path"))
    globbed = F.contains(F.col(path), F.lit("/*/"))
    joined = wanted.join(newest, globbed & (F.substring_index(F.col(path), "/*/", -1) == F.col("l_name")), "left")
    return joined.withColumn("resolved_path", F.when(globbed, F.col("l_path")).otherwise(F.col(path))).drop("l_name", "l_path")


def with_durations(rows: DataFrame, durations: DataFrame, key: str) -> DataFrame:
    return rows.join(durations, key, "left")


def lookup_parent(files: DataFrame, items: DataFrame, path: str, key: str) -> DataFrame:
    """Files with the entries of the folder each is in."""
    return files.withColumn("parent_", F.element_at(F.split(path, "/"), -2)).join(items, F.col("parent_") == F.col(key), "left").drop("parent_")


def either(name: Column, *others: Column) -> Column:
    """The first that isn't null."""
    return F.coalesce(name, *others)


KNOWN_SIDECARS = tuple(schemas.SIDECARS)


def by_locality(rows: DataFrame, parent: str, *order: str) -> DataFrame:
    """Rows of a parent side by side in one partition, so that what is read for it is read once."""
    return rows.repartition(parent).sortWithinPartitions(parent, *order)
