"""Documents to packed training sequences: five training-data operators in a row.

Each stage reads what its predecessor wrote, as Parquet in the shared folder.  All but the
last return the columns of ``documents``; the last returns one row per packed piece.

Every stage takes what its operator takes: null texts count as empty and go by the quality
rules, null languages and sources are groups of their own, rows without an id are never
dropped as near-duplicates, repeated rows are judged each and one of them stays.  Columns
beyond those of ``documents``, whatever their names, are carried along.  Without labels no
document counts as toxic; empty tables pass through all stages as empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessella.llm import common, mixing, packing, queries, quality_rules, simhash, toxicity


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that the factorization machine predicts toxic go."""
    return toxicity.keep_civil(docs, queries.table(spark, sf_dir, "labels"))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents beyond the base rules or their group's thresholds go."""
    return quality_rules.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash: one document of each group of near-duplicates stays."""
    return simhash.deduplicate(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents are left out or repeated to bring the sources to their weights."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of tokenised documents with their places in sequences."""
    return packing.pack(docs, queries.tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", civil),
    ("quality_rules", good),
    ("simhash_dedup", distinct),
    ("mix_sources", mixed),
    ("pack_sequences", packed),
]

#: The fitted classifier, the fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage has read is deleted once its own rows are written."""
    docs, before = queries.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = common.new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            common.remove(spark, before)
        before = path
    return docs
