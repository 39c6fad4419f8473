"""All registered queries of the manifest operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import analytics, browsing, emitting, files, passes, timelines

PARTS = (browsing, timelines, analytics, emitting, files, passes)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for part in PARTS for name, query in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in PARTS for name, sql in part.ORACLES.items()}
