"""Expressions and helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import cut, shared_dir  # noqa: F401

#: ASCII white space that separates words: space, and tab to carriage return.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD_REGEX = rf"[^{SPACE_CLASS}]+"
SPACE_REGEX = rf"[{SPACE_CLASS}]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_REGEX)).cast("long")


def words_of(text: Column) -> Column:
    """All words in order; an empty array for none."""
    return F.regexp_extract_all(text, F.lit(WORD_REGEX), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Rows of a table that is sent whole to every task, at most, and their bytes as text.
BROADCAST_ROWS, BROADCAST_BYTES = 20_000, 8 << 20


def is_small(table: DataFrame) -> bool:
    """Whether a computed table may be broadcast: by its rows, and then by what they hold."""
    if table.count() > BROADCAST_ROWS:
        return False
    held = table.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
    return (held or 0) <= BROADCAST_BYTES


def join_small(rows: DataFrame, small: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    """Join with a computed table that is usually small: broadcast if it is, else a plain join.

    Without the hint both sides would be shuffled before the small one's size is known.
    """
    return rows.join(F.broadcast(small) if is_small(small) else small, on, how)


def new_path(spark: SparkSession, kind: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared folder."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def bucket_count(rows: int, per_bucket: int, least: int) -> int:
    """Buckets so that one holds about ``per_bucket`` rows, ``least`` at the least."""
    return max(least, -(-rows // per_bucket))
