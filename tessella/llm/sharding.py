"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered in an order fixed by their values, whatever the partitions are.  A keyed
Feistel network permutes the numbers below the next power of four; numbers that leave the
range walk on through the network until they are back in it.  The permuted number gives
shard (remainder) and slot (quotient), so the shards' counts differ by one at most, and
where any row goes, and which row is anywhere, is computed without a table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import ship
from .common import bucket_count, col, cut, text_of

SHARDS = 24
KEY = 0x5EED
ROUNDS = 6
#: Rows in a bucket of the numbering, about, and the least number of buckets.  So many equal
#: rows are numbered by one task at most.
BUCKET_ROWS = 250_000
LEAST_BUCKETS = 256


def _mixed(x, key: int):
    """The round function: unsigned 64-bit numbers mixed with a key (the finaliser of SplitMix64)."""
    import numpy as np

    x = x + np.uint64((key * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Permutation:
    """A keyed permutation of 0 to ``size`` - 1; arrays in, arrays out."""

    size: int
    key: int = KEY
    rounds: int = ROUNDS

    @property
    def half_bits(self) -> int:
        return max(1, (max(self.size - 1, 1).bit_length() + 1) // 2)

    def _network(self, x, order):
        import numpy as np

        bits, mask = np.uint64(self.half_bits), np.uint64((1 << self.half_bits) - 1)
        left, right = x >> bits, x & mask
        for i in order:
            left, right = right, left ^ (_mixed(right, self.key * 64 + i) & mask)
        return (right << bits) | left  # the last swap undone, so the reversed order inverts

    def _walk(self, x, order):
        import numpy as np

        with np.errstate(over="ignore"):
            x = self._network(np.asarray(x).astype(np.uint64), order)
            while (out := x >= self.size).any():
                x[out] = self._network(x[out], order)
        return x.astype(np.int64)

    def forward(self, x):
        return self._walk(x, range(self.rounds))

    def backward(self, x):
        return self._walk(x, range(self.rounds - 1, -1, -1))

    def place(self, rows, shards: int = SHARDS):
        """(shard, slot) of row numbers."""
        at = self.forward(rows)
        return at % shards, at // shards

    def row(self, shard, slot, shards: int = SHARDS):
        """The row number at a shard's slot."""
        import numpy as np

        return self.backward(np.asarray(slot) * shards + np.asarray(shard))


def number_rows(rows: DataFrame, name: str = "row_number") -> tuple[DataFrame, int]:
    """``rows`` with global numbers from 0, and their count.

    The order is by a hash bucket of the values and then by the values alone.  Equal rows
    are counted before they are shuffled, take as many numbers in a row, and are spread
    over tasks again.  ``rows`` is read twice, so it should be a computed table.
    """
    columns = rows.columns
    total = rows.count()
    buckets = bucket_count(total, BUCKET_ROWS, LEAST_BUCKETS)
    distinct = cut(rows.groupBy(*columns).agg(F.count("*").alias("n")).withColumn("bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets))))
    # One row a bucket: BUCKET_ROWS times fewer than rows.
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = distinct.groupBy("bucket").agg(F.sum("n").alias("own")).select("bucket", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("bucket").orderBy(*columns).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = distinct.withColumn("upto", F.sum("n").over(within)).join(before, "bucket").select(*columns, "n", (F.col("before") + F.col("upto") - F.col("n")).alias("start"))
    each = lambda df: df.select(*columns, F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias(name))
    large = placed.filter(F.col("n") > BUCKET_ROWS).withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(BUCKET_ROWS).cast("long"))))
    parts = large.select(*columns, F.least(F.lit(BUCKET_ROWS), F.col("n") - F.col("at")).alias("n"), (F.col("start") + F.col("at")).alias("start")).repartition("start")
    return each(placed.filter(F.col("n") <= BUCKET_ROWS)).union(each(parts)), total


def assign(docs: DataFrame, *, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", key: int = KEY) -> DataFrame:
    """(doc_id, size, text_crc32, row_number, shard, slot) of every row.

    size is the text's UTF-8 bytes plus 8, a null text having none.  Null ids are numbered
    like any other.  Rows alike in id, size and checksum are each placed, in either order.
    An empty table gives no rows.  Columns other than id and text are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    blob = F.encode(text_of(text_col), "UTF-8")
    rows = cut(docs.select(col(id_col).alias("doc_id"), (F.octet_length(text_of(text_col)) + F.lit(8)).cast("long").alias("size"), F.crc32(blob).alias("text_crc32")))
    numbered, total = number_rows(rows)
    permutation = Permutation(total, key)
    names = [*numbered.columns, "shard", "slot"]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            shard, slot = permutation.place(batch.column(batch.num_columns - 1).to_numpy(), shards)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard.astype(np.int32)), pa.array(slot)], names)

    schema = T.StructType([*numbered.schema, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    return numbered.mapInArrow(run, schema)


def write_shards(docs: DataFrame, path: str, *, shards: int = SHARDS, id_col: str = "doc_id", **options) -> None:
    """Write the rows as Parquet, one folder per shard, in slot order within each file.

    Ids must be unique.  A shard is dealt to as many tasks as hold about BUCKET_ROWS rows.
    """
    placed = assign(docs, shards=shards, id_col=id_col, **options).select(F.col("doc_id").alias("own_id"), F.col("shard").alias("to_shard"), F.col("slot").alias("to_slot"))
    rows = docs.select(F.struct("*").alias("doc"), col(id_col).alias("find_id")).join(placed, F.col("find_id") == F.col("own_id"))
    part = F.floor(F.col("to_slot") / BUCKET_ROWS)
    out = rows.select("doc.*", F.col("to_shard"), F.col("to_slot"), part.alias("to_part")).repartition("to_shard", "to_part").sortWithinPartitions("to_shard", "to_slot")
    out.drop("to_part").write.partitionBy("to_shard").parquet(path)
