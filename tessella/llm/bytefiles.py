"""Binary files of any size in bounded chunks, through Spark's own readers.

Spark reads whole binary files as single values, of 2 GB at most.  Its text reader splits
files of any size and takes any separator, so here a byte that recurs is the separator:
lines come in order, and joined again they are the file's bytes.  A split begins after a
separator, so where it lies in its file follows from the lengths of those before it.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1 << 20


def runs(batches: Iterator, separator: bytes, chunk: int = CHUNK) -> Iterator[tuple]:
    """(file, block, nth, bytes, size) from batches of (value, file, block, size), inside Python workers.

    Each chunk ends with a separator.  If a file doesn't, its last chunk has one too many.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    key, nth = None, 0
    for batch in batches:
        value, file, block, size = batch.columns
        if not len(value):
            continue
        splits = block.to_numpy()
        parts = (np.cumsum(pc.binary_length(value).to_numpy(zero_copy_only=False).astype(np.int64) + 1) - 1) // chunk
        new = pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False) | (splits[1:] != splits[:-1]) | (parts[1:] != parts[:-1])
        starts = np.flatnonzero(np.append(True, new))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(starts, len(value)), pa.int32()), value), separator)
        for data, start in zip(joined, starts.tolist(), strict=True):
            now = file[start].as_py(), int(splits[start])
            nth, key = (nth + 1 if now == key else 0), now
            yield (*now, nth, data.as_py() + separator, size[start].as_py())


def lines(spark: SparkSession, path: str | list[str], separator: bytes, glob: str) -> DataFrame:
    """(value, file, block, size): pieces between separators, with their file, split and file's size."""
    plain = {"io.compression.codecs": "org.apache.hadoop.io.compress.DefaultCodec"}  # of .deflate alone, so no other name means a codec
    found = spark.read.options(lineSep=separator.decode("ascii"), pathGlobFilter=glob, **plain).text(path)
    return found.select(F.col("value").cast("binary"), *[F.col(f"_metadata.{m}").alias(n) for m, n in (("file_path", "file"), ("file_block_start", "block"), ("file_size", "size"))])
