"""Token counts of documents in flat token files that have no index.

A file is ids of fixed width one after the other, each document ended by an end id.  A
file of any size is read in blocks, by as many tasks as it has splits.  Each block is
searched for the end id with vectorised comparisons; a prefix scan over the blocks' sizes
tells where each of them lies, one over the ends carries the last end before it and the
number of ends, which joins documents that cross blocks and numbers them.

``write`` makes such files with Spark's text writer, to any store Spark writes to: a row
is a document's bytes without the last byte of its end id, and that byte, which has to be
ASCII, is the line separator.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import ship
from . import bytefiles
from .blocks import blocks, texts
from .common import col, cut, new_path, remove, text_of

#: 16-bit ids, high byte first: of the vocabulary's end id, 50256, the last byte is ASCII.
ID_TYPE = ">u2"
END_ID = 50_256
BLOCK_BYTES = 1 << 20


@functools.cache
def _encoding(ranks_path: str, pattern: str):
    """One per Python worker."""
    import base64

    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def write(docs: DataFrame, path: str, ranks_path: str, pattern: str, *, text_col: str = "text", end_id: int = END_ID, id_type: str = ID_TYPE) -> None:
    """Write every text's ids and an end id to flat files; a null text is an end id alone."""
    import numpy as np

    end = np.array([end_id], id_type).tobytes()
    if end[-1] >= 0x80:
        raise ValueError(f"the last byte of {end_id} as {id_type} isn't ASCII")
    ship(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encode = _encoding(ranks_path, pattern).encode_ordinary
        for batch in batches:
            rows = []
            for text in texts(batch.column(0)):
                parts = [np.array(encode(block.decode()), id_type).tobytes() for block in blocks(text)]
                rows.append(b"".join(parts) + end[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["ids"])

    rows = docs.select(text_of(text_col).alias("text")).mapInArrow(run, "ids binary").select(F.col("ids").cast("string").alias("value"))
    rows.write.option("lineSep", chr(end[-1])).option("compression", "none").option("maxRecordsPerFile", 0).text(path)


def _separator(end: bytes) -> bytes:
    """A byte to part blocks at: the last of an end, or one that ends don't hold, so none crosses blocks."""
    if end[-1] < 0x80 and end[-1] not in end[:-1]:
        return end[-1:]
    return next(bytes([b]) for b in (*range(0x50, 0x80), *range(0x50)) if b not in end)


def scan(spark: SparkSession, path: str, *, end_id: int = END_ID, id_type: str = ID_TYPE, block_bytes: int = BLOCK_BYTES, glob: str = "part-*") -> DataFrame:
    """One row for each block of each file: file, size, split, nth, bytes, ends.

    Blocks of a file are in the order of (split, nth), of its splits and within them;
    ``ends`` are the positions in the block where the end id's bytes begin, at any
    alignment, as the block's own place isn't known yet.
    """
    import numpy as np

    end = np.array([end_id], id_type).tobytes()
    width, separator = len(end), _separator(end)
    ship(spark)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for file, split, nth, data, size in bytefiles.runs(batches, separator, block_bytes):
            aligned = (np.frombuffer(data, id_type, (len(data) - a) // width, a) for a in range(min(width, len(data))))
            ends = np.sort(np.concatenate([np.flatnonzero(ids == end_id) * width + a for a, ids in enumerate(aligned)]))
            columns = [pa.array([file]), *[pa.array([x], pa.int64()) for x in (size, split, nth, len(data))], pa.array([ends], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["file", "size", "split", "nth", "bytes", "ends"])

    found = bytefiles.lines(spark, path, separator, glob)
    return found.mapInArrow(run, "file string, size long, split long, nth long, bytes long, ends array<long>")


def stitch(scanned: DataFrame, *, width: int = 2) -> DataFrame:
    """(file, doc_index, start, n_tokens, ended) of each document, the end id not counted.

    Ids after a file's last end are a document that isn't ``ended``.  An empty file has
    none.  A file that isn't whole ids long is an error.  ``scanned`` is read twice, so it
    should be a computed table; what goes over all blocks of a file is a few numbers each.
    """
    place = ["file", "split", "nth"]
    earlier = Window.partitionBy("file").orderBy("split", "nth").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    at = scanned.select(*place, "size", "bytes", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("at"), F.sum("bytes").over(whole).alias("read"))
    # The reader adds a separator to a file without one at its end; it drops a leading byte order mark.
    sound = (F.col("size") % width == 0) & (F.col("read") - F.col("size")).isin(0, 1)
    offset = cut(at.select(*place, F.when(sound, F.col("at")).otherwise(F.raise_error(F.concat(F.col("file"), F.lit(" isn't a whole number of ids, or begins with a byte order mark")))).alias("at")))
    is_end = lambda p: ((F.col("at") + p) % width == 0) & (F.col("at") + p + width <= F.col("size"))
    found = F.transform(F.filter("ends", is_end), lambda p: ((F.col("at") + p) / width).cast("long"))
    blocks_ = cut(scanned.join(offset, place).select(*place, (F.col("size") / width).cast("long").alias("length"), found.alias("ends")))
    n = F.size("ends")
    slim = blocks_.select(*place, "length", n.alias("n"), F.array_max("ends").alias("last"))
    carried = slim.select(
        *place,
        F.coalesce(F.max("last").over(earlier), F.lit(-1).cast("long")).alias("before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("first"),
        (F.row_number().over(Window.partitionBy("file").orderBy(F.desc("split"), F.desc("nth"))) == 1).alias("is_last"),
    )
    joined = blocks_.join(cut(carried), place)
    # A last block adds its file's length as a further end, if ids follow the last one.
    last_end = F.coalesce(F.array_max("ends"), F.col("before"))
    tail = F.col("is_last") & (last_end < F.col("length") - 1)
    stops = F.when(tail, F.array_append("ends", F.col("length"))).otherwise(F.col("ends"))
    rows = joined.select("file", "first", "before", "length", stops.alias("stops")).filter(F.size("stops") > 0)
    starts = F.transform(F.concat(F.array("before"), F.slice("stops", F.lit(1), F.size("stops") - 1)), lambda x: x + 1)
    return rows.select("file", "first", "length", F.posexplode(F.arrays_zip(F.col("stops"), starts.alias("starts"))).alias("nth", "at")).select(
        "file",
        (F.col("first") + F.col("nth")).alias("doc_index"),
        F.col("at.starts").alias("start"),
        (F.col("at.stops") - F.col("at.starts")).alias("n_tokens"),
        (F.col("at.stops") < F.col("length")).alias("ended"),
    )


def count_tokens(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, id_type: str = ID_TYPE) -> DataFrame:
    """(doc_id, n_tokens) of every row: ``docs`` is written to flat files and the files are scanned.

    The files hold no ids: the n-th document of a task's file is the n-th row of that
    task's part of ``docs``, which therefore should be a table, read alike each time; the
    documents of each file are compared in number with the rows, and a difference is an
    error.  The files are deleted once they are scanned.

    Null and empty texts have 0 tokens; null ids are kept; repeated rows count each; an
    empty table gives no rows.  Columns other than id and text are not read.
    """
    import numpy as np

    spark = docs.sparkSession
    path, width = new_path(spark, "tokens"), np.dtype(id_type).itemsize
    write(docs, path, ranks_path, pattern, text_col=text_col, end_id=end_id, id_type=id_type)
    counted = stitch(cut(scan(spark, path, end_id=end_id, id_type=id_type)), width=width)
    part = F.regexp_extract("file", r"part-(\d+)-[^/]*$", 1).cast("long")
    counted = cut(counted.select((part * F.lit(1 << 33) + F.col("doc_index")).alias("place"), "n_tokens"))
    remove(spark, path)
    rows = docs.select(col(id_col).alias("doc_id")).withColumn("row_place", F.monotonically_increasing_id())
    met = rows.join(counted, F.col("row_place") == F.col("place"), "full")
    differ = F.col("place").isNull() | F.col("row_place").isNull()
    n = F.when(differ, F.raise_error(F.lit("the files and the table differ in documents"))).otherwise(F.col("n_tokens"))
    return met.select("doc_id", n.cast("long").alias("n_tokens"))
