"""Packing tokenised documents into sequences by minimum bin slack.

For each sequence the longest piece left opens it, and dynamic programming over the
sums of the other lengths, kept as a bit set, finds the fullest combination that fits;
it is removed, and so on.  Only lengths matter, and there are at most as many as the
capacity, so the search runs on their counts: the same combination is taken as often as
the counts allow, which uses up one length each time.  The search therefore costs the
same for any corpus, and yields a table of bounded size, ``Layout``.  Each piece then
looks its place up by its rank among the pieces of its length.

Ranks are computed in salted groups of each length plus the counts of earlier groups, so
a length that a large part of the pieces share is spread over many tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import ship
from .blocks import texts
from .common import bucket_count, col, cut, text_of
from .tokens import encoder

CAPACITY = 4096
END_ID = 1
#: Pieces in a salted group of a length, about, and the least number of groups.
GROUP_ROWS = 250_000
LEAST_GROUPS = 64


@dataclass(frozen=True)
class Layout:
    """Where the pieces of each length go, in runs of ranks, sorted by length and rank.

    A piece of ``length`` with a rank of at least ``rank`` (and below the next run's) is
    number ``rank - run.rank`` of its run; every sequence takes ``per`` of these, the
    first at ``offset``; the run's sequences are numbered from ``sequence``.
    """

    length: list[int]
    rank: list[int]
    per: list[int]
    sequence: list[int]
    offset: list[int]
    sequences: int


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, copies) with the largest sum up to ``room``; long lengths are preferred."""
    reach, within, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        steps.append((length, reach))
        left, step = min(counts[length], room // length), 1
        while left:
            step = min(step, left)
            reach |= (reach << (step * length)) & within
            left -= step
            step *= 2
        if reach >> room:
            break
    rest, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        copies = 0
        while not before >> (rest - copies * length) & 1:
            copies += 1
        if copies:
            chosen.append((length, copies))
            rest -= copies * length
    return chosen


def layout(counts: dict[int, int], capacity: int = CAPACITY) -> Layout:
    """Fill sequences until no piece is left."""
    counts = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(counts, 0)
    runs, sequence = [], 0
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        chosen = dict(fullest({n: c for n, c in counts.items() if c}, capacity - longest))
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times, offset = min(counts[n] // k for n, k in chosen.items()), 0
        for n, k in sorted(chosen.items(), reverse=True):
            runs.append((n, used[n], k, sequence, offset))
            used[n] += k * times
            offset += k * n
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
        sequence += times
    runs.sort()
    return Layout(*[[r[i] for r in runs] for i in range(5)], sequence)


def tokenize(
    docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32 (and ids)."""
    fields = [
        T.StructField("doc_id", docs.select(col(id_col)).schema[0].dataType),
        *[T.StructField(n, t) for n, t in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()))],
        *([T.StructField("ids", T.BinaryType())] if keep_ids else []),
    ]
    size = 4 * capacity
    ship(docs.sparkSession)

    def cut_up(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encode, end = encoder(tokenizer).ids, end_id.to_bytes(4, "little")
        for batch in batches:
            owner, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, text in enumerate(texts(batch.column(1))):
                blob = encode(text) + end
                for i, at in enumerate(range(0, len(blob), size)):
                    part = blob[at : at + size]
                    owner.append(row)
                    piece.append(i)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(part)
            columns = [batch.column(0).take(pa.array(owner, pa.int32())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * keep_ids, [f.name for f in fields])

    return docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(cut_up, T.StructType(fields))


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset.

    ``pieces`` is read several times, in the same partitions, so it has to be a computed
    table.  Which of the pieces of a length goes where depends on them.
    """
    spark = pieces.sparkSession
    ship(spark)
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = spark.sparkContext.broadcast(layout(counts, capacity))
    groups = bucket_count(sum(counts.values()), GROUP_ROWS, LEAST_GROUPS)
    # With the partition, so that repeated rows and those without an id are spread as well.
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", F.spark_partition_id()), F.lit(groups)))
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = salted.groupBy("length", "salt").count().select("length", "salt", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(within)).join(before, ["length", "salt"])
    rows = ranked.select(*pieces.columns, (F.col("rank") - 1 + F.col("before")).alias("rank"))

    names = [*pieces.columns, "sequence_id", "offset"]

    def look_up(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        own = plan.value
        length, rank, per, sequence, offset = (np.array(x, np.int64) for x in (own.length, own.rank, own.per, own.sequence, own.offset))
        firsts = np.searchsorted(length, np.arange(capacity + 2))
        for batch in batches:
            n, r = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            low, high = firsts[n], firsts[n + 1]  # the last run of this length that begins at or before r
            while (open_ := high - low > 1).any():
                middle = (low + high) // 2
                right = open_ & (rank[np.minimum(middle, len(rank) - 1)] <= r)
                low, high = np.where(right, middle, low), np.where(open_ & ~right, middle, high)
            number = r - rank[low]
            columns = [c for name, c in zip(batch.schema.names, batch.columns, strict=True) if name != "rank"]
            places = (sequence[low] + number // per[low], offset[low] + number % per[low] * n)
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(x, pa.int64()) for x in places]], names)

    schema = T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return rows.mapInArrow(look_up, schema)


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, **options) -> DataFrame:
    """Pack all documents; one row per piece.

    Null and empty texts are a piece of the end id alone.  Null ids are kept.  Repeated
    rows are packed once each; pieces alike in every column may swap places.  An empty
    table gives no rows.  Columns other than id and text are not read.
    """
    return place(cut(tokenize(docs, tokenizer, capacity=capacity, **options)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (of pieces made with ``keep_ids``)."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    whole = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p))
    return packed.groupBy("sequence_id").agg(whole.alias("ids"))  # at most ``capacity`` ids each
