"""Near-duplicates by SimHash fingerprints and multi-index hashing.

Fingerprints link at 3 or fewer differing bits, and the halves of such a pair are such
that one half differs in at most one bit.  So each distinct half is looked up, and so is
every half one bit away: a Hamming ball of 33 in a table of 2**32.  Only halves that
exist, with their counts, take part in that lookup; then the fingerprints under a pair of
matching halves are compared in full.

Where both halves of a lookup hold many fingerprints (large groups of near copies), pairs
aren't enumerated.  There every fingerprint joins "hubs": all that agree but for one free
bit and at most one other bit away from a centre.  Members of a hub differ in 3 bits at
most, and two linked fingerprints always share a hub, so linking each member with the
lowest of its hub loses no connection and costs a fixed number of rows a fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import ship
from .blocks import blocks, texts
from .common import col, cut, join_small, text_of
from .components import components

RADIUS = 3
SHINGLE = 3
SEED = 42
HALF = 32
#: A lookup with more than the square of this many pairs goes by hubs: for one and the same
#: half, where a fingerprint makes 32 * 32 rows of hubs, and for neighbours, where it makes 33.
DENSE_SAME = 1024
DENSE_NEAR = 64


def _fingerprint(text: bytes) -> int:
    import numpy as np
    from xxhash import xxh64_intdigest

    digest = partial(xxh64_intdigest, seed=SEED)
    ones, total, carry, last = np.zeros(64, np.int64), 0, [], []
    for block in blocks(text.lower()):  # bytes.lower() changes A-Z only
        words = carry + block.split()
        hashes = np.fromiter(map(digest, map(b" ".join, zip(*[words[i:] for i in range(SHINGLE)]))), np.uint64)
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at : at + (1 << 16)]
            ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
        carry, last = words[-(SHINGLE - 1) :], words
    if not total:
        return digest(b" ".join(last)) if last else 0
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, fp): a 64-bit hash of the text, and its fingerprint as a signed long."""
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", docs.select(col(id_col)).schema[0].dataType), T.StructField("digest", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            found = np.array([_fingerprint(t) for t in texts(batch.column(2))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], schema.names)

    text = text_of(text_col)
    return docs.select(col(id_col).alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text")).mapInArrow(run, schema)


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _flipped(key: Column, bit: Column) -> Column:
    """``key`` with a bit of its half, given as a power of two, changed."""
    return key.bitwiseXOR(bit)


def _bits() -> Column:
    return F.array(*[F.lit(1 << i).cast("long") for i in range(HALF)])


def links(distinct: DataFrame) -> DataFrame:
    """Edges (v, w) between fingerprints: they connect exactly what links within RADIUS connect.

    ``distinct`` has one row per fingerprint (fp) and should be a computed table.
    """
    low = F.col("fp").bitwiseAND(F.lit((1 << HALF) - 1))
    high = F.shiftrightunsigned("fp", HALF)
    mark = F.lit(1 << HALF)
    halves = F.array(F.struct(low.alias("key"), high.alias("rest")), F.struct((high + mark).alias("key"), low.alias("rest")))
    table = distinct.select("fp", F.explode(halves).alias("h")).select("fp", "h.key", "h.rest")
    counts = cut(table.groupBy("key").agg(F.count("*").alias("n")))
    # Halves one bit apart: looked up from the one with the bit unset.
    flips = F.filter(_bits(), lambda b: F.col("key").bitwiseAND(b) == 0)
    probes = counts.select("key", "n", F.explode(flips).alias("bit")).select(
        "key", "n", "bit", _flipped(F.col("key"), F.col("bit")).alias("other")
    )
    near = probes.join(counts.select(F.col("key").alias("other"), F.col("n").alias("m")), "other")
    same = counts.filter("n > 1").select("key", "n", F.lit(0).cast("long").alias("bit"), F.col("key").alias("other"), F.col("n").alias("m"))
    lookups = cut(near.select(same.columns).union(same))

    most = F.when(F.col("bit") == 0, DENSE_SAME**2).otherwise(DENSE_NEAR**2)
    thin = lookups.filter(F.col("n") * F.col("m") <= most)
    left = table.select("key", F.col("fp").alias("v"))
    right = table.select(F.col("key").alias("other"), F.col("fp").alias("w"))
    # Within one half every pair comes twice and every fingerprint meets itself.
    pairs = thin.join(left, "key").join(right, "other").filter("bit <> 0 OR v < w").filter(_distance("v", "w") <= RADIUS).select("v", "w")

    dense = lookups.filter(F.col("n") * F.col("m") > most).select(F.explode(F.array(
        F.struct(F.col("key").alias("key"), "bit", F.col("key").alias("base")), F.struct(F.col("other").alias("key"), "bit", F.col("key").alias("base"))
    )).alias("d")).select("d.*").distinct()
    around = lambda c, skip: F.concat(F.array(c), F.transform(F.filter(_bits(), lambda b: b != skip), lambda b: c.bitwiseXOR(b)))
    centre = F.col("rest").bitwiseAND(F.bitwise_not(F.col("free")))
    crowd = table.join(dense, "key").select(
        "fp", "rest", "base", "bit", F.explode(F.when(F.col("bit") == 0, _bits()).otherwise(F.array(F.lit(0).cast("long")))).alias("free")
    )
    members = crowd.select("base", "bit", "free", F.explode(around(centre, F.col("free"))).alias("centre"), "fp")
    hub = ["base", "bit", "free", "centre"]
    lowest = members.groupBy(*hub).agg(F.min("fp").alias("w"), F.max("fp").alias("top")).filter("w <> top").drop("top")
    through = members.join(cut(lowest), hub).filter(F.col("fp") != F.col("w")).filter(_distance("fp", "w") <= RADIUS).select(F.col("fp").alias("v"), "w")
    return pairs.union(through.distinct())


def _classes(found: DataFrame) -> DataFrame:
    """(fp, component_id, first, size) for each fingerprint of ``found``, a computed table.

    component_id is the lowest id that its component holds, size the component's rows, and
    first the row that stands for it: (doc_id, fp, digest), the lowest in that order.
    """
    row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "fp", "digest"))
    lowest = cut(found.groupBy("fp").agg(F.min(row).alias("low"), F.count("*").alias("n")))
    labels = components(links(lowest)).withColumnRenamed("v", "fp")
    joined = cut(lowest.join(labels, "fp", "left").select("fp", "low", "n", F.coalesce("label", "fp").alias("label")))
    whole = cut(joined.groupBy("label").agg(F.min("low").alias("first"), F.sum("n").alias("size")))
    return cut(joined.join(whole, "label").select("fp", F.col("first.doc_id").alias("component_id"), "first", "size"))


def near_duplicates(docs: DataFrame, **columns) -> DataFrame:
    """(doc_id, fp, component_id) for every row; component_id is the lowest id reachable.

    Null and empty texts have fingerprint zero and link like any other.  Rows with equal
    ids or texts are each returned.  Rows with a null id are returned with their
    fingerprint and the component of its other rows, if any, and lend it no id.  An empty
    table gives no rows.  Columns other than id and text are not read.
    """
    found = cut(fingerprints(docs, **columns))
    return found.join(_classes(found), "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of near-duplicates; columns unchanged.

    It is the one with the lowest id, of those that share that id the one with the lowest
    fingerprint, then text hash; of rows alike in id and text, the one whose row as JSON
    has the lowest SHA-256.  Rows that share an id but not a group are judged apart.  Rows
    without an id can't stand for a group, so they stay.

    Only what goes is looked for, so texts aren't shuffled while that is under
    ``BROADCAST_ROWS`` rows of two numbers; above, rows are joined by those numbers.
    """
    found = cut(fingerprints(docs, id_col=id_col, text_col=text_col))
    shared = _classes(found).filter("size > 1").select("fp", "first")
    is_first = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("fp") == F.col("first.fp")) & (F.col("digest") == F.col("first.digest"))
    own = found.filter("doc_id IS NOT NULL").join(shared, "fp").select(F.xxhash64("doc_id").alias("id_hash"), "digest", is_first.alias("stays"))
    counted = own.groupBy("id_hash", "digest").agg(F.bool_or("stays").alias("stays"), F.count("*").alias("n"))
    going = cut(counted.filter("NOT stays OR n > 1"))
    own_hash = F.when(col(id_col).isNotNull(), F.xxhash64(col(id_col)))
    rows = docs.select(F.struct("*").alias("doc"), own_hash.alias("own_hash"), F.xxhash64(text_of(text_col)).alias("own_digest"))
    same = (F.col("own_hash") == F.col("id_hash")) & (F.col("own_digest") == F.col("digest"))
    kept = join_small(rows, going, same, "left_anti").select("doc")
    repeated = cut(going.filter("stays"))
    if not repeated.isEmpty():
        again = join_small(rows, repeated, same, "left_semi")
        kept = kept.union(again.groupBy("own_hash", "own_digest").agg(F.min_by("doc", F.sha2(F.to_json("doc"), 256)).alias("doc")).select("doc"))
    return kept.select("doc.*")
