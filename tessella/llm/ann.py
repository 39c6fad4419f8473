"""Approximate nearest neighbours by collision counting over single projections.

Each of many directions has its own sorted array of the vectors' projections.  A query
looks at a window centred on its own projection in every array; a vector in a window
collides, and vectors that collide in enough of the directions are verified with exact
inner products.  (QALSH: Huang et al., 2015.)

How wide the windows are follows from how far a query's neighbours lie, which it estimates
from a bounded sample of the vectors; so what is verified doesn't depend on how the work
is dealt out.  Queries that find fewer than they should widen their windows and look again
(virtual rehashing: no table is rebuilt).  Where windows hold more than half of an array,
what lies outside them is counted instead.

Vectors are dealt into ranges of a few projections, which are split into blocks.  Of each
range the ends of all projections are known, so a query goes only to ranges that enough of
its windows touch; then each pair of a block and a group of queries is a task's work.
Vectors without any structure have no range to leave out: there the pairs compared grow
with queries times vectors, at a fraction of a full comparison.

Largest inner products become smallest distances by one more coordinate that brings every
vector to the largest norm; a query has zero there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import ship
from .common import bucket_count, col, cut, join_small

DIRECTIONS = 128
#: Half a window, in standard deviations of the difference between two projections at the estimated distance.
WIDTH = 2.2
#: A vector at that distance collides in a share of the directions; less so many deviations is enough.
MARGIN = 0.4
#: Vectors, in hash order, that distances are estimated from and ranges are cut by; also a bound in bytes.
SAMPLE, SAMPLE_BYTES = 4_096, 4 << 20
#: Windows of queries with fewer found than asked for are widened so often, by this; then they take in everything.
WIDEN, ROUNDS = 2.0, 3
MOST_RANGES = 64
#: Rows of a block of vectors and of a group of queries.  Both grow with the table up to a task's
#: memory, as every block is sent once for each group; what is found doesn't depend on them.
BLOCK_ROWS, MOST_BLOCK_ROWS = 32_768, 65_536
QUERY_ROWS, MOST_QUERY_ROWS = 1_024, 16_384
BLOCKS, QUERY_BLOCKS = 256, 64
SEED = 20


def usable(vector: Column) -> Column:
    """Neither null nor empty nor all zero, and every component a finite number."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass
class Plan:
    """Directions, the sample, and ranges by medians of its projections; ``reach`` is the largest squared norm."""

    reach: float
    rows: int
    k: int
    ids: object
    sample: object
    directions: object
    #: The ranges are the leaves of a binary tree: (direction, where to cut) of its inner nodes, level by level.
    cuts: list[tuple[int, float]]

    def project(self, vectors, lifted: bool = True):
        import numpy as np

        out = vectors @ self.directions[:-1]
        if lifted:
            out += np.sqrt(np.maximum(self.reach - np.einsum("ij,ij->i", vectors, vectors), 0))[:, None] * self.directions[-1]
        return out.astype(np.float32)

    def centres(self, queries):
        """Projections of queries brought to the largest norm, which leaves their neighbours as they are."""
        import numpy as np

        return (self.project(queries, False) * (np.sqrt(self.reach) / np.sqrt(np.einsum("ij,ij->i", queries, queries)))[:, None]).astype(np.float32)

    def ranges(self, projected):
        import numpy as np

        at = np.zeros(len(projected), np.int64)
        if self.cuts:
            direction, where = np.array([d for d, _ in self.cuts]), np.array([w for _, w in self.cuts])
            for _ in range((len(self.cuts) + 1).bit_length() - 1):
                at = 2 * at + 1 + (projected[np.arange(len(at)), direction[at]] > where[at])
        return at - len(self.cuts)

    def half_widths(self, query_ids, queries):
        """Half a window for each query: of the place among the sample where its k-th neighbour may lie, at most."""
        import numpy as np

        mean = self.k * len(self.sample) / self.rows
        place = min(self.k, int(np.ceil(mean + 2 * np.sqrt(mean) + 1)))
        if len(self.sample) <= place:
            return np.full(len(queries), np.inf)
        scores = queries @ self.sample.T
        scores[self.ids == query_ids[:, None]] = -np.inf
        nearest = np.partition(scores, -place, axis=1)[:, -place]
        squared = 2 * self.reach - 2 * nearest * np.sqrt(self.reach / np.einsum("ij,ij->i", queries, queries))
        width = WIDTH * np.sqrt(np.maximum(squared, 0) / len(self.directions)) + 1e-5 * np.sqrt(self.reach)
        return np.where(np.isneginf(nearest), np.inf, width)


def needed(directions: int = DIRECTIONS) -> int:
    """Collisions that are enough to verify a vector."""
    from math import erf, floor, sqrt

    share = erf(WIDTH / sqrt(2))
    return floor(share * directions - MARGIN * sqrt(directions * share * (1 - share)))


def make_plan(ids, sample, reach: float, rows: int, k: int, ranges: int) -> Plan:
    """``ranges``: a power of two."""
    import numpy as np

    rng, size = np.random.default_rng(SEED), sample.shape[1] + 1
    bases = [np.linalg.qr(rng.normal(size=(size, size)))[0] for _ in range(-(-DIRECTIONS // size))]
    plan = Plan(reach, rows, k, ids, sample, np.concatenate(bases, axis=1)[:, :DIRECTIONS], [])
    projected, cuts, nodes = plan.project(sample), [], [np.arange(len(sample))]
    for _ in range(ranges.bit_length() - 1):
        lower = []
        for node in nodes:
            own = projected[node] if len(node) else projected
            widest = int(own.std(axis=0).argmax())
            cuts.append((widest, float(np.median(own[:, widest]))))
            above = projected[node, widest] > cuts[-1][1]
            lower += [node[~above], node[above]]
        nodes = lower
    plan.cuts = cuts
    return plan


def search_block(ids, vectors, query_ids, queries, widths, plan: Plan):
    """The best found for each query among a block: (query index, id, score) arrays, and how many were verified."""
    import numpy as np

    n, enough, k = len(vectors), needed(), plan.k
    projected = plan.project(vectors)
    order = np.argsort(projected, axis=0, kind="stable").T.copy()
    arrays = np.take_along_axis(projected.T, order, 1)
    del projected
    centres, widths = plan.centres(queries).T, widths.astype(np.float32)
    low = np.array([a.searchsorted(c - widths) for a, c in zip(arrays, centres, strict=True)])
    high = np.array([a.searchsorted(c + widths, "right") for a, c in zip(arrays, centres, strict=True)])
    del arrays
    small, close = vectors.astype(np.float32), queries.astype(np.float32)
    slack = 1e-5 * np.sqrt(plan.reach) * np.sqrt(np.einsum("ij,ij->i", queries, queries))
    inside = (high - low).sum(axis=0)
    out, verified = ([], [], []), 0
    for q in range(len(queries)):
        ends = list(zip(order, low[:, q].tolist(), high[:, q].tolist(), strict=True))
        if 2 * inside[q] > DIRECTIONS * n:
            missed = [o[:a] for o, a, _ in ends] + [o[b:] for o, _, b in ends]
            found = np.flatnonzero(np.bincount(np.concatenate(missed), minlength=n) <= DIRECTIONS - enough)
        else:
            found = np.flatnonzero(np.bincount(np.concatenate([o[a:b] for o, a, b in ends]), minlength=n) >= enough)
        found = found[ids[found] != query_ids[q]]
        verified += len(found)
        rough = small[found] @ close[q]
        if len(found) > k:
            found = found[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - slack[q]]
        score = (vectors[found] * queries[q]).sum(axis=1)
        best = np.lexsort((ids[found], -score))[:k]
        out[0].append(np.full(len(best), q))
        out[1].append(ids[found[best]])
        out[2].append(score[best])
    return *[np.concatenate(x) if x else np.array([]) for x in out], verified


def _matrix(column, dim: int):
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _flat(column, dim: int):
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def search(
    table: DataFrame, k: int = 20, *, query: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", dim: int | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query row, by inner product.

    ``query`` is a condition on the ids (all rows by default).  Rows with a null id, with a
    vector that isn't usable, or of a length other than ``dim`` (by default the most
    frequent length, of equally frequent ones the least) take no part.  Ties go to the
    smaller id.  Rows that share a query's id are its own; an id with several rows
    searches once, with the least of its vectors, and each row can be found.  Without
    usable rows the result is empty.
    """
    spark = table.sparkSession
    ship(spark)
    rows = table.select(col(id_col).cast("long").alias("vec_id"), col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    asked = F.col("query_id").isNotNull() if query is None else query
    if dim is None:
        top = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
        dim = top[0]["dim"] if top else 0
    rows = cut(rows.filter(F.size("vector") == dim))
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    told = rows.select(F.col("vec_id").alias("query_id"), squares.alias("squares")).agg(F.count("*").alias("n"), F.count_if(asked).alias("asked"), F.max("squares").alias("reach")).first()
    if not told["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    plan = _planned(rows, told["reach"], told["n"], k, dim)
    sent, ranges = spark.sparkContext.broadcast(plan), len(plan.cuts) + 1

    def deal(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = sent.value.ranges(sent.value.project(_flat(batch.column(1), dim)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], ["vec_id", "vector", "range"])

    dealt = rows.mapInArrow(deal, "vec_id long, vector array<double>, range long") if ranges > 1 else rows.withColumn("range", F.lit(0).cast("long"))
    counts = {r["range"]: r["count"] for r in dealt.groupBy("range").count().collect()}  # MOST_RANGES rows at most
    size = lambda n, least, most, tasks: min(max(least, n // tasks), most)
    block_rows = size(told["n"], BLOCK_ROWS, MOST_BLOCK_ROWS, BLOCKS)
    blocks = {r: bucket_count(c, block_rows, 1) for r, c in counts.items()}
    groups = bucket_count(told["asked"], size(told["asked"], QUERY_ROWS, MOST_QUERY_ROWS, QUERY_BLOCKS), 1)
    boxes = _boxes(dealt, sent, dim) if ranges > 1 else None
    # By row, not by value: repeated rows are spread as well.
    by_range = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair])
    data = dealt.withColumn("block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), by_range[F.col("range")]).cast("int"))

    def route(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            ids, queries = batch.column(0).to_numpy(), _flat(batch.column(1), dim)
            widths = sent.value.half_widths(ids, queries)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(widths), *routes(ids, queries, widths)], ["query_id", "vector", "width", "home", "ranges"])

    def routes(ids, queries, widths):
        import numpy as np
        import pyarrow as pa

        if boxes is None:
            return pa.array(np.zeros(len(ids), np.int64)), pa.array([[0]] * len(ids), pa.list_(pa.int64()))
        centres = sent.value.centres(queries)
        touched = np.array([((centres + widths[:, None] >= low) & (centres - widths[:, None] <= high)).sum(axis=1) for low, high in boxes.values()])
        names = np.array(list(boxes))
        return pa.array(sent.value.ranges(centres)), pa.array([names[t >= needed()] for t in touched.T], pa.list_(pa.int64()))

    def again(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            ids, queries, widths = batch.column(0).to_numpy(), _flat(batch.column(1), dim), batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *routes(ids, queries, widths)], ["query_id", "vector", "width", "home", "ranges"])

    kinds = "query_id long, vector array<double>, width double, home long, ranges array<long>"
    queries = rows.withColumnRenamed("vec_id", "query_id").filter(asked).groupBy("query_id").agg(F.min("vector").alias("vector"))
    queries, found, best = cut(queries.mapInArrow(route, kinds)), None, Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    for left in range(ROUNDS, -1, -1):
        pairs = _meet(data, queries, blocks, groups, ranges, sent, dim)
        best_now = cut(pairs.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
        found = best_now if found is None else found.join(queries.select("query_id"), "query_id", "left_anti").union(best_now)
        full = best_now.groupBy("query_id").count().filter(F.col("count") >= min(k, told["n"] - 1)).select("query_id")
        short = queries.filter(F.col("width") < float("inf")).join(full, "query_id", "left_anti")
        wider = short.select("query_id", "vector", (F.col("width") * WIDEN if left > 1 else F.lit(float("inf"))).alias("width"))
        queries = cut(wider.mapInArrow(again, kinds))
        if queries.isEmpty():
            break
    return found.select("query_id", "rank", "vec_id", "score")


def _planned(rows: DataFrame, reach: float, n: int, k: int, dim: int) -> Plan:
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))
    sample = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(most).toArrow()
    ranges = 1 << (min(MOST_RANGES, max(1, n // BLOCK_ROWS)).bit_length() - 1)
    return make_plan(sample.column(0).to_numpy(), _matrix(sample.column(1), dim), reach, n, k, ranges)


def _boxes(dealt: DataFrame, sent, dim: int) -> dict:
    """{range: (lowest, highest) projections of its vectors}; MOST_RANGES times DIRECTIONS rows at most."""
    import numpy as np

    def ends(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held = {}
        for batch in batches:
            projected, at = sent.value.project(_flat(batch.column(1), dim)), batch.column(2).to_numpy()
            for r in np.unique(at).tolist():
                own = projected[at == r]
                low, high = held.get(r, (own[0], own[0]))
                held[r] = np.minimum(low, own.min(axis=0)), np.maximum(high, own.max(axis=0))
        for r, (low, high) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([r] * DIRECTIONS, pa.int64()), pa.array(range(DIRECTIONS), pa.int32()), pa.array(low), pa.array(high)], ["range", "at", "low", "high"])

    found = dealt.mapInArrow(ends, "range long, at int, low float, high float").groupBy("range", "at").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    boxes = {}
    for r in found.collect():
        low, high = boxes.setdefault(r["range"], (np.zeros(DIRECTIONS, np.float32), np.zeros(DIRECTIONS, np.float32)))
        low[r["at"]], high[r["at"]] = r["low"], r["high"]
    return boxes


def _meet(data: DataFrame, queries: DataFrame, blocks: dict, groups: int, ranges: int, sent, dim: int) -> DataFrame:
    """(query_id, vec_id, score) of the best of each query in each block of the ranges it goes to."""
    # Queries of one range go to much the same ranges, so a group is of one.
    group = F.concat_ws("-", "home", F.pmod(F.xxhash64("query_id"), F.lit(max(1, -(-groups // ranges)))))
    grouped = queries.withColumn("part", group).select("query_id", "vector", "width", "part", F.explode("ranges").alias("range"))
    visits = cut(grouped.groupBy(F.col("range").alias("visited")).agg(F.collect_set("part").alias("parts")))  # as many rows as ranges
    vectors = join_small(data, visits, F.col("range") == F.col("visited")).select("vec_id", "vector", "range", "block", F.explode("parts").alias("part"))
    by_range = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair])
    asked = grouped.filter(F.col("range").isin(list(blocks))).select("*", F.explode(F.sequence(F.lit(0), by_range[F.col("range")] - 1)).alias("block"))

    def run(left, right):
        import pyarrow as pa

        names = ["query_id", "vec_id", "score"]
        if not len(left) or not len(right):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        ids = right.column("query_id").to_numpy()
        q, found, score, _ = search_block(left.column("vec_id").to_numpy(), _matrix(left.column("vector"), dim), ids, _matrix(right.column("vector"), dim), right.column("width").to_numpy(), sent.value)
        return pa.table([pa.array(ids[q.astype("int64")]), pa.array(found.astype("int64")), pa.array(score.astype("float64"))], names)

    key = ["range", "block", "part"]
    return vectors.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(run, "query_id long, vec_id long, score double")
