"""Connected components of a graph given as edges, on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _lowest(both: DataFrame) -> DataFrame:
    """(v, low) for each v of (v, w): the lowest of v and its neighbours.

    Cut, so that joins with it exchange both sides and a vertex with very many
    neighbours is split by adaptive execution.
    """
    return cut(both.groupBy("v").agg(F.least("v", F.min("w")).alias("low")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("v", "w").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for every vertex of ``edges`` (v, w: longs); label is the lowest vertex reached.

    Alternates large-star and small-star steps (Kiveris et al., "Connected Components in
    MapReduce and Beyond", 2014) until the edges are stars around the lowest vertices.
    Every step is written to the shared folder, so a lost executor costs that step at most.
    """
    edges = cut(edges.filter("v <> w").select(F.greatest("v", "w").alias("v"), F.least("v", "w").alias("w")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select("w", "v"))
        low = _lowest(both)
        large = cut(both.join(low, "v").filter("w > v").select(F.col("w").alias("v"), F.col("low").alias("w")).distinct())
        low = _lowest(large)
        moved = large.join(low, "v").select(F.col("w").alias("v"), F.col("low").alias("w"))
        edges = cut(moved.union(low.select("v", "low")).filter("v <> w").distinct())
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select("v", F.col("w").alias("label")).union(edges.select(F.col("w").alias("v"), F.col("w").alias("label")).distinct())
