"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.session import materialize


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``a, b`` (long) edges to ``node, root``: the smallest node reachable; nodes with edges only.

    Alternating star contractions: in the large-star step each node tells its larger neighbours the
    smallest node it sees, in the small-star step its smaller ones. Each step is an aggregate
    and an equi-join over as many rows as there are edges; a hub is pre-aggregated and its
    join partition can be split. The table is written after each round, so lineage stays short
    and a lost executor costs one round at most. The number of rounds is logarithmic in practice.
    """
    pairs = materialize(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    before = None
    for _ in range(max_rounds):
        pairs = materialize(_small_star(_large_star(pairs)))
        now = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = pairs.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def _large_star(pairs: DataFrame) -> DataFrame:
    """For each node u and neighbour v > u: (smallest of u and its neighbours, v)."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    # pairs has a < b: each edge is once a larger neighbour, seen from a.
    return pairs.join(low, "a").select(F.col("low").alias("a"), "b").distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """For each node u with smaller neighbours N: (min N, each of N and u)."""
    low = pairs.groupBy("b").agg(F.min("a").alias("low"))
    linked = pairs.join(low, "b").select("low", "a").filter("low <> a")
    own = low.select("low", F.col("b").alias("a"))
    return linked.unionByName(own).select(F.col("low").alias("a"), F.col("a").alias("b")).distinct()
