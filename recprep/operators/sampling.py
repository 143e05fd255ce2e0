"""Sampling by portable hash: order-free, and exact in size where an exact size is asked for."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recprep.functions.hashing import draw_below, draw_upto, u01
from recprep.operators.ordered import row_ids

_BUCKETS = 1 << 16  # of one histogram
_RANKED = 100_000  # keys of a bucket that one task may rank


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int, salt: str = "sample", instead: Column | None = None) -> DataFrame:
    """Keep every row of about ``fraction`` of the keys. A filter: no shuffle.

    Where the key is NULL, ``instead`` is hashed; without it NULL is one key of its own, whose
    rows are kept or dropped together.
    """
    values = [F.col(key).cast("string"), *([] if instead is None else [instead.cast("string")]), F.lit("")]
    return df.where(draw_below(fraction, seed, salt, F.coalesce(*values)))


@dataclass(frozen=True)
class Cut:
    """Hash position of the last key inside an exact-n sample."""

    u: float
    key: str


def hash_cut(
    keys: DataFrame,
    key: str,
    size: Callable[[Column], Column],
    seed: int,
    salt: str,
) -> Cut | None:
    """Position of the n-th key in hash order, n = size(number of keys); None when n is 0.

    ``keys`` holds each key once. Which keys are in an exact-n sample is then a comparison
    with a literal (``in_cut``) that any table can make row by row, without a join. The n-th
    position is found from a histogram of hash buckets (at most 65,536 rows); the bucket where
    the count reaches n gets a histogram of its own, until it holds few enough keys (100,000) to
    rank them in one task. Each level is a job; one row comes back.
    """
    draws = keys.where(F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("k"), u01(seed, salt, F.col(key)).alias("u")
    )
    wanted, cells = None, 1.0
    for _ in range(3):
        cells *= _BUCKETS
        histogram = draws.withColumn("b", F.floor(F.col("u") * cells)).groupBy("b").agg(F.count("*").alias("c"))
        upto = histogram.select(
            "b", "c", F.sum("c").over(Window.orderBy("b")).alias("upto"), F.sum("c").over(Window.partitionBy()).alias("total")
        )
        rank = size(F.col("total")).cast("long") if wanted is None else F.lit(wanted)
        edge = upto.where((F.col("upto") >= rank) & (F.col("upto") - F.col("c") < rank)).select(
            "b", "c", (rank - (F.col("upto") - F.col("c"))).alias("rank")
        ).first()
        if edge is None:
            return None
        wanted = edge["rank"]
        draws = draws.where(F.floor(F.col("u") * cells) == F.lit(edge["b"]))
        if edge["c"] <= _RANKED:
            break
    ranked = draws.withColumn("rn", F.row_number().over(Window.orderBy("u", "k")))
    last = ranked.where(F.col("rn") == F.lit(wanted)).select("u", "k").first()
    return Cut(last["u"], last["k"])


def in_cut(key: str, cut: Cut | None, seed: int, salt: str) -> Column:
    """True for keys in the exact-n sample; false for a NULL key or an empty sample."""
    if cut is None:
        return F.lit(False)
    return F.coalesce(draw_upto(cut.u, cut.key, seed, salt, F.col(key)), F.lit(False))


def take_keys(
    keys: DataFrame, key: str, size: Callable[[Column], Column], seed: int, salt: str
) -> DataFrame:
    """Exactly n of the given distinct keys."""
    return keys.where(in_cut(key, hash_cut(keys, key, size, seed, salt), seed, salt))


def limit_rows(df: DataFrame, n: int, seed: int, key: Column | None = None, salt: str = "limit") -> DataFrame:
    """At most ``n`` rows, the same ones in any run and under any partitioning.

    The rows that come first by a hash of ``key`` (one value per row; default: the row itself and
    the number of its copy). They are found by a comparison with the n-th position, in parallel;
    rows without a key are left out.
    """
    ids = row_ids(df, "_row") if key is None else df.withColumn("_row", key.cast("string"))
    cut = hash_cut(ids.select("_row"), "_row", lambda total: F.least(total, F.lit(n)), seed, salt)
    return ids.where(in_cut("_row", cut, seed, salt)).drop("_row")
