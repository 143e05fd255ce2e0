"""The next value of an ordered group, where a group may hold most of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recprep.operators.ordered import PART, ROW, lay_out
from recprep.session import materialize


@dataclass(frozen=True)
class SplitPlan:
    """Which keys are hot: those with at least 1/``pieces`` of the sampled rows, and at least ``min_hits`` of them.

    There are at most ``pieces`` such keys, whatever the size of the data. The sample (1 row in
    ``sample_mod``) decides only which way a key's rows take, never the result.
    """

    pieces: int = 4096
    sample_mod: int = 1024
    min_hits: int = 32


def hot_keys(df: DataFrame, key: str, plan: SplitPlan) -> DataFrame | None:
    """Keys (at most ``plan.pieces``) that hold a large share of the rows; None when there is none."""
    place = F.xxhash64(F.monotonically_increasing_id())
    sample = df.select(key, place.alias("_h")).where(F.pmod("_h", F.lit(plan.sample_mod)) == 0)
    counts = sample.groupBy(key).agg(F.count("*").alias("_n"))
    seen = counts.agg(F.sum("_n").alias("total"), F.max("_n").alias("most")).first()
    if seen["most"] is None or seen["most"] < plan.min_hits or seen["most"] * plan.pieces < seen["total"]:
        return None
    enough = (F.col("_n") >= plan.min_hits) & (F.col("_n") * F.lit(plan.pieces) >= F.lit(seen["total"]))
    return materialize(counts.where(enough).select(key))


def next_in_group(
    df: DataFrame, key: str, order: list[str], out: str, plan: SplitPlan | None = SplitPlan()
) -> DataFrame:
    """Add ``out``: the value of ``order[0]`` in the next row of the same key (NULL at the end).

    Equal to LEAD(order[0]) OVER (PARTITION BY key ORDER BY order). Rows of hot keys take another
    way: a segmented scan over range partitions of (key, order), which also cut a key whose rows
    share one instant. Inside a partition LEAD gives the next row; the last row of a key in a
    partition takes the first value of that key in the next partition, from a table with one row
    per key and partition (each border adds at most one, so it may be broadcast).
    """
    hot = None if plan is None else hot_keys(df, key, plan)
    window = Window.partitionBy(key).orderBy(*order)
    if hot is None:
        return df.withColumn(out, F.lead(order[0]).over(window))
    usual = df.join(F.broadcast(hot), key, "left_anti").withColumn(out, F.lead(order[0]).over(window))
    return usual.unionByName(_segmented(df.join(F.broadcast(hot), key, "left_semi"), key, order, out))


def _segmented(rows: DataFrame, key: str, order: list[str], out: str) -> DataFrame:
    laid = lay_out(rows, [key, *order])
    inside = Window.partitionBy(PART, key).orderBy(ROW)
    led = laid.withColumn("_lead", F.lead(order[0]).over(inside))
    heads = laid.groupBy(key, PART).agg(F.min(order[0]).alias("_head"))
    line = Window.partitionBy(key).orderBy(PART)
    following = heads.select(key, PART, F.lead("_head").over(line).alias("_next"))
    joined = led.join(F.broadcast(following), [key, PART])
    return joined.withColumn(out, F.coalesce("_lead", "_next")).select(*rows.columns, out)
