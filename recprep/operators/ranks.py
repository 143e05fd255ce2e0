"""Global positions (dense index, running total) without putting all values in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recprep.operators.ordered import with_position
from recprep.session import materialize


def dense_index(values: DataFrame, column: str, out: str = "idx") -> DataFrame:
    """Number distinct non-NULL values 1..k in ascending order."""
    distinct = values.select(column).where(F.col(column).isNotNull()).distinct()
    return with_position(distinct, [column], out, ties=False)


def dense_indexes(df: DataFrame, columns: list[str], out: str = "idx") -> DataFrame:
    """(column, value, idx): the distinct non-NULL values of each column, numbered 1..k in ascending order.

    One pass over ``df`` for all columns, which must have one type. Values are tagged with the place
    of their column, reduced to distinct ones on the map side, laid out by (tag, value), and a
    column's numbers start where the one before ends.
    """
    kinds = {df.schema[c].dataType for c in columns}
    if len(kinds) != 1:
        raise ValueError("columns of one type can share a pass")
    tagged = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("tag"), F.col(c).alias("value")) for i, c in enumerate(columns)
    ])).alias("t")).select("t.*")
    distinct = tagged.where(F.col("value").isNotNull()).distinct()
    placed = materialize(with_position(distinct, ["tag", "value"], "at", ties=False))
    first = placed.groupBy("tag").agg(F.min("at").alias("first"))
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("tag") + 1)
    joined = placed.join(F.broadcast(first), "tag")  # a row per column
    return joined.select(name.alias("column"), "value", (F.col("at") - F.col("first") + 1).alias(out))


def running_total(df: DataFrame, key: str, weight: str) -> DataFrame:
    """Add ``lo``/``hi``: each key's half-open interval on the line 0..sum(weight).

    ``weight`` is an integer, so totals are exact in any order. Keys are laid out by
    (hash prefix, key); 4,096 prefixes are summed first and shift the totals inside each.
    """
    placed = df.withColumn("_b", F.substring(F.md5(F.col(key).cast("string")), 1, 3))
    inside = placed.withColumn(
        "_in", F.sum(weight).over(Window.partitionBy("_b").orderBy(key))
    )
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shifts = placed.groupBy("_b").agg(F.sum(weight).alias("_s")).select(
        "_b", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_shift")
    )
    joined = inside.join(F.broadcast(shifts), "_b")  # at most 4,096 rows
    hi = F.col("_in") + F.col("_shift")
    return joined.select(*df.columns, (hi - F.col(weight)).alias("lo"), hi.alias("hi"))


def weighted_pick(
    draws: DataFrame, draw: str, weights: DataFrame, key: str, weight: str, total: int, n_keys: int
) -> DataFrame:
    """For each draw in [0, 1) choose a key with probability proportional to its weight.

    ``total`` is the sum of the whole-number weights. The weight line is cut into about
    ``n_keys`` equal cells. A key covers the cells its interval touches and a draw lands in
    one cell, so the range join becomes an equi-join with a residual test; a heavy key is
    spread over many cells. The number of cells changes the plan, never the result.
    """
    line = running_total(weights, key, weight)
    width = max(1, total // max(1, n_keys))
    covered = line.select(
        key, "lo", "hi",
        F.explode(F.sequence(_cell("lo", width), _cell(F.col("hi") - 1, width))).alias("_cell"),
    )
    placed = draws.withColumn("_at", F.floor(F.col(draw) * F.lit(float(total))))
    placed = placed.withColumn("_cell", _cell("_at", width))
    joined = placed.join(covered, "_cell")
    return joined.where((F.col("_at") >= F.col("lo")) & (F.col("_at") < F.col("hi"))).drop(
        "_cell", "_at", "lo", "hi"
    )


def _cell(position: Column | str, width: int) -> Column:
    position = F.col(position) if isinstance(position, str) else position
    return F.floor(position / F.lit(width))
