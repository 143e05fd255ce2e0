"""Global order in parallel: range partitions, and positions from their sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recprep.functions.hashing import row_key
from recprep.session import materialize

PART, ROW = "_part", "_row"
_ROW_BITS = 33  # monotonically_increasing_id: the partition above these bits, the row below


def lay_out(df: DataFrame, order: list[Column | str], ties: bool = True) -> DataFrame:
    """``df`` in ascending order over range partitions, stored; adds ``_part`` and ``_row``.

    Spark draws the splitters from the data and their number grows with it (adaptive execution
    merges partitions that are too small), so no literal list and no task that sees all rows is
    needed. Rows equal in ``order`` are laid out by a hash of the whole row, then by their place
    in the input (``ties``): many rows with one key are cut like any others, and only identical
    rows can change places between runs. The table is stored because the splitters are drawn
    again whenever the plan is built again.
    """
    keys, rows = list(order), df
    if ties:
        rows = rows.withColumn("_lay_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        rows = rows.withColumn("_lay_place", F.monotonically_increasing_id())
        keys += ["_lay_tie", "_lay_place"]
    laid = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_lay_tie", "_lay_place")
    numbered = laid.withColumn("_at", F.monotonically_increasing_id())
    return materialize(
        numbered.withColumns({
            PART: F.shiftright("_at", _ROW_BITS).cast("int"),
            ROW: F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }).drop("_at")
    )


def part_offsets(laid: DataFrame) -> DataFrame:
    """``_part``, ``_before``: rows in all partitions before; one row per partition, so it may be broadcast."""
    sizes = laid.groupBy(PART).agg(F.count(F.lit(1)).alias("_size"))
    line = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(PART, F.coalesce(F.sum("_size").over(line), F.lit(0)).alias("_before"))


def with_position(df: DataFrame, order: list[Column | str], out: str = "position", ties: bool = True) -> DataFrame:
    """Add the place of each row (from 1) in the given global order.

    Equal to ROW_NUMBER() OVER (ORDER BY order, hash of the row), which would sort all rows in one task.
    """
    laid = lay_out(df, order, ties)
    placed = laid.join(F.broadcast(part_offsets(laid)), PART)
    columns = [F.col(f"`{c}`") for c in df.columns]
    return placed.select(*columns, (F.col("_before") + F.col(ROW) + 1).alias(out))


def number_copies(df: DataFrame, out: str = "copy_no") -> DataFrame:
    """Number the identical rows 1, 2, ... without a group that holds all copies of a row.

    Two levels: copies are counted per task of the stored input, the counts of the tasks before
    give an offset, and only rows that have copies are numbered inside (row, task). Rows are told
    apart by 128 hash bits (:func:`recprep.functions.hashing.row_key`).
    """
    stored = materialize(df.withColumns({"_key": row_key(df), PART: F.spark_partition_id()}))
    per_task = stored.groupBy("_key", PART).agg(F.count(F.lit(1)).alias("_n"))
    line = Window.partitionBy("_key").orderBy(PART)
    spread = per_task.select(
        "_key", PART,
        F.coalesce(F.sum("_n").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("_key")).alias("_copies"),
    )
    offsets = materialize(spread.where("_copies > 1").drop("_copies"))
    once = stored.join(offsets, ["_key", PART], "left_anti").withColumn(out, F.lit(1).cast("long"))
    many = stored.join(offsets, ["_key", PART])
    inside = F.row_number().over(Window.partitionBy("_key", PART).orderBy(F.lit(0)))
    many = many.withColumn(out, (F.col("_before") + inside).cast("long")).drop("_before")
    columns = [F.col(f"`{c}`") for c in df.columns]
    return once.unionByName(many).select(*columns, out)


def row_ids(df: DataFrame, out: str = "row_id") -> DataFrame:
    """Add an id that no other row has: 128 hash bits of the row and the number of the copy."""
    numbered = number_copies(df, "_copy")
    return numbered.withColumn(out, F.concat_ws("#", row_key(df), F.col("_copy").cast("string"))).drop("_copy")

