"""Per-key reductions that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recprep.functions import numeric as num

_LATEST = 9223372036854775807


def first_values(
    df: DataFrame,
    keys: list[str],
    firsts: list[str],
    order: str,
    partial: list[Column] = (),
    merged: list[Column] = (),
) -> DataFrame:
    """Per key, the earliest non-NULL value of each column (ties: smallest value), plus measures.

    Phase 1 groups by keys *and* attributes: a hash aggregate with primitive buffers that
    folds a hot key on the map side. Phase 2 picks from the few attribute combinations left.
    ``partial`` are phase-1 aggregates, ``merged`` re-aggregates them in phase 2.
    """
    when = F.coalesce(F.col(order).cast("long"), F.lit(_LATEST))
    combos = df.groupBy(*keys, *firsts).agg(F.min(when).alias("_t"), *partial)
    picks = [
        F.min(F.when(F.col(c).isNotNull(), F.struct("_t", c)))[c].alias(c) for c in firsts
    ]
    return combos.groupBy(*keys).agg(*picks, *merged)


def best_row(df: DataFrame, keys: list[Column | str], order: list[Column]) -> DataFrame:
    """Keep the first row per key in the given order.

    Written as ROW_NUMBER() = 1, which Spark runs with a group limit before the shuffle: each
    map task sends at most one row per key, however hot the key is.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


# --- measures that aggregate in two steps ---------------------------------------------


@dataclass(frozen=True)
class Measure:
    """An aggregate as partial columns at a fine grain and their merge at a coarse one."""

    name: str
    partial: tuple[Column, ...]
    merged: Column


def m_sum(name: str, c: Column | str, places: int = 4) -> Measure:
    """Sum of a double (see ``fixed_sum``)."""
    part, left = f"_{name}", f"_{name}_rest"
    whole, rest = num.split_units(c, places)
    merged = F.sum(part) / F.lit(float(10**places)) + F.sum(left)
    return Measure(name, (F.sum(whole).alias(part), F.sum(rest).alias(left)), merged)


def m_avg(name: str, c: Column | str, places: int = 4) -> Measure:
    total, seen = m_sum(name, c, places), f"_{name}_n"
    merged = total.merged / F.nullif(F.sum(seen), F.lit(0))
    return Measure(name, (*total.partial, F.count(num.col(c)).alias(seen)), merged)


def m_total(name: str, c: Column | str) -> Measure:
    """Sum of whole numbers."""
    part = f"_{name}"
    return Measure(name, (F.sum(num.col(c).cast("long")).alias(part),), F.sum(part))


def m_count(name: str, test: Column | None = None) -> Measure:
    part = f"_{name}"
    counted = F.count("*") if test is None else F.count(F.when(test, F.lit(1)))
    return Measure(name, (counted.alias(part),), F.sum(part))


def m_min(name: str, c: Column | str) -> Measure:
    return Measure(name, (F.min(num.col(c)).alias(f"_{name}"),), F.min(f"_{name}"))


def m_max(name: str, c: Column | str) -> Measure:
    return Measure(name, (F.max(num.col(c)).alias(f"_{name}"),), F.max(f"_{name}"))


def m_any(name: str, test: Column) -> Measure:
    """Number of fine groups with at least one row that passes the test.

    With the stamp as the fine column this is COUNT(DISTINCT CASE WHEN test THEN stamp END).
    """
    part = f"_{name}"
    return Measure(name, (F.max(F.when(test, F.lit(1))).alias(part),), F.count(part))


def m_small_domain(name: str, value: Column) -> Measure:
    """Exact COUNT(DISTINCT value) for integers 0..63, carried as a bit mask; others are an error."""
    part = f"_{name}"
    mask = F.bit_or(num.bit_of(value))
    return Measure(name, (mask.alias(part),), F.coalesce(F.bit_count(F.bit_or(part)), F.lit(0)).cast("long"))


SPREAD = 4  # tasks that a key's fine groups are dealt to


def dealt(df: DataFrame, keys: list[str], finer: list[str]) -> DataFrame:
    """Rows shuffled by key and ``_bucket``, one of :data:`SPREAD` buckets of the finer columns."""
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(*finer), F.lit(SPREAD)).cast("int"))
    return rows.repartition(*keys, "_bucket")


def two_level(
    df: DataFrame, keys: list[str], finer: list[str], measures: list[Measure] = (), extra: list[Column] = (),
    spread: bool = False,
) -> DataFrame:
    """Group by keys + finer columns, then by keys.

    After step one there is one row per distinct ``finer`` value, so ``extra`` aggregates can
    count those rows: exact distinct counts next to plain measures, without Expand. Step one
    also folds a hot key on the map side before its rows meet.

    ``spread`` is for fine groups of about one row each, where folding on the map side only widens
    the rows: they are shuffled as they are, once, by key and one of 4 buckets of the fine columns. Step
    two then folds a key to at most 4 rows before the second, small shuffle.
    """
    partial = [p for m in measures for p in m.partial]
    fixed = list(keys)
    if spread:
        df = dealt(df, keys, finer)
        fixed.append("_bucket")
    grouped = df.groupBy(*fixed, *finer)
    fine = grouped.agg(*partial) if partial else df.select(*fixed, *finer).distinct()
    return fine.groupBy(*keys).agg(*extra, *[m.merged.alias(m.name) for m in measures])


def dimension(df: DataFrame, keys: list[str], attributes: list[str], measures: list[Measure] = ()) -> DataFrame:
    """One row per key: its smallest attribute combination (NULLs first) and its measures."""
    best = F.min(F.struct(*attributes)).alias("_a")
    wide = two_level(df, keys, attributes, measures, [best])
    return wide.select(*keys, "_a.*", *[m.name for m in measures])


def distinct_counts(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """COUNT(DISTINCT column) per key for several columns, in one pass.

    Each row is tagged once per column, (key, tag, value) is made distinct on the map side first
    and counted per tag afterwards, so a hot key's rows never meet before they are distinct.
    """
    return df.groupBy(*keys).agg(*[F.count_distinct(column).alias(name) for name, column in columns.items()])
