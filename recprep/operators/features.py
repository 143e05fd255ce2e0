"""Item and user feature tables with ordinal encodings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.operators.keyed import first_values, m_avg
from recprep.operators.ranks import dense_index, dense_indexes
from recprep.session import materialize

ITEM_ENCODINGS = {"category_code": "category_code_idx", "brand": "brand_idx", "category_id": "category_id_idx"}
USER_ENCODINGS = {"age_band": "age_band_idx", "geo_province": "geo_province_idx", "device_category": "device_idx"}


def ordinal_encode(
    df: DataFrame, column: str, out: str, mapping: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Add ``out``: 1-based rank of the value among the distinct values; 0 for NULL or unknown.

    Returns (frame, mapping(value, idx)). An earlier mapping can be applied to new data.
    """
    if mapping is None:
        mapping = _value_index(df, column)
    known = mapping.select(F.col("value").alias("_value"), F.col("idx").alias(out))
    joined = df.join(known, F.col(column) == F.col("_value"), "left").drop("_value")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(0)).cast("long")), mapping


def _encode_all(df: DataFrame, encodings: dict[str, str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Encode several text columns; all mappings come from one pass over a written copy of the table."""
    base = materialize(df)
    known = materialize(dense_indexes(base, list(encodings)))
    maps = {out: known.where(F.col("column") == column).drop("column") for column, out in encodings.items()}
    done = base
    for column, out in encodings.items():
        done, _ = ordinal_encode(done, column, out, maps[out])
    return done, maps


def _value_index(df: DataFrame, column: str) -> DataFrame:
    return dense_index(df, column).withColumnRenamed(column, "value")


def item_features(
    events: DataFrame, cold_ids: DataFrame | None = None, order: str = "event_time"
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Per item: first category and brand, mean price, popularity, cold flag, encodings."""
    price = m_avg("price", "price")
    items = first_values(
        events,
        ["item_id"],
        ["category_id", "category_code", "brand"],
        order,
        partial=[*price.partial, F.count("*").alias("_n")],
        merged=[price.merged.alias("price"), F.sum("_n").alias("popularity")],
    )
    if cold_ids is None:
        items = items.withColumn("is_cold", F.lit(False))
    else:
        cold = cold_ids.select(F.col("item_id").alias("_cold")).distinct()
        items = items.join(cold, F.col("item_id") == F.col("_cold"), "left")
        items = items.withColumn("is_cold", F.col("_cold").isNotNull()).drop("_cold")
    return _encode_all(items, ITEM_ENCODINGS)


def user_features(train: DataFrame, order: str = "event_time") -> tuple[DataFrame, dict[str, DataFrame]]:
    """Per user: first age band, province, device and lifetime value, event count, encodings."""
    users = first_values(
        train,
        ["user_id"],
        ["age_band", "geo_province", "device_category", "customer_ltv"],
        order,
        partial=[F.count("*").alias("_n")],
        merged=[F.sum("_n").alias("interaction_count")],
    )
    return _encode_all(users, USER_ENCODINGS)


def encoder_table(maps: dict[str, DataFrame]) -> DataFrame:
    """All mappings as one long table (encoder, value, idx)."""
    parts = [
        m.select(F.lit(name).alias("encoder"), F.col("value").cast("string").alias("value"), "idx")
        for name, m in maps.items()
    ]
    return reduce(DataFrame.unionByName, parts)
