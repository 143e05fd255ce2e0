"""The unified event schema and the loaders that produce it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recprep.config import EVENT_TYPE_MAP
from recprep.functions.text import age_band, map_values

# --- Fixed values: column names, types and order of the event schema and raw inputs. ---
EVENT_COLUMNS = {
    "event_time": "long",
    "event_type": "string",
    "user_id": "string",
    "user_pseudo_id": "string",
    "item_id": "string",
    "category_id": "string",
    "category_code": "string",
    "brand": "string",
    "price": "double",
    "user_session": "string",
    "engagement_time_msec": "long",
    "device_category": "string",
    "geo_province": "string",
    "discount_flag": "boolean",
    "fulfillment_status": "string",
    "customer_ltv": "double",
    "age_band": "string",
}
BEHAVIOR_SCHEMA = (
    "event_time timestamp, event_type string, product_id string, category_id string, "
    "category_code string, brand string, price double, user_id string, user_session string"
)
ORDER_SCHEMA = (
    "customer_id string, product_id string, order_timestamp timestamp, order_status string, "
    "price double, brand string, category string, region string, age int, discount boolean, ltv double"
)
# --- End of fixed values. ---

_TEXT_TIME = ["yyyy-MM-dd HH:mm:ss z", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss"]


def event_schema() -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in EVENT_COLUMNS.items()))


def to_event_schema(df: DataFrame, values: dict[str, Column], keep: tuple[str, ...] = ()) -> DataFrame:
    """Select the unified columns; what ``values`` does not name is NULL (discount: false).

    ``keep`` lists source columns (a row id, say) to carry along behind them.
    """
    out = []
    for name, kind in EVENT_COLUMNS.items():
        missing = F.lit(False) if name == "discount_flag" else F.lit(None)
        out.append(values.get(name, missing).cast(kind).alias(name))
    return df.select(*out, *keep)


def time_ms(df: DataFrame, column: str) -> Column:
    """Epoch milliseconds of a timestamp, date, epoch or text column; unparsable text is NULL."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.StringType):
        parsed = F.coalesce(*[F.try_to_timestamp(value, F.lit(p)) for p in _TEXT_TIME])
        return F.unix_millis(parsed)
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return value.cast("long")
    return F.unix_millis(value.cast("timestamp"))


def harmonize_behavior(
    raw: DataFrame, event_type_map: dict[str, str] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Behavior log to unified events; event types outside the map become NULL."""
    mapping = EVENT_TYPE_MAP if event_type_map is None else event_type_map
    same = ["category_id", "category_code", "brand", "price", "user_id", "user_session"]
    values = {name: F.col(name) for name in same}
    values["event_time"] = time_ms(raw, "event_time")
    values["event_type"] = map_values(F.col("event_type").cast("string"), mapping)
    values["item_id"] = F.col("product_id")
    return to_event_schema(raw, values, keep)


def harmonize_orders(
    raw: DataFrame,
    region_to_province: dict[str, str] | None = None,
    null_age_band: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Order table to purchase events, using whichever of the known columns exist.

    A missing status counts as 'completed'. A NULL age gives ``null_age_band``.
    """
    have = set(raw.columns)

    def first_of(*names: str) -> Column:
        for name in names:
            if name in have:
                return F.col(name)
        return F.lit(None)

    values = {
        "event_time": time_ms(raw, "order_timestamp" if "order_timestamp" in have else "event_time"),
        "event_type": F.lit("purchase"),
        "user_id": first_of("customer_id", "user_id"),
        "item_id": F.col("product_id"),
        "category_id": first_of("category_id"),
        "category_code": first_of("category", "category_code"),
        "brand": first_of("brand"),
        "price": first_of("price"),
        "user_session": first_of("user_session"),
        "customer_ltv": first_of("ltv"),
        "fulfillment_status": F.col("order_status") if "order_status" in have else F.lit("completed"),
    }
    if "region" in have:
        values["geo_province"] = map_values(F.col("region").cast("string"), region_to_province or {})
    if "discount" in have:
        values["discount_flag"] = F.col("discount")
    if "age" in have:
        values["age_band"] = age_band(F.col("age").cast("int"), null_age_band)
    return to_event_schema(raw, values, keep)


def _read_glob(spark: SparkSession, path_glob: str) -> DataFrame:
    try:
        return spark.read.parquet(path_glob)
    except Exception as error:  # Spark names the reason in its own exception classes
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            raise FileNotFoundError(f"no parquet files match {path_glob}") from error
        raise


def load_behavior(
    spark: SparkSession, path_glob: str, event_type_map: dict[str, str] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Read and harmonize behavior logs; an error when no file matches."""
    return harmonize_behavior(_read_glob(spark, path_glob), event_type_map, keep)


def load_orders(
    spark: SparkSession,
    path_glob: str,
    region_to_province: dict[str, str] | None = None,
    null_age_band: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Read and harmonize order tables; an error when no file matches."""
    return harmonize_orders(_read_glob(spark, path_glob), region_to_province, null_age_band, keep)


def harmonize(behavior: DataFrame, orders: DataFrame) -> DataFrame:
    """Both streams in one table."""
    return behavior.unionByName(orders)


def write_harmonized(behavior: DataFrame, orders: DataFrame, out_path: str) -> str:
    harmonize(behavior, orders).write.mode("overwrite").parquet(out_path)
    return out_path
