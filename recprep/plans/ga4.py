"""Customer x item dataset from an event-level analytics export with nested items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recprep.functions import numeric as num
from recprep.functions.times import days_between, local_parts
from recprep.operators.keyed import dimension, distinct_counts, m_any, m_avg, m_max, m_min, m_sum, m_total, two_level
from recprep.plans.core import CUSTOMER, PRODUCT, interaction_dataset

# --- Fixed values: counted event names and the property that holds the user type. ---
PAIR_EVENTS = {
    "view_count": "view_item",
    "cart_add_count": "add_to_cart",
    "cart_remove_count": "remove_from_cart",
    "wishlist_count": "add_to_wishlist",
    "checkout_start_count": "begin_checkout",
    "purchase_count": "purchase",
}
CUSTOMER_EVENTS = {
    "session_count": "session_start",
    "page_view_count": "page_view",
    "item_view_count": "view_item",
    "cart_add_count": "add_to_cart",
    "purchase_count": "purchase",
}
USER_TYPE_KEY = "user_type"
# --- End of fixed values. ---


def _known(events: DataFrame) -> DataFrame:
    return events.where(F.col("user_pseudo_id").isNotNull())


def _items(events: DataFrame) -> DataFrame:
    """One row per item of an event."""
    return events.select(
        F.col("user_pseudo_id").alias(CUSTOMER), "event_name", "event_timestamp", "event_date", "table_suffix",
        F.explode("items").alias("item"),
    ).select("*", F.col("item.item_id").alias(PRODUCT)).where(F.col(PRODUCT).isNotNull())


def _named(names: dict[str, str]) -> list:
    return [m_any(out, F.col("event_name") == name) for out, name in names.items()]


def _suffix_days(suffix: str, first_micros: str) -> Column:
    """Days from the first event to the newest shard."""
    return days_between(F.col(suffix), F.timestamp_micros(first_micros))


def customer_demographics(events: DataFrame) -> DataFrame:
    """Place, device, traffic source and user type; one row per customer."""
    of_type = F.filter("user_properties", lambda p: p["key"] == F.lit(USER_TYPE_KEY))
    flat = _known(events).select(
        F.col("user_pseudo_id").alias(CUSTOMER),
        "user_id",
        *[F.col(f"geo.{c}").alias(c) for c in ("continent", "country", "region", "metro", "city")],
        F.col("device.category").alias("device_category"),
        F.col("device.operating_system").alias("operating_system"),
        F.col("device.web_info.browser").alias("browser"),
        F.col("device.language").alias("language"),
        F.timestamp_micros("user_first_touch_timestamp").cast("timestamp_ntz").alias("first_touch_timestamp"),
        F.col("traffic_source.source").alias("traffic_source"),
        F.col("traffic_source.medium").alias("traffic_medium"),
        F.col("traffic_source.campaign").alias("traffic_campaign"),
        F.try_element_at(of_type, F.lit(1))["value"]["string_value"].alias("user_type"),
    )
    return dimension(flat, [CUSTOMER], flat.columns[1:])


def product_features(events: DataFrame) -> DataFrame:
    """Item names and categories, mean price and quantity, reach, quantity and revenue."""
    rows = _items(events)
    names = {"product_name": "item_name", "brand": "item_brand", "category": "item_category"}
    names |= {f"category{i}": f"item_category{i}" for i in range(2, 6)}
    flat = rows.select("*", *[F.col(f"item.{old}").alias(new) for new, old in names.items()])
    price, quantity = F.col("item.price"), F.col("item.quantity")
    measures = [
        m_avg("avg_price", price),
        m_avg("avg_quantity", quantity, 0),
        m_total("total_quantity_sold", quantity),
        m_sum("total_revenue", price * quantity),
    ]
    reach = distinct_counts(flat, [PRODUCT], {"unique_users_viewed": CUSTOMER, "days_available": "event_date"})
    return dimension(flat, [PRODUCT], list(names), measures).join(reach, PRODUCT)


def customer_product_interactions(events: DataFrame) -> DataFrame:
    """Funnel counts (distinct event times), purchase price and spend per (customer, item)."""
    bought = F.col("event_name") == "purchase"
    price, quantity = F.col("item.price"), F.col("item.quantity")
    measures = [
        *_named(PAIR_EVENTS),
        m_avg("avg_purchase_price", F.when(bought, price)),
        m_sum("total_spent", F.when(bought, price * quantity).otherwise(F.lit(0.0))),
        m_max("max_quantity_purchased", F.when(bought, quantity.cast("long"))),
        m_min("first_interaction_timestamp", "event_timestamp"),
        m_max("last_interaction_timestamp", "event_timestamp"),
        m_max("_suffix", F.to_date("table_suffix", "yyyyMMdd")),
    ]
    pairs = two_level(_items(_known(events)), [CUSTOMER, PRODUCT], ["event_timestamp"], measures)
    since = _suffix_days("_suffix", "first_interaction_timestamp")
    return pairs.withColumn("days_since_first_interaction", since).drop("_suffix")


def ecommerce_transactions(events: DataFrame) -> DataFrame:
    """Purchases with their value, tax, shipping and item totals."""
    rows = _known(events).where(F.col("event_name") == "purchase").select(
        F.col("user_pseudo_id").alias(CUSTOMER),
        F.col("event_name").alias("event_type"),
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        F.col("ecommerce.value").cast("double").alias("transaction_value"),
        F.col("ecommerce.currency").alias("currency"),
        F.col("ecommerce.tax").cast("double").alias("tax_amount"),
        F.col("ecommerce.shipping").cast("double").alias("shipping_amount"),
        F.col("event_timestamp").alias("transaction_timestamp"),
        F.col("event_date").alias("transaction_date"),
        F.explode("items").alias("item"),
    )
    return rows.groupBy(*rows.columns[:-1]).agg(
        num.fixed_sum(F.col("item.price") * F.col("item.quantity")).alias("items_total_value"),
        F.sum(F.col("item.quantity").cast("long")).alias("total_items_purchased"),
    )


def customer_behavior(events: DataFrame) -> DataFrame:
    """Distinct event counts, revenue and lifetime per customer."""
    flat = _known(events).withColumn(CUSTOMER, F.col("user_pseudo_id"))
    paid = F.when(F.col("event_name") == "purchase", F.col("ecommerce.value"))
    measures = [
        *_named(CUSTOMER_EVENTS),
        m_sum("total_revenue", F.coalesce(paid, F.lit(0.0))),
        m_avg("avg_transaction_value", paid),
        m_min("first_event_timestamp", "event_timestamp"),
        m_max("last_event_timestamp", "event_timestamp"),
        m_max("_suffix", F.to_date("table_suffix", "yyyyMMdd")),
    ]
    out = two_level(flat, [CUSTOMER], ["event_timestamp"], measures)
    return out.withColumn("customer_lifetime_days", _suffix_days("_suffix", "first_event_timestamp")).drop("_suffix")


def price_closeness(paid: Column, listed: Column) -> Column:
    """1 - |paid - listed| / listed, rounded to 2 places; 0 without a positive list price."""
    apart = F.abs(F.coalesce(paid, F.lit(0.0)) - listed) / listed
    return F.when(listed > 0, num.round_to(F.lit(1) - apart, 2)).otherwise(F.lit(0.0))


def _main_columns() -> list[Column]:
    c = F.col

    def zero(name: str, kind: str = "long") -> Column:
        return num.or_zero(name, kind)

    engagement = (
        zero("i.view_count") * 0.1 + zero("i.cart_add_count") * 0.3 + zero("i.purchase_count") * 0.6
        + zero("total_spent", "double") / 10
    )
    paid, listed = c("avg_purchase_price"), c("p.avg_price")
    return [
        c(CUSTOMER), c(PRODUCT), c("product_name"), c("brand"), c("category").alias("product_category"),
        c("user_id"), c("continent"), c("country"), c("region"), c("city"), c("device_category"),
        c("operating_system"), c("browser"), c("language"), c("traffic_source"), c("traffic_medium"),
        c("traffic_campaign"), c("user_type"),
        zero("i.view_count").alias("product_views"), zero("i.cart_add_count").alias("product_cart_adds"),
        zero("wishlist_count").alias("product_wishlist_adds"), zero("i.purchase_count").alias("product_purchases"),
        zero("total_spent", "double").alias("total_spent_on_product"),
        zero("avg_purchase_price", "double").alias("avg_purchase_price"),
        zero("max_quantity_purchased").alias("max_quantity_purchased"),
        zero("p.avg_price", "double").alias("product_avg_price"),
        zero("total_quantity_sold").alias("product_total_sold"),
        zero("p.total_revenue", "double").alias("product_total_revenue"),
        zero("unique_users_viewed").alias("product_unique_viewers"),
        listed.alias("product_list_price"),
        (zero("avg_purchase_price", "double") - zero("p.avg_price", "double")).alias("price_difference"),
        zero("b.total_revenue", "double").alias("customer_lifetime_value"),
        zero("avg_transaction_value", "double").alias("avg_transaction_value"),
        zero("session_count").alias("total_sessions"), zero("page_view_count").alias("total_page_views"),
        zero("item_view_count").alias("total_item_views"), zero("b.cart_add_count").alias("total_cart_adds"),
        zero("b.purchase_count").alias("total_purchases"),
        *local_parts(F.timestamp_micros("last_interaction_timestamp"), "last_interaction"),
        zero("days_since_first_interaction").alias("days_since_first_interaction"),
        zero("customer_lifetime_days").alias("customer_lifetime_days"),
        num.flag(c("i.purchase_count") > 0).alias("has_purchased"),
        num.flag(c("i.cart_add_count") > 0).alias("has_added_to_cart"),
        num.flag(c("i.view_count") > 0).alias("has_viewed"),
        engagement.alias("engagement_score"),
        price_closeness(paid, listed).alias("price_sensitivity_index"),
    ]


def customer_item_dataset(events: DataFrame, ordered: bool = False) -> DataFrame:
    """One row per (customer, item).

    The source query also joins transactions on the customer, only to coalesce a key that is
    never NULL; that join multiplies rows the dedupe removes again, so it is left out.
    """
    return interaction_dataset(
        customer_product_interactions(events),
        [
            (customer_demographics(events).alias("d"), [CUSTOMER], "left"),
            (product_features(events).alias("p"), [PRODUCT], "left"),
            (customer_behavior(events).alias("b"), [CUSTOMER], "left"),
        ],
        _main_columns(),
        ordered=[F.col(CUSTOMER), F.col(PRODUCT)] if ordered else None,
    )
