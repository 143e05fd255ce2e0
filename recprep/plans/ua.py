"""Customer x product dataset from a session-level analytics export with nested hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recprep.functions import numeric as num
from recprep.functions.times import days_between, local_parts
from recprep.operators.keyed import dimension, distinct_counts, m_any, m_avg, m_max, m_min, m_sum, m_total, two_level
from recprep.plans.core import CUSTOMER, PRODUCT, interaction_dataset
from recprep.plans.ga4 import price_closeness

# --- Fixed values: action codes, page pattern, revenue units. ---
ACTIONS = {
    "product_clicks": "2",
    "add_to_cart_count": "3",
    "remove_from_cart_count": "4",
    "checkout_start_count": "5",
    "purchase_count": "6",
}
PURCHASE = "6"
PAGE, PRODUCT_PAGE = "PAGE", "%product%"
MICROS = 1_000_000.0
# --- End of fixed values. ---


def _known(sessions: DataFrame) -> DataFrame:
    """Sessions of known visitors, with the visit start as a zone-less UTC timestamp."""
    started = F.timestamp_seconds("visitStartTime").cast("timestamp_ntz")
    return sessions.where(F.col("fullVisitorId").isNotNull()).select(
        "*", F.col("fullVisitorId").alias(CUSTOMER), started.alias("_visit")
    )


def _products(sessions: DataFrame) -> DataFrame:
    """One row per product of a hit."""
    hits = sessions.select(CUSTOMER, "visitId", "_visit", F.explode("hits").alias("hit"))
    return (
        hits.select("*", F.explode("hit.product").alias("product"))
        .select("*", F.col("product.productSKU").alias(PRODUCT))
        .where(F.col(PRODUCT).isNotNull())
    )


def customer_demographics(sessions: DataFrame) -> DataFrame:
    """Place, device and traffic source, one row per visitor, with the first visit."""
    phone = {
        "mobile_brand": "mobileDeviceBranding",
        "mobile_model": "mobileDeviceModel",
        "mobile_input": "mobileInputSelector",
        "mobile_marketing_name": "mobileDeviceMarketingName",
    }
    traffic = {
        "traffic_source": "source",
        "traffic_medium": "medium",
        "traffic_campaign": "campaign",
        "traffic_keyword": "keyword",
        "referral_path": "referralPath",
    }
    flat = _known(sessions).select(
        CUSTOMER,
        *[F.col(f"geoNetwork.{c}").alias(c) for c in ("continent", "country", "region", "metro", "city")],
        F.col("geoNetwork.networkDomain").alias("network_domain"),
        F.col("device.deviceCategory").alias("device_category"),
        F.col("device.operatingSystem").alias("operating_system"),
        *[F.col(f"device.mobileDeviceInfo.{old}").alias(new) for new, old in phone.items()],
        *[F.col(f"trafficSource.{old}").alias(new) for new, old in traffic.items()],
        "_visit",
    )
    attributes = [c for c in flat.columns if c not in (CUSTOMER, "_visit")]
    return dimension(flat, [CUSTOMER], attributes, [m_min("first_visit_timestamp", "_visit")])


def product_features(sessions: DataFrame) -> DataFrame:
    """Product names on page hits, mean price, reach in visitors and sessions, revenue."""
    names = {
        "product_name": "v2ProductName",
        "product_category": "v2ProductCategory",
        "product_brand": "productBrand",
        "product_variant": "productVariant",
    }
    every = sessions.select(
        "*", F.col("fullVisitorId").alias(CUSTOMER),
        F.timestamp_seconds("visitStartTime").cast("timestamp_ntz").alias("_visit"),
    )
    pages = _products(every).where(F.col("hit.type") == PAGE).select(
        "*",
        *[F.col(f"product.{old}").alias(new) for new, old in names.items()],
        F.concat(CUSTOMER, F.lit("_"), "visitId").alias("_session"),
    )
    measures = [
        m_avg("avg_product_price", "product.productPrice", 0),
        m_avg("avg_quantity", "product.productQuantity", 0),
        m_avg("avg_product_revenue", "product.productRevenue", 0),
        m_total("total_quantity_viewed", "product.productQuantity"),
        m_sum("_revenue", "product.productRevenue", 0),
    ]
    reach = distinct_counts(pages, [PRODUCT], {"unique_customers": CUSTOMER, "unique_sessions": "_session"})
    out = dimension(pages, [PRODUCT], list(names), measures).join(reach, PRODUCT)
    return out.withColumn("total_revenue", F.col("_revenue") / MICROS).drop("_revenue")


def customer_product_interactions(sessions: DataFrame) -> DataFrame:
    """Distinct hit numbers by action, price, purchased value and sessions per (visitor, SKU)."""
    rows = _products(_known(sessions)).withColumn("_hit", F.col("hit.hitNumber"))
    action = F.col("hit.eCommerceAction.action_type")
    page = (F.col("hit.type") == PAGE) & F.col("hit.page.pagePath").like(PRODUCT_PAGE)
    price, quantity = F.col("product.productPrice"), F.col("product.productQuantity")
    measures = [
        m_any("product_page_views", page),
        *[m_any(out, action == code) for out, code in ACTIONS.items()],
        m_avg("avg_view_price", price, 0),
        m_sum("total_purchased_value", F.when(action == PURCHASE, price * quantity).otherwise(F.lit(0)), 0),
        m_max("max_quantity_purchased", quantity.cast("long")),
        m_min("first_interaction_timestamp", "_visit"),
        m_max("last_interaction_timestamp", "_visit"),
    ]
    keys = [CUSTOMER, PRODUCT]
    visits = distinct_counts(rows, keys, {"session_count": "visitId"})
    return two_level(rows, keys, ["_hit"], measures).join(visits, keys)


def transaction_data(sessions: DataFrame) -> DataFrame:
    """Transactions: value, tax, shipping and items. A hit counts once, whatever it contains."""
    hits = _known(sessions).select(CUSTOMER, "date", "_visit", F.explode("hits").alias("hit")).where(
        F.col("hit.transaction.transactionId").isNotNull()
    )
    sale = "hit.transaction"
    bought = F.aggregate(
        "hit.product", F.lit(0).cast("long"),
        lambda total, p: total + F.coalesce(p["productQuantity"].cast("long"), F.lit(0)),
    )
    flat = hits.select(
        CUSTOMER,
        F.col(f"{sale}.transactionId").alias("transaction_id"),
        (F.col(f"{sale}.transactionRevenue") / MICROS).alias("transaction_value"),
        F.col(f"{sale}.transactionCurrency").alias("currency"),
        (F.col(f"{sale}.transactionTax") / MICROS).alias("tax_amount"),
        (F.col(f"{sale}.transactionShipping") / MICROS).alias("shipping_amount"),
        F.col("_visit").alias("transaction_timestamp"),
        F.col("date").alias("transaction_date"),
        F.col(f"{sale}.transactionRevenue").alias("_revenue"),
        bought.alias("_bought"),
    )
    return flat.groupBy(*flat.columns[:-2]).agg(
        (num.fixed_sum("_revenue", 0) / MICROS).alias("total_transaction_value"),
        F.sum("_bought").alias("total_items_purchased"),
    )


def customer_behavior(sessions: DataFrame) -> DataFrame:
    """Sessions, page views, transactions and revenue per visitor."""
    paid = F.when(F.col("totals.transactions") > 0, F.col("totals.transactionRevenue"))
    measures = [
        m_total("total_visits", "totals.visits"),
        m_total("total_pageviews", "totals.pageviews"),
        m_total("total_bounces", "totals.bounces"),
        m_total("total_transactions", "totals.transactions"),
        m_sum("_revenue", "totals.transactionRevenue", 0),
        m_avg("_mean", paid, 0),
        m_min("first_visit_timestamp", "_visit"),
        m_max("last_visit_timestamp", "_visit"),
        m_max("_suffix", F.to_date("table_suffix", "yyyyMMdd")),
    ]
    out = two_level(_known(sessions), [CUSTOMER], ["visitId"], measures, [F.count("visitId").alias("session_count")])
    lifetime = days_between(F.col("_suffix"), F.col("first_visit_timestamp"))
    return out.withColumns({
        "total_revenue": F.col("_revenue") / MICROS,
        "avg_transaction_value": F.col("_mean") / MICROS,
        "customer_lifetime_days": lifetime,
    }).drop("_revenue", "_mean", "_suffix")


def _main_columns() -> list[Column]:
    c = F.col

    def zero(name: str, kind: str = "long") -> Column:
        return num.or_zero(name, kind)

    engagement = (
        zero("product_page_views") * 0.1 + zero("add_to_cart_count") * 0.3 + zero("purchase_count") * 0.6
        + zero("total_purchased_value", "double") / 10
    )
    conversion = F.when(
        c("product_page_views") > 0, c("purchase_count") * 100.0 / c("product_page_views")
    ).otherwise(F.lit(0.0))
    return [
        c(CUSTOMER), c(PRODUCT), c("product_name"), c("product_category"), c("product_brand"), c("product_variant"),
        c("device_category"), c("operating_system"), c("mobile_brand"), c("country"), c("region"), c("city"),
        c("traffic_source"), c("traffic_medium"), c("traffic_campaign"),
        *[zero(n).alias(n) for n in ("product_page_views", "product_clicks", "add_to_cart_count", "purchase_count")],
        zero("total_purchased_value", "double").alias("total_purchased_value"),
        zero("avg_view_price", "double").alias("avg_view_price"),
        zero("max_quantity_purchased").alias("max_quantity_purchased"),
        zero("avg_product_price", "double").alias("product_avg_price"),
        zero("total_quantity_viewed").alias("product_total_viewed"),
        zero("p.total_revenue", "double").alias("product_total_revenue"),
        zero("unique_customers").alias("product_unique_customers"),
        c("avg_product_price").alias("product_list_price"),
        (zero("avg_view_price", "double") - zero("avg_product_price", "double")).alias("price_difference"),
        zero("b.total_revenue", "double").alias("customer_lifetime_value"),
        zero("avg_transaction_value", "double").alias("avg_transaction_value"),
        zero("b.session_count").alias("total_sessions"), zero("total_visits").alias("total_visits"),
        zero("total_pageviews").alias("total_pageviews"), zero("total_transactions").alias("total_transactions"),
        *local_parts(F.coalesce("last_interaction_timestamp", "d.first_visit_timestamp"), "last_interaction"),
        zero("i.session_count").alias("customer_product_sessions"),
        zero("customer_lifetime_days").alias("customer_lifetime_days"),
        num.flag(c("purchase_count") > 0).alias("has_purchased"),
        num.flag(c("add_to_cart_count") > 0).alias("has_added_to_cart"),
        num.flag(c("product_page_views") > 0).alias("has_viewed_product"),
        engagement.alias("engagement_score"),
        price_closeness(c("avg_view_price"), c("avg_product_price")).alias("price_sensitivity_index"),
        conversion.alias("conversion_rate_percentage"),
    ]


def visitor_product_dataset(sessions: DataFrame, ordered: bool = False) -> DataFrame:
    """One row per (visitor, SKU); the redundant transaction join is left out as in ``ga4``."""
    return interaction_dataset(
        customer_product_interactions(sessions),
        [
            (customer_demographics(sessions).alias("d"), [CUSTOMER], "left"),
            (product_features(sessions).alias("p"), [PRODUCT], "left"),
            (customer_behavior(sessions).alias("b"), [CUSTOMER], "left"),
        ],
        _main_columns(),
        ordered=[F.col(CUSTOMER), F.col(PRODUCT)] if ordered else None,
    )
