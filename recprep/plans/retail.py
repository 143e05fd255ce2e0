"""Store x item dataset from liquor-style retail sales; a store is the customer."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recprep.functions import numeric as num
from recprep.functions.text import first_like
from recprep.functions.times import days_between, days_until, local_parts, local_time
from recprep.operators.keyed import dealt, distinct_counts, m_avg, m_sum, m_total, two_level
from recprep.plans.core import CUSTOMER, PRODUCT, interaction_dataset
from recprep.session import materialize, release

# --- Fixed values: name patterns and labels of store classes. ---
STORE_TYPES = [
    (("%HY-VEE%",), "Supermarket Chain"),
    (("%FAREWAY%",), "Regional Grocery"),
    (("%WALMART%",), "Big Box Retail"),
    (("%QUICK%", "%CONVENIENCE%"), "Convenience Store"),
]
OTHER_STORE = "Other Retail"
CHAIN_PATTERN, CHAIN, INDEPENDENT = "%#%", "Chain Store", "Independent Store"
# --- End of fixed values. ---


def _measures() -> SimpleNamespace:
    """Measures summed once per (store, item, category, vendor) and merged per item, store or category."""
    return SimpleNamespace(
        sale=m_avg("sale", "sale_dollars"), spent=m_sum("sale", "sale_dollars"),  # they share their parts
        bottles=m_total("bottles", "bottles_sold"),
        cost=m_avg("cost", "state_bottle_cost"), retail=m_avg("retail", "state_bottle_retail"),
        liters=m_avg("liters", "volume_sold_liters"), gallons=m_avg("gallons", "volume_sold_gallons"),
        per_liter=m_avg("per_liter", num.safe_div("sale_dollars", "volume_sold_liters")), pack=m_avg("pack", "pack"),
    )


_PAIR = ["store_number", "item_number", "category_name", "vendor_name"]
_STORE_ATTRIBUTES = ["store_name", "address", "city", "zip_code", "county", "county_number"]
_ITEM_ATTRIBUTES = [
    "item_description", "category", "category_name", "vendor_number", "vendor_name", "pack", "bottle_volume_ml",
]


def pair_facts(sales: DataFrame) -> DataFrame:
    """The pre-aggregate of the family: one row per store, item, category and vendor as sold.

    One pass over the sales; everything but attributes and distinct days comes from this table. Most
    groups have one or two sales, so these are shuffled once, as they are: aggregates of a task
    would be wider than its rows. ``_best`` marks the row of a store and item with the highest spend
    among those with bottles sold.
    """
    m = _measures()
    measures = (m.sale, m.bottles, m.cost, m.retail, m.liters, m.gallons, m.per_liter, m.pack)
    # By store and item alone, so that the choice of the best row needs no shuffle of its own.
    pairs = sales.repartition("store_number", "item_number").groupBy(*_PAIR).agg(
        F.count_distinct("date").alias("purchase_frequency"),
        F.min("date").alias("_first"),
        F.max("date").alias("_last"),
        F.bit_or(num.bit_of(F.month("date"))).alias("_months"),
        F.bit_or(num.bit_of(F.dayofweek("date"))).alias("_weekdays"),
        F.stddev_samp("state_bottle_retail").alias("price_variation"),
        F.stddev_samp("bottles_sold").alias("purchase_quantity_variation"),
        *[p for each in measures for p in each.partial],
    )
    sold = F.coalesce(F.col("_bottles") > 0, F.lit(False))
    order = [sold.desc(), _sum("sale").desc(), F.desc("purchase_frequency"), F.col("category_name"), F.col("vendor_name")]
    place = F.row_number().over(Window.partitionBy("store_number", "item_number").orderBy(*order))
    return pairs.withColumn("_best", (place == 1) & sold)


def _days(sales: DataFrame, key: str, out: str) -> DataFrame:
    """Distinct days of each store or item (under ``key``): narrow rows, shuffled once."""
    return two_level(sales.where(F.col(key).isNotNull()), [key], ["date"], extra=[F.count("date").alias(out)], spread=True)


def _side(sales: DataFrame, source: str, key: str, attributes: list[str], names: list[str], days: str) -> DataFrame:
    """Per store or item: its smallest attribute combination (NULLs first) and its distinct days.

    Attributes are made distinct on the map side, apart from the days, so few wide rows are shuffled.
    """
    known = sales.where(F.col(source).isNotNull()).select(
        F.col(source).alias(key), *[F.col(c).alias(f"_{i}") for i, c in enumerate(attributes)]
    ).distinct()
    own = F.struct(*[F.col(f"_{i}").alias(n) for i, n in enumerate(names)])
    per_key = known.groupBy(key).agg(F.min(own).alias("_own"))
    counted = _days(sales, source, days).withColumnRenamed(source, key)
    return per_key.join(counted, key).select(key, "_own.*", days)


def store_demographics(sales: DataFrame) -> DataFrame:
    """Store attributes, street, type and size class; one row per store."""
    plain = ["customer_name", *_STORE_ATTRIBUTES[1:]]
    name = F.col("customer_name")
    return _side(sales, "store_number", CUSTOMER, _STORE_ATTRIBUTES, plain, "active_days").select(
        CUSTOMER,
        *plain,
        F.split("address", ",")[0].alias("street_address"),
        first_like(name, STORE_TYPES, OTHER_STORE).alias("store_type"),
        F.when(name.like(CHAIN_PATTERN), F.lit(CHAIN)).otherwise(F.lit(INDEPENDENT)).alias("store_size_category"),
    )


def product_features(sales: DataFrame) -> DataFrame:
    """Item attributes, price and volume averages, reach, and size of its category in items."""
    return _products(pair_facts(sales), sales)


def _products(pairs: DataFrame, sales: DataFrame) -> DataFrame:
    m = _measures()
    parts = [c for c in pairs.columns if c.endswith(("_rest", "_n")) or c in ("_sale", "_cost", "_retail", "_liters", "_gallons", "_per_liter", "_bottles")]
    own = pairs.where(F.col("item_number").isNotNull()).withColumn(PRODUCT, F.col("item_number"))
    per_store = dealt(own, [PRODUCT], ["store_number"]).groupBy(PRODUCT, "_bucket", "store_number").agg(
        *[F.sum(c).alias(c) for c in parts]
    )
    measured = per_store.groupBy(PRODUCT).agg(
        m.cost.merged.alias("avg_cost"),
        m.retail.merged.alias("avg_retail_price"),
        m.sale.merged.alias("avg_sale_dollars"),
        m.liters.merged.alias("avg_volume_liters"),
        m.gallons.merged.alias("avg_volume_gallons"),
        m.bottles.merged.alias("total_bottles_sold"),
        m.spent.merged.alias("total_revenue"),
        m.per_liter.merged.alias("avg_price_per_liter"),
        F.count("store_number").alias("stores_selling"),
    )
    named = _side(sales, "item_number", PRODUCT, _ITEM_ATTRIBUTES, ["product_name", *_ITEM_ATTRIBUTES[1:]], "days_available")
    items = materialize(named.join(measured, PRODUCT))
    size = items.groupBy(F.col("category_name").alias("_c")).agg(F.count("*").alias("category_popularity"))
    joined = items.join(size, F.col("category_name").eqNullSafe(F.col("_c"))).drop("_c")
    return (
        joined.withColumn("avg_price_per_liter", num.round_to("avg_price_per_liter", 2))
        .withColumn("pack", F.col("pack").cast("long"))
        .withColumn("bottle_volume_ml", F.col("bottle_volume_ml").cast("long"))
    )


def store_product_interactions(sales: DataFrame) -> DataFrame:
    """One row per (store, item, category, vendor) as sold."""
    return _interactions(pair_facts(sales))


def _sum(name: str, places: int = 4) -> Column:
    """The sum of a pre-aggregated row."""
    return F.col(f"_{name}") / F.lit(float(10**places)) + F.col(f"_{name}_rest")


def _avg(name: str) -> Column:
    return _sum(name) / F.nullif(F.col(f"_{name}_n"), F.lit(0))


def _bits(mask: str) -> Column:
    return F.coalesce(F.bit_count(mask), F.lit(0)).cast("long")


def _interactions(pairs: DataFrame) -> DataFrame:
    both = pairs.where(F.col("store_number").isNotNull() & F.col("item_number").isNotNull())
    return both.select(
        F.col("store_number").alias(CUSTOMER), F.col("item_number").alias(PRODUCT), "category_name", "vendor_name",
        "purchase_frequency",
        F.col("_bottles").alias("total_bottles_purchased"),
        _sum("sale").alias("total_spent"),
        _avg("retail").alias("avg_price_per_bottle"),
        _avg("liters").alias("avg_volume_per_transaction"),
        F.col("_last").alias("last_purchase_date"),
        F.col("_first").alias("first_purchase_date"),
        days_between(F.col("_last"), F.col("_first")).alias("customer_relationship_days"),
        _bits("_months").alias("months_purchased"),
        _bits("_weekdays").alias("days_of_week_purchased"),
        "price_variation",
        _avg("pack").alias("avg_pack_size"),
        "purchase_quantity_variation",
    )


def top_categories(sales: DataFrame, k: int = 3) -> DataFrame:
    """The k categories a store spends most on (ties: by name), as one text."""
    return _top_categories(pair_facts(sales), k)


def _top_categories(pairs: DataFrame, k: int = 3) -> DataFrame:
    bought = pairs.where(F.col("store_number").isNotNull() & F.col("category_name").isNotNull())
    spent = bought.groupBy(F.col("store_number").alias(CUSTOMER), "category_name").agg(_measures().spent.merged.alias("_spent"))
    window = Window.partitionBy(CUSTOMER).orderBy(F.desc("_spent"), "category_name")
    best = spent.withColumn("_r", F.row_number().over(window)).where(F.col("_r") <= k)
    listed = F.sort_array(F.collect_list(F.struct("_r", "category_name")))  # at most k entries
    return best.groupBy(CUSTOMER).agg(F.array_join(listed["category_name"], ", ").alias("top_categories"))


def store_behavior(sales: DataFrame, as_of: str) -> DataFrame:
    """Per store: variety, spending, top categories, activity span and recency."""
    return _behavior(materialize(pair_facts(sales)), sales, as_of)


def _behavior(pairs: DataFrame, sales: DataFrame, as_of: str) -> DataFrame:
    stores = pairs.where(F.col("store_number").isNotNull()).withColumn(CUSTOMER, F.col("store_number"))
    m = _measures()
    totals = stores.groupBy(CUSTOMER).agg(
        m.spent.merged.alias("total_spent_all_time"),
        m.sale.merged.alias("avg_transaction_value"),
        m.bottles.merged.alias("total_bottles_all_time"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        _bits(F.bit_or("_months")).alias("active_months"),
    )
    variety = distinct_counts(
        stores, [CUSTOMER],
        {
            "unique_categories_purchased": "category_name",
            "unique_vendors_purchased": "vendor_name",
        },
    )
    reach = two_level(
        stores, [CUSTOMER], ["item_number"], extra=[F.count("item_number").alias("unique_products_purchased")], spread=True
    )
    days = _days(sales, "store_number", "active_days").withColumnRenamed("store_number", CUSTOMER)
    return (
        totals.join(days, CUSTOMER)
        .join(reach, CUSTOMER)
        .join(variety, CUSTOMER)
        .join(_top_categories(pairs), CUSTOMER, "left")
        .withColumn("days_active", days_between(F.col("_last"), F.col("_first")))
        .withColumn("days_since_last_purchase", days_until(as_of, F.col("_last")))
        .drop("_first", "_last")
    )


def _main_columns(as_of: str) -> list[Column]:
    c = F.col
    share = F.when(
        c("total_spent_all_time") > 0, c("total_spent") / c("total_spent_all_time") * 100
    ).otherwise(F.lit(0.0))
    elasticity = F.when(
        (c("price_variation") > 0) & (c("purchase_frequency") > 1),
        num.ratio_round(c("purchase_quantity_variation") / c("price_variation"), 2),
    ).otherwise(F.lit(0.0))
    return [
        c(CUSTOMER), c(PRODUCT), c("product_name"), c("category"), c("p.category_name"), c("p.vendor_name"),
        c("i.vendor_name").alias("vendor_from_interaction"),
        c("customer_name").alias("store_name"), c("city").alias("store_city"), c("zip_code").alias("store_zip_code"),
        c("county").alias("store_county"), c("store_type"), c("store_size_category"),
        c("purchase_frequency"), c("total_bottles_purchased"), c("total_spent"), c("avg_price_per_bottle"),
        c("avg_volume_per_transaction"), c("avg_pack_size"), c("purchase_quantity_variation"),
        c("avg_cost").alias("product_avg_cost"), c("avg_retail_price").alias("product_avg_retail_price"),
        c("avg_price_per_liter"), c("avg_price_per_bottle").alias("store_avg_price_per_bottle"),
        num.round_to(c("avg_price_per_bottle") - c("avg_retail_price"), 2).alias("price_difference_from_avg"),
        c("stores_selling").alias("product_availability"),
        c("total_bottles_sold").alias("product_total_sales_volume"),
        c("total_revenue").alias("product_total_revenue"), c("category_popularity"),
        *local_parts(c("last_purchase_date"), "last_purchase", "last_purchase_utc9"),
        local_time(c("first_purchase_date")).alias("first_purchase_utc9"),
        c("unique_products_purchased").alias("store_unique_products"),
        c("unique_categories_purchased").alias("store_unique_categories"),
        c("total_spent_all_time").alias("store_lifetime_value"), c("avg_transaction_value"), c("active_days"),
        c("days_active").alias("store_days_active"), c("days_since_last_purchase").alias("store_recency"),
        num.flag(c("total_bottles_purchased") > 0).alias("has_purchased"),
        days_until(as_of, c("last_purchase_date")).alias("days_since_last_purchase"),
        num.round_to(share, 2).alias("product_share_of_store_spending"),
        elasticity.alias("price_elasticity_proxy"),
    ]


def store_product_dataset(
    sales: DataFrame, as_of: str, ordered: bool = False, position_of: list[str] | None = None
) -> DataFrame:
    """One row per (store, item) with bottles sold: the one with the highest spend.

    The pre-aggregate, which also marks that row, is stored; days and attributes come from narrow passes
    over the sales. The sides are stored one after the other; what is returned does not read ``sales`` any more.
    """
    pairs = materialize(pair_facts(sales))
    release(sales.sparkSession)
    return interaction_dataset(
        _interactions(pairs.where("_best")),
        [
            (_products(pairs, sales), [PRODUCT], "inner", "p"),
            (store_demographics(sales), [CUSTOMER], "inner"),
            (_behavior(pairs, sales, as_of), [CUSTOMER], "inner"),
        ],
        _main_columns(as_of),
        ordered=[F.col(CUSTOMER), F.col(PRODUCT)] if ordered else None,
        position_of=position_of,
        read=(pairs,),
        store_rows=False,
    )
