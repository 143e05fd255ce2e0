"""Queries over retail sales.

A full dataset reads its source many times, so the derived source is written once first.
"""

from __future__ import annotations

from recprep.functions.numeric import round_to
from recprep.plans import retail
from recprep.session import discard, materialize
from recprep.sources.standins import retail_sales

AS_OF = "2002-01-01"


def retail_store_demographics(spark, sf_dir):
    return retail.store_demographics(retail_sales(spark, sf_dir))


def retail_product_features(spark, sf_dir):
    return retail.product_features(retail_sales(spark, sf_dir))


def retail_interactions(spark, sf_dir):
    out = retail.store_product_interactions(retail_sales(spark, sf_dir))
    noisy = ("price_variation", "purchase_quantity_variation")  # roots differ in the last bit
    return out.withColumns({c: round_to(c, 4) for c in noisy})


def retail_store_behavior(spark, sf_dir):
    return retail.store_behavior(retail_sales(spark, sf_dir), AS_OF)


def top_categories(spark, sf_dir):
    return retail.top_categories(retail_sales(spark, sf_dir))


def retail_main(spark, sf_dir):
    sales = materialize(retail_sales(spark, sf_dir))
    out = retail.store_product_dataset(sales, AS_OF)
    discard(sales)
    return out.withColumn("purchase_quantity_variation", round_to("purchase_quantity_variation", 4))


def retail_main_ordered(spark, sf_dir):
    """Place of each row of the dataset in its order by store and item."""
    keys = ["customer_id", "product_id"]
    sales = materialize(retail_sales(spark, sf_dir))
    out = retail.store_product_dataset(sales, AS_OF, ordered=True, position_of=keys).select("position", *keys)
    discard(sales)
    return out


RETAIL_QUERIES = {
    f.__name__: f
    for f in (
        retail_store_demographics, retail_product_features, retail_interactions, retail_store_behavior,
        top_categories, retail_main, retail_main_ordered,
    )
}
