"""Small event tables for tests."""

from pyspark.sql import functions as F

from recprep.sources.events import EVENT_COLUMNS

KINDS = ["view", "view", "view", "cart", "purchase", "remove"]


def made_events(spark, users, per_user, items):
    """users x per_user events in sessions of eight, a minute apart."""
    rows = spark.range(users * per_user).select(
        F.floor(F.col("id") / max(per_user, 1)).alias("u"), (F.col("id") % max(per_user, 1)).alias("s"), "id"
    )
    draw = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(n))
    item = draw("item", items)
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (draw("kind", len(KINDS)) + 1).cast("int"))
    known = {
        "event_time": 1704067200000 + F.col("u") * 86400000 + F.col("s") * 60000,
        "event_type": kind,
        "user_id": F.concat(F.lit("user_"), "u"),
        "item_id": F.concat(F.lit("item_"), item),
        "category_id": F.concat(F.lit("cat_"), item % 13),
        "category_code": F.concat(F.lit("code_"), item % 7),
        "brand": F.concat(F.lit("brand_"), item % 11),
        "price": (draw("price", 10000) + 1) / 100,
        "user_session": F.concat(F.lit("sess_"), "u", F.lit("_"), F.floor(F.col("s") / 8)),
        "discount_flag": F.lit(False),
        "customer_ltv": (F.col("u") + 1) * 10.5,
        "age_band": F.when(F.col("u") % 2 == 0, "18-24").otherwise("45+"),
    }
    return rows.select(*[known.get(n, F.lit(None)).cast(t).alias(n) for n, t in EVENT_COLUMNS.items()])
