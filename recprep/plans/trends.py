"""Region x term dataset from search trends; domestic and international tables are united."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recprep.functions import numeric as num
from recprep.functions.text import first_like
from recprep.functions.times import days_between, days_until, local_parts
from recprep.operators.keyed import dimension, distinct_counts, m_avg, m_count, m_max, m_min, two_level
from recprep.plans.core import CUSTOMER, PRODUCT, interaction_dataset

# --- Fixed values: market and term classes. ---
URBAN = [(("%New York%", "%Los Angeles%", "%Chicago%", "%Philadelphia%", "%Dallas%"), "Urban")]
TIERS = [(("%New York%", "%Los Angeles%"), "Tier 1"), (("%Chicago%",), "Tier 2")]
TERMS = [
    (("%google%", "%Google%"), "Brand"),
    (("%how%", "%what%", "%why%"), "Question"),
    (("%news%", "%update%"), "News"),
    (("%buy%", "%sale%", "%price%"), "Commercial"),
]
TOP, TOP_WIDE = 5, 10
# --- End of fixed values. ---


def _unite(domestic: DataFrame, international: DataFrame, columns: list[str]) -> DataFrame:
    """Both tables under one text region id; rows without a region are dropped."""
    home = domestic.where(F.col("dma_id").isNotNull()).select(
        F.col("dma_id").cast("string").alias(CUSTOMER), *columns
    )
    abroad = international.where(F.col("country_name").isNotNull()).select(
        F.col("country_name").alias(CUSTOMER), *columns
    )
    return home.unionByName(abroad)


def region_demographics(domestic: DataFrame, international: DataFrame) -> DataFrame:
    """Market areas and countries with class and tier, one row per region id."""
    home = dimension(
        domestic.where(F.col("dma_id").isNotNull()).select(
            F.col("dma_id").cast("string").alias(CUSTOMER), F.col("dma_name").alias("customer_name")
        ),
        [CUSTOMER], ["customer_name"],
    )
    name = F.col("customer_name")
    home = home.select(
        CUSTOMER, "customer_name", F.lit("US").alias("country"), F.lit("Domestic").alias("region_type"),
        first_like(name, URBAN, "Regional").alias("region_category"),
        first_like(name, TIERS, "Tier 3").alias("market_tier"),
    )
    country = F.col("country_name")
    abroad = international.where(country.isNotNull()).select("country_name").distinct().select(
        country.alias(CUSTOMER), country.alias("customer_name"), country.alias("country"),
        F.lit("International").alias("region_type"), F.lit("Country").alias("region_category"),
        F.lit("Tier 1").alias("market_tier"),
    )
    return home.unionByName(abroad)


def term_features(domestic: DataFrame, international: DataFrame) -> DataFrame:
    """Term class, length, score and rank statistics, weeks and days trending."""
    columns = ["term", "score", "rank", "week", "refresh_date"]
    rows = domestic.select(*columns).unionByName(international.select(*columns))
    rows = rows.where(F.col("term").isNotNull()).withColumn(PRODUCT, F.col("term"))
    scored = two_level(
        rows, [PRODUCT], ["refresh_date"],
        [
            m_avg("avg_score", "score"),
            m_max("max_score", F.col("score").cast("double")), m_min("min_score", F.col("score").cast("double")),
            m_avg("avg_rank", "rank", 0), m_min("best_rank", F.col("rank").cast("long")),
        ],
        [F.count("refresh_date").alias("days_trending")],
    )
    weeks = distinct_counts(rows, [PRODUCT], {"weeks_trending": "week"})
    term = F.col(PRODUCT)
    return scored.join(weeks, PRODUCT).withColumns({
        "product_name": term,
        "term_length": F.length(term).cast("long"),
        "term_category": first_like(term, TERMS, "General"),
    })


def region_term_interactions(domestic: DataFrame, international: DataFrame) -> DataFrame:
    """Every ranking of a term in a region, with top flags and date parts."""
    rows = _unite(domestic, international, ["term", "week", "refresh_date", "rank", "score"])
    date, rank = F.col("refresh_date"), F.col("rank")
    return rows.where(F.col("term").isNotNull()).select(
        CUSTOMER,
        F.col("term").alias(PRODUCT),
        F.col("week").alias("interaction_week"),
        date.alias("interaction_date"),
        rank.cast("long").alias("rank"),
        F.col("score").cast("double").alias("score"),
        num.flag(rank <= TOP).alias("is_top_5"),
        num.flag(rank <= TOP_WIDE).alias("is_top_10"),
        F.dayofweek(date).cast("long").alias("day_of_week"),
        F.month(date).cast("long").alias("month"),
        F.year(date).cast("long").alias("year"),
    )


def rising_terms(domestic_rising: DataFrame, international_rising: DataFrame) -> DataFrame:
    """How often and how strongly a term rises in a region."""
    return _unite(domestic_rising, international_rising, ["term", "score"]).groupBy(
        CUSTOMER, F.col("term").alias(PRODUCT)
    ).agg(
        F.count("*").alias("rising_count"),
        num.fixed_avg("score").alias("avg_rising_score"),
        F.max(F.col("score").cast("double")).alias("max_rising_score"),
    )


def region_behavior(interactions: DataFrame) -> DataFrame:
    """Per region: distinct terms, rankings, mean score, top counts, activity span."""
    out = two_level(
        interactions, [CUSTOMER], [PRODUCT],
        [
            m_count("total_interactions"), m_avg("avg_score", "score"),
            m_count("top_5_count", F.col("rank") <= TOP), m_count("top_10_count", F.col("rank") <= TOP_WIDE),
            m_min("first_interaction_date", "interaction_date"), m_max("last_interaction_date", "interaction_date"),
        ],
        [F.count(PRODUCT).alias("unique_terms_engaged")],
    )
    span = days_between(F.col("last_interaction_date"), F.col("first_interaction_date"))
    return out.withColumn("days_active", span)


def _main_columns(as_of: str) -> list[Column]:
    c = F.col

    def zero(name: str, kind: str = "double") -> Column:
        return num.or_zero(name, kind)

    date = F.coalesce("interaction_date", "first_interaction_date")
    top = c("is_top_5") == 1
    engagement = zero("i.score") * 0.5 + zero("rising_count", "long") * 0.3 + F.when(top, F.lit(10)).otherwise(F.lit(0))
    momentum = zero("i.score") * (F.lit(1) + zero("rising_count", "long") * 0.1)
    return [
        c(CUSTOMER), c(PRODUCT), c("product_name"), c("customer_name"), c("country").alias("customer_country"),
        c("region_type").alias("customer_type"), c("region_category"), c("market_tier"),
        c("term_length").alias("product_name_length"), c("term_category").alias("product_category"),
        c("t.avg_score").alias("product_avg_score"), c("max_score").alias("product_max_score"),
        c("weeks_trending").alias("product_weeks_trending"), c("best_rank").alias("product_best_rank"),
        zero("i.rank", "long").alias("interaction_rank"), zero("i.score").alias("interaction_score"),
        c("is_top_5"), c("is_top_10"),
        zero("rising_count", "long").alias("rising_count"), zero("avg_rising_score").alias("avg_rising_score"),
        zero("i.score").alias("popularity_score"), zero("t.avg_score").alias("product_avg_popularity"),
        (zero("i.score") - zero("t.avg_score")).alias("score_difference"),
        c("unique_terms_engaged").alias("customer_unique_terms"),
        c("total_interactions").alias("customer_total_interactions"), c("b.avg_score").alias("customer_avg_score"),
        c("top_5_count").alias("customer_top_5_count"), c("top_10_count").alias("customer_top_10_count"),
        *local_parts(date),
        F.coalesce(c("interaction_week").cast("string"), F.lit("")).alias("interaction_week"),
        zero("month", "long").alias("interaction_month"), zero("year", "long").alias("interaction_year"),
        days_until(as_of, F.coalesce("interaction_date", "last_interaction_date")).alias("days_since_last_interaction"),
        num.flag(top).alias("is_high_priority"), num.flag(c("is_top_10") == 1).alias("is_medium_priority"),
        num.flag(c("rising_count") > 0).alias("is_rising_term"),
        engagement.alias("engagement_score"), momentum.alias("trend_momentum"),
    ]


def region_term_dataset(
    domestic: DataFrame, international: DataFrame, domestic_rising: DataFrame, international_rising: DataFrame,
    as_of: str, ordered: bool = False,
) -> DataFrame:
    """Per (region, term) the highest-scoring ranking."""
    interactions = region_term_interactions(domestic, international)
    return interaction_dataset(
        interactions,
        [
            (region_demographics(domestic, international).alias("d"), [CUSTOMER], "left"),
            (term_features(domestic, international).alias("t"), [PRODUCT], "left"),
            (rising_terms(domestic_rising, international_rising).alias("r"), [CUSTOMER, PRODUCT], "left"),
            (region_behavior(interactions).alias("b"), [CUSTOMER], "left"),
        ],
        _main_columns(as_of),
        best=[
            F.desc("score"), F.desc("is_top_5"), F.desc("interaction_date"), F.col("rank"), F.col("interaction_week"),
        ],
        ordered=[F.col(CUSTOMER), F.col(PRODUCT)] if ordered else None,
    )
