"""Implicit ratings from interaction counts and dwell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.config import RatingConfig
from recprep.functions.numeric import count_when, round_to

RATED_TYPES = ("view", "cart", "purchase")


def implicit_scores(events: DataFrame, cfg: RatingConfig = RatingConfig()) -> DataFrame:
    """(user_id, item_id, raw_score); anonymous rows count under their pseudo id."""
    kind = F.col("event_type")
    per_pair = (
        events.where(kind.isin(*RATED_TYPES))
        .groupBy(F.coalesce("user_id", "user_pseudo_id").alias("user_id"), "item_id")
        .agg(
            count_when(kind == "view").alias("n_view"),
            count_when(kind == "cart").alias("n_cart"),
            count_when(kind == "purchase").alias("n_buy"),
            F.sum(F.coalesce("engagement_time_msec", F.lit(0))).alias("dwell_ms"),
        )
    )
    raw = (
        F.col("n_view") * cfg.view
        + F.col("n_cart") * cfg.cart
        + F.col("n_buy") * cfg.buy
        + F.log2(F.lit(1) + F.col("dwell_ms") / 1000.0) * cfg.dwell
    )
    return per_pair.select("user_id", "item_id", raw.alias("raw_score"))


def implicit_ratings(events: DataFrame, cfg: RatingConfig = RatingConfig()) -> DataFrame:
    """Scores scaled to [low, high] by their global range; NULL when all scores are equal.

    The range is a scalar subquery over the same aggregate; Spark reuses the shuffled
    per-pair table for both, so the events are read once.
    """
    scored = implicit_scores(events, cfg)
    lo, hi = F.min("raw_score"), F.max("raw_score")
    span = F.nullif(hi - lo, F.lit(0.0))
    bounds = scored.agg(F.struct(lo.alias("lo"), span.alias("span")).alias("b")).scalar()
    scaled = F.lit(cfg.high - cfg.low) * (F.col("raw_score") - F.col("_b.lo")) / F.col("_b.span")
    return scored.withColumn("_b", bounds).select(
        "user_id", "item_id", "raw_score", round_to(F.lit(cfg.low) + scaled, 3).alias("pseudo_rating")
    )
