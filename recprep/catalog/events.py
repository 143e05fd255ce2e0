"""Queries over the unified events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recprep.config import SEED
from recprep.functions.numeric import round_to
from recprep.operators import degrade, features, ordered, ratings, sampling, sessions, split
from recprep.operators.skew import SplitPlan
from recprep.sources.events import harmonize as union_events
from recprep.sources.standins import behavior_events, keyed_events, order_events, table

CAP_MS = 30 * 60_000


def _all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_events(behavior_events(spark, sf_dir), order_events(spark, sf_dir))


def _with_dwell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_dwell(keyed_events(spark, sf_dir), CAP_MS, F.col("event_id"))


def _rounded_ratings(events: DataFrame) -> DataFrame:
    return ratings.implicit_ratings(events).withColumn("raw_score", round_to("raw_score", 6))


def unify_events(spark, sf_dir):
    return behavior_events(spark, sf_dir)


def unify_events_text(spark, sf_dir):
    return behavior_events(spark, sf_dir, text_time=True)


def unify_orders(spark, sf_dir):
    return order_events(spark, sf_dir)


def harmonize(spark, sf_dir):
    return _all_events(spark, sf_dir)


def session_dwell(spark, sf_dir):
    return _with_dwell(spark, sf_dir)


def enrich_sessions(spark, sf_dir):
    return sessions.enrich_sessions(keyed_events(spark, sf_dir), CAP_MS, tie=F.col("event_id"))


def implicit_ratings(spark, sf_dir):
    return _rounded_ratings(_with_dwell(spark, sf_dir))


def implicit_ratings_all(spark, sf_dir):
    return _rounded_ratings(union_events(_with_dwell(spark, sf_dir).drop("event_id"), order_events(spark, sf_dir)))


def item_features(spark, sf_dir):
    events = _all_events(spark, sf_dir)
    cold_ids, _, _ = degrade.hold_out_cold_items(events, 0.15)
    return features.item_features(events, cold_ids)[0]


def item_encoders(spark, sf_dir):
    return features.encoder_table(features.item_features(_all_events(spark, sf_dir))[1])


def user_features(spark, sf_dir):
    return features.user_features(_all_events(spark, sf_dir))[0]


def ordinal_encode(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return features.ordinal_encode(part, "p_name", "name_idx")[0]


def ordinal_encode_known(spark, sf_dir):
    """The mapping is learned from the types that were sold, and applied to all parts."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    sold = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    _, mapping = features.ordinal_encode(part.join(sold, "p_partkey", "left_semi"), "p_type", "idx")
    return features.ordinal_encode(part, "p_type", "type_idx", mapping)[0]


def row_copies(spark, sf_dir):
    """Numbers of identical rows."""
    return ordered.number_copies(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus"))


def limit_rows(spark, sf_dir):
    """A thousand order lines, the same ones in any run."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return sampling.limit_rows(lines, 1000, SEED, F.concat_ws("-", "l_orderkey", "l_linenumber"))


def session_dwell_hot(spark, sf_dir):
    """Dwell in three sessions that hold all events: they are cut into segments."""
    events = keyed_events(spark, sf_dir).withColumn("user_session", F.concat(F.lit("s"), F.col("event_id") % 3))
    return sessions.session_dwell(events, CAP_MS, F.col("event_id"), split=SplitPlan(sample_mod=16))


def split_train(spark, sf_dir):
    return split.split_by_user(keyed_events(spark, sf_dir), 0.15, 5)[0]


def split_test(spark, sf_dir):
    return split.split_by_user(keyed_events(spark, sf_dir), 0.15, 5)[1]


def null_item_attributes(spark, sf_dir):
    return degrade.null_item_attributes(order_events(spark, sf_dir), 0.25)


def null_items(spark, sf_dir):
    return degrade.null_items(order_events(spark, sf_dir), 0.25)


def cold_items(spark, sf_dir):
    return degrade.hold_out_cold_items(order_events(spark, sf_dir), 0.15)[0]


def warm_events(spark, sf_dir):
    return degrade.hold_out_cold_items(order_events(spark, sf_dir), 0.15)[1]


def cold_catalog(spark, sf_dir):
    return degrade.hold_out_cold_items(keyed_events(spark, sf_dir), 0.15, tie=F.col("event_id").cast("string"))[2]


def jitter_event_time(spark, sf_dir):
    return degrade.jitter_event_time(keyed_events(spark, sf_dir), 0.5, key=F.col("event_id"))


def drop_pre_purchase_carts(spark, sf_dir):
    # one session per user, so that carts and purchases of an item meet
    events = keyed_events(spark, sf_dir).withColumn("user_session", F.col("user_id"))
    return degrade.drop_pre_purchase_carts(events, 0.5, key=F.col("event_id"))


def append_bot_traffic(spark, sf_dir):
    return degrade.append_bot_traffic(keyed_events(spark, sf_dir), 0.05, 150.0, 1, 10)


def degrade_all(spark, sf_dir):
    return degrade.degrade_all(keyed_events(spark, sf_dir), key=F.col("event_id"))[0]


def hash_sample(spark, sf_dir):
    return sampling.hash_sample(keyed_events(spark, sf_dir), "user_session", 0.1, seed=20260831)


EVENT_QUERIES = {
    f.__name__: f
    for f in (
        unify_events, unify_events_text, unify_orders, harmonize, session_dwell, enrich_sessions,
        implicit_ratings, implicit_ratings_all, item_features, item_encoders, user_features,
        ordinal_encode, ordinal_encode_known, split_train, split_test, null_item_attributes, null_items,
        cold_items, warm_events, cold_catalog, jitter_event_time, drop_pre_purchase_carts,
        append_bot_traffic, degrade_all, hash_sample, row_copies, limit_rows, session_dwell_hot,
    )
}
