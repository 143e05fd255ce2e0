import pytest
from pyspark.sql import functions as F

from recprep.config import RatingConfig
from recprep.operators import features, ratings, split


def test_ratings_by_hand(make_events):
    rows = [
        ("u1", None, "i1", "view", 1_000), ("u1", None, "i1", "view", 2_000),
        ("u1", None, "i2", "cart", 0), ("u1", None, "i2", "purchase", None),
        (None, "p", "i1", "view", 1_000), (None, "p", "i1", "cart", 0),
        ("u1", None, "i9", "remove", 5), ("u1", None, "i9", "checkout", 5), ("u1", None, "i9", None, 5),
    ]
    names = ("user_id", "user_pseudo_id", "item_id", "event_type", "engagement_time_msec")
    out = ratings.implicit_ratings(make_events([dict(zip(names, r)) for r in rows]))
    got = {(r.user_id, r.item_id): (r.raw_score, r.pseudo_rating) for r in out.collect()}
    assert got == {("u1", "i1"): (3.0, 1.0), ("u1", "i2"): (8.0, 5.0), ("p", "i1"): (4.5, 2.2)}


def test_equal_scores_have_no_rating(make_events):
    events = make_events([{"user_id": u, "item_id": "i", "event_type": "view"} for u in "ab"])
    assert [r.pseudo_rating for r in ratings.implicit_ratings(events).collect()] == [None, None]


def test_ratings_stay_in_range_with_a_hot_pair(spark):
    events = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id") % 90)).alias("user_id"),
        F.lit(None).cast("string").alias("user_pseudo_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("i"), F.col("id") % 7)).alias("item_id"),
        F.lit("cart").alias("event_type"), F.lit(1_000).cast("long").alias("engagement_time_msec"),
    )
    out = ratings.implicit_ratings(events, RatingConfig(low=2.0, high=3.0))
    low, high = out.agg(F.min("pseudo_rating"), F.max("pseudo_rating")).first()
    assert (low, high) == (2.0, 3.0)


def test_ordinal_encode_and_reuse(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "v string")
    out, mapping = features.ordinal_encode(df, "v", "idx")
    got = sorted(((r.v or "", r.idx) for r in out.collect()))
    assert got == [("", 0), ("a", 1), ("b", 2), ("b", 2), ("c", 3)]
    old = mapping.where("value <> 'c'")
    again, _ = features.ordinal_encode(df, "v", "idx", old)
    assert {r.v: r.idx for r in again.collect()} == {"a": 1, "b": 2, "c": 0, None: 0}


def test_item_features_take_earliest_known_value(make_events, spark):
    rows = [
        {"item_id": "i", "event_time": 5, "brand": "late", "category_code": "z", "price": 3.0},
        {"item_id": "i", "event_time": 1, "brand": None, "category_code": "y", "price": 1.0},
        {"item_id": "i", "event_time": 2, "brand": "early", "category_code": "x", "price": None},
        {"item_id": "j", "event_time": None, "brand": "b"},
    ]
    cold = spark.createDataFrame([("j",)], "item_id string")
    out, maps = features.item_features(make_events(rows), cold)
    got = {r.item_id: r for r in out.collect()}
    i, j = got["i"], got["j"]
    assert (i.brand, i.category_code, i.price, i.popularity, i.is_cold) == ("early", "y", 2.0, 3, False)
    assert (j.brand, j.price, j.popularity, j.is_cold, j.category_code_idx) == ("b", None, 1, True, 0)
    assert (j.brand_idx, i.brand_idx) == (1, 2) and set(maps) == {"category_code_idx", "brand_idx", "category_id_idx"}
    assert features.encoder_table(maps).count() == 3
    assert features.item_features(make_events(rows))[0].where("is_cold").count() == 0


def test_user_features(make_events):
    rows = [
        {"user_id": "u", "event_time": 2, "age_band": "25-34", "customer_ltv": 9.0, "device_category": "mobile"},
        {"user_id": "u", "event_time": 1, "age_band": None, "customer_ltv": 4.0, "device_category": "tablet"},
        {"user_id": None, "event_time": 1},
    ]
    out, _ = features.user_features(make_events(rows))
    got = {r.user_id: r for r in out.collect()}
    assert (got["u"].age_band, got["u"].customer_ltv, got["u"].device_category) == ("25-34", 4.0, "tablet")
    assert got["u"].interaction_count == 2 and got[None].age_band_idx == 0


@pytest.fixture
def user_events(spark):
    """40 users with 1..40 events, one of them with a third of all rows, and rows without a user."""
    return spark.range(2_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 10 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("u"), F.floor(F.sqrt(F.col("id"))))).alias("user_id"),
        F.col("id").alias("event_id"),
    )


def test_split_is_by_user_and_complete(user_events):
    train, test = split.split_by_user(user_events, 0.4, 5)
    assert train.join(test, "user_id", "left_semi").count() == 0
    assert train.count() + test.count() == user_events.where("user_id IS NOT NULL").count()
    eligible = split.eligible_users(user_events, 5)
    chosen = test.select("user_id").distinct()
    assert chosen.count() == int(0.4 * eligible.count())
    assert chosen.join(eligible, "user_id", "left_anti").count() == 0
    assert split.test_users(user_events, 0.4, 5).exceptAll(chosen).count() == 0


def test_split_options(user_events):
    train, test = split.split_by_user(user_events, 0.4, 5, null_users="train")
    assert train.count() + test.count() == user_events.count()
    none = split.split_by_user(user_events, 0.001, 5)[1]
    assert none.count() == 0
    one = split.split_by_user(user_events, 0.001, 5, at_least_one=True)[1]
    assert one.select("user_id").distinct().count() == 1
    with pytest.raises(ValueError):
        split.split_by_user(user_events, 0.1, 5, null_users="both")
