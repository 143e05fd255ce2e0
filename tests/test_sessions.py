import pytest
from pyspark.sql import functions as F

from recprep.operators import sessions
from recprep.operators.ordered import lay_out
from recprep.operators.skew import SplitPlan, hot_keys

CAP = 30 * 60_000
T0 = 1_789_034_400_000


def dwell_of(df):
    return [r.engagement_time_msec for r in df.orderBy("event_id").collect()]


def test_dwell_is_gap_to_next_event(make_events):
    events = make_events(
        [{"user_session": "sess_001", "event_time": T0 + ms} for ms in (0, 12_000, 45_000)]
        + [{"user_session": "sess_002", "event_time": T0 + ms} for ms in (600_000, 630_000)]
        + [{"user_session": "sess_003", "event_time": T0 + ms} for ms in (0, 45 * 60_000)]
    )
    out = sessions.session_dwell(events, CAP, F.col("event_id"))
    assert dwell_of(out) == [12_000, 33_000, 0, 30_000, 0, CAP, 0]
    assert out.columns == events.columns


def test_null_session_and_null_time(make_events):
    events = make_events([
        {"event_time": T0}, {"event_time": T0 + 5_000},
        {"user_session": "s", "event_time": None}, {"user_session": "s", "event_time": T0},
    ])
    assert dwell_of(sessions.session_dwell(events, CAP, F.col("event_id"))) == [0, 0, 0, 0]
    one = sessions.session_dwell(events, CAP, F.col("event_id"), null_session="reference")
    assert dwell_of(one) == [5_000, 0, 0, 0]


def hot_events(spark):
    """A third of all rows in one session, many at the same instant."""
    return spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 400)).alias("user_session"),
        (F.lit(T0) + F.pmod(F.xxhash64("id"), F.lit(5_000)) * 7).alias("event_time"),
        F.concat(F.lit("i"), F.col("id") % 50).alias("item_id"),
        F.lit("view").alias("event_type"),
        F.col("id").alias("event_id"),
    )


def test_hot_session_is_cut_and_result_is_the_same(spark, uncoalesced):
    events = hot_events(spark)
    plan = SplitPlan(pieces=64, sample_mod=1, min_hits=50)
    plain = sessions.session_dwell(events, CAP, F.col("event_id"), split=None)
    cut = sessions.session_dwell(events, CAP, F.col("event_id"), split=plan)
    assert plain.exceptAll(cut).count() == 0 and cut.count() == 3_000
    assert [r.user_session for r in hot_keys(events, "user_session", plan).collect()] == ["hot"]
    assert hot_keys(events.where("user_session <> 'hot'"), "user_session", SplitPlan(4, 1, 50)) is None


def test_default_tie_in_a_hot_session(spark, uncoalesced):
    events = hot_events(spark)
    plan = SplitPlan(pieces=64, sample_mod=1, min_hits=50)
    plain = sessions.session_dwell(events, CAP, split=None)
    assert plain.exceptAll(sessions.session_dwell(events, CAP, split=plan)).count() == 0


@pytest.mark.parametrize("instants", [1, 3, 100_000])
def test_session_with_nine_tenths_of_the_rows(spark, uncoalesced, instants):
    """Also where all its rows share one instant: the segments are cut by the tie then."""
    events = spark.range(20_000).select(
        F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 300)).alias("user_session"),
        (F.lit(T0) + F.pmod(F.xxhash64("id"), F.lit(instants)) * 7).alias("event_time"),
        F.lit("i").alias("item_id"), F.lit("view").alias("event_type"), F.col("id").alias("event_id"),
    )
    plan = SplitPlan(pieces=64, sample_mod=4, min_hits=50)
    plain = sessions.session_dwell(events, CAP, F.col("event_id"), split=None)
    cut = sessions.session_dwell(events, CAP, F.col("event_id"), split=plan)
    assert plain.exceptAll(cut).count() == 0 and cut.count() == 20_000
    laid = lay_out(events.where("user_session = 'hot'"), ["user_session", "event_time", "event_id"])
    sizes = [r["count"] for r in laid.groupBy("_part").count().collect()]
    assert len(sizes) > 2 and max(sizes) < 9_000


def test_profile_keeps_known_values_and_is_per_session(spark, make_events):
    events = make_events(
        [{"user_session": f"s{i % 500}", "event_time": T0 + i} for i in range(1_500)]
        + [{"user_session": "s1", "user_pseudo_id": "mine", "device_category": "tv"}, {}]
    )
    out = sessions.assign_session_profile(events)
    last = out.where("event_id = 1500").first()
    assert last.user_pseudo_id == "mine" and last.device_category == "tv" and last.geo_province.startswith("ID-")
    assert out.where("event_id = 1501").first().user_pseudo_id is None
    per_session = out.where("event_id < 1500").groupBy("user_session").agg(
        F.count_distinct("user_pseudo_id", "device_category", "geo_province").alias("n")
    )
    assert per_session.where("n <> 1").count() == 0
    shape = r"^\d{10}\.\d{10}$"
    assert out.where("event_id < 1500").where(~F.col("user_pseudo_id").rlike(shape)).count() == 0
    share = out.where("event_id < 500 AND device_category = 'mobile'").count() / 500
    assert 0.70 < share < 0.86


def test_uniform_provinces_when_not_the_default_eight(make_events):
    events = make_events([{"user_session": f"s{i}"} for i in range(600)])
    out = sessions.assign_session_profile(events, provinces=("A", "B", "C"))
    counts = {r.geo_province: r["count"] for r in out.groupBy("geo_province").count().collect()}
    assert set(counts) == {"A", "B", "C"} and min(counts.values()) > 150
