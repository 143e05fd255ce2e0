import pytest
from pyspark.sql import functions as F

from made import made_events
from recprep.config import DegradeConfig
from recprep.operators import degrade
from recprep.session import materialize



@pytest.fixture(scope="module")
def events(spark):
    made = made_events(spark, 60, 20, 120)
    return materialize(made.withColumn("event_id", F.xxhash64("user_id", "event_time", "item_id")))


def test_only_a_cart_before_a_purchase_is_dropped(make_events):
    key = {"user_id": "u", "item_id": "i", "user_session": "s"}
    rows = [("cart", 1), ("purchase", 2), ("cart", 3), ("view", 1)]
    other = [{**key, "item_id": "j", "event_type": "cart", "event_time": 1}]
    missing = [{"item_id": "i", "event_type": t, "event_time": n} for t, n in rows]
    events = make_events([{**key, "event_type": t, "event_time": n} for t, n in rows] + other + missing)
    kept = degrade.drop_pre_purchase_carts(events, 1.0, key=F.col("event_id"))
    assert sorted(r.event_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 8]
    stored = degrade.drop_pre_purchase_carts(events, 1.0, key=F.col("event_id"), store=True)
    assert sorted(r.event_id for r in stored.collect()) == [1, 2, 3, 4, 6, 7, 8]
    assert degrade.drop_pre_purchase_carts(events, 0.0, key=F.col("event_id")).count() == 9


def test_dropping_removes_carts_only(events):
    one_session = events.withColumn("user_session", F.lit("s")).withColumn("item_id", F.lit("i"))
    kept = degrade.drop_pre_purchase_carts(one_session, 0.5, key=F.col("event_id"))
    gone = one_session.join(kept, "event_id", "left_anti")
    assert gone.count() > 0 and gone.where("event_type <> 'cart'").count() == 0


def test_cold_items_are_exact_and_disjoint(events):
    cold, warm, catalog = degrade.hold_out_cold_items(events, 0.15, tie=F.col("event_id"))
    n_items = events.select("item_id").distinct().count()
    assert cold.count() == round(0.15 * n_items)
    assert warm.join(cold, "item_id", "left_semi").count() == 0
    assert warm.count() + events.join(cold, "item_id", "left_semi").count() == events.count()
    assert catalog.count() == cold.count() == catalog.select("item_id").distinct().count()


@pytest.mark.parametrize("rate,expected", [(0.0, 0), (1.0, 120)])
def test_cold_item_extremes(spark, rate, expected):
    events = spark.range(120).select(
        F.concat(F.lit("i"), "id").alias("item_id"), F.col("id").alias("event_time"), F.col("id").alias("event_id")
    )
    cold, warm, _ = degrade.hold_out_cold_items(events, rate, tie=F.col("event_id"))
    assert (cold.count(), warm.count()) == (expected, 120 - expected)


def test_null_items_lose_both_attributes_everywhere(events):
    out = degrade.null_item_attributes(events, 0.25)
    lost = degrade.null_items(events, 0.25)
    hit = out.join(lost, "item_id", "left_semi")
    assert hit.where("brand IS NOT NULL OR category_code IS NOT NULL").count() == 0
    assert out.where("brand IS NULL").count() == hit.count() > 0
    assert degrade.null_item_attributes(events.drop("brand"), 0.25).columns == events.drop("brand").columns


def test_jitter_delays_and_keeps_true_time(events):
    out = degrade.jitter_event_time(events, 0.5, key=F.col("event_id"))
    assert out.where("event_time < true_event_time").count() == 0
    mean = out.agg(F.avg(F.col("event_time") - F.col("true_event_time"))).first()[0]
    assert 1_700 < mean < 2_300


def test_jitter_on_timestamps(events):
    stamped = events.withColumn("event_time", F.timestamp_millis("event_time"))
    out = degrade.jitter_event_time(stamped, 0.5, key=F.col("event_id"))
    plain = degrade.jitter_event_time(events, 0.5, key=F.col("event_id"))
    moved = out.select("event_id", F.unix_millis("event_time").alias("t"))
    assert moved.exceptAll(plain.select("event_id", F.col("event_time").alias("t"))).count() == 0


def test_bots_add_the_fraction_with_small_gaps(events):
    n = events.count()
    out = degrade.append_bot_traffic(events, 0.5, 150.0, 1, 10)
    bots = out.where(F.col("user_pseudo_id").startswith("bot_"))
    assert out.count() == n + int(0.5 * n) and bots.count() == int(0.5 * n)
    first = events.agg(F.min("event_time")).first()[0]
    per_bot = bots.groupBy("user_pseudo_id").agg(
        F.count("*").alias("n"), F.min("event_time").alias("a"), F.max("event_time").alias("b")
    ).collect()
    assert len(per_bot) == 3 and all(r.n == 200 for r in per_bot)
    assert all(first < r.a <= first + 10 and r.n <= r.b - first <= 10 * r.n for r in per_bot)
    odd = "user_id IS NOT NULL OR user_session IS NOT NULL OR event_type <> 'view' OR item_id IS NULL"
    assert bots.where(odd).count() == 0
    assert degrade.append_bot_traffic(events.limit(5), 0.1, 150.0, 1, 10).count() == 5


def test_bot_items_follow_popularity(spark):
    events = spark.range(4_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("i"), F.col("id") % 100)).alias("item_id"),
        F.col("id").alias("event_time"), F.lit("x").alias("user_id"), F.lit("view").alias("event_type"),
    )
    bots = degrade.bot_traffic(events, 1.0, 150.0, 1, 10)
    share = bots.where("item_id = 'hot'").count() / bots.count()
    counts = [r["count"] for r in events.groupBy("item_id").count().collect()]
    expected = max(counts) ** 0.75 / sum(c**0.75 for c in counts)
    assert abs(share - expected) < 0.02


def test_all_steps_do_not_depend_on_partitioning(events):
    a, cold_a, _, _ = degrade.degrade_all(events, key=F.col("event_id"))
    b, cold_b, _, _ = degrade.degrade_all(events.repartition(7, "item_id"), key=F.col("event_id"))
    assert cold_a.exceptAll(cold_b).count() == 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_written_pass_equals_the_steps_one_by_one(events):
    cfg = DegradeConfig(cart_drop_rate=0.6)
    human, cold, lost, catalog = degrade.degrade_human_events(events, cfg, key=F.col("event_id"))
    blanked = degrade.null_item_attributes(events, cfg.null_item_rate)
    cold2, warm, catalog2 = degrade.hold_out_cold_items(blanked, cfg.cold_item_rate, tie=F.col("event_id"))
    late = degrade.jitter_event_time(warm, cfg.jitter_rate_per_s, key=F.col("event_id"))
    steps = degrade.drop_pre_purchase_carts(late, cfg.cart_drop_rate, key=F.col("event_id"))
    for one, two in ((human, steps), (cold, cold2), (catalog, catalog2)):
        assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0
    assert lost.count() == degrade.null_items(events, cfg.null_item_rate).count()


def test_config_checks_ranges():
    for bad in ({"null_item_rate": 1.2}, {"jitter_rate_per_s": 0}, {"bot_gap_min_ms": 9, "bot_gap_max_ms": 3}):
        with pytest.raises(ValueError):
            DegradeConfig(**bad)
