"""What a row costs in the build: draws compared as text, one hash per row, one shuffle of purchases, no second key."""

import pytest
from pyspark.sql import functions as F

from recprep.functions.hashing import draw_below, u01
from recprep.operators import degrade, sampling
from recprep.sources import files


@pytest.mark.parametrize("rate", [-1.0, 0.0, 2.0**-52, 0.05, 0.1, 0.5, 1 - 2.0**-52, 1 - 2.0**-53, 1.0, 3.0])
def test_a_draw_below_a_rate_is_told_from_its_text(spark, rate):
    keys = spark.range(3_000).select(F.when(F.col("id") > 0, F.concat(F.lit("k"), "id")).alias("k"))
    text, number = draw_below(rate, 3, "s", F.col("k")), u01(3, "s", F.col("k")) < F.lit(rate)
    assert keys.where(~text.eqNullSafe(number)).count() == 0
    assert "conv(" not in keys.where(text)._jdf.queryExecution().toString()


def test_the_cut_is_told_from_text(spark):
    keys = spark.range(3_000).select(F.concat(F.lit("k"), "id").alias("k"))
    cut = sampling.hash_cut(keys, "k", lambda n: F.floor(n / 4), 3, "s")
    u = u01(3, "s", F.col("k"))
    number = (u < cut.u) | ((u == cut.u) & (F.col("k") <= cut.key))
    text = sampling.in_cut("k", cut, 3, "s")
    assert keys.where(text).count() == 750 and keys.where(text != number).count() == 0
    twins = sampling.Cut(cut.u, "")  # the key decides between equal draws
    assert keys.where(sampling.in_cut("k", twins, 3, "s")).count() == 749
    assert "conv(" not in keys.where(text)._jdf.queryExecution().toString()


def test_purchases_are_shuffled_once(spark, make_events):
    rows = [{"user_id": "u", "item_id": "i", "event_type": t, "event_time": n} for t, n in (("cart", 1), ("purchase", 2))]
    events = make_events(rows + [{**rows[0], "user_id": None}, {**rows[0], "user_id": ""}, {**rows[1], "user_id": ""}])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = degrade.drop_pre_purchase_carts(events, 1.0, key=F.col("event_id"))
        assert kept._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
        assert sorted(r.event_id for r in kept.collect()) == [1, 2, 4]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_observation_hashes_nothing(spark, tmp_path, monkeypatch):
    seen, kind = [], type(spark.range(1))
    real = kind.observe
    monkeypatch.setattr(kind, "observe", lambda df, to, *of: (seen.extend(map(str, of)), real(df, to, *of))[1])
    rows = spark.range(50).select("id", F.concat(F.lit("t"), "id").alias("text"))
    digest = files.write_checked(rows, str(tmp_path / "t"))
    assert seen and not any("xxhash64" in s for s in seen)
    back = files.read_checked(spark, str(tmp_path / "t"), digest)
    assert back.columns == rows.columns and files.content_digest(rows) == digest


def test_a_named_key_is_not_stored_again(make_events, monkeypatch):
    stored, real = [], degrade.materialize
    monkeypatch.setattr(degrade, "materialize", lambda df, by=(): (stored.append(df.columns), real(df, by))[1])
    events = make_events([{"item_id": f"i{i}", "event_type": "view", "event_time": i} for i in range(40)])
    by_name = degrade.degrade_human_events(events, key="event_id")
    assert "_row" not in stored[0] and "event_id" in stored[0]
    by_value = degrade.degrade_human_events(events, key=F.col("event_id"))
    for a, b in zip(by_name, by_value):
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
