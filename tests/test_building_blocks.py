import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recprep.functions import hashing, numeric, text, times
from recprep.operators import keyed, ranks, sampling

FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def keys(spark, n):
    return spark.range(n).select(F.concat(F.lit("k"), F.col("id")).alias("k"))


@pytest.mark.parametrize("n", [0, 1, 7, 499, 500])
def test_exact_sample_has_exact_size(spark, n):
    out = sampling.take_keys(keys(spark, 500), "k", lambda total: F.lit(n), 5, "t")
    assert out.count() == n == out.distinct().count()


def test_exact_sample_is_the_smallest_hashes(spark):
    all_keys = keys(spark, 300)
    draws = all_keys.withColumn("u", hashing.u01(5, "t", F.col("k"))).orderBy("u", "k").limit(20)
    got = sampling.take_keys(all_keys.repartition(5), "k", lambda total: F.floor(total / 15), 5, "t")
    assert {r.k for r in got.collect()} == {r.k for r in draws.collect()}


def test_hash_sample_keeps_whole_sessions(spark):
    rows = spark.range(5_000).select(F.concat(F.lit("s"), F.col("id") % 1_000).alias("s"), "id")
    out = sampling.hash_sample(rows.unionByName(rows.limit(2).withColumn("s", F.lit(None).cast("string"))), "s", 0.1, 1)
    sizes = {r["count"] for r in out.where("s IS NOT NULL").groupBy("s").count().collect()}
    assert sizes == {5} and 350 < out.count() < 650


def test_draws_are_uniform_and_in_range(spark):
    draws = spark.range(5_000).select(hashing.u01(1, "x", F.col("id")).alias("u"))
    low, high, mean = draws.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.02


def test_row_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, "a")], "x int, y string")
    assert df.select(hashing.row_key(df).alias("k")).distinct().count() == 3


@FEW
@given(st.lists(st.text(alphabet="abz", max_size=6), max_size=60))
def test_dense_index_equals_sorting(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v string")
    got = {r.v: r.idx for r in ranks.dense_index(df, "v").collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(set(values)))}


def test_weighted_pick_equals_walking_the_line(spark):
    rng = random.Random(3)
    weights = [(f"k{i}", rng.choice([1, 2, 5, 4_000])) for i in range(60)]
    table = spark.createDataFrame(weights, "k string, w long")
    line = sorted((r.lo, r.hi, r.k) for r in ranks.running_total(table, "k", "w").collect())
    total = sum(w for _, w in weights)
    assert line[0][0] == 0 and line[-1][1] == total
    assert all(a[1] == b[0] for a, b in zip(line, line[1:]))
    draws = spark.range(400).select("id", hashing.u01(9, "p", F.col("id")).alias("u"))
    for n_keys in (1, 60, 5_000):
        out = ranks.weighted_pick(draws, "u", table, "k", "w", total, n_keys).collect()
        assert len(out) == 400
        for r in out:
            at = int(r.u * total)
            assert next(k for lo, hi, k in line if lo <= at < hi) == r.k


def test_sum_does_not_depend_on_order(spark):
    df = spark.range(20_000).select((F.rand(3) * 1e5).alias("x")).select(F.round("x", 2).alias("x"))
    rows = df.collect()
    a = spark.createDataFrame(rows).repartition(3).agg(numeric.fixed_sum("x"), numeric.fixed_avg("x")).first()
    b = spark.createDataFrame(rows[::-1]).repartition(11).agg(numeric.fixed_sum("x"), numeric.fixed_avg("x")).first()
    assert tuple(a) == tuple(b)


def test_sum_cuts_no_decimals(spark):
    fine = spark.createDataFrame([(0.00004,), (0.00003,), (0.00002,), (None,)], "x double")
    total, mean = fine.agg(numeric.fixed_sum("x"), numeric.fixed_avg("x")).first()
    assert abs(total - 0.00009) < 1e-18 and abs(mean - 0.00003) < 1e-18
    mixed = spark.createDataFrame([(1, 1e17), (2, 12.34567891), (1, 2e17), (2, 0.00000001)], "k int, x double")
    want = {1: 3e17, 2: 12.34567892}
    assert {k: round(s, 10) for k, s in mixed.groupBy("k").agg(numeric.fixed_sum("x")).collect()} == want
    two = keyed.two_level(mixed, ["k"], ["x"], [keyed.m_sum("s", "x"), keyed.m_avg("a", "x")])
    assert {r.k: (round(r.s, 10), round(r.a, 10)) for r in two.collect()} == {1: (3e17, 1.5e17), 2: (12.34567892, 6.17283946)}
    none = spark.createDataFrame([(None,)], "x double").agg(numeric.fixed_sum("x"), numeric.fixed_avg("x")).first()
    assert tuple(none) == (None, None)


def test_numeric_helpers(spark):
    row = spark.range(1).select(
        numeric.round_to(F.lit(2.5), 0), numeric.round_to(F.lit(-1.25), 1), numeric.safe_div(F.lit(1.0), F.lit(0)),
        numeric.clamp(F.lit(9), 0, 5), numeric.clamp(F.lit(None).cast("int"), 0, 5),
        numeric.flag(F.lit(None).cast("boolean")),
    ).first()
    assert tuple(row) == (3.0, -1.3, None, 5, None, 0)


def test_small_domain_count(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("v"))
    got = {r.g: r.n for r in df.groupBy("g").agg(numeric.count_small_domain(F.col("v")).alias("n")).collect()}
    assert got == {0: 0, 1: 7, 2: 7}


def test_two_level_measures_equal_plain_aggregates(spark):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5).alias("k"),
        (F.col("id") % 11).alias("stamp"), (F.col("id") % 4).alias("kind"), (F.col("id") * 0.25).alias("x"),
    )
    two = keyed.two_level(
        df, ["k"], ["stamp"],
        [
            keyed.m_sum("s", "x"), keyed.m_avg("a", "x"), keyed.m_count("n"), keyed.m_min("lo", "x"),
            keyed.m_max("hi", "x"), keyed.m_any("d", F.col("kind") == 1), keyed.m_small_domain("kinds", F.col("kind")),
        ],
        [F.count("stamp").alias("stamps")],
    )
    plain = df.groupBy("k").agg(
        F.count_distinct("stamp").alias("stamps"), F.sum("x").alias("s"), F.avg("x").alias("a"), F.count("*").alias("n"),
        F.min("x").alias("lo"), F.max("x").alias("hi"),
        F.count_distinct(F.when(F.col("kind") == 1, F.col("stamp"))).alias("d"), F.count_distinct("kind").alias("kinds"),
    )
    assert two.exceptAll(plain.select(two.columns)).count() == 0


def test_text_and_time_helpers(spark):
    row = spark.range(1).select(
        text.extract(F.lit("/product/12/x"), r"/product/([^/]+)"), text.extract(F.lit("/home"), r"/product/([^/]+)"),
        text.age_band(F.lit(24)), text.age_band(F.lit(25)), text.age_band(F.lit(44)), text.age_band(F.lit(45)),
        text.age_band(F.lit(None).cast("int")), text.age_band(F.lit(None).cast("int"), "45+"),
        text.map_values(F.lit("x"), {"a": "b"}),
        times.local_time(F.lit("2024-01-01 20:30:00").cast("timestamp_ntz")).cast("string"),
        times.days_until("2024-01-03", F.lit("2024-01-01 23:59:00").cast("timestamp_ntz")),
    ).first()
    assert tuple(row) == (
        "12", None, "18-24", "25-34", "35-44", "45+", None, "45+", None, "2024-01-02 05:30:00", 2
    )
