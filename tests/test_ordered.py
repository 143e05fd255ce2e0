"""Global order, row numbers of copies and limits, without a task that sees all rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from recprep.operators import ordered, ranks, sampling
from recprep.plans import core


def mixed(spark, n=5_000):
    """A third of the rows share one key; some keys are missing."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.pmod(F.xxhash64("id"), F.lit(900))).alias("k"),
        (F.col("id") % 4).alias("v"), F.col("id"),
    )


def test_positions_are_the_global_order(spark, uncoalesced):
    df = mixed(spark)
    out = ordered.with_position(df, [F.desc("k"), "v", "id"]).collect()
    want = sorted((r for r in df.collect()), key=lambda r: (r.k is None, -(r.k or 0), r.v, r.id))
    assert sorted(r.position for r in out) == list(range(1, 5_001))
    assert [r.id for r in sorted(out, key=lambda r: r.position)] == [r.id for r in want]


def test_ties_are_cut_and_keep_their_order(spark, uncoalesced):
    df = mixed(spark)
    laid = ordered.lay_out(df, ["k"])
    parts = {r["_part"]: r["count"] for r in laid.where("k = 7").groupBy("_part").count().collect()}
    assert len(parts) > 1  # rows of one key lie in several partitions
    one = {r.id: r.position for r in ordered.with_position(df, ["k"]).collect()}
    two = {r.id: r.position for r in ordered.with_position(df.repartition(7), ["k"]).collect()}
    assert one == two  # ties go by a hash of the row, not by partitioning
    by_key = sorted((p, i) for i, p in one.items())
    keys = {r.id: r.k for r in df.collect()}
    shown = [keys[i] for _, i in by_key]
    assert shown == sorted(shown, key=lambda k: (k is not None, k or 0))


def test_order_of_nothing(spark):
    df = spark.createDataFrame([], "k int, position string")
    assert ordered.with_position(df, ["k"], "at").count() == 0
    assert ordered.number_copies(df).count() == 0


def test_dense_index_of_a_million_values(spark, uncoalesced):
    df = spark.range(1_000_000).select((F.col("id") * 3 + 5).alias("v"))
    out = ranks.dense_index(df, "v")
    assert out.where("idx <> (v - 5) / 3 + 1").count() == 0 and out.count() == 1_000_000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "array(" not in plan.lower()


def test_indexes_of_several_columns_in_one_pass(spark, uncoalesced):
    rows = [("a", "x"), ("b", None), ("c", "x"), (None, "a"), ("c", "b")]
    out = ranks.dense_indexes(spark.createDataFrame(rows, "p string, q string"), ["p", "q"]).collect()
    assert sorted(tuple(r) for r in out) == [("p", "a", 1), ("p", "b", 2), ("p", "c", 3), ("q", "a", 1), ("q", "b", 2), ("q", "x", 3)]
    with pytest.raises(ValueError):
        ranks.dense_indexes(spark.createDataFrame([(1, "a")], "p int, q string"), ["p", "q"])


def test_copies_are_numbered(spark):
    rows = [(1, "a")] * 700 + [(1, None)] * 3 + [(None, None)] * 2 + [(i, "b") for i in range(200)]
    df = spark.createDataFrame(rows, "copy_no int, y string").repartition(9)
    out = ordered.number_copies(df, "n").collect()
    seen = {}
    for r in out:
        seen.setdefault((r.copy_no, r.y), []).append(r.n)
    assert {k: len(v) for k, v in seen.items()} == Counter(rows)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in seen.values())
    ids = ordered.row_ids(df)
    assert ids.columns == ["copy_no", "y", "row_id"] and ids.select("row_id").distinct().count() == len(rows)


def test_copies_do_not_meet_in_one_group(spark):
    """No window over all copies: a group is a row's copies in one task."""
    df = spark.range(4_000).select(F.lit(1).alias("x")).repartition(8)
    out = ordered.number_copies(df)
    assert sorted(r.copy_no for r in out.collect()) == list(range(1, 4_001))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window" in line]
    assert windows and all("_part" in w.split("],")[1] for w in windows if "row_number" in w)


@pytest.mark.parametrize("n", [0, 1, 37, 5_000, 9_000])
def test_limit_is_exact_and_repeatable(spark, n):
    df = mixed(spark)
    one = sampling.limit_rows(df, n, seed=3, key=F.col("id"))
    two = sampling.limit_rows(df.repartition(5), n, seed=3, key=F.col("id"))
    assert one.count() == min(n, 5_000) and one.columns == df.columns
    assert one.exceptAll(two).count() == 0


def test_limit_of_copies(spark):
    df = spark.createDataFrame([(1,)] * 500 + [(2,)] * 20, "x int").repartition(6)
    assert sampling.limit_rows(df, 123, seed=1).count() == 123
    assert sampling.limit_rows(df, 1_000, seed=1).count() == 520


def test_deep_cut_looks_inside_buckets(spark, monkeypatch):
    """Where a bucket of the histogram is too large for one task, its own histogram comes next."""
    keys = spark.range(3_000).select(F.col("id").cast("string").alias("k"))
    whole = sampling.hash_cut(keys, "k", lambda n: n / 3, 5, "s")
    monkeypatch.setattr(sampling, "_BUCKETS", 4)
    monkeypatch.setattr(sampling, "_RANKED", 50)
    assert sampling.hash_cut(keys, "k", lambda n: n / 3, 5, "s") == whole
    assert keys.where(sampling.in_cut("k", whole, 5, "s")).count() == 1_000


def test_ordered_dataset_has_positions(spark):
    rows = spark.createDataFrame([("b", "x", 1), ("a", "y", 2), ("a", "x", 3)], "customer_id string, product_id string, v int")
    out = core.interaction_dataset(rows, [], [F.col("customer_id"), F.col("product_id")], ordered=[F.col("customer_id"), F.desc("product_id")])
    assert sorted((r.position, r.customer_id, r.product_id) for r in out.collect()) == [(1, "a", "y"), (2, "a", "x"), (3, "b", "x")]
