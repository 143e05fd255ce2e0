"""Narrow shuffles: spread fine groups, the pre-aggregate's best rows, positions of keys alone, task sizes."""

import datetime
import os

from pyspark.sql import functions as F

from recprep.operators import keyed
from recprep.plans import core, retail
from recprep.session import TABLE_CONF, materialize, tune

SALES = (
    "store_number long, item_number long, category_name string, vendor_name string, date date, sale_dollars double, "
    "bottles_sold long, state_bottle_cost double, state_bottle_retail double, volume_sold_liters double, "
    "volume_sold_gallons double, pack long"
)


def test_spread_groups_give_the_same_and_are_not_aggregated_before_the_shuffle(spark):
    rows = [(i % 5 or None, i % 3 or None, f"t{i % 40}" if i % 7 else None, i) for i in range(500)]
    df = spark.createDataFrame(rows, "a long, b long, t string, v long")
    measures = [keyed.m_total("total", "v"), keyed.m_avg("mean", "v"), keyed.m_any("seen", F.col("v") > 400)]
    extra = [F.count("t").alias("times")]
    plain, spread = (keyed.two_level(df, ["a", "b"], ["t"], measures, extra, spread=s) for s in (False, True))
    assert sorted(map(str, plain.collect())) == sorted(map(str, spread.collect()))
    bare = keyed.two_level(df, ["a"], ["t"], extra=extra, spread=True)
    assert sorted(map(str, bare.collect())) == sorted(map(str, keyed.two_level(df, ["a"], ["t"], extra=extra).collect()))
    again = keyed.two_level(df, ["a", "b"], ["t"], measures, extra, spread=True)
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_best_row_of_store_and_item_is_marked_in_one_shuffle(spark):
    day = datetime.date(2001, 1, 1)

    def sale(store, item, category, dollars, bottles):
        return store, item, category, "v", day, dollars, bottles, 1.0, 2.0, 1.0, 0.5, 6

    rows = [
        sale(1, 1, "a", 5.0, 1), sale(1, 1, "b", 9.0, 1), sale(1, 1, "c", 99.0, 0), sale(1, 2, "a", 5.0, None),
        sale(2, 1, "a", 4.0, 2), sale(2, 1, "a", 6.0, 2), sale(2, 1, None, 10.0, 2), sale(None, 1, "a", 3.0, 1),
    ]
    pairs = retail.pair_facts(spark.createDataFrame(rows, SALES))
    best = {(r.store_number, r.item_number, r.category_name) for r in pairs.where("_best").collect()}
    assert best == {(1, 1, "b"), (2, 1, None), (None, 1, "a")}
    assert pairs.count() == 7
    assert pairs._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_only_the_named_columns_are_laid_out(spark, monkeypatch):
    laid, real = [], core.with_position
    monkeypatch.setattr(core, "with_position", lambda df, order: (laid.append(df.columns), real(df, order))[1])
    rows = spark.createDataFrame([("b", "x", 1), ("a", "y", 2)], "customer_id string, product_id string, v long")
    columns = [F.col("customer_id"), F.col("product_id"), F.col("v"), F.col("w")]
    keys = ["customer_id", "product_id"]
    out = core.interaction_dataset(
        rows, [], columns, ordered=[F.col(k) for k in keys], derived={"w": F.col("v") + 1}, position_of=keys
    )
    assert sorted(map(tuple, out.collect())) == [("a", "y", 1), ("b", "x", 2)] and laid == [keys]


def test_task_sizes_are_set_for_tables_and_taken_back(spark):
    try:
        tune(spark, tables=True)
        assert {k: spark.conf.get(k) for k in TABLE_CONF} == TABLE_CONF
    finally:
        tune(spark)
    assert all(spark.conf.get(k, None) != v for k, v in TABLE_CONF.items())


def test_rows_and_sides_are_stored_one_by_one_and_read_tables_are_deleted(spark, monkeypatch):
    """Disk holds one step's shuffle files; of a dataset that is only ordered, keys and needed columns are stored."""
    steps = []
    monkeypatch.setattr(core, "materialize", lambda df: (steps.append(sorted(df.columns)), materialize(df))[1])
    monkeypatch.setattr(core, "release", lambda s: steps.append("release"))
    known = "customer_id string, product_id string, v long, day long"
    source = materialize(spark.createDataFrame([("b", "x", 1, 5), ("a", "y", 2, 6), ("a", "y", 9, 4)], known))
    names = spark.createDataFrame([("a", "A", 1), ("b", "B", 2)], "customer_id string, who string, n long")
    columns = [F.col(c) for c in ("customer_id", "product_id", "v", "day", "c.who", "n")]
    keys = ["customer_id", "product_id", "day"]

    def dataset(**options):
        steps.clear()
        rows = materialize(source)
        made = core.interaction_dataset(
            rows, [(names, ["customer_id"], "left", "c")], columns, best=[F.desc("v")], read=(rows,), **options
        )
        assert not os.path.exists(rows._stored_at)
        return sorted(map(tuple, made.collect()))

    assert dataset() == [("a", "y", 9, 4, "A", 1), ("b", "x", 1, 5, "B", 2)]
    assert steps == [sorted([*keys, "v"]), "release", ["customer_id", "n", "who"], "release"]
    assert dataset(ordered=[F.col("customer_id")], position_of=keys, needs=("day",)) == [("a", "y", 4, 1), ("b", "x", 5, 2)]
    assert steps == [sorted(keys), "release", ["customer_id"], "release"]
