import pytest
from pyspark.sql import functions as F

from made import made_events
from recprep.config import BuildConfig
from recprep.plans import build
from recprep.sources import events as src
from recprep.sources import files
from recprep.streaming import windows
from recprep.streaming.harmonize import append_arrivals, stream_behavior, stream_orders

BEHAVIOR = [
    ("2024-01-01 00:00:01 UTC", "view", 7, 1, "c", "b", 2.5, 9, "s"),
    ("2024-01-01 00:00:02 UTC", "remove_from_cart", 7, 1, None, None, 2.5, 9, "s"),
    ("not a time", "wishlist", 8, 1, "c", "b", None, 9, None),
]
BEHAVIOR_DDL = (
    "event_time string, event_type string, product_id int, category_id long, category_code string, brand string, "
    "price double, user_id long, user_session string"
)


def test_behavior(spark, tmp_path):
    spark.createDataFrame(BEHAVIOR, BEHAVIOR_DDL).write.parquet(str(tmp_path / "b"))
    out = src.load_behavior(spark, str(tmp_path / "b" / "*.parquet"))
    assert out.schema.simpleString() == src.event_schema().simpleString()
    got = [(r.event_time, r.event_type, r.item_id, r.user_id, r.discount_flag) for r in out.orderBy("event_time").collect()]
    assert got == [
        (None, None, "8", "9", False),
        (1_704_067_201_000, "view", "7", "9", False),
        (1_704_067_202_000, "remove", "7", "9", False),
    ]


def test_missing_files_are_an_error(spark, tmp_path):
    for load in (src.load_behavior, src.load_orders):
        with pytest.raises(FileNotFoundError):
            load(spark, str(tmp_path / "none" / "*.parquet"))


def test_orders_full_and_sparse(spark):
    full = spark.createDataFrame(
        [("u", "p", "2024-01-01 00:00:00", "shipped", 1.0, "b", "cat", "R1", 24, True, 5.0),
         ("v", "p", "2024-01-01 00:00:00", None, 1.0, "b", "cat", "R9", None, False, None)],
        "customer_id string, product_id string, order_timestamp string, order_status string, price double, "
        "brand string, category string, region string, age int, discount boolean, ltv double",
    )
    u, v = src.harmonize_orders(full, {"R1": "ID-JK"}).orderBy("user_id").collect()
    assert (u.event_type, u.category_code, u.geo_province, u.age_band, u.discount_flag) == ("purchase", "cat", "ID-JK", "18-24", True)
    assert (v.fulfillment_status, v.geo_province, v.age_band, v.customer_ltv) == (None, None, None, None)
    assert src.harmonize_orders(full, null_age_band="45+").where("user_id = 'v'").first().age_band == "45+"
    sparse = spark.createDataFrame(
        [(1_704_067_200_000, 3, "p", "code")], "event_time long, user_id int, product_id string, category_code string"
    )
    row = src.harmonize_orders(sparse).first()
    assert (row.event_time, row.user_id, row.category_code, row.fulfillment_status) == (1_704_067_200_000, "3", "code", "completed")
    assert (row.price, row.brand, row.user_session, row.discount_flag) == (None, None, None, False)
    both = src.harmonize(src.harmonize_orders(full), src.harmonize_orders(sparse))
    assert both.count() == 3


def test_csv_conversion_skips_existing_target(spark, tmp_path):
    csv, target = str(tmp_path / "in.csv"), str(tmp_path / "out")
    (tmp_path / "in.csv").write_text("a,b\n1,x\n2,\n")
    files.csv_to_parquet(spark, csv, target)
    assert [(r.a, r.b) for r in spark.read.parquet(target).orderBy("a").collect()] == [(1, "x"), (2, None)]
    (tmp_path / "in.csv").write_text("a,b\n5,z\n")
    files.csv_to_parquet(spark, csv, target)
    assert spark.read.parquet(target).count() == 2


def test_csv_rejects_are_kept_and_counted(spark, tmp_path):
    """Types come from the heads; a later field that does not fit is NULL and its line is kept."""
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "a.csv").write_text("a,b,c\n" + "".join(f"{i},{i}.5,x\n" for i in range(50)) + "oops,1.5,y\n51,bad,z\n")
    (folder / "b.csv").write_text("a,b,c\n7,1,\n")
    assert files.infer_csv_schema(spark, str(folder), lines=40).simpleString() == "struct<a:int,b:double,c:string>"
    assert files.csv_to_parquet(spark, str(folder), target, head_lines=40) == {"rows": 53, "rejected": 2}
    rows = files.read_converted(spark, target)
    assert rows.columns == ["a", "b", "c"] and rows.count() == 53
    assert [(r.a, r.b) for r in rows.where("c in ('y', 'z')").orderBy("c").collect()] == [(None, 1.5), (51, None)]
    assert sorted(r.line for r in files.rejected_lines(spark, target).collect()) == ["51,bad,z", "oops,1.5,y"]
    assert files.csv_to_parquet(spark, str(folder), target) is None
    (tmp_path / "out" / "_SUCCESS").unlink()  # as after a failed job
    with pytest.raises(FileNotFoundError):
        files.read_converted(spark, target)
    assert files.csv_to_parquet(spark, str(folder), target, head_lines=40)["rows"] == 53
    with pytest.raises(FileNotFoundError):
        files.infer_csv_schema(spark, str(tmp_path / "none" / "*.csv"))


def test_csv_schema_covers_the_heads_of_all_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("v\n1\n")
    (tmp_path / "b.csv").write_text("v\n1.5\n")
    (tmp_path / "c.csv").write_text("v\nword\n")
    assert files.infer_csv_schema(spark, str(tmp_path / "[ab].csv")).simpleString() == "struct<v:double>"
    assert files.infer_csv_schema(spark, str(tmp_path / "*.csv")).simpleString() == "struct<v:string>"


def test_digest_sees_content_not_order(spark, tmp_path):
    rows = spark.range(500).selectExpr("id % 50 a", "cast(id % 7 as string) b", "if(id % 3 = 0, null, id) c")
    digest = files.write_checked(rows, str(tmp_path / "t"))
    assert digest == files.content_digest(rows.repartition(7).select("c", "a", "b")) and digest.startswith("500:")
    assert files.read_checked(spark, str(tmp_path / "t"), digest).count() == 500
    changed = (
        rows.limit(499), rows.unionByName(rows.limit(1)), rows.withColumn("b", F.when(F.col("c") == 7, "x").otherwise(F.col("b"))),
        rows.where("c <> 7 or c is null").unionByName(rows.where("c = 8")),
    )
    for other in changed:
        assert files.content_digest(other) != digest
    rows.where("a > 0").write.mode("overwrite").parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError):
        files.read_checked(spark, str(tmp_path / "t"), digest)
    assert files.content_digest(rows.limit(0)) == "0:0:0:0"


def test_shards_out_of_range_are_not_read(spark, tmp_path):
    for day in range(1, 31):
        spark.range(3).coalesce(1).write.parquet(str(tmp_path / f"events_202401{day:02d}"))
    picked = files.read_date_shards(spark, str(tmp_path / "events_*"), start="20240105", end="20240114")
    assert len(picked.inputFiles()) == 10 and all("events_2024010" in f or "events_2024011" in f for f in picked.inputFiles())
    assert picked.count() == 30 and picked.select("table_suffix").distinct().count() == 10
    assert files.read_date_shards(spark, str(tmp_path / "events_*"), start="20250101").count() == 0
    with pytest.raises(FileNotFoundError):
        files.read_date_shards(spark, str(tmp_path / "none_*"))


def test_stream_windows_equal_their_batch_twin(spark, tmp_path):
    """Late events within the delay count; events behind the watermark do not; open windows wait."""
    start = 1_704_067_200
    made = [(i % 5, start + 97 * i - (i % 9) * 60) for i in range(400)]
    events = spark.createDataFrame(made, "user_id int, s long").select("user_id", F.timestamp_seconds("s").alias("event_at"))
    for part in range(5):
        chunk = [m for i, m in enumerate(made) if i // 80 == part]
        rows = spark.createDataFrame(chunk, "user_id int, s long").select("user_id", F.timestamp_seconds("s").alias("event_at"))
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    def stream():
        return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for name, of in (
        ("windows", lambda e: windows.window_counts(e, "1 hour", "20 minutes", ["user_id"])),
        ("slides", lambda e: windows.window_counts(e, "1 hour", "20 minutes", ["user_id"], slide="30 minutes")),
        ("sessions", lambda e: windows.session_counts(e, "6 minutes", "20 minutes", ["user_id"])),
    ):
        out, state = str(tmp_path / name), str(tmp_path / f"{name}-state")
        windows.run_to_end(of(stream()), out, state)
        twin = windows.closed(of(events), events, "20 minutes")
        got = spark.read.parquet(out)
        assert 0 < twin.count() < of(events).count()
        assert got.exceptAll(twin).count() == 0 and twin.exceptAll(got).count() == 0
        windows.run_to_end(of(stream()), out, state)  # nothing new has arrived
        assert spark.read.parquet(out).count() == twin.count()
    late = spark.createDataFrame([(1, start)], "user_id int, s long").select("user_id", F.timestamp_seconds("s").alias("event_at"))
    late.write.mode("append").parquet(str(tmp_path / "in"))
    before = spark.read.parquet(str(tmp_path / "windows")).count()
    windows.run_to_end(windows.window_counts(stream(), "1 hour", "20 minutes", ["user_id"]), str(tmp_path / "windows"), str(tmp_path / "windows-state"))
    assert spark.read.parquet(str(tmp_path / "windows")).count() == before


def test_date_shards(spark, tmp_path):
    for day in ("20240101", "20240102", "20240103"):
        spark.createDataFrame([(day,)], "d string").coalesce(1).write.parquet(str(tmp_path / f"events_{day}"))
    out = files.read_date_shards(spark, str(tmp_path / "events_*"), start="20240102")
    assert sorted((r.d, r.table_suffix) for r in out.collect()) == [("20240102", "20240102"), ("20240103", "20240103")]
    files.write_date_shards(out, "table_suffix", str(tmp_path / "parts"))
    pruned = files.read_partitioned_shards(spark, str(tmp_path / "parts"), end="20240102")
    assert [r.table_suffix for r in pruned.collect()] == ["20240102"]


def test_id_list_and_audit(spark, tmp_path):
    ids = spark.createDataFrame([("b",), ("a",), ("c",)], "item_id string")
    files.write_id_list(ids.repartition(3), str(tmp_path / "ids"))
    assert [r.item_id for r in spark.read.json(str(tmp_path / "ids")).collect()] == ["a", "b", "c"]
    files.write_parquet(ids, str(tmp_path / "p"))
    rows = {r.name: r for r in files.audit_outputs(spark, {"p": str(tmp_path / "p"), "no": str(tmp_path / "no")}).collect()}
    assert (rows["p"].exists, rows["p"].rows) == (True, 3) and rows["p"].size_bytes > 0
    assert (rows["no"].exists, rows["no"].rows, rows["no"].size_bytes) == (False, None, 0)


def test_stream_equals_batch(spark, tmp_path):
    raw = spark.createDataFrame(BEHAVIOR, BEHAVIOR_DDL)
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for row in BEHAVIOR:
        spark.createDataFrame([row], BEHAVIOR_DDL).write.mode("append").parquet(folder)
        append_arrivals(stream_behavior(spark, folder, raw.schema), out, state)
    append_arrivals(stream_behavior(spark, folder, raw.schema), out, state)  # nothing new
    assert spark.read.parquet(out).exceptAll(src.harmonize_behavior(raw)).count() == 0
    assert spark.read.parquet(out).count() == 3
    assert stream_orders(spark, folder, "customer_id string, product_id string, order_timestamp timestamp").isStreaming


@pytest.fixture
def raw_sources(spark, tmp_path):
    events = made_events(spark, 80, 20, 60)
    raw = events.select(
        F.timestamp_millis("event_time").alias("event_time"), "event_type", F.col("item_id").alias("product_id"),
        "category_id", "category_code", "brand", "price", "user_id", "user_session",
    )
    raw.write.parquet(str(tmp_path / "behavior"))
    orders = events.where("event_type = 'purchase'").select(
        F.col("user_id").alias("customer_id"), F.col("item_id").alias("product_id"),
        F.timestamp_millis("event_time").alias("order_timestamp"), "price",
    )
    orders.write.parquet(str(tmp_path / "orders"))
    return str(tmp_path / "behavior"), str(tmp_path / "orders"), str(tmp_path / "out")


def test_whole_build(spark, raw_sources):
    behavior, orders, out = raw_sources
    cfg = BuildConfig()
    manifest = build.build_dataset(spark, behavior, orders, out, cfg)
    metrics = manifest["metrics"]
    read = {n: spark.read.parquet(p) for n, p in manifest["outputs"].items() if n.endswith(("interactions", "features", "matrix"))}
    train, test = read["train_interactions"], read["test_interactions"]
    assert metrics["n_events_train"] == train.count() and metrics["n_events_test"] == test.count()
    assert train.join(test, "user_id", "left_semi").count() == 0
    assert metrics["n_cold_items"] == round(0.15 * 60)
    assert read["implicit_matrix"].where("pseudo_rating < 1 OR pseudo_rating > 5").count() == 0
    assert read["item_features"].count() == metrics["n_items_catalog"]
    assert read["user_features"].count() == metrics["n_users_train"]
    assert train.where("device_category IS NULL AND user_session IS NOT NULL").count() == 0
    assert build.read_manifest(spark, f"{out}/build_manifest")["metrics"] == metrics
    assert metrics["n_bot_events"] > 0 and metrics["n_dropped_no_user"] == metrics["n_bot_events"] and metrics["n_dropped_no_item"] == 0
    for name in manifest["digests"]:
        assert build.read_output(spark, manifest, name).count() >= 0
    spark.read.parquet(manifest["outputs"]["item_features"]).limit(3).write.mode("append").parquet(manifest["outputs"]["item_features"])
    with pytest.raises(ValueError):
        build.read_output(spark, manifest, "item_features")


def test_empty_source_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        build.build_from_events(made_events(spark, 0, 0, 1), str(tmp_path / "out"))


def test_sampling_options(spark):
    events = made_events(spark, 40, 20, 50)
    cfg = BuildConfig()
    assert build.sample_sessions(events, cfg, None, None).count() == 800
    few = build.sample_sessions(events, cfg, None, 10)
    assert few.count() == 10 and few.exceptAll(few).count() == 0
    assert 0 < build.sample_sessions(events, cfg, 0.3, None).count() < 800
    orders = events.withColumn("user_session", F.lit(None).cast("string"))
    assert 0 < build.sample_sessions(orders, cfg, 0.3, None).count() < 800
    nobody = orders.withColumn("user_id", F.lit(None).cast("string"))
    assert 0 < build.sample_sessions(nobody, cfg, 0.3, None).count() < 800


def test_rounding_and_bits(spark):
    from recprep.functions import numeric as num

    rows = spark.createDataFrame([(1e18, 2), (0.49999999999999994, 0), (-2.5, 0), (0.125, 2)], "x double, p int")
    got = rows.select("x", num.round_to("x", 0).alias("a"), num.round_to("x", 2).alias("b")).collect()
    assert [r.a for r in got] == [1e18, 0.0, -3.0, 0.0] and [r.b for r in got] == [1e18, 0.5, -2.5, 0.13]
    ok = spark.createDataFrame([(0,), (63,), (63,), (None,)], "v int")
    assert ok.agg(num.count_small_domain(F.col("v"))).first()[0] == 2
    with pytest.raises(Exception, match="outside 0..63"):
        spark.createDataFrame([(64,)], "v int").agg(num.count_small_domain(F.col("v"))).collect()
