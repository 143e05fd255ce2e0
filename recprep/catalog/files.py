"""Queries over file round trips and the whole build."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from recprep.config import BuildConfig
from recprep.functions.numeric import round_to
from recprep.operators import degrade, features
from recprep.plans import build
from recprep.session import shared_folder
from recprep.sources import files
from recprep.sources.standins import (
    REGION_PROVINCES,
    behavior_events,
    keyed_events,
    order_events,
    raw_behavior,
    raw_orders,
    table,
)
from recprep.streaming import windows
from recprep.streaming.harmonize import append_arrivals, stream_behavior


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def csv_round_trip(spark, sf_dir):
    """orders -> CSV with header -> typed parquet."""
    at = _scratch(spark)
    files.write_csv(table(spark, sf_dir, "orders"), f"{at}/csv")
    files.csv_to_parquet(spark, f"{at}/csv", f"{at}/parquet")
    return files.read_converted(spark, f"{at}/parquet").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def date_shards(spark, sf_dir):
    """Ten days of date shards, by partition pruning."""
    at = _scratch(spark)
    events = keyed_events(spark, sf_dir).withColumn("table_suffix", F.substring_index("user_session", "-", -1))
    files.write_date_shards(events, "table_suffix", at)
    picked = files.read_partitioned_shards(spark, at, start="20240105", end="20240114")
    return picked.select("event_id", "event_time", "user_id", "item_id", "table_suffix")


def flat_date_shards(spark, sf_dir):
    """The same shards read as flat files, the day taken from the path."""
    at = _scratch(spark)
    events = keyed_events(spark, sf_dir).withColumn("table_suffix", F.substring_index("user_session", "-", -1))
    files.write_date_shards(events, "table_suffix", at)
    picked = files.read_date_shards(
        spark, f"{at}/table_suffix=*", r"table_suffix=(\d{8})", start="20240105", end="20240114"
    )
    return picked.select("event_id", "event_time", "user_id", "item_id", "table_suffix")


def id_list_json(spark, sf_dir):
    at = _scratch(spark)
    files.write_id_list(degrade.hold_out_cold_items(order_events(spark, sf_dir), 0.15)[0], at)
    return spark.read.schema("item_id string").json(at)


def encoder_json(spark, sf_dir):
    at = _scratch(spark)
    part = table(spark, sf_dir, "part").select("p_name", "p_brand")
    maps = {c: features.ordinal_encode(part, c, "idx")[1] for c in ("p_name", "p_brand")}
    files.write_json(features.encoder_table(maps), at)
    return spark.read.schema("encoder string, value string, idx long").json(at)


def audit_outputs(spark, sf_dir):
    at = _scratch(spark)
    files.write_parquet(behavior_events(spark, sf_dir), f"{at}/behavior")
    files.write_parquet(order_events(spark, sf_dir), f"{at}/orders")
    outputs = {"behavior": f"{at}/behavior", "orders": f"{at}/orders", "missing": f"{at}/missing"}
    return files.audit_outputs(spark, outputs).select("name", "exists", "rows", (F.col("size_bytes") > 0).alias("stored"))


def manifest_counts(spark, sf_dir):
    counts = build.split_counts(behavior_events(spark, sf_dir), order_events(spark, sf_dir))
    return spark.createDataFrame(list(counts.items()), "metric string, n long")


def stream_arrivals(spark, sf_dir):
    """Behavior events harmonized from arriving files, stored in two triggers."""
    at = _scratch(spark)
    raw = raw_behavior(spark, sf_dir)
    schema = raw.schema
    for half in (0, 1):
        raw.where(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{at}/in")
        stream = stream_behavior(spark, f"{at}/in", schema, keep=("event_id",))
        append_arrivals(stream, f"{at}/out", f"{at}/checkpoint")
    return spark.read.parquet(f"{at}/out")


def _arrivals(spark, sf_dir):
    """Events in four files by time, read as a stream of one file per trigger."""
    at = _scratch(spark)
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("event_at"), "event_type")
    cuts = events.select(F.unix_micros("event_at").alias("us")).agg(F.min("us"), F.max("us")).first()
    for quarter in range(4):
        low, high = (cuts[0] + (cuts[1] - cuts[0]) * q // 4 for q in (quarter, quarter + 1))
        us = F.unix_micros("event_at")
        mine = (us >= low) & ((us < high) if quarter < 3 else (us <= high))
        events.where(mine).coalesce(1).write.mode("append").parquet(f"{at}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
    return at, stream


def stream_window_counts(spark, sf_dir):
    """Events per day and type, of the days that the watermark has closed."""
    at, stream = _arrivals(spark, sf_dir)
    windows.run_to_end(windows.window_counts(stream, "1 day", "6 hours", ["event_type"]), f"{at}/out", f"{at}/state")
    return windows.as_ntz(spark.read.parquet(f"{at}/out"))


def stream_sessions(spark, sf_dir):
    """Sessions of a user with gaps of less than two hours, of those that the watermark has closed."""
    at, stream = _arrivals(spark, sf_dir)
    windows.run_to_end(windows.session_counts(stream, "2 hours", "6 hours", ["user_id"]), f"{at}/out", f"{at}/state")
    return windows.as_ntz(spark.read.parquet(f"{at}/out"))


def _build(spark: SparkSession, sf_dir: str) -> dict:
    """The whole build over both sources, draws and ties by a row id; its manifest."""
    at = _scratch(spark)
    behavior = raw_behavior(spark, sf_dir).withColumn("row_key", F.concat(F.lit("b"), F.col("event_id")))
    behavior.drop("event_id").write.parquet(f"{at}/behavior")
    raw_orders(spark, sf_dir, "row_key").write.parquet(f"{at}/orders")
    return build.build_dataset(
        spark, f"{at}/behavior", f"{at}/orders", f"{at}/out", BuildConfig(), region_to_province=REGION_PROVINCES,
        key="row_key",
    )


def build_dataset(spark, sf_dir):
    """Counts of the manifest, as it is read back."""
    manifest = build.read_manifest(spark, _build(spark, sf_dir)["outputs"]["implicit_matrix"].rsplit("/", 1)[0] + "/build_manifest")
    return spark.createDataFrame(list(manifest["metrics"].items()), "metric string, n long")


def build_interactions(spark, sf_dir):
    """Both sides of the split, read back with their content digests checked."""
    manifest = _build(spark, sf_dir)
    sides = [
        build.read_output(spark, manifest, f"{side}_interactions").withColumn("side", F.lit(side)) for side in ("train", "test")
    ]
    return sides[0].unionByName(sides[1])


def build_ratings(spark, sf_dir):
    """The rating matrix of a build, read back with its content digest checked."""
    out = build.read_output(spark, _build(spark, sf_dir), "implicit_matrix")
    return out.withColumn("raw_score", round_to("raw_score", 6))


def build_features(spark, sf_dir):
    """Item and user features of a build, read back with their content digests checked."""
    manifest = _build(spark, sf_dir)
    items = build.read_output(spark, manifest, "item_features")
    users = build.read_output(spark, manifest, "user_features")
    return items.unionByName(users, allowMissingColumns=True).fillna(False, ["is_cold"])


FILE_QUERIES = {
    f.__name__: f
    for f in (
        csv_round_trip, date_shards, flat_date_shards, id_list_json, encoder_json, audit_outputs, manifest_counts,
        stream_arrivals, stream_window_counts, stream_sessions, build_dataset, build_interactions, build_ratings, build_features,
    )
}
