"""The whole build: raw sources in, train/test, ratings and feature tables out."""

from __future__ import annotations

import json
import time
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recprep.config import BuildConfig
from recprep.functions.hashing import row_key
from recprep.operators import degrade, features, ratings, sampling, sessions, split
from recprep.session import materialize
from recprep.sources import files
from recprep.sources.events import harmonize, load_behavior, load_orders


def load_sources(
    spark: SparkSession,
    behavior_glob: str,
    orders_glob: str,
    event_type_map: dict[str, str] | None = None,
    region_to_province: dict[str, str] | None = None,
    key: str | None = None,
) -> DataFrame:
    """Both raw sources as one unified event table; ``key`` names a row id that both carry."""
    keep = () if key is None else (key,)
    behavior = load_behavior(spark, behavior_glob, event_type_map, keep)
    return harmonize(behavior, load_orders(spark, orders_glob, region_to_province, keep=keep))


def sample_sessions(
    events: DataFrame, cfg: BuildConfig, fraction: float | None, limit: int | None, key: str | None = None
) -> DataFrame:
    """Optionally keep a hash sample of sessions, then at most ``limit`` rows.

    Rows without a session are sampled by user, or one by one where that lacks too. The limit
    keeps the rows that come first by a hash of ``key`` (default: of the row), in any run.
    """
    if fraction is not None:
        alone = F.coalesce(F.col("user_id"), row_key(events))
        events = sampling.hash_sample(events, "user_session", fraction, cfg.seed, instead=alone)
    if limit is None:
        return events
    return sampling.limit_rows(events, limit, cfg.seed, None if key is None else F.col(key).cast("string"))


def split_counts(train: DataFrame, test: DataFrame) -> dict[str, int]:
    """Row, user and item counts of a written split."""
    row = F.count("*").alias("rows"), F.count_distinct("user_id").alias("users")
    of_train, of_test = train.agg(*row).first(), test.agg(*row).first()
    items = train.select("item_id").unionByName(test.select("item_id")).agg(F.count_distinct("item_id")).first()[0]
    return {
        "n_events_train": of_train["rows"],
        "n_events_test": of_test["rows"],
        "n_users_train": of_train["users"],
        "n_users_test": of_test["users"],
        "n_items_catalog": items,
    }


def _item_table(events: DataFrame) -> DataFrame:
    """item_id, n of the source, stored: item sets, the number of events and the rows without an item come from it."""
    return materialize(events.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")))


def build_from_events(
    events: DataFrame,
    out_dir: str,
    cfg: BuildConfig = BuildConfig(),
    null_users: str = "drop",
    null_session: str = "isolate",
    at_least_one: bool = True,
    key: str | None = None,
) -> dict:
    """Run every stage on a unified event table and write the outputs below ``out_dir``.

    Session telemetry and degradation form one plan, written once; both sides of the split are
    written by one job into one table partitioned by side, and everything after it reads that.
    ``key`` names a row id that draws and ties follow (default: hashes of rows); it is carried
    along. ``at_least_one`` gives the test side a user where the fraction rounds to none and two
    or more are eligible. An empty source is an error.

    The manifest counts what was dropped on the way and holds a content digest of each parquet
    output, to be checked on reading (:func:`read_output`).
    """
    spark = events.sparkSession
    out_dir = out_dir.rstrip("/")
    names = (
        "implicit_matrix", "item_features", "user_features", "cold_items", "null_items", "cold_catalog",
        "item_encoders", "user_encoders",
    )
    paths = {f"{side}_interactions": f"{out_dir}/interactions/side={side}" for side in ("train", "test")}
    paths |= {name: f"{out_dir}/{name}" for name in names}
    timing: dict[str, float] = {}
    digests: dict[str, str] = {}

    @contextmanager
    def stage(name: str):
        start = time.time()
        yield
        timing[name] = round(time.time() - start, 3)

    with stage("telemetry_and_degradation"):
        items = _item_table(events)
        source = items.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("item_id").isNull(), F.col("n"))), F.lit(0)).alias("no_item"),
        ).first()
        if not source["rows"]:
            raise ValueError("the source has no events")
        row = None if key is None else F.col(key)
        enriched = sessions.enrich_sessions(
            events, cfg.dwell_cap_ms, cfg.seed, row, null_session,
            devices=cfg.devices, device_weights=cfg.device_weights, provinces=cfg.provinces,
        )
        d = cfg.degrade
        human, cold, lost, catalog = degrade.degrade_human_events(enriched, d, cfg.seed, key, items_from=items)
        bots = degrade.bot_traffic(
            human, d.bot_fraction, d.bot_rate_per_s, d.bot_gap_min_ms, d.bot_gap_max_ms, cfg.provinces, cfg.seed
        )
        bots = None if bots is None else materialize(bots)
        damaged = human if bots is None else human.unionByName(bots, allowMissingColumns=True)
        files.write_id_list(cold, paths["cold_items"])
        files.write_id_list(lost, paths["null_items"])
        digests["cold_catalog"] = files.write_checked(catalog, paths["cold_catalog"])

    with stage("train_test_split"):
        sides = split.with_side(
            damaged, cfg.test_fraction, cfg.min_user_events, cfg.seed, null_users, at_least_one=at_least_one
        )
        counted = Observation()
        of = ("train", "test")
        # hashed once in the row's own projection; the observation only adds up plain columns
        own = {f"_{side}": F.when(F.col("side") == side, F.lit(1)) for side in of}
        own |= {
            f"_{side}_{i}": F.when(F.col("side") == side, F.col(name)) for side in of for i, name in enumerate(files.SLICES)
        }
        sliced = sides.withColumns({n: part for n, part in zip(files.SLICES, files.row_slices(damaged))})
        watched = sliced.withColumns(own).drop(*files.SLICES).observe(
            counted, F.count(F.lit(1)).alias("rows"), *[F.count(f"_{side}").alias(side) for side in of],
            *[F.sum(f"_{side}_{i}").alias(f"{side}_{i}") for side in of for i in range(3)],
        ).drop(*own)
        watched.where(F.col("side").isNotNull()).write.mode("overwrite").partitionBy("side").parquet(f"{out_dir}/interactions")
        seen = counted.get
        for side in of:
            sums = {f"slice_{i}": seen[f"{side}_{i}"] for i in range(3)}
            digests[f"{side}_interactions"] = files.digest_text({"rows": seen[side], **sums})

    train, test = (_side(spark, out_dir, damaged, side) for side in ("train", "test"))
    with stage("implicit_matrix"):
        digests["implicit_matrix"] = files.write_checked(ratings.implicit_ratings(train, cfg.rating), paths["implicit_matrix"])

    with stage("feature_engineering"):
        cold_ids = spark.read.schema("item_id string").json(paths["cold_items"])
        both = spark.read.schema(damaged.schema).parquet(*[
            paths[f"{side}_interactions"] for side in of if seen[side]
        ]) if seen["train"] + seen["test"] else train
        item_table, item_maps = features.item_features(both, cold_ids)
        digests["item_features"] = files.write_checked(item_table, paths["item_features"])
        files.write_json(features.encoder_table(item_maps), paths["item_encoders"])
        users, user_maps = features.user_features(train)
        digests["user_features"] = files.write_checked(users, paths["user_features"])
        files.write_json(features.encoder_table(user_maps), paths["user_encoders"])

    with stage("manifest"):
        made_items, made_users = (spark.read.parquet(paths[f"{n}_features"]) for n in ("item", "user"))
        metrics = {
            "n_events_raw": source["rows"],
            "n_events_train": seen["train"],
            "n_events_test": seen["test"],
            "n_users_train": made_users.where(F.col("user_id").isNotNull()).count(),
            "n_users_test": test.agg(F.count_distinct("user_id")).first()[0],
            "n_items_catalog": made_items.where(F.col("item_id").isNotNull()).count(),
            "n_cold_items": cold_ids.count(),
            "n_null_items": spark.read.schema("item_id string").json(paths["null_items"]).count(),
            "n_dropped_no_item": source["no_item"],
            "n_bot_events": 0 if bots is None else bots.count(),
            "n_dropped_no_user": seen["rows"] - seen["train"] - seen["test"],
        }
    manifest = {
        "metrics": metrics,
        "outputs": paths,
        "digests": digests,
        "timing": timing,
        "config": cfg.as_dict(),
        "built_at": datetime.now(timezone.utc).isoformat(),
    }
    write_manifest(spark, manifest, f"{out_dir}/build_manifest")
    return manifest


def _side(spark: SparkSession, out_dir: str, like: DataFrame, side: str) -> DataFrame:
    """One side of the written split; a side without rows has no folder."""
    table = spark.read.schema(f"{like.schema.toDDL()}, side string").parquet(f"{out_dir}/interactions")
    return table.where(F.col("side") == side).drop("side")


def read_output(spark: SparkSession, manifest: dict, name: str) -> DataFrame:
    """A parquet output of a build; an error where its content is not what the build wrote."""
    return files.read_checked(spark, manifest["outputs"][name], manifest["digests"][name])


def write_manifest(spark: SparkSession, manifest: dict, path: str) -> None:
    """The manifest as one JSON line."""
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def build_dataset(
    spark: SparkSession,
    behavior_glob: str,
    orders_glob: str,
    out_dir: str,
    cfg: BuildConfig = BuildConfig(),
    session_sample: float | None = None,
    limit: int | None = None,
    event_type_map: dict[str, str] | None = None,
    region_to_province: dict[str, str] | None = None,
    key: str | None = None,
    **options,
) -> dict:
    """Load, harmonize, optionally sample, then ``build_from_events``."""
    events = load_sources(spark, behavior_glob, orders_glob, event_type_map, region_to_province, key)
    sampled = sample_sessions(events, cfg, session_sample, limit, key)
    return build_from_events(sampled, out_dir, cfg, key=key, **options)
