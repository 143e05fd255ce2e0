"""Time the headline queries and the whole build; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from recprep.catalog import ALL_QUERIES
from recprep.config import BuildConfig
from recprep.plans.build import build_dataset
from recprep.session import get_session
from recprep.sources.standins import REGION_PROVINCES, raw_behavior, raw_orders

HEADLINE = (
    "harmonize", "session_dwell", "enrich_sessions", "implicit_ratings", "implicit_ratings_all", "item_features",
    "user_features", "split_train", "null_item_attributes", "warm_events", "jitter_event_time",
    "drop_pre_purchase_carts", "append_bot_traffic", "degrade_all", "hash_sample", "retail_main", "shop_main",
    "ledger_main", "ga_main", "ua_main", "route_main", "trend_main",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def bench_build(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Raw files are written first; only the build is timed."""
    at = tempfile.mkdtemp(prefix="recprep-bench-")
    raw_behavior(spark, sf_dir).drop("event_id").repartition(8).write.parquet(f"{at}/behavior")
    raw_orders(spark, sf_dir).repartition(16).write.parquet(f"{at}/orders")
    cfg = BuildConfig()
    out = {}

    def run() -> None:
        out.update(build_dataset(
            spark, f"{at}/behavior", f"{at}/orders", f"{at}/out", cfg, region_to_province=REGION_PROVINCES
        ))

    seconds = timed(run)
    events = out["metrics"]["n_events_raw"]
    return {"build_dataset": seconds, "events": events, "events_per_s": round(events / seconds), **out["timing"]}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = get_session(
        "recprep-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.log.level": "ERROR",
        },
    )
    ALL_QUERIES["hash_sample"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in only or HEADLINE:
        seconds[name] = timed(
            lambda: ALL_QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    build = {} if only else bench_build(spark, sf_dir)
    if build:
        seconds["build_dataset"] = build["build_dataset"]
    print(json.dumps({
        "metric": "headline queries and whole build, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "build": build,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
