"""Load and harmonize raw files as they arrive.

Harmonizing and hash sampling look at one row at a time, so the batch functions work on a
stream as they are. Everything that needs all rows (dwell, split, ratings) runs in the batch
build over what this job has stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from recprep.sources.events import harmonize_behavior, harmonize_orders


def stream_behavior(
    spark: SparkSession, folder: str, schema: T.StructType | str, pattern: str = "*.parquet", **options
) -> DataFrame:
    """New behavior files in a folder, harmonized; ``options`` go to ``harmonize_behavior``."""
    raw = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    return harmonize_behavior(raw, **options)


def stream_orders(
    spark: SparkSession, folder: str, schema: T.StructType | str, pattern: str = "*.parquet", **options
) -> DataFrame:
    """New order files in a folder as purchase events."""
    raw = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    return harmonize_orders(raw, **options)


def append_arrivals(events: DataFrame, out_path: str, checkpoint: str) -> None:
    """Store everything that has arrived since the last call, exactly once."""
    query = (
        events.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out_path)
    )
    query.awaitTermination()
