"""Session settings the operators rely on."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only: they can be applied to a session somebody else made.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even when the split costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# For the recommender side: tasks after a shuffle stay small however large the tables are, since an
# aggregate holds many times the bytes of its compressed input.
TABLE_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "800",
    # A table with a few partition values (cold or not, train or test) is written without sorting its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def tune(spark: SparkSession, tables: bool = False) -> SparkSession:
    """Apply the settings above to an existing session; those for ``tables`` are taken back without it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    for key, value in TABLE_CONF.items():
        if tables:
            spark.conf.set(key, value)
        elif spark.conf.get(key, None) == value:
            spark.conf.unset(key)
    return spark


def get_session(name: str = "recprep", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or fetch) a session; pass dotted settings as ``**{"spark.x.y": "z"}``."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    A local session without the setting gets a temporary folder; a cluster must name one,
    since a folder on one machine would be lost with it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="recprep-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table once to the shared folder and read it back: computed once, lineage cut."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`materialize` wrote, after their last reader's result is stored."""
    for table in tables:
        path = getattr(table, "_stored_at", None)
        if path:
            spark = table.sparkSession
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose results are stored: it drops them when
    the driver's garbage collection finds their plans unused, which else may take half an hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
