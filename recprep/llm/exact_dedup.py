"""Exact deduplication of documents over a file stream with keyed state on disk."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recprep.llm.common import SPACE, text_of
from recprep.session import materialize, shared_folder

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Many small stores: no disk set aside in advance for the logs of each.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
}


def normal(text_col: str) -> Column:
    """Text in which each run of ASCII white space is one space; null is empty."""
    return F.regexp_replace(text_of(text_col), SPACE, " ")


def _located(df: DataFrame, id_col: str, text_col: str, digest_bytes: int) -> DataFrame:
    meta = df.metadataColumn("_metadata")
    return df.select(
        F.col(id_col).alias("id"),
        normal(text_col).alias("body"),
        meta.getField("file_path").alias("file"),
        meta.getField("row_index").alias("row"),
    ).withColumn("digest", F.substring(F.unhex(F.sha2("body", 256)), 1, digest_bytes))


def _first() -> Column:
    """Order of arrival does not matter: the smallest id stays, null ids last, ties by place."""
    return F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "file", "row"))


def update_state(
    spark: SparkSession, path: str, checkpoint: str, *, id_col: str = "doc_id", text_col: str = "text",
    digest_bytes: int = 32, max_bytes_per_trigger: int = 16 << 30, max_files_per_trigger: int | None = None,
) -> None:
    """Bring the state under ``checkpoint`` up to date with the files in ``path``.

    Key: the digest. Value: the smallest id, the place of its content (file and row) and the
    number of rows. The state lives in RocksDB, has no watermark and never expires. Rows of
    one digest are combined before the shuffle, so a digest with a third of all rows costs
    one row per task. A second call reads only files that are new, also after a crash.
    """
    before = {k: spark.conf.get(k, None) for k in _STATE_CONF}
    for key, value in _STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        reader = spark.readStream.schema(spark.read.parquet(path).schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        else:
            reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
        # As a pattern the path may also be a single file, which the stream refuses otherwise.
        pattern = path.rstrip("/")
        pattern = f"{pattern[:-1]}[{pattern[-1]}]"
        rows = _located(reader.parquet(pattern), id_col, text_col, digest_bytes).drop("body")
        held = rows.groupBy("digest").agg(_first().alias("first"), F.count(F.lit(1)).alias("n"))
        query = (
            held.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
            .option("checkpointLocation", checkpoint).start()
        )
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state as a table: digest, id, file, row, n."""
    state = spark.read.format("statestore").load(checkpoint)
    first, n = (F.col("value").getField(f.name) for f in state.schema["value"].dataType.fields)
    return state.select(
        F.col("key.digest").alias("digest"), first["id"].alias("keep_id"), first["file"].alias("keep_file"),
        first["row"].alias("keep_row"), n.alias("n"),
    )


def exact_dedup(
    spark: SparkSession, path: str, *, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 32,
    max_bytes_per_trigger: int = 16 << 30, max_files_per_trigger: int | None = None, checkpoint: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Every row that hits a digest is compared with the content found at the stored place, in
    full. Rows that share the digest but not the text form groups of their own.

    Defined cases: null text is empty text, and all empty texts are one group. Null ids come
    last when the row that stays is chosen; rows with one id (or repeated rows) are told
    apart by file and row, so exactly one row of a group is kept. An empty table gives an
    empty result. Other columns are ignored, whatever their names.
    """
    checkpoint = checkpoint or f"{shared_folder(spark)}/state-{uuid.uuid4().hex}"
    update_state(
        spark, path, checkpoint, id_col=id_col, text_col=text_col, digest_bytes=digest_bytes,
        max_bytes_per_trigger=max_bytes_per_trigger, max_files_per_trigger=max_files_per_trigger,
    )
    docs = _located(spark.read.parquet(path), id_col, text_col, digest_bytes)
    state = read_state(spark, checkpoint)

    hits = materialize(docs.join(state.filter("n > 1"), "digest"))
    at_place = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
    kept = hits.filter(at_place).select("digest", F.col("body").alias("kept_body"))
    false_hits = materialize(
        hits.filter(~at_place).join(kept, "digest").filter(F.col("body") != F.col("kept_body"))
        .select("digest", "body", "id", "file", "row")
    )

    placed = docs.select("id", "file", "row", "digest", F.sha2("body", 256).alias("text_sha256")).join(state, "digest")
    if not false_hits.isEmpty():
        placed = _split_groups(placed, false_hits)
    return placed.select(
        F.col("id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"), at_place.alias("kept"), "text_sha256"
    )


def _split_groups(placed: DataFrame, false_hits: DataFrame) -> DataFrame:
    """Give rows with the digest but not the text of their group a group by the text itself."""
    own = false_hits.groupBy("digest", "body").agg(_first().alias("first"), F.count(F.lit(1)).alias("own_n"))
    moved = false_hits.join(own, ["digest", "body"]).select("file", "row", "first", "own_n")
    left = false_hits.groupBy("digest").agg(F.count(F.lit(1)).alias("gone"))
    mine = F.col("first").isNotNull()
    return (
        placed.join(moved, ["file", "row"], "left").join(left, "digest", "left")
        .withColumn("n", F.when(mine, F.col("own_n")).otherwise(F.col("n") - F.coalesce("gone", F.lit(0))))
        .withColumn("keep_id", F.when(mine, F.col("first.id")).otherwise(F.col("keep_id")))
        .withColumn("keep_file", F.when(mine, F.col("first.file")).otherwise(F.col("keep_file")))
        .withColumn("keep_row", F.when(mine, F.col("first.row")).otherwise(F.col("keep_row")))
    )
