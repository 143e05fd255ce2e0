"""File sources and sinks around the pipeline: CSV, date shards, JSON lists, audit."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


REJECTED = "_rejected"  # the raw line of a row with a field that does not fit its column


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of the store that Spark itself reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _files_at(spark: SparkSession, path_glob: str, inside: bool = True) -> list[tuple[str, int]]:
    """(path, bytes) of what a glob matches, from listings only; ``inside`` lists the data files in matched folders."""
    store, place = _hadoop(spark, path_glob)
    found = []
    for status in store.globStatus(place) or []:
        if inside and status.isDirectory():
            found += [(f.getPath(), f.getLen()) for f in store.listStatus(status.getPath()) if f.isFile()]
        else:
            found.append((status.getPath(), status.getLen()))
    hidden = ("_", ".")
    return sorted((p.toString(), int(n)) for p, n in found if not p.getName().startswith(hidden))


def _head(spark: SparkSession, path: str, lines: int, max_bytes: int) -> list[str]:
    """The first whole lines of a (possibly compressed) text file, at most ``max_bytes`` of it."""
    store, place = _hadoop(spark, path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    stream = store.open(place)
    try:
        data = bytes((stream if codec is None else codec.createInputStream(stream)).readNBytes(max_bytes))
    finally:
        stream.close()
    text = data.decode("utf-8", "replace").splitlines()
    return (text[:-1] if len(data) == max_bytes else text)[:lines]


def infer_csv_schema(spark: SparkSession, csv_path: str, lines: int = 10_000, max_bytes: int = 4 << 20) -> T.StructType:
    """Column types from the head of each file, a bounded number of its lines; a column takes the type that fits all heads."""
    names = [path for path, size in _files_at(spark, csv_path) if size]
    if not names:
        raise FileNotFoundError(f"no CSV files match {csv_path}")
    rows: list[str] = []
    for name in names:
        head = _head(spark, name, lines + 1, max_bytes)
        rows += head[1:] if rows else head
    sample = spark.sparkContext.parallelize(rows, 1)
    return spark.read.option("header", True).option("inferSchema", True).csv(sample).schema


def is_complete(spark: SparkSession, path: str) -> bool:
    """Did the job that wrote this folder end well? Its commit leaves a marker."""
    store, place = _hadoop(spark, f"{path.rstrip('/')}/_SUCCESS")
    return bool(store.exists(place))


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str, head_lines: int = 10_000) -> dict | None:
    """Convert headed CSV files to zstd parquet in one pass; None where the target is there and complete.

    Types come from the heads of the files (:func:`infer_csv_schema`). A field that does not fit
    its column becomes NULL, and the row's raw line is kept in the column ``_rejected``. Returns the
    counted rows and rejects. A target without the marker of a finished job is written anew.
    """
    if is_complete(spark, parquet_path):
        return None
    schema = infer_csv_schema(spark, csv_path, head_lines).add(REJECTED, T.StringType())
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    rows = reader.option("columnNameOfCorruptRecord", REJECTED).csv(csv_path)
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(REJECTED).alias("rejected"))
    counted.write.mode("overwrite").option("compression", "zstd").parquet(parquet_path)
    return seen.get


def read_converted(spark: SparkSession, parquet_path: str) -> DataFrame:
    """The rows of a converted CSV; an error where the conversion has not ended."""
    if not is_complete(spark, parquet_path):
        raise FileNotFoundError(f"{parquet_path} is not there or was not finished")
    return spark.read.parquet(parquet_path).drop(REJECTED)


def rejected_lines(spark: SparkSession, parquet_path: str) -> DataFrame:
    """The raw lines of a converted CSV that had a field set to NULL."""
    return spark.read.parquet(parquet_path).where(F.col(REJECTED).isNotNull()).select(F.col(REJECTED).alias("line"))


def read_date_shards(
    spark: SparkSession,
    path_glob: str,
    pattern: str = r"_(\d{8})",
    column: str = "table_suffix",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Read flat shards named ..._YYYYMMDD with the shard day as a text column.

    Days are taken from the names of the matched shards before anything is read, so shards out
    of range are not opened; the day of a row comes from the metadata of its file.
    """
    days = {path: re.search(pattern, path) for path, _ in _files_at(spark, path_glob, inside=False)}
    if not days:
        raise FileNotFoundError(f"no shards match {path_glob}")
    inside = [
        path for path, day in days.items()
        if (start is None and end is None) or day and (start is None or day[1] >= start) and (end is None or day[1] <= end)
    ]
    shards = spark.read.parquet(*(inside or [next(iter(days))]))
    suffix = F.nullif(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1), F.lit(""))
    dated = shards.withColumn(column, suffix)
    return dated if inside else dated.where(F.lit(False))


def write_date_shards(df: DataFrame, column: str, path: str) -> None:
    """Write one directory per shard day; readers then prune shards by partition."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def read_partitioned_shards(
    spark: SparkSession, path: str, column: str = "table_suffix", start: str | None = None, end: str | None = None
) -> DataFrame:
    """Read shards laid out by partition; a day range prunes directories."""
    df = spark.read.parquet(path).withColumn(column, F.col(column).cast("string"))
    return _within(df, column, start, end)


def _within(df: DataFrame, column: str, start: str | None, end: str | None) -> DataFrame:
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end))
    return df


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


SLICES = ("_slice_0", "_slice_1", "_slice_2")
_SLICE_BITS = 21  # three slices of a row's hash; their sums stay below 2^63 for 2^42 rows


def row_slices(df: DataFrame) -> list[Column]:
    """Three slices of a hash over the row's columns, in order of their names."""
    row = F.xxhash64(F.lit("row"), *[F.col(f"`{c}`") for c in sorted(df.columns)])
    mask = F.lit((1 << _SLICE_BITS) - 1)
    return [F.shiftrightunsigned(row, _SLICE_BITS * k).bitwiseAND(mask) for k in range(3)]


def with_slices(df: DataFrame) -> DataFrame:
    """Add the row's slices as columns: :func:`observe` then sums plain columns and hashes nothing itself."""
    return df.withColumns({name: part for name, part in zip(SLICES, row_slices(df))})


def digest_columns(df: DataFrame) -> list[Column]:
    """Aggregates of an order-free content digest: the number of rows and the sums of their slices.

    Sums do not depend on the order of rows, on files or on partitions; a lost, doubled or
    changed row changes them.
    """
    return [F.count(F.lit(1)).alias("rows"), *[F.sum(s).alias(f"slice_{k}") for k, s in enumerate(row_slices(df))]]


def digest_text(values: dict) -> str:
    return ":".join(str(values[k] or 0) for k in ("rows", "slice_0", "slice_1", "slice_2"))


def content_digest(df: DataFrame) -> str:
    """The digest of a table, by one pass over it."""
    return digest_text(df.agg(*digest_columns(df)).first().asDict())


def write_checked(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Write parquet and return the content digest, which the writing job computes on the way."""
    seen = Observation()
    sums = [F.sum(name).alias(f"slice_{k}") for k, name in enumerate(SLICES)]
    watched = with_slices(df).observe(seen, F.count(F.lit(1)).alias("rows"), *sums).drop(*SLICES)
    writer = watched.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return digest_text(seen.get)


def read_checked(spark: SparkSession, path: str, digest: str, schema: str | None = None) -> DataFrame:
    """Read a table that was written with :func:`write_checked`; other content is an error."""
    df = spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    found = content_digest(df)
    if found != digest:
        raise ValueError(f"{path} does not hold what was written: digest {found}, expected {digest}")
    return df


def write_id_list(ids: DataFrame, path: str) -> str:
    """Sorted ids as JSON lines."""
    ids.orderBy(*ids.columns).write.mode("overwrite").json(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def stored_bytes(spark: SparkSession, path: str, pattern: str = "*.parquet") -> int:
    """Bytes in the data files below a path, from file listings only (no content is read)."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return int(listed.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


def audit_outputs(spark: SparkSession, outputs: dict[str, str]) -> DataFrame:
    """One row per named output: exists, bytes, rows (rows for parquet only)."""
    found = []
    for name, path in outputs.items():
        try:
            size = stored_bytes(spark, path)
            rows = spark.read.parquet(path).count() if size else None
            found.append((name, path, True, size, rows))
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            found.append((name, path, False, 0, None))
    return spark.createDataFrame(found, "name string, path string, exists boolean, size_bytes long, rows long")
