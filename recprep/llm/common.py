"""Helpers shared by the document operators."""

from __future__ import annotations

import ctypes
import gc
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recprep.session import release  # noqa: F401

# The ASCII white space that separates words, as Java and DuckDB patterns.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Bound the Arrow batches handed to Python, in rows and (where Spark has it) in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark resolves it to, for code that opens files by itself."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(place).toString()


def trim_memory() -> None:
    """Give back to the system what earlier tasks of this Python worker have freed: workers are used again,
    and the pools of Arrow and of the C library otherwise keep the peak of every stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def trimmed(work: Callable) -> Callable:
    """A function over Arrow batches that leaves no freed memory with its Python worker, which may lie idle
    beside the workers of the next stage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            trim_memory()

    return run


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def crc_rest(column: str, divisor: int) -> Column:
    """crc32 of the value as text, modulo ``divisor``; a null value counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def words_of(text: str) -> list[bytes]:
    """Words of a text in UTF-8, A-Z in lower case. ``bytes.split`` cuts at the same ASCII white space."""
    return text.encode().lower().split()


def crc32_of(values: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(values, dtype="<u4"))


def rows_in(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, one batch in memory at a time."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def out_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4000) -> Iterator[pa.RecordBatch]:
    """Tuples to Arrow batches of bounded length."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema
    )
