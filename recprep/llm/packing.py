"""Pack documents into sequences under target token proportions of their sources."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recprep.llm import vocab
from recprep.llm.common import arrow_batches, crc32_of, out_batches, rows_in, text_of, trim_memory, trimmed
from recprep.session import materialize


def tokenize(df: DataFrame, path: str, pattern: str, *, end_id: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, n, width, ids (binary). ``path`` names a byte-level tokenizer on every executor.

    Null text is empty: its ids are the end id alone. Strings of added tokens become their ids,
    as the tokenizers library has it by default.
    """
    arrow_batches(df.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim_memory()
        encoder = vocab.load(path, pattern)
        width = encoder.width
        end = np.array([end_id], width).tobytes()
        for batch in batches:
            ids = [x + end for x in encoder.encode(batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([len(x) // width.itemsize for x in ids], pa.int64()),
                    pa.array([width.itemsize] * len(ids), pa.int32()), pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "source", "n", "width", "ids"],
            )

    rows = df.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), text_of(text_col).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(trimmed(work), f"doc_id {kind}, source string, n long, width int, ids binary")


def _running(value: str, window) -> Column:
    """Sum of the rows before this one."""
    return F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(value)


def queue_offsets(docs: DataFrame, bucket_docs: int) -> DataFrame:
    """Adds ``start``: tokens before a document in the queue of its source.

    The queue runs through hash buckets of about ``bucket_docs`` documents; only the bucket
    sums of a source meet in one task, so a source with most of the rows is summed in parallel.
    """
    buckets = max(1, -(-docs.count() // bucket_docs))
    dealt = docs.withColumn("bucket", F.pmod(F.xxhash64("row_id"), F.lit(buckets)))
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "row_id")
    sums = dealt.groupBy("source", "bucket").agg(F.sum("n").alias("in_bucket"))
    before = sums.withColumn("before", _running("in_bucket", Window.partitionBy("source").orderBy("bucket")))
    same = dealt.withColumn("inner", _running("n", inside)).alias("d")
    joined = same.join(
        before.drop("in_bucket").alias("b"),
        F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.bucket") == F.col("b.bucket")),
    )
    return joined.select("d.row_id", "d.doc_id", "d.source", "d.n", (F.col("before") + F.col("inner")).alias("start"))


def rounds(queued: DataFrame, window_tokens: int, targets: Mapping[str | None, float] | None) -> DataFrame:
    """Adds ``round``: the round of deficit round-robin that serves a document.

    In each round the deficit counter of a source grows by its quantum (its share of
    ``window_tokens``), a document is served once the counter covers it, and what is left is
    carried on. Quanta served by round r add up to (r + 1) quanta, so a document whose queue
    range ends at ``start + n`` is served in round ceil((start + n) / quantum) - 1: no round
    has to wait for the one before it, and the carry crosses windows and partitions exactly.

    Without ``targets`` the share of a source is its share of all tokens, and all queues end
    together. With targets, sources that are not named share the weight under the key None by
    their tokens (without that key each has its share of all tokens), and a queue that ends
    early leaves the later rounds to the others.
    """
    totals = queued.groupBy("source").agg(F.sum("n").alias("tokens"))
    named = F.coalesce(F.col("source").isin(*[s for s in targets or () if s is not None]), F.lit(False))
    everything = totals.agg(
        F.sum("tokens").alias("all_tokens"), F.sum(F.when(~named, F.col("tokens"))).alias("other_tokens")
    )
    shares = totals.crossJoin(F.broadcast(everything)).withColumn("share", F.col("tokens") / F.col("all_tokens"))
    if targets:
        whole = float(sum(targets.values()))
        rest = targets.get(None)
        share = F.col("share") if rest is None else F.lit(rest / whole) * F.col("tokens") / F.col("other_tokens")
        for source, weight in targets.items():
            if source is not None:
                share = F.when(F.col("source") == source, F.lit(weight / whole)).otherwise(share)
        shares = shares.withColumn("share", share)
    quantum = F.col("share") * F.lit(float(window_tokens))
    shares = shares.select(F.col("source").alias("of"), quantum.alias("quantum"))
    joined = queued.join(shares, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    served = F.ceil((F.col("start") + F.col("n")) / F.col("quantum")) - 1
    return joined.withColumn("round", served.cast("long")).drop("quantum")


def stream_offsets(served: DataFrame, block_rounds: int = 1024) -> DataFrame:
    """Adds ``at``: tokens before a document in the packed stream (by round, source, queue).

    Two levels of sums: rounds in a block, then blocks. A round holds about one window.
    """
    block = (F.col("round") / block_rounds).cast("long")
    sums = served.groupBy("round").agg(F.sum("n").alias("in_round")).withColumn("block", block)
    inner = sums.withColumn("inner", _running("in_round", Window.partitionBy("block").orderBy("round")))
    blocks = sums.groupBy("block").agg(F.sum("in_round").alias("in_block"))
    before = blocks.withColumn("before", _running("in_block", Window.partitionBy(F.lit(0)).orderBy("block")))
    starts = inner.join(before, "block").select("round", (F.col("before") + F.col("inner")).alias("round_at"))
    order = Window.partitionBy("round").orderBy("source", "start", "row_id")
    return (
        served.withColumn("in_window", _running("n", order)).join(starts, "round")
        .select("row_id", "round", (F.col("round_at") + F.col("in_window")).alias("at"))
    )


def cut_pieces(placed: DataFrame, seq_len: int) -> DataFrame:
    """Pieces of documents: each ends with its document or with its sequence.

    placed: doc_id, source, round, at, n, width, ids. Returns doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, source, round, ids (unsigned 32 bit, little-endian).
    """
    arrow_batches(placed.sparkSession)
    kind = placed.schema["doc_id"].dataType
    names = ("doc_id", "source", "round", "at", "n", "width", "ids")
    ddl = (
        f"doc_id {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, source string, round long, ids binary"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces(batch: pa.RecordBatch) -> Iterator[tuple]:
            for doc_id, source, window, at, n, width, data in rows_in(iter([batch]), *names):
                ids = np.frombuffer(data, "<u2" if width == 2 else "<u4").astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, seq_len)
                    length = min(n - start, seq_len - offset)
                    part = ids[start : start + length]
                    yield doc_id, start, length, crc32_of(part), n, sequence, offset, source, window, part.tobytes()
                    start += length

        for batch in batches:
            longs = [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
            yield from out_batches(pieces(batch), pa.schema([
                ("doc_id", batch.column(0).type), *longs, ("source", pa.string()), ("round", pa.int64()), ("ids", pa.binary()),
            ]))

    return placed.select(*names).mapInArrow(trimmed(work), ddl)


def pack(
    df: DataFrame, tokenizer_path: str, pattern: str, *, seq_len: int = 2048, end_id: int = 1, window_sequences: int = 64,
    targets: Mapping[str | None, float] | None = None, bucket_docs: int = 5000, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Mixture-controlled packing. All sequences are full but the last, so padding is under one sequence.

    Windows of ``window_sequences`` sequences follow the target proportions by deficit
    round-robin (:func:`rounds`). Documents are cut only where a sequence ends.

    Defined cases: null or empty text is the end id alone; a null source is a queue of its
    own; null or repeated ids and repeated rows are packed one by one (ties by place in the
    stored token table); an empty table gives no pieces; other columns are left out.
    """
    tokens = tokenize(df, tokenizer_path, pattern, end_id=end_id, id_col=id_col, text_col=text_col, source_col=source_col)
    stored = materialize(tokens.withColumn("row_id", F.monotonically_increasing_id()))
    queued = queue_offsets(stored.select("row_id", "doc_id", "source", "n"), bucket_docs)
    served = rounds(queued, window_sequences * seq_len, targets)
    return cut_pieces(stored.join(stream_offsets(materialize(served)), "row_id"), seq_len)
