"""Token ids as length-delimited binary records, with a separate offset index.

A file is a row of records: length (unsigned 64 bit, little-endian), masked CRC-32C of those
eight bytes, payload, masked CRC-32C of the payload (the framing that TFRecord readers expect).
A payload is a serialized ``Example`` message with the features ``doc_id`` (left out where null)
and ``ids_u16`` or ``ids_u32`` (little-endian ids). The index beside it holds three unsigned
64-bit numbers per record (offset, framed length, ids before it in the file), so that record k
of a file is found by one seek.
"""

from __future__ import annotations

import posixpath
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recprep.llm import vocab
from recprep.llm.common import arrow_batches, crc32_of, out_batches, qualified, rows_in, text_of
from recprep.llm.warc import _open
from recprep.session import shared_folder

# The reflected Castagnoli polynomial and the constant of masked checksums.
_CASTAGNOLI = 0x82F63B78
_MASK_DELTA = 0xA282EAD8
_STEP = 512  # bytes whose checksum is one gather and one xor
_ENTRY = np.dtype([("offset", "<u8"), ("length", "<u8"), ("before", "<u8")])
_MANIFEST = "part int, seq int, file string, index string, records long, tokens long, bytes long"


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Checksum of byte b with k zero bytes behind it, at [k * 256 + b]; and the four tables that put ``_STEP`` zero bytes behind a checksum."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(_CASTAGNOLI), one >> 1)
    rows = [one]
    for _ in range(_STEP - 1):
        rows.append((rows[-1] >> 8) ^ one[rows[-1] & 255])
    shifted = []
    for k in range(4):
        value = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(_STEP):
            value = (value >> 8) ^ one[value & 255]
        shifted.append(value)
    return np.concatenate(rows), np.stack(shifted)


def crc32c(payloads: list[bytes]) -> np.ndarray:
    """CRC-32C of each payload (unsigned 32 bit).

    The checksum is linear: flipping the first four bytes stands for its start value, zero bytes
    in front change nothing, so payloads are padded in front to whole steps, all steps are
    gathered at once, and a payload's steps are chained.
    """
    table, shift = _tables()
    sizes = np.array([len(p) for p in payloads], np.int64)
    if len(sizes) and sizes.min() < 4:
        return np.array([_crc32c_short(p) for p in payloads], np.uint32)
    steps = -(-sizes // _STEP)
    ends = np.cumsum(steps)
    flat = np.zeros(int(ends[-1]) * _STEP if len(ends) else 0, np.uint8)
    for payload, size, end in zip(payloads, sizes.tolist(), (ends * _STEP).tolist()):
        flat[end - size : end] = np.frombuffer(payload, np.uint8)
    first = (ends * _STEP - sizes)[:, None] + np.arange(4)
    flat[first] ^= 0xFF
    place = (np.arange(_STEP - 1, -1, -1) * 256).astype(np.int32)
    parts = np.empty(len(flat) // _STEP, np.uint32)
    for at in range(0, len(parts), 2048):
        block = flat[at * _STEP : (at + 2048) * _STEP].reshape(-1, _STEP)
        parts[at : at + len(block)] = np.bitwise_xor.reduce(table[block + place], axis=1)
    starts = ends - steps
    out = parts[starts] if len(starts) else np.zeros(0, np.uint32)
    live = np.nonzero(steps > 1)[0]
    k = 1
    while len(live):
        c = out[live]
        moved = shift[0][c & 255] ^ shift[1][c >> 8 & 255] ^ shift[2][c >> 16 & 255] ^ shift[3][c >> 24]
        out[live] = moved ^ parts[starts[live] + k]
        k += 1
        live = live[steps[live] > k]
    return ~out


def _crc32c_short(payload: bytes) -> int:
    table, c = _tables()[0], 0xFFFFFFFF
    for b in payload:
        c = c >> 8 ^ int(table[(c ^ b) & 255])
    return c ^ 0xFFFFFFFF


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated and shifted, so that a checksum of data that holds checksums stays sound."""
    crc = crc.astype(np.uint32)
    return (crc >> np.uint32(15) | crc << np.uint32(17)) + np.uint32(_MASK_DELTA)


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, data: bytes) -> bytes:
    return bytes([number << 3 | 2]) + _varint(len(data)) + data


def example(features: dict[str, int | bytes]) -> bytes:
    """A serialized Example message with one value per feature."""
    entries = []
    for name, value in features.items():
        if isinstance(value, bytes):
            kind = _field(1, _field(1, value))
        else:
            kind = _field(3, _field(1, _varint(value)))
        entries.append(_field(1, _field(1, name.encode()) + _field(2, kind)))
    return _field(1, b"".join(entries))


def _parts(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Field numbers and contents of a message whose fields are all length-delimited."""
    at = 0
    while at < len(data):
        number, at = data[at] >> 3, at + 1
        size = shift = 0
        while True:
            byte, at = data[at], at + 1
            size |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                break
        yield number, data[at : at + size]
        at += size


def features(message: bytes) -> dict[str, int | bytes]:
    """The inverse of :func:`example`."""
    out: dict[str, int | bytes] = {}
    for _, body in _parts(message):
        for _, entry in _parts(body):
            named = dict(_parts(entry))
            (kind, values), = _parts(named[2])
            (_, value), = _parts(values)
            if kind == 3:
                number = 0
                for k, byte in enumerate(value):
                    number |= (byte & 127) << 7 * k
                value = number - (1 << 64) if number >> 63 else number
            out[named[1].decode()] = value
    return out


def frame(payloads: list[bytes]) -> list[bytes]:
    """Payloads with their lengths and masked checksums."""
    heads = [struct.pack("<Q", len(p)) for p in payloads]
    head_crc, crc = masked(crc32c(heads)).tolist(), masked(crc32c(payloads)).tolist()
    return [b"".join((h, struct.pack("<I", hc), p, struct.pack("<I", c))) for h, hc, p, c in zip(heads, head_crc, payloads, crc)]


def unframe(framed: list[bytes]) -> list[bytes]:
    """Payloads of framed records; a wrong length or checksum is an error."""
    heads, payloads = [f[:8] for f in framed], [f[12:-4] for f in framed]
    said_head = np.array([struct.unpack_from("<I", f, 8)[0] for f in framed], np.uint32)
    said = np.array([struct.unpack_from("<I", f, len(f) - 4)[0] for f in framed], np.uint32)
    sizes_right = all(struct.unpack("<Q", h)[0] == len(p) for h, p in zip(heads, payloads))
    if not sizes_right or (masked(crc32c(heads)) != said_head).any() or (masked(crc32c(payloads)) != said).any():
        raise ValueError("a record is damaged: its length or checksum does not fit its bytes")
    return payloads


def ordered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text in ascending order of id over the partitions and in each of them; null ids come first.

    Rows of one id are dealt by a hash of their text and by their place, so many rows without an
    id do not meet in one task.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(f"`{text_col}`").alias("text"))
    keyed = rows.withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    keys = ("doc_id", "tie", "place")
    return keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")


def write_records(
    ordered_docs: DataFrame, folder: str, tokenizer_path: str, pattern: str, *, end_id: int, file_bytes: int = 256 << 20,
) -> DataFrame:
    """Encode documents in their given order and write record files with their indexes; returns the manifest.

    A task begins a new file after ``file_bytes``. Files carry the name of one attempt of a task,
    and only those named by a finished task are in the manifest.
    """
    arrow_batches(ordered_docs.sparkSession, 1000)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocab.load(tokenizer_path, pattern)
        end, size = np.array([end_id], encoder.width).tobytes(), encoder.width.itemsize
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        part, done, out, side = TaskContext.get().partitionId(), [], None, None
        name, at, tokens, count = "", 0, 0, 0

        def close() -> None:
            out.close()
            side.close()
            done.append((part, len(done), f"{name}.records", f"{name}.index", count, tokens, at))

        for batch in batches:
            ids = [x + end for x in encoder.encode(batch.column(1).to_pylist())]
            payloads = []
            for doc_id, data in zip(batch.column(0).to_pylist(), ids):
                named = {} if doc_id is None else {"doc_id": doc_id if isinstance(doc_id, int) else str(doc_id).encode()}
                payloads.append(example({**named, f"ids_u{8 * size}": data}))
            for data, record in zip(ids, frame(payloads)):
                if out is None:
                    name, at, tokens, count = f"tokens-{part:06d}-{uuid.uuid4().hex}", 0, 0, 0
                    out = store.open_output_stream(posixpath.join(root, f"{name}.records"), compression=None)
                    side = store.open_output_stream(posixpath.join(root, f"{name}.index"), compression=None)
                out.write(record)
                side.write(struct.pack("<QQQ", at, len(record), tokens))
                at, tokens, count = at + len(record), tokens + len(data) // size, count + 1
                if at >= file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        longs = [(c, pa.int64()) for c in ("records", "tokens", "bytes")]
        yield from out_batches(iter(done), pa.schema([
            ("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("index", pa.string()), *longs,
        ]))

    return ordered_docs.mapInArrow(work, _MANIFEST)


def file_starts(manifest: DataFrame, block_parts: int = 1024) -> DataFrame:
    """Adds ``start``: ids in all files before. Two levels of sums: files in a block of parts, then blocks."""
    def before(value: str, window) -> F.Column:
        return F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(value)

    files = manifest.withColumn("block", F.floor(F.col("part") / block_parts))
    inner = files.withColumn("inner", before("tokens", Window.partitionBy("block").orderBy("part", "seq")))
    blocks = files.groupBy("block").agg(F.sum("tokens").alias("in_block"))
    outer = blocks.withColumn("outer", before("in_block", Window.partitionBy(F.lit(0)).orderBy("block")))
    joined = inner.join(outer, "block").withColumn("start", F.col("inner") + F.col("outer"))
    return joined.select(*manifest.columns, "start")


def slices(manifest: DataFrame, records: int = 2000) -> DataFrame:
    """Ranges of records (first, last) of each file, for :func:`read_records`."""
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("records") - 1, F.lit(records).cast("long")))
    return manifest.select("*", first.alias("first")).withColumn("last", F.least(F.col("first") + records, F.col("records")) - 1)


def shuffled(manifest: DataFrame, seed: int, batch: int = 2000) -> DataFrame:
    """Single records of all files in an order that depends on ``seed`` alone: one row per record for :func:`read_records`.

    The order is that of a keyed hash of (file number, record number); tasks hold ranges of it.
    """
    numbered = slices(manifest, batch).select("*", F.explode(F.sequence("first", "last")).alias("k"))
    one = numbered.withColumn("first", F.col("k")).withColumn("last", F.col("k")).drop("k")
    draw = F.xxhash64(F.lit(seed), "part", "seq", "first")
    return one.withColumn("draw", draw).repartitionByRange("draw", "part", "seq", "first").sortWithinPartitions("draw", "part", "seq", "first").drop("draw")


def read_records(wanted: DataFrame, folder: str, id_type: str = "bigint", *, ids: bool = True) -> DataFrame:
    """Records of the ranges in ``wanted`` (file, index, first, last, start), through the index, checksums verified.

    Returns doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as
    unsigned 32-bit integers) and with ``ids`` those integers (binary).
    """
    arrow_batches(wanted.sparkSession, 200)
    number = id_type in ("bigint", "int", "smallint", "tinyint")
    schema = pa.schema([
        ("doc_id", pa.int64() if number else pa.string()), ("start", pa.int64()), ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()), *([("ids", pa.binary())] if ids else []),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        open_file: dict[str, object] = {}

        def of(name: str):
            if name not in open_file:
                if len(open_file) >= 64:  # files stay open for the next range, a bounded number of them
                    for f in open_file.values():
                        f.close()
                    open_file.clear()
                open_file[name] = store.open_input_file(posixpath.join(root, name))
            return open_file[name]

        def rows() -> Iterator[tuple]:
            for file, index, first, last, start in rows_in(batches, "file", "index", "first", "last", "start"):
                side = of(index)
                side.seek(first * _ENTRY.itemsize)
                entries = np.frombuffer(side.read((last - first + 1) * _ENTRY.itemsize), _ENTRY)
                src, at = of(file), 0
                while at < len(entries):
                    # A bounded run of neighbours is one read.
                    sizes = np.cumsum(entries["length"][at:].astype(np.int64))
                    many = max(1, int(np.searchsorted(sizes, 8 << 20, "right")))
                    run = entries[at : at + many]
                    src.seek(int(run["offset"][0]))
                    data = src.read(int(sizes[many - 1]))
                    cuts = [0, *sizes[:many].tolist()]
                    payloads = unframe([data[a:b] for a, b in zip(cuts, cuts[1:])])
                    for payload, before in zip(payloads, run["before"].tolist()):
                        named = features(payload)
                        width = "<u2" if "ids_u16" in named else "<u4"
                        found = np.frombuffer(named["ids_u16" if width == "<u2" else "ids_u32"], width).astype("<u4")
                        doc_id = named.get("doc_id")
                        if isinstance(doc_id, bytes):
                            doc_id = doc_id.decode()
                        row = (doc_id, start + before, len(found), crc32_of(found))
                        yield (*row, found.tobytes()) if ids else row
                    at += many
            for f in open_file.values():
                f.close()

        yield from out_batches(rows(), schema, 500 if ids else 4000)

    ddl = f"doc_id {'long' if number else 'string'}, start long, n_tokens long, ids_crc32 long" + (", ids binary" if ids else "")
    return wanted.select("file", "index", "first", "last", "start").mapInArrow(work, ddl)


def binary_records(
    df: DataFrame, tokenizer_path: str, pattern: str, folder: str | None = None, *, end_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text", file_bytes: int = 256 << 20, ids: bool = True,
) -> DataFrame:
    """Write documents as records in ascending order of id, and read all of them back through the index.

    Defined cases: null or empty text is the end id alone; null ids come first and are read as
    null; rows of one id stay single rows, in an order by text hash; repeated rows are written one
    by one; an empty table gives no file and no rows; other columns are left out, whatever
    their names. Ids that are no integers are written and read as strings.
    """
    spark = df.sparkSession
    folder = qualified(spark, f"{folder or shared_folder(spark)}/records-{uuid.uuid4().hex}")
    kind = df.schema[id_col].dataType
    docs = ordered(df, id_col, text_col)
    written = write_records(docs, folder, tokenizer_path, pattern, end_id=end_id, file_bytes=file_bytes)
    # Writing has a side effect: its manifest is stored, so that nothing is written twice.
    written.write.parquet(f"{folder}/manifest")
    manifest = file_starts(spark.read.schema(written.schema).parquet(f"{folder}/manifest"))
    total = manifest.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    # An explicit number of tasks: rows of the manifest are tiny, what they stand for is not.
    wanted = slices(manifest).repartition(int(max(1, min(total // (16 << 20) + 8, 100_000))))
    return read_records(wanted, folder, "bigint" if isinstance(kind, T.IntegralType) else "string", ids=ids)
