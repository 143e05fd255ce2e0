"""WARC archives: write, normalise monolithic gzip into one member per record, index, read back."""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recprep.llm.common import arrow_batches, out_batches, qualified, rows_in, text_of
from recprep.session import shared_folder

_CRLF2 = b"\r\n\r\n"
_ID = "urn:page:"  # record ids: <urn:page:{page_id}>
_DATE = "2024-01-01T00:00:00Z"  # fixed, so that a task run again writes the same bytes
_INDEX = "archive string, offset long, length long, record_id string, record_type string"


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder (local, HDFS or an object store) and the path in it."""
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def _attempt() -> str:
    """A name that no other attempt of a task shares: only files named by a finished task are read."""
    return f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"


def mark_revisits(pages: DataFrame, *, id_col: str, url_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, refers_to: null for the smallest id of equal payloads, else that id.

    Equal means equal SHA-1 and SHA-256. Payloads under ``min_bytes`` are never revisits.
    Null payloads are empty. Of rows with the same id and payload each is a response.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        text_of(payload_col).alias("payload"),
    ).withColumn("key", F.concat(F.sha1(F.col("payload").cast("binary")), F.sha2("payload", 256)))
    large = F.octet_length("payload") >= min_bytes
    first = rows.filter(large).groupBy("key").agg(F.min("page_id").alias("first"))
    return rows.join(first, "key", "left").select(
        "page_id", "url", "payload",
        F.when(large & F.col("page_id").isNotNull() & (F.col("page_id") != F.col("first")), F.col("first")).alias("refers_to"),
    )


def record(page_id, url: str, payload: bytes, refers_to) -> bytes:
    """One WARC/1.1 record. A revisit has the HTTP headers of the full payload and no payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        "WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url),
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{_ID}{refers_to}>",
        ]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + _CRLF2 + block + _CRLF2


def write_archives(marked: DataFrame, folder: str, *, archive_bytes: int = 256 << 20) -> DataFrame:
    """Write ``marked`` as gzip archives, each one stream over all of its records; returns their names.

    A task starts a new archive after ``archive_bytes`` of records, so no file grows with the table.
    """
    arrow_batches(marked.sparkSession, 500)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        name, out, packer, size, n = None, None, None, 0, 0
        done = []

        def close() -> None:
            out.write(packer.flush())
            out.close()
            done.append((name, n))

        for row in rows_in(batches, "page_id", "url", "payload", "refers_to"):
            if out is None:
                name = f"mono-{_attempt()}.warc.gz"
                out, size, n = store.open_output_stream(posixpath.join(root, name), compression=None), 0, 0
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
            data = record(row[0], row[1], row[2].encode(), row[3])
            out.write(packer.compress(data))
            size, n = size + len(data), n + 1
            if size >= archive_bytes:
                close()
                out = None
        if out is not None:
            close()
        yield from out_batches(iter(done), pa.schema([("archive", pa.string()), ("records", pa.int64())]))

    return marked.mapInArrow(work, "archive string, records long")


def inflate(read, size: int = 1 << 20) -> Iterator[bytes]:
    """Blocks of a gzip file of one or many members, in one pass over its bytes.

    A block has at most ``size`` bytes, however well the file is compressed.
    """
    unpack = zlib.decompressobj(31)
    data = read(size)
    while data:
        yield unpack.decompress(data, size)
        data = unpack.unconsumed_tail
        if unpack.eof:
            data = unpack.unused_data or read(size)
            if data:
                unpack = zlib.decompressobj(31)
        elif not data:
            data = read(size)
    while not unpack.eof:  # all bytes are read; what zlib still holds comes out in blocks too
        block = unpack.decompress(b"", size)
        if not block:
            raise ValueError("the archive ends inside a gzip member")
        yield block


def headers(head: bytes) -> dict[str, str]:
    """Named fields of a record or HTTP head, names in lower case."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def records_of(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records from inflated blocks; holds one record and one block at a time."""
    held, want, scanned = bytearray(), 0, 0
    for block in blocks:
        held += block
        while True:
            if not want:
                end = held.find(_CRLF2, max(0, scanned - 3))
                if end < 0:
                    scanned = len(held)
                    break
                want = end + 8 + int(headers(bytes(held[:end]))["content-length"])
            if len(held) < want:
                break
            yield bytes(held[:want])
            del held[:want]
            want = scanned = 0
    if held:
        raise ValueError("the archive ends inside a record")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive as one gzip member per record, with a sidecar index beside it.

    The index is JSON lines (archive, offset, length, record_id, record_type). Returns archive
    and index names; memory holds one record, whatever the size of the archive.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        made = []
        for (source,) in rows_in(batches, "archive"):
            name = f"member-{_attempt()}.warc.gz"
            index = name.replace(".warc.gz", ".idx.json")
            at = 0
            with (
                store.open_input_stream(posixpath.join(root, source), compression=None) as src,
                store.open_output_stream(posixpath.join(root, name), compression=None) as out,
                store.open_output_stream(posixpath.join(root, index), compression=None) as side,
            ):
                for data in records_of(inflate(src.read)):
                    field = headers(data[: data.index(_CRLF2)])
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    member = packer.compress(data) + packer.flush()
                    out.write(member)
                    entry = (name, at, len(member), field["warc-record-id"], field["warc-type"])
                    side.write((json.dumps(dict(zip(("archive", "offset", "length", "record_id", "record_type"), entry))) + "\n").encode())
                    at += len(member)
            made.append((name, index))
        yield from out_batches(iter(made), pa.schema([("archive", pa.string()), ("index", pa.string())]))

    return archives.select("archive").mapInArrow(work, "archive string, index string")


def read_index(spark: SparkSession, folder: str, names: list[str] | None = None) -> DataFrame:
    """Entries of the sidecar indexes in a folder (of the named ones, if names are given)."""
    return spark.read.schema(_INDEX).json([f"{folder}/{n}" for n in names] if names else f"{folder}/*.idx.json")


def read_records(entries: DataFrame, folder: str, id_type: str = "long") -> DataFrame:
    """Read records through index entries, each by one seek to its own member.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to and payload (null
    for revisits). The digest of a response is computed again and must equal its header.
    """
    arrow_batches(entries.sparkSession, 500)
    number = int if id_type in ("long", "bigint", "int") else str
    arrow_id = pa.int64() if number is int else pa.string()
    schema = pa.schema([
        ("page_id", arrow_id), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", arrow_id), ("payload", pa.string()),
    ])

    def name_of(urn: str | None):
        value = (urn or "").strip("<>").removeprefix(_ID)
        return number(value) if value else None

    def parse(member: bytes) -> tuple:
        data = zlib.decompress(member, 31)
        cut = data.index(_CRLF2)
        field = headers(data[:cut])
        http, _, payload = data[cut + 4 : -4].partition(_CRLF2)
        said, kind = field["warc-payload-digest"].removeprefix("sha1:"), field["warc-type"]
        if kind == "response":
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if found != said:
                raise ValueError(f"digest of {field['warc-record-id']} is {found}, its header says {said}")
        size = int(headers(http)["content-length"])
        text = payload.decode() if kind == "response" else None
        return name_of(field["warc-record-id"]), size, said, kind, name_of(field.get("warc-refers-to")), text

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)

        def found() -> Iterator[tuple]:
            name, src = None, None
            for archive, offset, length in rows_in(batches, "archive", "offset", "length"):
                if archive != name:
                    if src is not None:
                        src.close()
                    name, src = archive, store.open_input_file(posixpath.join(root, archive))
                src.seek(offset)
                yield parse(src.read(length))
            if src is not None:
                src.close()

        yield from out_batches(found(), schema, 500)

    kind = "long" if number is int else "string"
    return entries.select("archive", "offset", "length").mapInArrow(
        work,
        f"page_id {kind}, payload_bytes long, payload_digest string, record_type string, refers_to {kind}, payload string",
    )


def archive_pages(
    pages: DataFrame, folder: str | None = None, *, id_col: str = "page_id", url_col: str = "url",
    payload_col: str = "html", min_bytes: int = 0, archive_bytes: int = 256 << 20,
) -> DataFrame:
    """Write pages as archives, normalise them, and read every record back from its own member.

    Defined cases: null html is an empty payload, a null url an empty target, a null id is
    written and read as no id; repeated rows give one record each; an empty table gives no
    archive and an empty result. Other columns are left out, whatever their names.
    """
    spark = pages.sparkSession
    folder = qualified(spark, f"{folder or shared_folder(spark)}/warc-{uuid.uuid4().hex}")
    id_type = pages.schema[id_col].dataType.simpleString()
    marked = mark_revisits(pages, id_col=id_col, url_col=url_col, payload_col=payload_col, min_bytes=min_bytes)
    # Writing has a side effect: its manifest is stored, so that nothing is written twice.
    manifest = _stored(write_archives(marked, folder, archive_bytes=archive_bytes), folder, "mono")
    # Explicit numbers of tasks: these rows are tiny, what they stand for is not, and adaptive
    # execution merges by bytes. A task per archive, then a task per 32 MB of members.
    archives = max(1, min(manifest.count(), 100_000))
    members = _stored(normalise(manifest.repartitionByRange(archives, "archive"), folder), folder, "member")
    wanted = members.select("archive")
    if members.isEmpty():
        entries = spark.createDataFrame([], _INDEX)
    else:
        entries = read_index(spark, folder).join(wanted, "archive", "left_semi")
    # Ranges of an archive go to tasks in order of offset: few open files, forward seeks only.
    stored = entries.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = int(max(1, min(stored // (32 << 20) + 8, 100_000)))
    spread = entries.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    return read_records(spread, folder, "long" if isinstance(pages.schema[id_col].dataType, T.IntegralType) else id_type)


def _stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    path = f"{folder}/manifest-{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
