"""Alignment of two tokenizers over a corpus: inverted bitmaps of documents per pair of ids.

A first pass encodes each text with both tokenizers, cuts it into groups where tokens of both
end, and numbers the documents in blocks. For each pair of ids that overlaps somewhere in a
block it writes a compressed bitmap of the block's documents that hold the pair, and multiplicity
planes: plane k holds the documents whose further links of the pair (beyond the first) have
bit k set. Popcounts of the bitmaps, added up over blocks, are the counts of a pair; a pair's
counts meet its bitmaps again in an equi-join, and each block's bitmaps return the scores to its
documents. No row of the shuffles stands for a single link, and none holds more than one block.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.llm import vocab
from recprep.llm.chunks import cut, no_cycles
from recprep.llm.common import arrow_batches, text_of
from recprep.session import discard, materialize

_BLOCK_DOCS, _BLOCK_BYTES, _SLICE_BYTES = 1 << 16, 16 << 20, 4 << 20
_CHUNK, _CHUNKS = 64, 300_000  # chunks remembered per worker: characters of one, and how many
_SPACE = "▁"  # fixed value: the sign for a space in pieces


class Aligner:
    """Groups and links of texts under a byte-level tokenizer (A) and a piece tokenizer (B)."""

    def __init__(self, a_path: str, pattern: str, b_path: str):
        import sentencepiece

        self.a = vocab.load(a_path, pattern, special=False)
        self.a_bytes = vocab.token_bytes(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        self.b_bytes = []
        inside = False
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            code = byte.fullmatch(piece) if self.b.is_byte(i) else None
            self.b_bytes.append(bytes([int(code[1], 16)]) if code else piece.replace(_SPACE, " ").encode())
            inside = inside or _SPACE in piece.lstrip(_SPACE)
        # Chunks can be encoded one by one only if no piece goes on over the space between two words.
        self.cuttable = not inside
        self.names = list(map(str, range(max(len(self.b_bytes), 1 + max(self.a_bytes)))))
        self.known: dict[str, tuple | None] = {}

    def chunks(self, text: str) -> list[str]:
        """Parts of a space and the text, each with its leading space."""
        if not self.cuttable:
            return [" " + text]
        head, rest = cut(text)
        return [" " + head, *[" " + r for r in rest]]

    def align(self, chunk: str, a_ids: list[int], b_ids: list[int]) -> tuple | None:
        """(tokens of A, of B, groups, links, groups as text, pairs) of a chunk, or None where bytes differ."""
        whole = chunk.encode()
        a_parts, b_parts = [self.a_bytes[i] for i in a_ids], [self.b_bytes[i] for i in b_ids]
        if b"".join(a_parts) != whole or b"".join(b_parts) != whole:
            return None
        a_named, b_named = [self.names[i] for i in a_ids], [self.names[i] for i in b_ids]
        a_left, b_left = [len(x) for x in a_parts], [len(x) for x in b_parts]
        pairs, groups, last = [], [], len(a_ids)
        i = j = from_i = from_j = 0
        high, low = a_ids[0] << 32, b_ids[0]
        behind = a_left[0] - b_left[0]  # how far the token of A reaches beyond that of B
        while True:
            pairs.append(high | low)
            if not behind:
                i, j = i + 1, j + 1
                groups.append(",".join(a_named[from_i:i]) + "|" + ",".join(b_named[from_j:j]))
                if i == last:
                    break
                from_i, from_j = i, j
                high, low, behind = a_ids[i] << 32, b_ids[j], a_left[i] - b_left[j]
            elif behind < 0:
                i += 1
                high, behind = a_ids[i] << 32, behind + a_left[i]
            else:
                j += 1
                low, behind = b_ids[j], behind - b_left[j]
        return last, len(b_ids), len(groups), len(pairs), ";".join(groups), array("q", pairs).tobytes()

    def align_all(self, chunks: list[str]) -> Iterator[tuple | None]:
        width = self.a.width.char
        for at in range(0, len(chunks), 5000):
            part = chunks[at : at + 5000]
            b_ids = self.b.encode([c[1:] for c in part], num_threads=1)
            for chunk, a, b in zip(part, self.a.many(part), b_ids):
                yield self.align(chunk, memoryview(a).cast(width).tolist(), b)

    @no_cycles
    def texts(self, texts: list[str]) -> list[tuple[int, int, int, int, str, bytes]]:
        """(n_a, n_b, n_groups, n_links, groups as text, pairs as 64-bit numbers) of each text; zeros and '' without tokens."""
        known = self.known
        if len(known) > _CHUNKS:
            known.clear()
        cuts = [self.chunks(t) if t else [] for t in texts]
        fresh = list({c for chunks in cuts for c in chunks}.difference(known))
        new = dict(zip(fresh, self.align_all(fresh)))
        known.update((c, v) for c, v in new.items() if len(c) <= _CHUNK)
        out = []
        for chunks in cuts:
            try:
                found = [known[c] for c in chunks]
            except KeyError:
                found = [known[c] if c in known else new[c] for c in chunks]
            if not found or None in found:
                out.append((0, 0, 0, 0, "", b""))
                continue
            a, b, groups, links, shown, pairs = zip(*found)
            out.append((sum(a), sum(b), sum(groups), sum(links), ";".join(shown), b"".join(pairs)))
        return out


@lru_cache(maxsize=1)
def _aligner(a_path: str, pattern: str, b_path: str) -> Aligner:
    return Aligner(a_path, pattern, b_path)


def planes(pairs: np.ndarray, docs: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(plane, pairs, documents) sorted by both: plane 0 is presence, plane 1 + k bit k of the further links."""
    if not len(pairs):
        return
    order = np.argsort(pairs, kind="stable")  # documents ascend already
    pairs, docs = pairs[order], docs[order]
    fresh = np.ones(len(pairs), bool)
    fresh[1:] = (pairs[1:] != pairs[:-1]) | (docs[1:] != docs[:-1])
    at = np.nonzero(fresh)[0]
    more = np.diff(np.append(at, len(pairs))) - 1
    pairs, docs = pairs[at], docs[at]
    yield 0, pairs, docs
    for k in range(int(more.max()).bit_length()):
        held = (more >> k & 1).astype(bool)
        yield 1 + k, pairs[held], docs[held]


class Block:
    """Postings of up to 65,536 documents, gathered slice by slice and compressed when the block is full."""

    def __init__(self, number: int):
        self.number, self.docs, self.bytes = number, 0, 0
        self.slices: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

    def add(self, pairs: np.ndarray, docs: np.ndarray) -> None:
        for plane, keys, members in planes(pairs, docs):
            first = np.ones(len(keys), bool)
            first[1:] = keys[1:] != keys[:-1]
            at = np.nonzero(first)[0]
            sizes = np.diff(np.append(at, len(keys)))
            self.slices.setdefault(plane, []).append((keys[at], sizes, members.astype(np.uint16)))

    def merged(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
        """(plane, pairs, popcounts, bitmaps): the slices' sets of documents are OR-ed per pair and plane.

        Slices hold different documents in ascending order, so a union is a concatenation. A
        bitmap is a list of 16-bit numbers where that is shorter, else one bit per document.
        """
        width = -(-self.docs // 8)
        for plane, parts in sorted(self.slices.items()):
            keys = np.concatenate([k for k, _, _ in parts])
            sizes = np.concatenate([s for _, s, _ in parts])
            members = np.concatenate([m for _, _, m in parts])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            order = np.argsort(keys, kind="stable")
            keys, sizes, starts = keys[order], sizes[order], starts[order]
            ends = np.cumsum(sizes)
            members = members[np.repeat(starts - (ends - sizes), sizes) + np.arange(len(members))]
            first = np.ones(len(keys), bool)
            first[1:] = keys[1:] != keys[:-1]
            at = np.nonzero(first)[0]
            counts = np.add.reduceat(sizes, at)
            pairs, offsets = keys[at], np.concatenate(([0], np.cumsum(counts)))
            data, lengths = members.astype("<u2").tobytes(), counts * 2
            dense = np.nonzero(lengths > width)[0]
            if len(dense):
                pieces, done = [], 0
                for d in dense.tolist():
                    a, b = int(offsets[d]), int(offsets[d + 1])
                    bits = np.zeros(width * 8, np.uint8)
                    bits[members[a:b]] = 1
                    pieces += [data[done * 2 : a * 2], np.packbits(bits, bitorder="little").tobytes()]
                    done = b
                data = b"".join([*pieces, data[done * 2 :]])
                lengths[dense] = width
            places = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            bitmaps = pa.Array.from_buffers(pa.binary(), len(pairs), [None, pa.py_buffer(places), pa.py_buffer(data)])
            yield plane, pairs, counts, bitmaps


def _weights(postings: pa.Table, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document of a block: links whose pair is its B id's best, and the sum of counts over links."""
    best, total = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
    for batch in postings.to_batches(max_chunksize=20_000):
        n = batch.column("n").to_numpy()
        plane = batch.column("plane").to_numpy()
        weight = np.where(plane == 0, 1, np.int64(1) << np.maximum(plane.astype(np.int64) - 1, 0))
        count = batch.column("links").to_numpy() * weight
        top = np.where(batch.column("is_best").to_numpy(zero_copy_only=False), weight, 0)
        maps = batch.column("docs").to_pylist()
        dense = np.array([len(m) < 2 * k for m, k in zip(maps, n.tolist())], bool)
        listed = np.nonzero(~dense)[0]
        members = np.frombuffer(b"".join([maps[i] for i in listed.tolist()]), "<u2").astype(np.int64)
        np.add.at(best, members, np.repeat(top[listed], n[listed]))
        np.add.at(total, members, np.repeat(count[listed], n[listed]))
        for i in np.nonzero(dense)[0].tolist():
            held = np.nonzero(np.unpackbits(np.frombuffer(maps[i], np.uint8), bitorder="little"))[0]
            best[held] += top[i]
            total[held] += count[i]
    return best, total


_DOC = "n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string"
_POSTING = "a int, b int, plane int, n int, docs binary"


def postings(
    df: DataFrame, a_path: str, pattern: str, b_path: str, *, id_col: str, text_col: str, keep_groups: bool,
) -> DataFrame:
    """One pass over the texts: a row per document (a is null) and a row per pair, plane and block (n_a is null).

    Both kinds have ``block``; a document's row has its number in the block (``low``), the
    last posting of a block is written when the block is closed, at 65,536 documents or about 16 MB.
    """
    arrow_batches(df.sparkSession, 1000)
    kind = df.schema[id_col].dataType.simpleString()
    ddl = f"block long, low int, doc_id {kind}, {_DOC}, {_POSTING}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        aligner = _aligner(a_path, pattern, b_path)
        part, block, number = TaskContext.get().partitionId(), None, 0
        fields = None

        def rows(columns: dict[str, pa.Array], length: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [columns[f.name] if f.name in columns else pa.nulls(length, f.type) for f in fields], schema=fields
            )

        def closed(block: Block) -> Iterator[pa.RecordBatch]:
            for plane, pairs, counts, bitmaps in block.merged():
                for at in range(0, len(pairs), 20_000):
                    p, m = pairs[at : at + 20_000], len(pairs[at : at + 20_000])
                    yield rows({
                        "block": pa.array(np.full(m, block.number)), "a": pa.array((p >> 32).astype(np.int32)),
                        "b": pa.array((p & 0xFFFFFFFF).astype(np.int32)), "plane": pa.array(np.full(m, plane, np.int32)),
                        "n": pa.array(counts[at : at + m].astype(np.int32)), "docs": bitmaps.slice(at, m),
                    }, m)

        for batch in batches:
            if fields is None:
                fields = pa.schema([
                    ("block", pa.int64()), ("low", pa.int32()), ("doc_id", batch.column(0).type),
                    *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups", pa.string()),
                    ("groups_sha256", pa.string()), *[(c, pa.int32()) for c in ("a", "b", "plane", "n")], ("docs", pa.binary()),
                ])
            texts = batch.column(1).to_pylist()
            sizes = np.cumsum([len(t) for t in texts])
            at = 0
            while at < len(texts):
                if block is None:
                    block, number = Block(part << 32 | number), number + 1
                room = min(_BLOCK_DOCS - block.docs, 4096)
                upto = min(at + room, max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _SLICE_BYTES, "right"))))
                found = aligner.texts(texts[at:upto])
                low = np.arange(block.docs, block.docs + len(found))
                links = np.array([f[3] for f in found], np.int64)
                block.add(np.frombuffer(b"".join([f[5] for f in found]), np.int64), np.repeat(low, links))
                block.docs += len(found)
                block.bytes += int(sizes[upto - 1] - (sizes[at - 1] if at else 0))
                counted = {c: pa.array([f[k] for f in found], pa.int64()) for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
                digests = [hashlib.sha256(f[4].encode()).hexdigest() if f[4] else "" for f in found]
                shown = {"groups": pa.array([f[4] for f in found], pa.string())} if keep_groups else {}
                yield rows({
                    "block": pa.array(np.full(len(found), block.number)), "low": pa.array(low.astype(np.int32)),
                    "doc_id": batch.column(0).slice(at, len(found)), **counted, **shown,
                    "groups_sha256": pa.array(digests, pa.string()),
                }, len(found))
                at = upto
                if block.docs >= _BLOCK_DOCS or block.bytes >= _BLOCK_BYTES:
                    yield from closed(block)
                    block = None
        if block is not None:
            yield from closed(block)

    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(work, ddl)


def pair_counts(stored: DataFrame) -> DataFrame:
    """a, b, documents, links, is_best (no pair of this B id has more links) of the postings."""
    weight = F.expr("shiftleft(1L, greatest(plane - 1, 0))")
    counts = stored.filter("a IS NOT NULL").groupBy("a", "b").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n").cast("long"))).alias("documents"),
        F.sum(F.col("n").cast("long") * weight).alias("links"),
    )
    return counts


def with_best(counts: DataFrame) -> DataFrame:
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    return counts.join(most, "b").select("a", "b", "documents", "links", (F.col("links") == F.col("most")).alias("is_best"))


def returned(stored: DataFrame, counts: DataFrame) -> DataFrame:
    """block, low, n_best, count_sum: each block's bitmaps give the scores of their pairs back to its documents."""
    arrow_batches(stored.sparkSession, 20_000)

    def work(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        size = 0
        for maps, ns in zip(table.column("docs").chunks, table.column("n").chunks):
            for m, n in zip(maps.to_pylist(), ns.to_pylist()):
                size = max(size, len(m) * 8 if len(m) < 2 * n else int.from_bytes(m[-2:], "little") + 1)
        best, total = _weights(table, size)
        return pa.table({
            "block": pa.array(np.full(size, block)), "low": pa.array(np.arange(size, dtype=np.int32)),
            "n_best": pa.array(best), "count_sum": pa.array(total),
        })

    told = stored.filter("a IS NOT NULL").select("block", "a", "b", "plane", "n", "docs").join(
        counts.select("a", "b", "links", "is_best"), ["a", "b"]
    )
    return told.select("block", "plane", "n", "docs", "links", "is_best").groupBy("block").applyInArrow(
        work, "block long, low int, n_best long, count_sum long"
    )


def align(
    df: DataFrame, a_path: str, pattern: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Alignment of every text, and the table of pairs.

    The first result has doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is its B
    id's best), count_sum (of the pairs' counts over the links), groups_sha256 and with
    ``keep_groups`` the groups themselves; the second a, b, documents, links, is_best.

    Defined cases: null and empty texts, and texts that one of the tokenizers does not give back
    byte for byte, have no tokens: zeros and ''. Null or repeated ids and repeated rows are
    aligned one by one; an empty table gives two empty results; other columns are left out,
    whatever their names. Strings of special tokens are ordinary text.
    """
    stored = materialize(postings(df, a_path, pattern, b_path, id_col=id_col, text_col=text_col, keep_groups=keep_groups))
    plain = materialize(pair_counts(stored))
    counts = materialize(with_best(plain))
    scores = materialize(returned(stored, counts))
    discard(plain)
    docs = stored.filter("n_a IS NOT NULL").alias("d")
    joined = docs.join(scores.alias("s"), (F.col("d.block") == F.col("s.block")) & (F.col("d.low") == F.col("s.low")), "left")
    zero = {c: F.coalesce(F.col(f"s.{c}"), F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")}
    shown = ["d.groups"] if keep_groups else []
    return joined.select(
        "d.doc_id", "d.n_a", "d.n_b", "d.n_groups", "d.n_links", zero["n_best"], zero["count_sum"], "d.groups_sha256", *shown
    ), counts
