"""Byte-level BPE with a rank queue over hierarchical bitmaps."""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.llm.chunks import ChunkEncoder
from recprep.llm.common import arrow_batches, text_of, trimmed

_SHORT, _PIECES = 32, 300_000  # pre-tokens remembered: characters of one, and how many
_TEXTS, _QUEUE, _IDS = 20_000, 100_000, 200_000  # texts cut at a time, bytes of pre-tokens in one queue (one pre-token at least), ids decoded at a time


class BytePairs:
    """Encode and decode by a table of ranks; a token's id is its rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        # Bytes of all tokens in a row, and where those of an id start; ids without a token have size -1.
        self.joined = np.frombuffer(b"".join(ranks), np.uint8)
        self.starts, self.sizes = np.zeros((2, max(ranks.values(), default=0) + 1), np.int64) - 1
        told = np.fromiter(ranks.values(), np.int64, len(ranks))
        self.sizes[told] = [len(token) for token in ranks]
        self.starts[told] = np.cumsum(self.sizes[told]) - self.sizes[told]
        self.byte_ids = [*(ranks.get(bytes([b])) for b in range(256)), -1]
        self.byte_pairs = np.full((257, 257), -1, np.int32)  # their ranks, -1 for none
        # One number per pair. With a power of two for a stride, equal right sides would collide in the table.
        self.stride = (max(ranks.values(), default=0) | 1) + 2
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    self.pairs[left * self.stride + right] = rank
                    if len(token) == 2:
                        self.byte_pairs[token[0], token[1]] = rank
        self.seen: dict[str, bytes] = {}
        # Python's \s has four control characters more than the Unicode white space meant here.
        space = r"\p{White_Space}"
        self.pattern = regex.compile(pattern.replace(r"[^\s", "[^" + space).replace(r"\S", r"\P{White_Space}").replace(r"\s", space))

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of pre-tokens: in each, merge the lowest-ranked pair, leftmost first, until none is left.

        The rank queue, one for all given pre-tokens (they lie in one linked list, with a -1 between
        them that is in no pair): a bucket per rank holds positions in the list. ``words`` are
        bitmaps of 256 ranks that say which buckets are in use, ``top`` says which words are;
        find-first-set in both gives the next rank, however long the pre-tokens are. A bucket is
        emptied from left to right, unless a merge brings up a lower rank. An entry whose pair has
        changed since it was pushed is stale and skipped. The queue is written out here because
        calls cost more than its steps.
        """
        wholes = [self.ranks.get(piece) for piece in pieces]
        cut = [piece for piece, whole in zip(pieces, wholes) if whole is None]
        if cut:
            lists = iter(self._merged(cut))
        return [next(lists) if whole is None else [whole] for whole in wholes]

    def _merged(self, pieces: list[bytes]) -> list[list[int]]:
        pairs, stride = self.pairs.get, self.stride
        # Bytes of all pre-tokens, with the 257th byte before, between and behind them.
        data = np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0", np.uint8).astype(np.int64)
        ends = np.cumsum([0, *(len(piece) + 1 for piece in pieces)])
        data[ends] = 256
        ids = list(map(self.byte_ids.__getitem__, data.tolist()))
        first = np.append(self.byte_pairs[data[:-1], data[1:]], -1)
        now = first.tolist()  # the rank of the pair that starts here
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0) :]
        ranks, at = np.unique(first[order], return_index=True)
        places, at = order.tolist(), [*at.tolist(), len(order)]
        buckets = {rank: places[a:b] for rank, a, b in zip(ranks.tolist(), at, at[1:])}
        used = buckets.get
        words: dict[int, int] = {}
        top = 0
        for rank in buckets:
            words[rank >> 8] = words.get(rank >> 8, 0) | 1 << (rank & 255)
            top |= 1 << (rank >> 8)
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        while top:
            word = (top & -top).bit_length() - 1
            bits = words[word]
            rank = word << 8 | (bits & -bits).bit_length() - 1
            words[word] = bits = bits & bits - 1
            if not bits:
                top &= top - 1
            bucket = buckets.pop(rank)
            if len(bucket) > 1:
                bucket.sort()
            lowest = rank
            for at, i in enumerate(bucket, 1):
                if now[i] != rank:
                    continue
                j, h = after[i], before[i]
                k = after[j]
                ids[i] = rank
                ids[j] = now[j] = -2
                after[i] = k
                before[k] = i
                now[i] = fresh = pairs(rank * stride + ids[k], -1)
                if fresh >= 0:
                    others = used(fresh)
                    if others is not None:
                        others.append(i)
                    else:
                        buckets[fresh] = [i]
                        word = fresh >> 8
                        words[word] = words.get(word, 0) | 1 << (fresh & 255)
                        top |= 1 << word
                        if fresh < lowest:
                            lowest = fresh
                now[h] = fresh = pairs(ids[h] * stride + rank, -1)
                if fresh >= 0:
                    others = used(fresh)
                    if others is not None:
                        others.append(h)
                    else:
                        buckets[fresh] = [h]
                        word = fresh >> 8
                        words[word] = words.get(word, 0) | 1 << (fresh & 255)
                        top |= 1 << word
                        if fresh < lowest:
                            lowest = fresh
                if lowest < rank and at < len(bucket):
                    buckets[rank] = bucket[at:]
                    word = rank >> 8
                    words[word] |= 1 << (rank & 255)
                    top |= 1 << word
                    break
        return [[x for x in ids[a + 1 : b] if x >= 0] for a, b in zip(ends.tolist(), ends[1:].tolist())]

    def encode_piece(self, piece: bytes) -> list[int]:
        return self.encode_pieces([piece])[0]

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.pattern.findall(text) for i in self.encode_piece(piece.encode())]

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """Ids as bytes, with a bounded memory of short pre-tokens met before."""
        out: list[bytes] = []
        for at in range(0, len(texts), _TEXTS):
            out += self._encode_packed(texts[at : at + _TEXTS])
        return out

    def _encode_packed(self, texts: list[str]) -> list[bytes]:
        seen = self.seen
        if len(seen) >= _PIECES:  # the half met first stays, among them most frequent ones
            seen = self.seen = dict(islice(seen.items(), _PIECES // 2))
        cut = list(map(self.pattern.findall, texts))
        fresh = list(set(chain.from_iterable(cut)).difference(seen))
        held, size = [], 0
        for n, piece in enumerate(fresh, 1):
            held.append(piece.encode())
            size += len(held[-1])
            if size >= _QUEUE or n == len(fresh):
                ids = self.encode_pieces(held)
                seen.update(zip(fresh[n - len(held) : n], map(_packed, ids)))
                held, size = [], 0
        of = seen.__getitem__
        out = [b"".join(map(of, pieces)) for pieces in cut]
        for piece in fresh:
            if len(piece) > _SHORT:
                del seen[piece]
        return out

    def forget(self) -> None:
        """Drop the memory of pre-tokens, in a worker that goes on to decode beside one that encodes."""
        self.seen = {}

    def decode(self, ids) -> bytes:
        ids = np.asarray(ids, np.int64)
        sizes = self.sizes[ids]
        if len(ids) and (ids.min() < 0 or sizes.min() < 0):
            raise KeyError("an id that no token has")
        before = np.cumsum(sizes) - sizes
        return self.joined[np.repeat(self.starts[ids] - before, sizes) + np.arange(sizes.sum())].tobytes()

    def decode_many(self, packed: list[bytes]) -> pa.Array:
        """Bytes of each row of ids, by slices of all rows."""
        ids = np.frombuffer(b"".join(packed), "<u4")
        out = b"".join(self.decode(ids[at : at + _IDS]) for at in range(0, len(ids), _IDS))
        ends = np.concatenate(([0], np.cumsum(self.sizes[ids])))[np.cumsum([0, *(len(x) // 4 for x in packed)])]
        return pa.Array.from_buffers(pa.large_binary(), len(packed), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out)])


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> tuple[BytePairs, ChunkEncoder]:
    """Once per Python worker: the table at ``path`` (base64 token and rank per line)."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    model = BytePairs(ranks, pattern)
    return model, ChunkEncoder(model.encode_packed, 0)  # the model remembers pre-tokens


def encode(df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (binary, little-endian unsigned 32 bit).

    ``path`` names a rank file that every executor has. Special tokens are ordinary text.
    Null text is empty and gives no ids. Repeated rows stay repeated; other columns are left out.
    """
    arrow_batches(df.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = load(path, pattern)
        for batch in batches:
            ids = encoder.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "n_tokens", "ids"],
            )

    rows = df.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(trimmed(work), f"doc_id {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds ``decoded`` (binary) to the result of :func:`encode`."""
    arrow_batches(encoded.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = load(path, pattern)
        model.forget()
        for batch in batches:
            texts = model.decode_many(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, texts.cast(pa.binary())], names=["doc_id", "n_tokens", "ids", "decoded"]
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.mapInArrow(trimmed(work), f"doc_id {kind}, n_tokens long, ids binary, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of a decoded table."""
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


__all__ = ["BytePairs", "decode", "digests", "encode"]
