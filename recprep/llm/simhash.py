"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.llm.common import arrow_batches, text_of, words_of
from recprep.llm.components import connected_components
from recprep.session import materialize

_BITS = 64
_BLOCK = 1 << 15  # shingles whose bits are counted at a time


def fingerprint(text: str, words: int, seed: int = 42) -> int:
    """Bit i is 1 if it is set in over half of the shingles' XXH64; zero without a word.

    A text with fewer words than a shingle is one shingle.
    """
    parts = words_of(text)
    if not parts:
        return 0
    whole = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(_BITS, np.int64), len(parts) - span + 1
    for at in range(0, n, _BLOCK):
        stop = min(n, at + _BLOCK)
        cuts = zip(starts[at:stop].tolist(), ends[at + span - 1 : stop + span - 1].tolist())
        hashes = np.array([digest(whole[s:e], seed) for s, e in cuts], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, *, words: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, h (hash of the text) and ``fp`` (the 64 bits as a long) of every document; null text is empty."""
    arrow_batches(df.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=["doc_id", "h", "fp"]
            )

    text = text_of(text_col)
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, h long, fp long")


def ball(low: int, high: int, flips: int) -> np.ndarray:
    """Masks with at most ``flips`` bits set, all of them in positions low..high-1."""
    masks = [0]
    for k in range(1, flips + 1):
        masks += [sum(1 << b for b in c) for c in combinations(range(low, high), k)]
    return np.array(masks, np.uint64)


def ball_size(bits: int, flips: int) -> int:
    total, term = 1, 1
    for k in range(1, flips + 1):
        term = term * (bits - k + 1) // k
        total += term
    return total


def _bits_set(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values)


def deal(nodes: DataFrame, radius: int, low: int) -> DataFrame:
    """Send every fingerprint to each bucket that holds some of its variants.

    A variant is the fingerprint with at most radius/2 bits flipped; the bucket of a variant
    is its bits from ``low`` up. All variants of a fingerprint in a bucket differ from it by
    the same bits there, so one row (bucket, fp, flips left) stands for all of them; they are
    written out after the shuffle. nodes: fp; the result has bucket, fp, left.
    """
    masks = ball(low, _BITS, radius // 2)
    left = (radius // 2 - _bits_set(masks)).astype(np.int32)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), 1000):
                some = fps[at : at + 1000]
                buckets = (some[:, None] ^ masks[None, :]) >> np.uint64(low) if low < 64 else np.zeros((len(some), 1), np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(buckets.ravel().view(np.int64)),
                        pa.array(np.repeat(some, len(masks)).view(np.int64)),
                        pa.array(np.tile(left, len(some))),
                    ],
                    names=["bucket", "fp", "left"],
                )

    return nodes.mapInArrow(work, "bucket long, fp long, left int")


def meet(bucket: int, fps: np.ndarray, left: np.ndarray, low: int, radius: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of one bucket that have a variant in common: a spanning forest.

    Fingerprints that share a variant are within ``radius`` of each other; each colliding pair
    that is used is verified all the same. Variants are written out and sorted in slices of the
    bucket's space, so memory is bounded by ``most`` variants (or by one value of the top bits).
    """
    base = np.uint64(bucket) << np.uint64(low) if low < 64 else np.uint64(0)
    centres = base | (fps & np.uint64((1 << low) - 1))
    total = sum(ball_size(low, int(k)) * int((left == k).sum()) for k in np.unique(left))
    if total > most and low > 8:
        return _meet_slices(bucket, fps, left, low, radius, most)
    values, owners = [], []
    for k in np.unique(left):
        mine = np.flatnonzero(left == k)
        masks = ball(0, low, int(k))
        values.append((centres[mine][:, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(mine, len(masks)))
    value, owner = np.concatenate(values), np.concatenate(owners)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    same = np.flatnonzero(value[1:] == value[:-1])
    a, b = owner[same], owner[same + 1]
    near = _bits_set(fps[a] ^ fps[b]) <= radius
    return _forest(a[near], b[near], len(fps))


def _meet_slices(bucket, fps, left, low, radius, most):
    """The same, one value of the next bits after another."""
    step = 8 if low > 16 else low - 8
    lower = low - step
    masks = ball(0, step, radius // 2)
    cost = _bits_set(masks).astype(np.int64)
    mine = (fps >> np.uint64(lower)) & np.uint64((1 << step) - 1)
    a_all, b_all = [], []
    reach_mask = mine[:, None] ^ masks[None, :]
    rest = left[:, None].astype(np.int64) - cost[None, :]
    for part in range(1 << step):
        who, which = np.nonzero((reach_mask == np.uint64(part)) & (rest >= 0))
        if len(who) < 2:
            continue
        a, b = meet((int(bucket) << step) | part, fps[who], rest[who, which].astype(np.int32), lower, radius, most)
        a_all.append(who[a])
        b_all.append(who[b])
    if not a_all:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _forest(np.concatenate(a_all), np.concatenate(b_all), len(fps))


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (root, node) of the components of n nodes."""
    root = np.arange(n)
    if len(a):
        key = np.unique(a.astype(np.int64) * n + b)
        a, b = key // n, key % n
        while True:
            ra, rb = root[a], root[b]
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            if (high == low).all():
                break
            np.minimum.at(root, high, low)
            while (root[root] != root).any():
                root = root[root]
    nodes = np.flatnonzero(root != np.arange(n))
    return root[nodes], nodes


def links(nodes: DataFrame, radius: int = 4, *, bucket_variants: int = 1 << 21) -> DataFrame:
    """Edges ``a, b`` (fingerprints) that connect exactly what distance <= radius connects.

    nodes: distinct ``fp``. Two fingerprints within ``radius`` have a variant in common that is
    within radius/2 of both. The number of buckets follows from the number of fingerprints.
    Of each bucket only a spanning forest leaves its task, so a dense ball of fingerprints costs
    rows in proportion to its members, not to its pairs.
    """
    spark, half = nodes.sparkSession, radius // 2
    arrow_batches(spark)
    if radius % 2:
        raise ValueError("the radius must be even")
    variants = max(1, nodes.count()) * ball_size(_BITS, half)
    top = min(40, max(0, (variants // bucket_variants).bit_length()))
    low = _BITS - top
    dealt = deal(nodes.select("fp"), radius, low)

    def work(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        order = np.argsort(fps, kind="stable")  # results don't depend on the order of arrival
        fps, left = fps[order], table.column("left").to_numpy()[order]
        bucket = int(table.column("bucket")[0].as_py()) & ((1 << 64) - 1)
        a, b = meet(bucket, fps, left, low, radius, bucket_variants * 2)
        return pa.table({"a": pa.array(fps[a].view(np.int64)), "b": pa.array(fps[b].view(np.int64))})

    return dealt.groupBy("bucket").applyInArrow(work, "a long, b long").distinct()


def _grouped(df: DataFrame, words: int, radius: int, id_col: str, text_col: str, bucket_variants: int) -> DataFrame:
    """doc_id, h, fp, root (a fingerprint that names the component)."""
    docs = materialize(fingerprints(df, words=words, id_col=id_col, text_col=text_col))
    nodes = materialize(docs.select("fp").distinct())
    roots = connected_components(links(nodes, radius, bucket_variants=bucket_variants))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return docs.join(rooted, "fp")


def near_duplicates(
    df: DataFrame, *, words: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text",
    bucket_variants: int = 1 << 21,
) -> DataFrame:
    """doc_id, fp, component_id: the smallest id reachable over links of distance <= radius.

    Copies share a fingerprint and are one node. Defined cases: null and empty texts have
    fingerprint zero and are linked like any other; a null id is in its component but never
    its name unless all are null; repeated rows stay repeated; an empty table gives no rows;
    other columns are left out.
    """
    found = _grouped(df, words, radius, id_col, text_col, bucket_variants)
    names = found.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return found.join(names, "root").select("doc_id", "fp", "component_id")
