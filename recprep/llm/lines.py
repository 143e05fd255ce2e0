"""Line deduplication by an exact set-similarity join over the words of lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recprep.llm.common import arrow_batches, release, text_of, trimmed
from recprep.session import discard, materialize

_SKETCH = 1 << 24  # counters for the frequency of words: 16 MB as logarithms, whatever the vocabulary
_SLICE = 1 << 16  # counters that are summed together
_PART = 1_000_000  # postings that meet in one group of a task, about
_ROW = 20_000  # postings in a row of the shuffle, at most
_BEST, _KEPT = 8, 1024  # candidates of a line in one part that are verified first, and that are stored
_HOT = 4096  # lines of a word; beyond, they first meet the first of them alone
_AT_ONCE = 1 << 21  # pairs in memory
_DOC_BITS = 1 << 25  # bits of a filter over documents: 4 MB
_WIDEST = 16  # 64-bit numbers of parities of a line


@dataclass(frozen=True)
class Lines:
    """Lines of some texts as sets of words. Words of line i: words[start[i]:start[i + 1]], in the order asked for."""

    doc: np.ndarray  # place of the text
    number: np.ndarray  # line number in the text, from 0
    start: np.ndarray
    words: np.ndarray  # 64-bit hashes


def parse(
    texts: pa.Array, least: int, weights: np.ndarray | None = None, only: list | None = None, drop: list | None = None
) -> Lines:
    """All lines with at least ``least`` distinct words; words are compared with A-Z in lower case.

    Words of a line are in order of hash, or with ``weights`` (see :func:`word_sketch`) rare ones first.
    ``only`` and ``drop`` list line numbers of each text that alone count, or that do not (None: no limit).
    """
    split = pc.split_pattern(pc.ascii_lower(texts), "\n")
    doc, rows = pc.list_parent_indices(split).to_numpy().astype(np.int64), split.flatten()
    first = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(texts)))))
    number = np.arange(len(doc)) - first[doc]
    if only is not None or drop is not None:
        good = np.full(len(doc), only is None)
        for d, listed in enumerate(only if only is not None else drop):
            if listed is not None:
                good[first[d] + np.array(listed, np.int64)] = only is not None
        doc, number, rows = doc[good], number[good], rows.filter(pa.array(good))
    words = pc.ascii_split_whitespace(rows)
    line = pc.list_parent_indices(words).to_numpy().astype(np.int64)
    coded = words.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    known = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
    empty = np.flatnonzero(pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) == 0)
    if len(empty):  # what the split finds before the first and after the last word
        real = code != empty[0]
        code, line = code[real], line[real]
    order = np.argsort(hashes) if weights is None else np.lexsort((hashes, weights[_counter(hashes)]))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    # Line and rank in one number: a plain sort puts words in order and repeats side by side.
    both = line * max(1, len(order)) + rank[code]
    both.sort()
    fresh = np.ones(len(both), bool)
    fresh[1:] = both[1:] != both[:-1]
    line, place = np.divmod(both[fresh], max(1, len(order)))
    counted = np.bincount(line, minlength=len(doc))
    kept = counted >= max(1, least)
    found = hashes[order][place][kept[line]]
    start = np.concatenate(([0], np.cumsum(counted[kept])))
    return Lines(doc[kept], number[kept], start, found)


def _counter(words: np.ndarray) -> np.ndarray:
    return (words & np.uint64(_SKETCH - 1)).astype(np.int64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A second hash of 64-bit hashes (the finaliser of a common 64-bit generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, start[:-1]) if len(start) > 1 else np.zeros(0, values.dtype)


def set_keys(lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that depend on the set of words alone."""
    one = _sums(_mix(lines.words), lines.start)
    two = _sums(_mix(lines.words + np.uint64(0x9E3779B97F4A7C15)), lines.start)
    return one.view(np.int64), two.view(np.int64)


def _wide(n: np.ndarray) -> np.ndarray:
    """64-bit numbers that hold the parities of a line: a power of 2, with at least as many bits as words up to 1,024."""
    return 1 << np.ceil(np.log2(np.clip(n / 64, 1, _WIDEST))).astype(np.int64)


def parity(lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Flat parities and where a line's begin. Bit b: parity of the number of words with that hash pattern. Two sets
    whose parities differ in k bits differ in at least k words. Folded by half, they are those of half the bits."""
    n = np.diff(lines.start)
    wide = _wide(n)
    at = np.concatenate(([0], np.cumsum(wide)))
    line = np.repeat(np.arange(len(n)), n)
    hashed = _mix(lines.words)
    place = at[line] + ((hashed >> np.uint64(32)).astype(np.int64) & (wide[line] - 1))
    out = np.zeros(at[-1], np.uint64)
    np.bitwise_xor.at(out, place, np.uint64(1) << (hashed >> np.uint64(58)))
    return out, at


def _docs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, h, text. Documents are told apart by id, and where ids repeat or lack by a hash of the text too."""
    ids = df.groupBy(F.col(f"`{id_col}`").alias("i")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR i IS NULL")
    text = text_of(text_col)
    h = F.lit(0).cast("long") if ids.isEmpty() else F.xxhash64(text)
    return df.select(F.col(f"`{id_col}`").alias("doc"), h.alias("h"), text.alias("text"))


_AT = ("doc", "h", "line")


def _order(*columns: str) -> Column:
    """Position of a line in the corpus: by document id (null last), then line."""
    doc, h, line = (F.col(c) for c in columns)
    return F.struct(doc.isNull().alias("no_id"), doc.alias("doc"), h.alias("h"), line.alias("line"))


def scan(docs: DataFrame, least: int) -> DataFrame:
    """One pass over all lines: rows with their keys (slice null), and the number of lines per counter of words
    as a row a slice of counters: places (16 bits each), then numbers (32 bits each)."""
    kind = docs.schema["doc"].dataType.simpleString()
    names = [*_AT, "key1", "key2", "words", "slice", "counts"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, types = np.zeros(_SKETCH, np.uint32), None
        for batch in batches:
            lines = parse(batch.column(2), least)
            at, many = np.unique(_counter(lines.words), return_counts=True)
            seen[at] += many.astype(np.uint32)
            one, two = set_keys(lines)
            at, n = pa.array(lines.doc), len(lines.doc)
            types = batch.column(0).type
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at), batch.column(1).take(at), pa.array(lines.number), pa.array(one), pa.array(two),
                    pa.array(np.diff(lines.start).astype(np.int32)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                ],
                names=names,
            )
        for k in range(_SKETCH // _SLICE) if types is not None else ():
            part = seen[k * _SLICE : (k + 1) * _SLICE]
            used = np.flatnonzero(part)
            if len(used):
                none = pa.nulls(1, pa.int64())
                held = used.astype("<u2").tobytes() + part[used].astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, types), none, none, none, none, pa.nulls(1, pa.int32()), pa.array([k], pa.int32()), pa.array([held])],
                    names=names,
                )

    return docs.mapInArrow(
        trimmed(work), f"doc {kind}, h long, line long, key1 long, key2 long, words int, slice int, counts binary"
    )


def word_sketch(scanned: DataFrame) -> np.ndarray:
    """Eight times the logarithm of the number of lines per counter of words, over all lines: what rarity is
    judged by; 0 for counters of one line at most.

    A fixed number of counters. Words that share one look more frequent than they are, which
    costs time, not results: any one order of words gives the same pairs.
    """

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(_SLICE, np.int64)
        for held in table.column("counts").to_pylist():
            n = len(held) // 6
            total[np.frombuffer(held, "<u2", n)] += np.frombuffer(held, "<u4", n, 2 * n)
        log = np.minimum(255, np.ceil(8 * np.log2(np.maximum(total, 1)))).astype(np.uint8)
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "log": pa.array([log.tobytes()])})

    slices = scanned.filter("slice IS NOT NULL").select("slice", "counts")
    out = np.zeros(_SKETCH, np.uint8)
    for k, log in slices.groupBy("slice").applyInArrow(add, "slice int, log binary").collect():
        out[k * _SLICE : (k + 1) * _SLICE] = np.frombuffer(log, np.uint8)
    return out


def _bucket() -> Column:
    return F.pmod(F.xxhash64("doc", "h"), F.lit(_DOC_BITS)).cast("int")


def _doc_filter(keys: DataFrame) -> np.ndarray:
    """A fixed-size filter (packed bits) that holds the given documents (doc, h), and perhaps others."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        held = np.zeros(_SLICE, bool)
        held[table.column("place").to_numpy()] = True
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(held).tobytes()])})

    place = keys.select(F.floor(_bucket() / _SLICE).cast("int").alias("slice"), (_bucket() % _SLICE).alias("place")).distinct()
    out = np.zeros(_DOC_BITS // 8, np.uint8)
    for k, bits in place.groupBy("slice").applyInArrow(pack, "slice int, bits binary").collect():
        out[k * _SLICE // 8 : (k + 1) * _SLICE // 8] = np.frombuffer(bits, np.uint8)
    return out


def _inside(bits: np.ndarray, bucket: pa.Array) -> np.ndarray:
    at = bucket.to_numpy()
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def _pass(docs: DataFrame, bits) -> DataFrame:
    """Documents in the filter, decided before any shuffle."""
    schema = docs.schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_inside(bits.value, batch.column(batch.num_columns - 1)))).select(schema.names)

    return docs.select(*schema.names, _bucket().alias("bucket")).mapInArrow(trimmed(work), schema)


def _with_lines(docs: DataFrame, at: DataFrame, bits, lists: dict[str, Column], how: str) -> DataFrame:
    """Texts of the documents of ``at`` (doc, h, line; with ``how`` left also others in the filter) with lists of its lines.

    Lists and texts go through one shuffle by document and meet in one group, which also leaves each document once.
    """
    wanted = at.groupBy("doc", "h").agg(*[F.collect_set(c).alias(name) for name, c in lists.items()])
    both = _pass(docs, bits).unionByName(wanted, allowMissingColumns=True).repartition("doc", "h")
    met = both.groupBy("doc", "h").agg(F.max("text").alias("text"), *[F.first(x, ignorenulls=True).alias(x) for x in lists])
    kept = met.filter("text IS NOT NULL")
    return kept.dropna(subset=[*lists]) if how == "inner" else kept


def _only(lines: Lines, only: list[list[int] | None]) -> np.ndarray:
    """Which lines are among the listed ones of their document."""
    sets = [set(x or ()) for x in only]
    return np.array([n in sets[d] for d, n in zip(lines.doc.tolist(), lines.number.tolist())], bool)


_LISTS = ["word", *_AT, "n", "place", "asked", "bits"]


def postings(docs: DataFrame, threshold: float, least: int, sketch, parts: int, outside=None) -> DataFrame:
    """Prefixes of all lines, as rows of many postings each: word, place (from 0, rare words first), n, parities
    (``bits``), and where the line is. ``part`` deals words to groups.

    A prefix has n - ceil(threshold * n) + 1 words: two lines that reach the threshold have a
    word of both prefixes in common. Words that only one line has find nothing and are left out
    (their places still count). A word's 32 bits beside its part may meet another's: every pair is verified.
    docs may have ``drop``, lines that do not count, and ``ask``, lines that are ``asked`` for; with
    ``outside`` only documents outside that filter are read.
    """
    kind = docs.schema["doc"].dataType.simpleString()
    listed = "drop" in docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sketch.value
        for batch in batches:
            if outside is not None:
                batch = batch.filter(pa.array(~_inside(outside.value, batch.column(3))))
            lines = parse(batch.column(2), least, weights, drop=batch.column(3).to_pylist() if listed else None)
            n = np.diff(lines.start)
            line = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(line)) - np.repeat(lines.start[:-1], n)
            prefix = n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1
            # A word whose counter stands at 1 is in no other line of the whole corpus.
            taken = np.flatnonzero((place < prefix[line]) & (weights[_counter(lines.words)] > 0))
            word = _mix(lines.words[taken])
            part = ((word >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            part, word, taken = part[order], word[order], taken[order]
            own = line[taken]
            asked = _only(lines, batch.column(4).to_pylist()) if listed else np.zeros(len(n), bool)
            bits, at = parity(lines)
            wide = at[own + 1] - at[own]
            ends = np.concatenate(([0], np.cumsum(wide)))
            flat = np.repeat(at[own] - ends[:-1], wide) + np.arange(ends[-1])
            cuts = np.unique(np.concatenate((
                np.flatnonzero(np.diff(part)) + 1, np.arange(0, len(part), _ROW), [len(part)]
            ))).astype(np.int32) if len(part) else np.zeros(1, np.int32)
            where = pa.array(lines.doc[own])
            columns = {
                "word": pa.array((word & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)),
                "doc": batch.column(0).take(where), "h": batch.column(1).take(where), "line": pa.array(lines.number[own]),
                "n": pa.array(n[own].astype(np.int32)), "place": pa.array(place[taken].astype(np.int32)), "asked": pa.array(asked[own]),
            }
            rows = [pa.ListArray.from_arrays(pa.array(cuts), c) for c in columns.values()]
            rows.append(pa.ListArray.from_arrays(pa.array(ends[cuts].astype(np.int32)), pa.array(bits[flat].view(np.int64))))
            yield pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]]), *rows], names=["part", *_LISTS])

    rows = docs.select("doc", "h", "text", *(["drop", "ask"] if listed else [] if outside is None else [_bucket().alias("bucket")]))
    schema = (
        f"part int, word array<int>, doc array<{kind}>, h array<long>, line array<long>, n array<int>, place array<int>, "
        "asked array<boolean>, bits array<long>"
    )
    return rows.mapInArrow(trimmed(work), schema)


def _ranks(doc: pa.Array, h: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Numbers in the order of :func:`_order`; equal for the same place."""
    coded = doc.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order) + 1, np.int64)
    rank[order] = np.arange(len(order))
    rank[-1] = len(order)  # no id: last
    rows = rank[pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)]
    if len(h) and (h != h[0]).any():
        place = np.lexsort((h, rows))
        new = np.concatenate(([0], np.cumsum((np.diff(rows[place]) != 0) | (np.diff(h[place]) != 0))))
        rows[place] = new
    return rows * (int(line.max(initial=0)) + 1) + line


def _near(
    i: np.ndarray, j: np.ndarray, n: np.ndarray, place: np.ndarray, folded: np.ndarray, bits: np.ndarray, at: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that pass the parity, length and positional filters, and the number of words they differ in at least."""
    share = threshold / (1 + threshold)
    total = n[i] + n[j]
    apart = np.bitwise_count(folded[i] ^ folded[j])
    good = np.flatnonzero(apart <= total * (1 - 2 * share) + 1e-6)
    i, j, total, apart = i[good], j[good], total[good], apart[good].astype(np.int64)
    need = np.ceil(share * total - 1e-9).astype(np.int64)
    most = np.minimum(n[i] - place[i], n[j] - place[j]) + np.minimum(place[i], place[j])
    good = (apart <= total - 2 * need) & (most >= need) & (np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]) - 1e-9)
    i, j, apart, allowed = i[good], j[good], apart[good], (total - 2 * need)[good]
    wide = np.minimum(at[i + 1] - at[i], at[j + 1] - at[j])
    for w in np.unique(wide[wide > 1]).tolist():
        these = np.flatnonzero(wide == w)
        apart[these] = sum(
            np.bitwise_count(_fold(bits, at, i[these], w, b) ^ _fold(bits, at, j[these], w, b)).astype(np.int64) for b in range(w)
        )
    good = apart <= allowed
    return i[good], j[good], apart[good]


def _fold(bits: np.ndarray, at: np.ndarray, rows: np.ndarray, w: int, b: int) -> np.ndarray:
    """Number b of the parities of some lines, folded to w numbers."""
    out = bits[at[rows] + b]
    for k in range(b + w, int((at[rows + 1] - at[rows]).max(initial=0)), w):
        more = at[rows] + k < at[rows + 1]
        out = out ^ np.where(more, bits[np.minimum(at[rows] + k, len(bits) - 1)], np.uint64(0))
    return out


def candidates(rows: DataFrame, kind: str, threshold: float, asked: bool = False) -> DataFrame:
    """Pairs of a line and an earlier one that share a word of their prefixes and pass the filters.

    A part's lines are put in order of word and length in one sort; a line meets the lines of its word up to
    1 / threshold times its length. Only the best 1,024 pairs of a later line are given (``turn`` counts them), and of
    a word with very many lines only those with its first one; ``more`` tells that there may be others (then also
    without a pair). With ``asked`` all pairs of the lines asked for are given.
    """
    names = [*_AT, *[f"{c}2" for c in _AT], "turn", "more"]

    def work(table: pa.Table) -> pa.Table:
        flat = {c: pa.concat_arrays([x.flatten() for x in table.column(c).chunks]) for c in _LISTS}
        word, n = flat["word"].to_numpy().view(np.uint32).astype(np.int64), flat["n"].to_numpy().astype(np.int64)
        both = (word << 31) | n
        order = np.argsort(both)
        both, held = both[order], flat.pop("bits").to_numpy().view(np.uint64)
        wide = _wide(n)
        begin = (np.cumsum(wide) - wide)[order]
        n, wide = n[order], wide[order]
        at = np.concatenate(([0], np.cumsum(wide)))
        bits = held[np.repeat(begin - at[:-1], wide) + np.arange(at[-1])]
        folded = np.bitwise_xor.reduceat(bits, at[:-1])
        flat = {c: x.take(pa.array(order)) for c, x in flat.items() if c not in ("word", "n")}
        h, line, place, wanted = (flat[c].to_numpy(zero_copy_only=False) for c in ("h", "line", "place", "asked"))
        place, rank, own = place.astype(np.int64), _ranks(flat["doc"], h, line), both >> 31
        edge = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1], [True])))
        size = np.diff(edge)
        # Lines of the same word up to the longest that may match, from the next one or the shortest on.
        last = np.searchsorted(both, (own << 31) | np.floor(n / threshold + 1e-9).astype(np.int64), "right")
        hot = np.repeat(size > _HOT, size) & (not asked)
        if asked:
            start = np.searchsorted(both, (own << 31) | np.ceil(n * threshold - 1e-9).astype(np.int64))
            width = np.where(wanted, last - start, 0)
        else:
            start = np.arange(1, len(n) + 1)
            width = np.where(hot, 0, last - start)
        found = [(np.zeros(0, np.int64),) * 3]

        def meet(i: np.ndarray, j: np.ndarray) -> None:
            i, j, apart = _near(i, j, n, place, folded, bits, at, threshold)
            swap = (rank[i] < rank[j]) & (not asked)
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            some = rank[i] > rank[j]
            found.append((i[some], j[some], apart[some]))

        for g in np.flatnonzero(size > _HOT) if not asked else ():
            some = np.arange(edge[g], edge[g + 1])
            meet(some, np.full(len(some), some[np.argmin(rank[some])]))
        sums, lo = np.cumsum(width), 0
        while lo < len(width):
            hi = max(lo + 1, int(np.searchsorted(sums, (sums[lo - 1] if lo else 0) + _AT_ONCE, "right")))
            count = width[lo:hi]
            i = np.repeat(np.arange(lo, hi), count)
            meet(i, np.arange(len(i)) + np.repeat(start[lo:hi] - np.cumsum(count) + count, count))
            lo = hi
        i, j, apart = (np.concatenate(x) for x in zip(*found))
        # Each pair once, the closest of a line first.
        first = np.lexsort((rank[j], apart, rank[i]))
        i, j = i[first], j[first]
        once = np.ones(len(i), bool)
        once[1:] = (np.diff(rank[i]) != 0) | (np.diff(rank[j]) != 0)
        i, j = i[once], j[once]
        begin = np.flatnonzero(np.diff(rank[i], prepend=-1))
        turn = np.arange(len(i)) - np.repeat(begin, np.diff(np.append(begin, len(i))))
        more = np.isin(rank[i], rank[i][turn >= _KEPT]) & (not asked)
        kept = (turn < _KEPT) | asked
        i, j, turn, more = i[kept], j[kept], turn[kept], more[kept]
        # Lines of a hot word may have other partners, with a pair or without one.
        left = np.flatnonzero(hot)
        left = left[np.unique(rank[left], return_index=True)[1]]
        later, n_left = pa.array(np.concatenate((i, left))), len(left)
        earlier = pa.array(np.concatenate((j, left)), mask=np.arange(len(i) + n_left) >= len(i))
        sides = [*[flat[c].take(later) for c in _AT], *[flat[c].take(earlier) for c in _AT]]
        rest = [np.concatenate((turn, np.zeros(n_left, np.int64))), np.concatenate((more, np.ones(n_left, bool)))]
        return pa.table([*sides, *map(pa.array, rest)], names=names)

    at = f"doc {kind}, h long, line long, doc2 {kind}, h2 long, line2 long, turn long, more boolean"
    return rows.groupBy("part").applyInArrow(work, at)


def _semi(rows: DataFrame, at: DataFrame, how: str = "left_semi") -> DataFrame:
    same = F.col("r.doc").eqNullSafe(F.col("a.doc")) & (F.col("r.h") == F.col("a.h")) & (F.col("r.line") == F.col("a.line"))
    return rows.alias("r").join(at.alias("a"), same, how)


def verify(docs: DataFrame, pairs: DataFrame, threshold: float, least: int) -> DataFrame:
    """Lines of ``pairs`` whose Jaccard similarity with an earlier line reaches the threshold; stored."""
    kind = docs.schema["doc"].dataType.simpleString()
    ends = materialize(pairs.select(*_AT).unionByName(pairs.select(*[F.col(f"{c}2").alias(c) for c in _AT])).distinct())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = parse(batch.column(2), least, only=batch.column(3).to_pylist())
            at = pa.array(lines.doc)
            words = pa.ListArray.from_arrays(pa.array(lines.start.astype(np.int32)), pa.array(lines.words.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(lines.number), words], names=[*_AT, "words"],
            )

    bits = docs.sparkSession.sparkContext.broadcast(_doc_filter(ends))
    texts = _with_lines(docs, ends, bits, {"only": F.col("line")}, "inner")
    sets = materialize(texts.mapInArrow(trimmed(work), f"doc {kind}, h long, line long, words array<long>"))
    one = F.col("p.doc").eqNullSafe(F.col("s.doc")) & (F.col("p.h") == F.col("s.h")) & (F.col("p.line") == F.col("s.line"))
    two = F.col("q.doc2").eqNullSafe(F.col("t.doc")) & (F.col("q.h2") == F.col("t.h")) & (F.col("q.line2") == F.col("t.line"))
    left = pairs.alias("p").join(sets.alias("s"), one).select("p.*", F.col("s.words").alias("words"))
    both = left.alias("q").join(sets.alias("t"), two).select("q.*", F.col("t.words").alias("words2"))
    common = F.size(F.array_intersect("words", "words2"))
    like = common / (F.size("words") + F.size("words2") - common) >= threshold - 1e-9
    found = materialize(both.filter(like).select(*_AT).distinct())
    discard(sets, ends)
    return found


def removed_lines(docs: DataFrame, threshold: float = 0.8, least: int = 1) -> DataFrame:
    """doc, h, line of every line that is like an earlier one. docs: doc, h, text."""
    spark = docs.sparkSession
    arrow_batches(spark)
    kind = docs.schema["doc"].dataType.simpleString()
    scanned = materialize(scan(docs, least))
    keys = scanned.filter("slice IS NULL").select(*_AT, "key1", "key2")
    firsts = keys.groupBy("key1", "key2").agg(F.min(_order(*_AT)).alias("first"), F.count(F.lit(1)).alias("n"))
    shared = keys.join(firsts.filter("n > 1"), ["key1", "key2"])
    copies = materialize(shared.filter(_order(*_AT) != F.col("first")).select(*_AT).distinct())
    total = scanned.agg(F.sum(F.col("words") - F.ceil(threshold * F.col("words") - 1e-9) + 1)).first()[0]
    parts = 1 + int(total or 0) // _PART
    sketch = spark.sparkContext.broadcast(word_sketch(scanned))
    discard(scanned)
    # Sets of three words or fewer have no partner but their copies (for a threshold over 0.75).
    floor = max(least, 4) if threshold > 0.75 else least

    def met(marks: DataFrame, asked: bool) -> DataFrame:
        """Candidates; marks: copies, which are left out, and lines to ask for."""
        release(spark)
        bits = spark.sparkContext.broadcast(_doc_filter(marks))
        lists = {"drop": F.when(~F.col("ask"), F.col("line")), "ask": F.when(F.col("ask"), F.col("line"))}
        mixed = _with_lines(docs, marks, bits, lists, "left")
        rows = postings(mixed, threshold, floor, sketch, parts).unionByName(
            postings(docs, threshold, floor, sketch, parts, outside=bits)
        )
        pairs = materialize(candidates(rows, kind, threshold, asked))
        release(spark)
        return pairs

    def checked(pairs: DataFrame) -> DataFrame:
        both = pairs.filter("line2 IS NOT NULL").select(*_AT, *[f"{c}2" for c in _AT]).distinct()
        out = verify(docs, both, threshold, least)
        release(spark)
        return out

    marks = copies.withColumn("ask", F.lit(False))
    pairs = met(marks, False)
    found = [copies, checked(pairs.filter(F.col("turn") < _BEST))]
    later = pairs.filter(F.col("turn") >= _BEST)
    if not later.isEmpty():  # lines with many candidates, none of the closest like them
        found.append(checked(_semi(later, found[1], "left_anti")))
    left = pairs.filter("more").select(*_AT).distinct()
    for known in found[1:]:
        left = _semi(left, known, "left_anti")
    left = materialize(left)
    discard(pairs)
    if not left.isEmpty():
        more = met(marks.unionByName(left.withColumn("ask", F.lit(True))), True)
        found.append(checked(more))
        discard(more)
    removed = materialize(reduce(DataFrame.unionByName, found).distinct())
    discard(left, *found)
    release(spark)
    return removed


def line_dedup(
    df: DataFrame, *, threshold: float = 0.8, least_words: int = 1, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (line numbers from 0, ascending), one row per document.

    Lines are sets of words (A-Z in lower case). A line is removed if an earlier line, of the
    same document or of one with a smaller id, has a Jaccard similarity of ``threshold`` or
    more with it, whether that line is removed itself or not. Lines with fewer than
    ``least_words`` distinct words stay.

    Equal sets are found by key. Distinct sets go through the join: words ordered by rarity,
    prefix, length and positional filters, and the similarity of all candidates verified.
    Lines are first compared with the first line of each of their prefix words; that settles
    the members of a large group of similar lines with one pair each. Only lines without a
    match so far are compared with all others.

    Defined cases: null and empty texts have one line, which stays; null ids come last in the
    order; rows that repeat an id and its text are one document and get the same result; rows
    with the same id and another text are ordered by a hash of the text; an empty table gives
    an empty result; other columns are left out.
    """
    docs = _docs(df, id_col, text_col)
    removed = removed_lines(docs, threshold, least_words)
    per_doc = removed.groupBy("doc", "h").agg(F.array_sort(F.collect_list("line")).alias("removed")).alias("r")
    counted = docs.select("doc", "h", F.size(F.split("text", "\n")).cast("long").alias("n_lines")).alias("d")
    same = F.col("d.doc").eqNullSafe(F.col("r.doc")) & (F.col("d.h") == F.col("r.h"))
    lines = F.coalesce("removed", F.array().cast("array<bigint>"))
    return counted.join(per_doc, same, "left").select(
        F.col("d.doc").alias("doc_id"), "n_lines", F.size(lines).cast("long").alias("n_removed"), lines.alias("removed")
    )


def clean(
    df: DataFrame, *, threshold: float = 0.8, least_words: int = 1, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The table without the removed lines in its text; cases as in :func:`line_dedup`, null text stays null."""
    removed = removed_lines(_docs(df, id_col, text_col), threshold, least_words)
    per_doc = removed.groupBy("doc", "h").agg(F.collect_list("line").alias("removed")).alias("r")
    text = F.col(f"d.`{text_col}`")
    by_text = (F.col("r.h") == 0) | (F.xxhash64(text_of(f"d.`{text_col}`")) == F.col("r.h"))
    same = F.col(f"d.`{id_col}`").eqNullSafe(F.col("r.doc")) & by_text
    lines = F.split(text, "\n")
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("r.removed", i.cast("long"))), "\n")
    new = F.when(F.col("r.removed").isNull(), text).otherwise(left).alias(text_col)
    columns = [F.col(f"d.`{c}`") if c != text_col else new for c in df.columns]
    return df.alias("d").join(per_doc, same, "left").select(*columns)


__all__ = ["clean", "line_dedup", "parse", "removed_lines"]
