"""Prediction by partial matching over bytes, trained on the corpus, with a unigram base beside it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.llm.common import arrow_batches, release, text_of, trim_memory, trimmed, words_of
from recprep.session import discard, materialize

_END = 0xFF  # closes a text; no UTF-8 text holds this byte
_START = 0x0A  # stands before the first byte, as often as the order asks
_SLICE = 1 << 22  # bytes whose contexts are looked up at a time
_SCORED = 1 << 21  # the same for bytes that are scored, which takes a score of numbers for each
_WORD = -1  # the level of words among the levels of contexts


@dataclass(frozen=True)
class Level:
    """One order of the context trie, contexts and (context, symbol) pairs as sorted integers.

    n: count of a pair. total, kinds: sum and number of the symbols of a context. below_total,
    below_kinds: the same of the context that is one byte shorter, without the symbols seen
    here: what is left there after an escape from here (symbol exclusion).
    """

    pairs: np.ndarray
    n: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    kinds: np.ndarray
    below_total: np.ndarray
    below_kinds: np.ndarray


@dataclass(frozen=True)
class Trie:
    order: int
    levels: tuple[Level, ...]  # by length of context, 0 first


def _find(sorted_values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the wanted values, -1 where missing."""
    if not len(sorted_values):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return np.where(sorted_values[at] == wanted, at, -1)


def build(counts: list[tuple[np.ndarray, np.ndarray]]) -> Trie:
    """Trie from (pairs, counts) of each order, 0 first; pairs hold the context and the symbol."""
    levels: list[Level] = []
    for k, (pairs, n) in enumerate(counts):
        order = np.argsort(pairs)
        pairs, n = pairs[order].astype(np.int64), n[order].astype(np.int64)
        contexts, first = np.unique(pairs >> 8, return_index=True)
        ends = np.append(first[1:], len(pairs))
        total = np.add.reduceat(n, first) if len(pairs) else n
        kinds = ends - first if len(pairs) else n
        if k and len(pairs):
            lower = levels[k - 1]
            taken = np.add.reduceat(lower.n[_find(lower.pairs, pairs & ((1 << 8 * k) - 1))], first)
            parent = _find(lower.contexts, contexts & ((1 << 8 * (k - 1)) - 1))
            below_total, below_kinds = lower.total[parent] - taken, lower.kinds[parent] - kinds
        else:
            below_total = below_kinds = np.zeros(len(contexts), np.int64)
        levels.append(Level(pairs, n, contexts, total, kinds, below_total, below_kinds))
    return Trie(len(counts) - 1, tuple(levels))


def bits(trie: Trie, grams: np.ndarray) -> np.ndarray:
    """Code length of the last byte of each gram (order + 1 bytes as an integer) after the others.

    From the longest known context down: a symbol seen there costs its share of total + kinds,
    one not seen costs an escape (kinds out of total + kinds), and the symbols of the context
    are excluded below. Bytes never seen share what is left below order 0.
    """
    cost, done = np.zeros(len(grams)), np.zeros(len(grams), bool)
    child = np.full(len(grams), -1)
    for k in range(trie.order, -1, -1):
        level = trie.levels[k]
        tail = grams & ((1 << 8 * (k + 1)) - 1)
        context = _find(level.contexts, tail >> 8)
        pair = _find(level.pairs, tail)
        total, kinds = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
        known, inside = context >= 0, child >= 0
        total[known], kinds[known] = level.total[context[known]], level.kinds[context[known]]
        if k < trie.order:
            above = trie.levels[k + 1]
            total[inside], kinds[inside] = above.below_total[child[inside]], above.below_kinds[child[inside]]
        hit = ~done & (pair >= 0)
        cost[hit] += np.log2((total[hit] + kinds[hit]) / level.n[pair[hit]])
        escape = ~done & ~hit & known & (kinds > 0)
        cost[escape] += np.log2((total[escape] + kinds[escape]) / kinds[escape])
        done |= hit
        child = context
    left = 256 - len(trie.levels[0].pairs)
    cost[~done] += np.log2(max(left, 1))
    return cost


def grams_of(texts: list[bytes], order: int, most: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams, text number) of all bytes and ends of texts, in slices of ``most`` bytes (0: ``_SLICE``)."""
    held, size, most = [], 0, most or _SLICE
    for i, text in enumerate(texts):
        for at in range(0, len(text) + 1, most):
            # A long text goes on with the bytes before the cut as its context.
            before = text[at - order : at] if at else bytes([_START]) * order
            part = text[at : at + most] + (bytes([_END]) if at + most > len(text) else b"")
            held.append((i, before + part))
            size += len(part)
            if size >= most:
                yield _grams(held, order)
                held, size = [], 0
    if held:
        yield _grams(held, order)


def _grams(parts: list[tuple[int, bytes]], order: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(p for _, p in parts), np.uint8)
    lengths = np.array([len(p) for _, p in parts])
    packed = np.zeros(len(data) - order, np.int64)
    for k in range(order + 1):
        packed <<= 8
        packed |= data[k : len(data) - order + k]
    owner = np.repeat(np.array([i for i, _ in parts]), lengths - order)
    real = np.ones(len(data), bool)  # not the context before each part
    real[((np.cumsum(lengths) - lengths)[:, None] + np.arange(order)).ravel()] = False
    return packed[real[order:]], owner


def code_lengths(trie: Trie, texts: list[bytes]) -> np.ndarray:
    """Bits of each whole text, its end included."""
    out = np.zeros(len(texts))
    for grams, owner in grams_of(texts, trie.order, _SCORED):
        distinct, which = np.unique(grams, return_inverse=True)
        out += np.bincount(owner, bits(trie, distinct)[which], len(texts))
    return out


def adaptive_code_length(text: bytes, order: int = 4) -> float:
    """Bits of a text by a trie that starts empty and learns each byte after coding it.

    The same model, followed symbol by symbol; for single texts. The corpus uses a trained trie.
    """
    seen: dict[bytes, dict[int, int]] = {}
    past, cost = bytes([_START]) * order, 0.0
    for symbol in (*text, _END):
        excluded: set[int] = set()
        for k in range(order, -1, -1):
            counts = seen.get(past[len(past) - k :], {})
            left = {s: n for s, n in counts.items() if s not in excluded}
            whole = sum(left.values()) + len(left)
            if symbol in left:
                cost += np.log2(whole / left[symbol])
                break
            if left:
                cost += np.log2(whole / len(left))
                excluded |= left.keys()
        else:
            cost += np.log2(max(1, 256 - len(excluded)))
        for k in range(order + 1):
            table = seen.setdefault(past[len(past) - k :], {})
            table[symbol] = table.get(symbol, 0) + 1
        past = (past + bytes([symbol]))[1:] if order else b""
    return float(cost)


def train(
    docs: DataFrame, *, order: int = 4, text_col: str = "text",
) -> tuple[list[tuple[np.ndarray, np.ndarray]], DataFrame]:
    """Count all (context, symbol) pairs of all texts.

    Orders 0 and 1 come back as arrays (pairs, counts): at most 65,536 pairs. Longer contexts
    come back as a stored table (level, at, seen): one row per context ``at``, with all symbols
    seen after it and their counts. That table grows with the corpus and stays distributed.
    All counts are kept.
    """
    spark = docs.sparkSession
    arrow_batches(spark)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column(0).to_pylist()]
            for grams, _ in grams_of(texts, order):
                gram, n = np.unique(grams, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], names=["gram", "n"])

    found = docs.select(text_of(text_col).alias("text")).mapInArrow(trimmed(work), "gram long, n long")
    full = materialize(found.groupBy("gram").agg(F.sum("n").alias("n")))
    low, longer = [], None
    for k in range(order + 1):
        tail = F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("pair")
        pairs = full.groupBy(tail).agg(F.sum("n").alias("n"))
        if k < 2:
            kept = pairs.toArrow()
            low.append((kept.column("pair").to_numpy(), kept.column("n").to_numpy()))
            continue
        symbol = F.struct(F.col("pair").bitwiseAND(F.lit(255)).alias("symbol"), "n")
        level = pairs.groupBy(F.shiftright("pair", 8).alias("at")).agg(F.collect_list(symbol).alias("seen"))
        level = level.select(F.lit(k).alias("level"), "at", "seen")
        longer = level if longer is None else longer.unionByName(level)
    if longer is None:
        longer = spark.createDataFrame([], _CONTEXTS)
    stored = materialize(longer)
    discard(full)
    release(spark)
    return low, stored


_CONTEXTS = "level int, at long, seen array<struct<symbol: long, n: long>>"


def contexts_of(texts: list[bytes], order: int) -> list[np.ndarray]:
    """Distinct contexts of the texts, of each length from 2 to order."""
    distinct = np.zeros(0, np.int64)
    for grams, _ in grams_of(texts, order):
        distinct = np.union1d(distinct, grams >> 8)
    return [np.unique(distinct & ((1 << 8 * k) - 1)) for k in range(2, order + 1)]


def told_trie(low: list[tuple[np.ndarray, np.ndarray]], told: pa.Table, order: int) -> Trie:
    """Trie of the complete orders 0 and 1 and the told contexts (level, at, seen).

    Each context that a text asks for comes with those it ends with, so what the trie says of
    the text is what the trie of all contexts says.
    """
    counts, level = list(low), told.column("level").to_numpy()
    for k in range(2, order + 1):
        part = told.filter(pa.array(level == k)).combine_chunks()
        at = np.repeat(part.column("at").to_numpy(), pc.list_value_length(part.column("seen")).to_numpy())
        pairs = pc.list_flatten(part.column("seen")).combine_chunks()
        counts.append((at << 8 | pairs.field("symbol").to_numpy(), pairs.field("n").to_numpy()))
    return build(counts[: order + 1])


def _hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of distinct words, and for each word the place of its hash."""
    coded = words.dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(w) for w in coded.dictionary.to_pylist()], np.uint64).view(np.int64)
    return hashes, coded.indices.to_numpy(zero_copy_only=False)


def _flat(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Words of texts in one array, and the number of words of each."""
    split = [words_of(t) for t in texts]
    return pa.array([w for ws in split for w in ws], pa.binary()), np.array([len(ws) for ws in split], np.int64)


def word_counts(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """word (64-bit hash) and n over all texts."""
    arrow_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, which = _hashes(_flat(batch.column(0).to_pylist())[0])
            n = np.bincount(which, minlength=len(hashes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n)], names=["word", "n"])

    rows = docs.select(text_of(text_col).alias("text")).mapInArrow(trimmed(work), "word long, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def score(
    df: DataFrame, trained_on: DataFrame, *, order: int = 4, block_bytes: int = 8 << 20,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    ``score`` is the log10 probability of the text under the trie of ``trained_on``;
    ``base_score`` that of its words and one end under add-one unigram counts of the same texts
    (words are told apart by 64-bit hashes). Documents are dealt into blocks of about
    ``block_bytes``; a block asks once for the counts of its distinct words and of its distinct
    contexts, so frequent ones cost one row per block, not one per document. No count is
    dropped, however rare.

    Defined cases: null text is empty and has the end alone; without training texts every
    count is 0 and every byte costs 8 bits; repeated rows and null ids are scored one by one;
    an empty table gives an empty result; other columns are left out.
    """
    spark = df.sparkSession
    low, contexts = train(trained_on, order=order, text_col=text_col)
    model = spark.sparkContext.broadcast(low)
    counts = materialize(word_counts(trained_on, text_col=text_col))
    ends = trained_on.count()
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = tokens + ends, distinct + (ends > 0)

    rows = df.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    # The place of a row deals it out, so that repeated rows don't meet in one block.
    place = F.xxhash64(F.monotonically_increasing_id())
    dealt = rows.withColumn("block", F.pmod(place, F.lit(blocks)))

    def ask(table: pa.Table) -> pa.Table:
        texts = table.column("text").to_pylist()
        wanted = [_hashes(_flat(texts)[0])[0], *contexts_of([t.encode() for t in texts], order)]
        level = np.repeat(np.array([_WORD, *range(2, order + 1)], np.int32), [len(w) for w in wanted])
        block = pa.array([table.column("block")[0].as_py()] * len(level), pa.int64())
        trim_memory()
        return pa.table({"block": block, "level": level, "at": np.concatenate(wanted)})

    asked = dealt.groupBy("block").applyInArrow(ask, "block long, level int, at long")
    word = F.array(F.struct(F.lit(0).cast("long").alias("symbol"), "n")).alias("seen")
    known = counts.select(F.lit(_WORD).alias("level"), F.col("word").alias("at"), word).unionByName(contexts)
    told = asked.join(known, ["level", "at"]).select("block", "level", "at", "seen")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def answer(docs: pa.Table, known: pa.Table) -> pa.Table:
        trim_memory()
        texts = docs.column("text").to_pylist()
        flat, lengths = _flat(texts)
        hashes, which = _hashes(flat)
        own = known.filter(pa.array(known.column("level").to_numpy() == _WORD))
        order_ = np.argsort(own.column("at").to_numpy())
        words = own.column("at").to_numpy()[order_]
        n = pc.list_flatten(own.column("seen")).combine_chunks().field("n").to_numpy()[order_]
        at = _find(words, hashes)
        found = np.where(at >= 0, n[at] if len(n) else 0, 0)[which]
        owner = np.repeat(np.arange(len(texts)), lengths)
        logs = np.bincount(owner, np.log10(found + 1), len(texts))
        seen = np.bincount(owner, found > 0, len(texts)).astype(np.int64)
        n_tokens = lengths + 1
        base = logs + np.log10(ends + 1) - n_tokens * np.log10(tokens + distinct + 1)
        code = code_lengths(told_trie(model.value, known, order), [t.encode() for t in texts])
        return pa.table({
            "doc_id": docs.column("doc_id"), "n_tokens": n_tokens, "n_known": seen + (ends > 0),
            "train_tokens": np.full(len(texts), tokens), "base_score": base, "score": -code * np.log10(2.0),
        })

    return dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        answer,
        f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


__all__ = ["Trie", "adaptive_code_length", "bits", "build", "code_lengths", "score", "train", "word_counts"]
