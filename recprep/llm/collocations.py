"""Collocations per language: phrases whose words come together far more often than apart.

Branch and bound over a tree of phrases. The score of a phrase is at most 1000 * n / f, f being
the count of its first word or of its last word: in the cut behind the first word the rest
occurs at least as often as the phrase, and likewise before the last. So phrases of rare words
have the highest bounds. Words wait in a frontier of classes of rising counts; the class with
the highest bound is expanded first, in waves of growing size: phrases that begin with its words
grow to the right, those that end with them to the left, word by word, while they are frequent.
The counts of all parts of a phrase with both ends expanded are then known (beginnings from the
right-growing tree, endings from the other), and so are its one-word extensions, which decide
whether a longer candidate takes its place. A language is settled when the last of its best
scores lies above the bound of everything still in the frontier; its other words are never expanded.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recprep.llm.common import arrow_batches, release, text_of, trim_memory, trimmed
from recprep.session import discard, materialize

# A-Z in lower case, a tab as a space, and every sign that ends a piece as a full stop.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes(46 if b in _ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BLOCK_BYTES, _SLICE_BYTES = 32 << 20, 2 << 20  # a block has fewer than 2^24 words, so _LOCAL bits number them
_LOCAL, _PART = 24, 16
_CLASSES = 4  # classes of counts per power of two


def tokens(text: str) -> list[bytes]:
    """Words in order, with b"." where a piece ends. No word holds a full stop, so none is mistaken for one."""
    return text.encode().translate(_TABLE).replace(b".", b" . ").split()


class _Words:
    """Texts of one language in a block: word numbers from 1, their counts, and the texts in these numbers (0: end of a piece)."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {b".": 0}
        self.codes: list[np.ndarray] = []

    def add(self, flat: list[bytes]) -> None:
        coded = pa.array(flat, pa.binary()).dictionary_encode()
        numbers = self.numbers
        told = [numbers.setdefault(w, len(numbers)) for w in coded.dictionary.to_pylist()]
        self.codes.append(np.array(told, np.int32)[coded.indices.to_numpy(zero_copy_only=False)])


def split(df: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """One pass over the texts, by blocks of about 32 MB: a row per (block, lang, word) with its number there
    (``local``), its place among all words and its count, and a row per (block, lang) with the texts in these numbers (``codes``,
    the lowest bytes of all numbers first: the higher ones are mostly zero and pack well)."""
    arrow_batches(df.sparkSession, 1000)
    fields = pa.schema([
        ("block", pa.int64()), ("lang", pa.string()), ("local", pa.int32()), ("place", pa.int64()),
        ("word", pa.string()), ("n", pa.int64()), ("codes", pa.binary()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId(), 0, {}, 0

        def rows(length: int, **columns: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(length, f.type)) for f in fields], schema=fields)

        def closed() -> Iterator[pa.RecordBatch]:
            block, place = part << _PART | number, (part << _PART | number) << _LOCAL
            for lang, words in held.items():
                codes = np.concatenate(words.codes)
                counts = np.bincount(codes, minlength=len(words.numbers))
                names = list(words.numbers)
                for at in range(1, len(names), 20_000):
                    some = names[at : at + 20_000]
                    yield rows(
                        len(some), block=pa.array(np.full(len(some), block)), lang=pa.array([lang] * len(some), pa.string()),
                        local=pa.array(np.arange(at, at + len(some), dtype=np.int32)),
                        place=pa.array(np.arange(place + at, place + at + len(some))),
                        word=pa.array(some, pa.binary()).cast(pa.string()), n=pa.array(counts[at : at + len(some)].astype(np.int64)),
                    )
                place += len(names)
                yield rows(
                    1, block=pa.array([block], pa.int64()), lang=pa.array([lang], pa.string()),
                    codes=pa.array([_planes(codes)], pa.binary()),
                )

        for batch in batches:
            flat: dict[str, list[bytes]] = {}
            pending = 0
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mine = flat.setdefault(lang, [])
                mine += tokens(text)
                mine.append(b".")
                pending += len(text)
                if pending >= _SLICE_BYTES:
                    for key, some in flat.items():
                        held.setdefault(key, _Words()).add(some)
                    size, flat, pending = size + pending, {}, 0
                    if size >= _BLOCK_BYTES:
                        yield from closed()
                        held, size, number = {}, 0, number + 1
            for key, some in flat.items():
                held.setdefault(key, _Words()).add(some)
            size += pending
        if held:
            yield from closed()

    rows = df.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), text_of(f"`{text_col}`").alias("text")
    )
    return rows.mapInArrow(trimmed(work), "block long, lang string, local int, place long, word string, n long, codes binary")


def _planes(codes: np.ndarray) -> bytes:
    """32-bit numbers byte plane by byte plane."""
    return np.ascontiguousarray(codes.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def told_words(stored: DataFrame, min_count: int) -> DataFrame:
    """block, lang, local, id, f, word of the words that occur often enough; no other word can be part of a candidate.

    A word's id is its place in the first block that has it. The rows of a word are at most one
    per block, so the window that adds up its counts and finds that place sees no occurrences.
    ``word`` is given once, in the row of that place.
    """
    same = Window.partitionBy("lang", "word")
    rows = stored.filter("word IS NOT NULL").select("block", "lang", "local", "place", "word", "n")
    known = rows.withColumns({"f": F.sum("n").over(same), "id": F.min("place").over(same)})
    often = known.filter(F.col("f") >= min_count)
    return often.select("block", "lang", "local", "id", "f", F.when(F.col("place") == F.col("id"), F.col("word")).alias("word"))


def runs(stored: DataFrame, told: DataFrame) -> DataFrame:
    """Texts as runs of frequent words, a row per (block, lang): ids and counts of its words, and the runs
    in places of these lists from 1 (0: end of a run). A block meets what it is told of its own words."""
    spark = stored.sparkSession
    told = told.select("block", "lang", "local", "id", "f")
    coded = stored.filter("codes IS NOT NULL").select(F.col("block").alias("in_block"), F.col("lang").alias("of"), "codes")
    arrow_batches(spark, 10_000)

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"block": pa.int64(), "lang": pa.string(), "ids": pa.binary(), "f": pa.binary(), "codes": pa.binary()}
        trim_memory()
        if not len(left) or not len(right):
            return pa.schema(list(out.items())).empty_table()
        codes = _from_planes(left.column("codes")[0].as_py())
        local = right.column("local").to_numpy()
        place = np.zeros(max(int(codes.max()), int(local.max())) + 1, np.int32)
        place[local] = np.arange(1, len(local) + 1)
        end = np.zeros(1, np.int32)
        codes = np.concatenate((end, place[codes], end))
        # A word between two ends is in no phrase; of ends in a row one is enough.
        alone = np.zeros(len(codes), bool)
        alone[1:-1] = (codes[:-2] == 0) & (codes[2:] == 0)
        codes[alone] = 0
        kept = np.ones(len(codes), bool)
        kept[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
        return pa.table({
            "block": left.column("in_block"), "lang": left.column("of"),
            "ids": pa.array([right.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()),
            "f": pa.array([right.column("f").to_numpy().astype("<i8").tobytes()], pa.binary()),
            "codes": pa.array([codes[kept].astype("<i4").tobytes()], pa.binary()),
        })

    return coded.groupBy("in_block", "of").cogroup(told.groupBy("block", "lang")).applyInArrow(
        work, "block long, lang string, ids binary, f binary, codes binary"
    )


def contexts(texts: DataFrame, ranges: DataFrame, reach: int) -> DataFrame:
    """Every occurrence of a word with lo <= f < hi (per lang): w, the ``reach`` words after it (r1, ...) and
    before it (l1, ...) in its run; 0 beyond the end of the run."""
    names = ["w", *(f"{side}{k}" for side in "rl" for k in range(1, reach + 1))]
    arrow_batches(texts.sparkSession, 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, f, codes, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("ids", "f", "codes", "lo", "hi"))):
                ids = np.concatenate(([0], np.frombuffer(ids, "<i8")))
                f = np.concatenate(([0], np.frombuffer(f, "<i8")))
                codes = np.frombuffer(codes, "<i4")
                codes = np.concatenate((np.zeros(reach, np.int32), codes, np.zeros(reach, np.int32)))
                wanted = (f >= lo) & (f < hi)
                wanted[0] = False
                for at in range(0, len(codes), 200_000):
                    here = at + np.nonzero(wanted[codes[at : at + 200_000]])[0]
                    here = here[(codes[here + 1] != 0) | (codes[here - 1] != 0)]
                    if not len(here):
                        continue
                    columns = [ids[codes[here]]]
                    for step in (1, -1):
                        open_run = np.ones(len(here), bool)
                        for k in range(1, reach + 1):
                            near = codes[here + step * k]
                            open_run &= near != 0
                            columns.append(ids[np.where(open_run, near, 0)])
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    joined = texts.join(ranges.select("lang", "lo", "hi"), "lang").select("ids", "f", "codes", "lo", "hi")
    return joined.mapInArrow(trimmed(work), ", ".join(f"{c} long" for c in names))


def grow(near: DataFrame, side: str, reach: int, min_count: int) -> DataFrame:
    """ids (in order of the text), f: frequent phrases from 2 words that begin (side r) or end (side l) with w.

    Grown word by word: only occurrences of a frequent phrase are counted with one word more.
    """
    near = near.select("w", *(f"{side}{k}" for k in range(1, reach + 1)))
    keys = ["w", f"{side}1"]
    first = materialize(_often(near.filter(F.col(keys[-1]) > 0), keys, min_count))
    levels = [(first, keys)]
    if reach > 1:
        # The first cut drops most occurrences: what is left is stored for the longer phrases.
        alive = materialize(near.filter(F.col(f"{side}2") > 0).join(first.select(*keys), keys, "left_semi"))
        rest = alive
        for k in range(2, reach + 1):
            keys = [*keys, f"{side}{k}"]
            level = _often(rest.filter(F.col(keys[-1]) > 0), keys, min_count)
            levels.append((level, keys))
            if k < reach:
                rest = rest.join(level.select(*keys), keys, "left_semi")
    nodes = [level.select(F.array(*(keys if side == "r" else keys[::-1])).alias("ids"), "f") for level, keys in levels]
    grown = materialize(reduce(DataFrame.unionByName, nodes))
    discard(first, *([alive] if reach > 1 else []))
    return grown


def _often(rows: DataFrame, keys: list[str], min_count: int) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("f")).filter(F.col("f") >= min_count)


def _exact_score(a: str, n: str, left: str, right: str, factor: int = 1000) -> Column:
    """floor(factor * a * n / (l * r)) in whole numbers of up to 38 digits."""
    return F.expr(
        f"(cast({factor} as decimal(4,0)) * cast({a} as decimal(17,0)) * cast({n} as decimal(17,0)))"
        f" div (cast({left} as decimal(18,0)) * cast({right} as decimal(18,0)))"
    )


def survivors(right: DataFrame, left: DataFrame, words: DataFrame, totals: DataFrame, percent: int) -> DataFrame:
    """lang, ids, a, l, r, n, score of candidates with both ends expanded that no longer candidate replaces."""
    single = words.select(F.array("id").alias("ids"), "f")
    begin, end = right.unionByName(single), left.unionByName(single)
    found = right.select("ids", F.col("f").alias("a")).join(left.select("ids"), "ids")
    cuts = found.select("ids", "a", F.explode(F.expr("sequence(1, size(ids) - 1)")).alias("k"))
    parts = cuts.withColumn("head", F.expr("slice(ids, 1, k)")).withColumn("tail", F.expr("slice(ids, k + 1, size(ids) - k)"))
    known = (
        parts.join(begin.select(F.col("ids").alias("head"), F.col("f").alias("l")), "head")
        .join(end.select(F.col("ids").alias("tail"), F.col("f").alias("r")), "tail")
        .withColumn("id", F.col("ids")[0])
        .join(words.select("id", "lang"), "id").join(totals, "lang")
    )
    lowest = known.groupBy("lang", "ids", "a", "n").agg(
        F.min(F.struct(_exact_score("a", "n", "l", "r").alias("score"), "k", "l", "r")).alias("cut")
    )
    longer = right.filter("size(ids) > 2").select(F.expr("slice(ids, 1, size(ids) - 1)").alias("ids"), F.col("f").alias("more"))
    longer = longer.unionByName(
        left.filter("size(ids) > 2").select(F.expr("slice(ids, 2, size(ids) - 1)").alias("ids"), F.col("f").alias("more"))
    )
    most = longer.groupBy("ids").agg(F.max("more").alias("more"))
    kept = lowest.join(most, "ids", "left").filter(F.coalesce(100 * F.col("more") < percent * F.col("a"), F.lit(True)))
    return kept.select("lang", "ids", "a", "cut.l", "cut.r", "n", "cut.score")


def frontier(words: DataFrame, totals: DataFrame, first_share: float, growth: int) -> DataFrame:
    """lang, n, wave, lo, hi: words of a language with lo <= f < hi are expanded in one wave.

    Classes of counts are taken in rising order, highest bound first. Wave 0 holds about ``first_share``
    of all occurrences, each later wave ``growth`` times as many as all before it.
    """
    held = words.withColumn("class", F.floor(F.log2("f") * _CLASSES).cast("long"))
    classes = held.groupBy("lang", "class").agg(F.min("f").alias("lo"), F.max("f").alias("hi"), F.sum("f").alias("occurrences"))
    line = Window.partitionBy("lang").orderBy("class").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("occurrences").over(line) - F.col("occurrences")
    share = before / F.col("n") / F.lit(first_share)
    wave = F.when(share < 1, 0).otherwise(F.floor(F.log(float(growth), share)) + 1).cast("int")
    placed = classes.join(totals, "lang").withColumn("wave", wave)
    return placed.groupBy("lang", "n", "wave").agg(F.min("lo").alias("lo"), (F.max("hi") + 1).alias("hi"))


def collocations(
    df: DataFrame, *, lang_col: str = "lang", text_col: str = "text", min_count: int = 100, max_words: int = 5,
    top: int = 2000, percent: int = 100, first_share: float = 1 / 16, growth: int = 4,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``top`` phrases of 2 to ``max_words`` words per language.

    a, l, r are the counts of the phrase and of the two parts of its lowest-scoring cut, n all words
    of the language. A phrase goes if a longer candidate holds it and has ``percent`` of its count.

    Defined cases: null and empty texts have no words; a null lang is ``und``; a language without
    a candidate has no rows; repeated rows count each time; ties go by a, then phrase; an
    empty table gives no rows; other columns are left out, whatever their names.
    """
    reach = max_words - 1
    stored = materialize(split(df, lang_col, text_col))
    told = materialize(told_words(stored, min_count))
    words = materialize(told.filter("word IS NOT NULL").select("id", "lang", "word", "f"))
    totals = materialize(stored.filter("word IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n")))
    texts = materialize(runs(stored, told))
    discard(stored, told)
    release(df.sparkSession)
    waves = materialize(frontier(words, totals, first_share, growth))
    last = waves.agg(F.max("wave")).first()[0]
    right, left, best, open_langs = [], [], None, waves.select("lang").distinct()
    for wave in range(0 if last is None else last + 1):
        ranges = materialize(waves.filter(F.col("wave") == wave).join(open_langs, "lang", "left_semi"))
        if not ranges.isEmpty():
            near = materialize(contexts(texts, ranges, reach))
            right.append(grow(near, "r", reach, min_count))
            left.append(grow(near, "l", reach, min_count))
            discard(near)
            found = survivors(reduce(DataFrame.unionByName, right), reduce(DataFrame.unionByName, left), words, totals, percent)
            newest = materialize(found)
            release(df.sparkSession)
            if best is not None:
                discard(best)
            best = newest
        waiting = waves.filter(F.col("wave") > wave).groupBy("lang", "n").agg(F.min("lo").alias("lo"))
        open_langs = materialize(_unsettled(waiting, best, top))
        if open_langs.isEmpty():
            break
    discard(texts)
    if best is None:
        ddl = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
        return df.sparkSession.createDataFrame([], ddl)
    return _ranked(best, words, top)


def _least_of_best(best: DataFrame, top: int) -> DataFrame:
    """lang, least: the score at rank ``top``; no row for languages with fewer survivors."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score")))
    return best.select("lang", "score", place.alias("place")).filter(F.col("place") <= top).filter(F.col("place") == top).select(
        "lang", F.col("score").alias("least")
    )


def _unsettled(waiting: DataFrame, best: DataFrame, top: int) -> DataFrame:
    """Languages whose unexpanded words may still give a score among the best, ties included."""
    joined = waiting.join(_least_of_best(best, top), "lang", "left")
    bound = F.expr("(cast(1000 as decimal(4,0)) * cast(n as decimal(17,0))) div cast(lo as decimal(18,0))")
    return joined.filter(F.col("least").isNull() | (bound >= F.col("least"))).select("lang")


def _ranked(best: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """Ranks and phrases; words are looked up only for phrases that can be among the best."""
    near = best.join(_least_of_best(best, top), "lang", "left").filter(F.col("least").isNull() | (F.col("score") >= F.col("least")))
    spelled = (
        near.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
        .groupBy("ids").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("told"))
        .select("ids", F.array_join(F.col("told.word"), " ").alias("phrase"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = near.join(spelled, "ids").withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
