"""Near-duplicate documents by an exact set-similarity join over their shingles of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recprep.llm import simhash
from recprep.llm.common import arrow_batches, free_name, release, text_of, trimmed, words_of
from recprep.llm.components import connected_components
from recprep.session import materialize

_SKETCH = 1 << 20  # counters for the frequency of shingles: 4 MB, whatever the corpus
_PARTS = 16  # pieces in which the counters travel
_DOC_BITS = 1 << 22  # bits of a filter over documents


def _mix(x: np.ndarray) -> np.ndarray:
    """A second hash of 64-bit hashes (the finaliser of a common 64-bit generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(_SKETCH - 1)).astype(np.int64)


def shingle_sets(texts: list[str], words: int, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, start): the distinct shingles of text i are shingles[start[i]:start[i + 1]], as 64-bit hashes.

    A text with fewer words than a shingle is one shingle, one without a word has none. In order
    of hash, or with ``counts`` (see :func:`shingle_sketch`) rare ones first.
    """
    split = [words_of(t) for t in texts]
    lengths = np.array([len(w) for w in split], np.int64)
    coded = pa.array([w for ws in split for w in ws], pa.binary()).dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    flat = hashes[coded.indices.to_numpy(zero_copy_only=False)] if len(hashes) else np.zeros(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    found, owners = [], []
    for span in range(1, words + 1):
        mine = np.flatnonzero((lengths >= words) if span == words else (lengths == span))
        n = lengths[mine] - span + 1
        at = np.repeat(first[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        value = np.full(len(at), span, np.uint64)
        for k in range(span):
            value = _mix(value * np.uint64(0x9E3779B97F4A7C15) + flat[at + k])
        found.append(value)
        owners.append(np.repeat(mine, n))
    shingle, owner = np.concatenate(found), np.concatenate(owners)
    keys = (shingle, owner) if counts is None else (shingle, counts[_bucket(shingle)], owner)
    order = np.lexsort(keys)
    shingle, owner = shingle[order], owner[order]
    fresh = np.ones(len(shingle), bool)
    fresh[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
    start = np.concatenate(([0], np.cumsum(np.bincount(owner[fresh], minlength=len(texts)))))
    return shingle[fresh], start


def set_keys(shingles: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64 bits that depend on the set of shingles alone; 0 for a text without a word."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mix(shingles), dtype=np.uint64)))
    return (sums[start[1:]] - sums[start[:-1]]).view(np.int64)


def scan(docs: DataFrame, words: int) -> DataFrame:
    """One pass: doc, h, key, fp (SimHash) of every document (part null), and the counters of each task in parts."""
    kind = docs.schema["doc"].dataType.simpleString()
    names, size = ["doc", "h", "key", "fp", "part", "counts"], _SKETCH // _PARTS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, types = np.zeros(_SKETCH, np.int64), None
        for batch in batches:
            texts = batch.column(2).to_pylist()
            shingles, start = shingle_sets(texts, words)
            prints = np.array([simhash.fingerprint(t, words) for t in texts], np.uint64)
            seen += np.bincount(_bucket(shingles), minlength=_SKETCH)
            types, n = batch.column(0).type, batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(set_keys(shingles, start)), pa.array(prints.view(np.int64)),
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                ],
                names=names,
            )
        if types is not None:
            none = pa.nulls(_PARTS, pa.int64())
            held = [seen[i * size : (i + 1) * size].tobytes() for i in range(_PARTS)]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(_PARTS, types), none, none, none, pa.array(range(_PARTS), pa.int32()), pa.array(held, pa.binary())], names=names
            )

    return docs.mapInArrow(trimmed(work), f"doc {kind}, h long, key long, fp long, part int, counts binary")


def shingle_sketch(scanned: DataFrame) -> np.ndarray:
    """Number of documents per bucket of shingles: what rarity is judged by.

    A fixed number of counters. Shingles that share one look more frequent than they are, which
    costs time, not results: any one order of shingles gives the same pairs.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["part", "counts"]
        )

    rows = scanned.filter("part IS NOT NULL").select("part", "counts")
    # Each file is summed where it is read, then the sums of each part meet.
    summed = rows.mapInArrow(trimmed(add), rows.schema).repartition(_PARTS, "part").mapInArrow(trimmed(add), rows.schema)
    out = np.zeros((_PARTS, _SKETCH // _PARTS), np.int64)
    for row in summed.toLocalIterator():
        out[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return np.minimum(out.ravel(), np.iinfo(np.int32).max).astype(np.int32)


def postings(docs: DataFrame, words: int, threshold: float, sketch) -> DataFrame:
    """Prefix of every distinct set: shingle, key of the set, n, place (from 0, rare shingles first).

    A prefix has n - ceil(threshold * n) + 1 shingles: two sets that reach the threshold have a
    shingle of both prefixes in common. A task writes a set once, however many copies it meets.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            shingles, start = shingle_sets(batch.column(0).to_pylist(), words, sketch.value)
            keys, n = set_keys(shingles, start), np.diff(start)
            fresh = np.array([not (k in done or done.add(k)) for k in keys.tolist()], bool)
            prefix = np.where(fresh & (n > 0), n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1, 0)
            owner = np.repeat(np.arange(len(n)), prefix)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(prefix) - prefix, prefix)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shingles[start[owner] + place].view(np.int64)), pa.array(keys[owner]),
                    pa.array(n[owner].astype(np.int32)), pa.array(place.astype(np.int32)),
                ],
                names=["shingle", "key", "n", "place"],
            )

    return docs.select("text").mapInArrow(trimmed(work), "shingle long, key long, n int, place int")


def _may_match(threshold: float) -> Column:
    """Length and positional filters on columns n, place and n2, place2."""
    need = F.ceil(threshold / (1 + threshold) * (F.col("n") + F.col("n2")) - 1e-9)
    most = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2")) + F.least("place", "place2")
    lengths = F.least("n", "n2") >= threshold * F.greatest("n", "n2") - 1e-9
    return lengths & (most >= need)


def _pairs(joined: DataFrame, threshold: float) -> DataFrame:
    """Distinct candidate pairs, the smaller key first."""
    near = joined.filter((F.col("key") != F.col("key2")) & _may_match(threshold))
    return near.select(F.least("key", "key2").alias("a"), F.greatest("key", "key2").alias("b")).distinct()


_OTHER = {c: f"{c}2" for c in ("key", "n", "place")}


def _beside(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(*[c for c in rows.columns if c not in _OTHER.values()], *[F.col(f"{name}.{c}").alias(o) for c, o in _OTHER.items()])


def verify(docs: DataFrame, keyed: DataFrame, pairs: DataFrame, words: int, threshold: float) -> DataFrame:
    """The pairs whose Jaccard similarity reaches the threshold."""
    spark, schema = docs.sparkSession, docs.schema
    ends = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    # One document stands for its copies.
    at = materialize(keyed.join(ends, "key").groupBy("key").agg(F.min(F.struct("doc", "h")).alias("f")).select("key", "f.doc", "f.h"))
    bucket = F.pmod(F.xxhash64("doc", "h"), F.lit(_DOC_BITS)).cast("int").alias("bucket")
    used = at.select(bucket).distinct().toArrow().column("bucket").to_numpy()
    held = np.zeros(_DOC_BITS, bool)
    held[used] = True
    bits = spark.sparkContext.broadcast(np.packbits(held))

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.unpackbits(bits.value).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(mask[batch.column(batch.num_columns - 1).to_numpy()])).select(schema.names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles, start = shingle_sets(batch.column(1).to_pylist(), words)
            lists = pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), pa.array(shingles.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["key", "shingles"])

    some = docs.select(*schema.names, bucket).mapInArrow(trimmed(inside), schema).alias("d")
    same = F.col("d.doc").eqNullSafe(F.col("w.doc")) & (F.col("d.h") == F.col("w.h"))
    texts = some.join(at.alias("w"), same).select("key", "text").dropDuplicates(["key"])
    sets = materialize(texts.mapInArrow(trimmed(cut), "key long, shingles array<long>"))
    left = pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("one")), "a")
    both = left.join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("two")), "b")
    common = F.size(F.array_intersect("one", "two"))
    return both.filter(common / (F.size("one") + F.size("two") - common) >= threshold - 1e-9).select("a", "b")


def fingerprint_pairs(keyed: DataFrame, radius: int) -> DataFrame:
    """Candidate pairs of sets by SimHash: fingerprints that differ in at most ``radius`` bits.

    keyed: key, fp. All sets of a fingerprint meet the smallest key of it, and the smallest keys of two linked
    fingerprints meet (see :func:`recprep.llm.simhash.links`).
    """
    sets = materialize(keyed.filter("key <> 0").select("key", "fp").distinct())
    heads = materialize(sets.groupBy("fp").agg(F.min("key").alias("head")))
    near = simhash.links(heads.select("fp"), radius)
    one = heads.select(F.col("fp").alias("a"), F.col("head").alias("key"))
    two = heads.select(F.col("fp").alias("b"), F.col("head").alias("key2"))
    met = near.join(one, "a").join(two, "b").select("key", "key2")
    same = sets.join(heads, "fp").select("key", F.col("head").alias("key2"))
    both = met.unionByName(same).filter("key <> key2")
    return both.select(F.least("key", "key2").alias("a"), F.greatest("key", "key2").alias("b")).distinct()


def links(docs: DataFrame, keyed: DataFrame, sketch: np.ndarray, words: int, threshold: float, radius: int = 4) -> DataFrame:
    """``a, b`` (keys of sets): edges that connect exactly what a similarity >= threshold connects.

    Sets first meet those of near fingerprints, and the smallest and the largest key of each of their
    prefix shingles; that joins the members of a large group with two pairs each. Then sets meet all others of their
    prefix shingles that are still in another component.
    """
    spark = docs.sparkSession
    alike = materialize(fingerprint_pairs(keyed, radius))
    arrow_batches(spark, 500)  # the fingerprints' links take larger ones
    release(spark)
    rows = materialize(postings(docs, words, threshold, spark.sparkContext.broadcast(sketch)))
    whole = F.struct("key", "n", "place")
    ends = rows.groupBy("shingle").agg(F.min(whole).alias("low"), F.max(whole).alias("high")).filter("low.key <> high.key")
    met = materialize(rows.join(ends, "shingle").distinct())
    release(spark)
    first = _beside(met, "low").unionByName(_beside(met, "high"))
    candidates = _pairs(first, threshold).unionByName(alike).distinct()
    near = materialize(verify(docs, keyed, materialize(candidates), words, threshold))
    release(spark)

    roots = connected_components(near)
    rooted = met.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    rooted = materialize(rooted.filter("key <> low.key AND key <> high.key").select("shingle", "key", "n", "place", "root"))
    mixed = rooted.groupBy("shingle").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 <> r2").select("shingle")
    open_ = materialize(rooted.join(mixed, "shingle", "left_semi"))
    others = open_.select("shingle", F.col("root").alias("root2"), *[F.col(c).alias(o) for c, o in _OTHER.items()])
    apart = open_.join(others, "shingle").filter("key < key2 AND root <> root2")
    late = verify(docs, keyed, materialize(_pairs(apart, threshold)), words, threshold)
    return near.unionByName(materialize(late))


def keep_one(
    df: DataFrame, *, words: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The table with one row of each group of near duplicates: the one with the smallest id (null ids last).

    Documents are sets of shingles of ``words`` words (A-Z in lower case). Two are linked if
    their Jaccard similarity is ``threshold`` or more; groups are the components of these links.
    Candidates come from SimHash fingerprints within 4 bits of each other, and, since most pairs at such a
    similarity are further apart, from prefixes of rare shingles: no pair is missed, and each is verified
    (shingles are told apart by 64-bit hashes).

    Defined cases: a text with fewer words than a shingle is one shingle; null texts and texts
    without a word are alike; of rows that repeat id and text one is kept; an empty table gives
    an empty result. All columns stay as they are.
    """
    arrow_batches(df.sparkSession, 500)  # bounds the arrays of a worker
    text = text_of(f"`{text_col}`")
    docs = df.select(F.col(f"`{id_col}`").alias("doc"), F.xxhash64(text).alias("h"), text.alias("text"))
    scanned = materialize(scan(docs, words))
    keyed = scanned.filter("part IS NULL").select("doc", "h", "key", "fp")
    roots = connected_components(links(docs, keyed, shingle_sketch(scanned), words, threshold))
    found = keyed.join(roots, keyed.key == roots.node, "left").select("doc", "h", F.coalesce("root", "key").alias("root"))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc").isNull().alias("no_id"), "doc", "h")).alias("f"))
    chosen = first.select(F.col("f.doc").alias("chosen_id"), F.col("f.h").alias("chosen_h"))
    row_hash = free_name(df, "row_hash")
    hashed = df.withColumn(row_hash, F.xxhash64(text)).alias("d")
    same = F.col(f"d.`{id_col}`").eqNullSafe(chosen.chosen_id) & (F.col(f"d.`{row_hash}`") == chosen.chosen_h)
    kept = hashed.join(chosen, same, "left_semi").dropDuplicates([id_col, row_hash])
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])


__all__ = ["keep_one", "shingle_sets"]
