"""Document quality by compression with dictionaries of good and of bad text."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.llm.common import arrow_batches, crc_rest, text_of, trimmed


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the weights of the calibration; a few hundred kilobytes at most."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]  # bias, slope; empty where there was too little to learn from
    share: float  # of good rows among all usable labels
    chunk: int
    level: int


_DOUBT = 50.0  # bytes at which a text's own evidence counts as much as the share of its class


def difference(sizes: tuple[int, int, int]) -> float:
    """The normalised difference of the sizes with the bad and with the good dictionary."""
    raw, good, bad = sizes
    return (bad - good) / max(bad, good) if raw else 0.0


class Sizes:
    """Compressed sizes of whole texts, cut into chunks of bounded size so that a dictionary
    counts throughout a long text and memory does not grow with it."""

    def __init__(self, model: QualityModel):
        self.chunk = model.chunk
        self.coders = [self._coder(d, model.level) for d in (model.good, model.bad)]

    @staticmethod
    def _coder(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
        if not dictionary:
            return zstandard.ZstdCompressor(level=level, write_content_size=False)
        data = zstandard.ZstdCompressionDict(dictionary)
        data.precompute_compress(level)
        params = zstandard.ZstdCompressionParameters.from_level(level, write_content_size=False, write_dict_id=False)
        return zstandard.ZstdCompressor(dict_data=data, compression_params=params)

    def of(self, text: str) -> tuple[int, int, int]:
        raw = text.encode()
        parts = [raw[i : i + self.chunk] for i in range(0, len(raw), self.chunk)]
        sums = [sum(len(coder.compress(p)) for p in parts) for coder in self.coders]
        return len(raw), *sums


def labelled(docs: DataFrame, labels: DataFrame, *, id_col: str) -> DataFrame:
    """id, label (0 or 1) of the labelled documents; several equal labels count once, unequal ones not."""
    clear = (
        labels.select(F.col(id_col).alias("id"), F.col("quality").cast("int").alias("label"))
        .filter("id IS NOT NULL AND label IN (0, 1)").groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other").drop("other")
    )
    return clear.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")


def fit(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 3000,
    dictionary_bytes: int = 112_640, chunk: int = 2048, level: int = 3, folds: int = 4,
) -> QualityModel:
    """Learn from at most ``sample_rows`` rows of each label.

    Where that bound leaves labels out, the bias is corrected by the share of each label among
    all usable rows, so the scores mean the same at every size of the table.

    Only labelled rows with crc32(id) mod 3 <> 1 are used; the choice among them is by hash.
    Chosen texts are used whole. The calibration sees each of them through dictionaries built
    without its fold, so it learns differences as unseen texts have them and no text is spent
    on one purpose only; the dictionaries of the model come from all.

    Defined cases: null text is empty, and empty texts are not learnt from; several equal labels of
    a document count once, contradicting ones not at all; of rows that repeat an id the smallest
    text is used; if a class has fewer than two rows, the model has no weights and each score is 0.5.
    """
    # Ids are chosen before any text moves; then only the chosen texts leave the scan.
    known = labelled(docs, labels.filter(crc_rest(id_col, 3) != 1), id_col=id_col)
    known = known.withColumn("turn", F.xxhash64(F.lit("sample"), "id"))
    chosen = [known.filter(F.col("label") == label).orderBy("turn", "id").limit(sample_rows) for label in (0, 1)]
    rows = [part.collect() for part in chosen]
    picked = docs.sparkSession.createDataFrame([tuple(r) for part in rows for r in part], known.schema)
    texts = (
        docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(F.broadcast(picked), "id")
        .groupBy("id", "label", "turn").agg(F.min("text").alias("text"))
    )
    found = sorted(texts.collect(), key=lambda r: (r["turn"], r["id"]))
    sample = {label: [r["text"] for r in found if r["label"] == label and r["text"].strip()] for label in (0, 1)}
    empty = QualityModel(b"", b"", (), 0.5, chunk, level)
    if min(map(len, sample.values())) < 2:
        return empty

    def dictionaries(left_out: int | None) -> list[bytes]:
        used = {k: [t for i, t in enumerate(texts) if i % folds != left_out] for k, texts in sample.items()}
        return [_dictionary(used[label], dictionary_bytes, chunk, level) for label in (1, 0)]

    x, y = [], []
    for fold in range(folds):
        sizes = Sizes(QualityModel(*dictionaries(fold), (), 0.5, chunk, level))
        for label in (1, 0):
            held = sample[label][fold::folds]
            x += [[difference(sizes.of(t))] for t in held]
            y += [float(label)] * len(held)
    bias, *slopes = _logistic(np.array(x), np.array(y))
    everyone = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    bias += math.log(everyone[1] / len(rows[1])) - math.log(everyone[0] / len(rows[0]))
    share = everyone[1] / (everyone[0] + everyone[1])
    return QualityModel(*dictionaries(None), (bias, *slopes), share, chunk, level)


def _dictionary(texts: list[str], size: int, chunk: int, level: int) -> bytes:
    """A trained dictionary; where there is too little text to train on, the text itself."""
    parts = [t.encode()[i : i + 2048] for t in texts for i in range(0, len(t.encode()), 2048)]
    try:
        return zstandard.train_dictionary(size, parts, level=level, threads=0).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[:size]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, steps: int = 50) -> tuple[float, ...]:
    """Weights by Newton steps, bias first; inputs are scaled inside and the scale is folded in."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    penalty = ridge * np.eye(z.shape[1])
    penalty[0, 0] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    slopes = w[1:] / scale
    return float(w[0] - slopes @ mean), *map(float, slopes)


def score_text(model: QualityModel, sizes: Sizes, text: str) -> float:
    """Probability that the text is good.

    The calibrated difference and the share of good texts, weighted by how much text there is: the
    difference of a few bytes says little, and an empty text has the share alone.
    """
    if not model.weights:
        return 0.5
    found = sizes.of(text)
    bias, slope = model.weights
    own = 1 / (1 + math.exp(-max(-30.0, min(30.0, bias + slope * difference(found)))))
    trust = found[0] / (found[0] + _DOUBT)
    return trust * own + (1 - trust) * model.share


def score(df: DataFrame, model: QualityModel, *, text_col: str = "text", name: str = "score") -> DataFrame:
    """The table with a score (double) of each whole text; null text is empty. Replaces a column of that name."""
    spark = df.sparkSession
    arrow_batches(spark, 500)
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c != name]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], text_of(text_col).alias(name))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(shared.value)
        for batch in batches:
            found = [score_text(shared.value, sizes, t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.float64())], names=batch.schema.names
            )

    schema = df.select(*[F.col(f"`{c}`") for c in kept]).schema.add(name, "double")
    return rows.mapInArrow(trimmed(work), schema)
