"""The corpus pipeline: quality, repeated lines, near duplicates, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from recprep.llm import lines, packing, pii, quality, shingles
from recprep.llm.common import table
from recprep.session import materialize, tune


def _recounted(docs: DataFrame) -> DataFrame:
    """The number of characters follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.5 or more; the model learns from labelled documents of the input."""
    model = quality.fit(docs, table(tune(spark), sf_dir, "labels"))
    scored = quality.score(docs, model, name="quality_score")
    return scored.filter("quality_score >= 0.5").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are like an earlier one; a text may become empty."""
    tune(spark)
    return _recounted(lines.clean(docs, least_words=1))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (shingles of five words, similarity of 0.8 or more).

    Fingerprints (SimHash, as in op7) within 4 bits give candidates; an exact join gives the rest. All are verified.
    """
    tune(spark)
    return shingles.keep_one(docs, words=5, threshold=0.8)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in the place of personal data and secrets."""
    tune(spark)
    return _recounted(pii.replace(docs).select(*docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, sources mixed in proportion."""
    tune(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

# A learned classifier, keyed surrogates and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_SQL = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
