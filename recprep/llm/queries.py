"""Registered queries of the document operators; oracle SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from recprep.llm import (
    alignment, bpe, collocations, exact_dedup, lines, packing, pii, ppm, quality, records, rules, simhash, warc,
)
from recprep.llm.common import crc_rest, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents"), least_words=1)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model).drop("text")
    return scored.select(
        "doc_id", (crc_rest("doc_id", 3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return pieces.drop("ids")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(spark, f"{sf_dir}/documents.parquet")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "posterior",
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs).withColumn("n_replaced", F.size("pii_found").cast("long"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_rest("doc_id", 7) == 2
    return ppm.score(docs, docs.filter(~held_out)).withColumn("held_out", held_out)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(encoded, ranks, public_tokenizers.PATTERN))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).drop("payload")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), a, public_tokenizers.PATTERN, b)[0]


def op12_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return records.binary_records(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, ids=False)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


LLM_QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality": op2_quality,
    "op3_packing": op3_packing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_pii": op6_pii,
    "op7_simhash": op7_simhash,
    "op8_ppm": op8_ppm,
    "op9_bpe": op9_bpe,
    "op10_warc": op10_warc,
    "op11_alignment": op11_alignment,
    "op12_binary_records": op12_binary_records,
    "op13_collocations": op13_collocations,
}

LLM_SQL = {
    "op4_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        ), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
    """,
    "op10_warc": r"""
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                   (unhex(sha1(coalesce(html, '')))::BIT)::VARCHAR AS bits
            FROM pages
        ), d AS (
            SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr(
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', list_sum(list_transform(range(5), lambda j:
                           substr(bits, (5 * i + j + 1)::INT, 1)::INT * (16 >> j::INT)))::INT + 1, 1)), '') AS payload_digest
            FROM p
        ), g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM g
    """,
    "op13_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), w AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM p
        ), t AS (SELECT lang, sum(len(words))::HUGEINT AS n FROM w GROUP BY lang
        ), g AS (
            SELECT lang, words[i : i + m - 1] AS phrase
            FROM (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w), (SELECT unnest(range(1, 6)) AS m)
            WHERE i + m - 1 <= len(words)
        ), f AS (SELECT lang, phrase, count(*)::HUGEINT AS f FROM g GROUP BY lang, phrase HAVING count(*) >= 100
        ), c AS (SELECT * FROM f WHERE len(phrase) > 1
        ), k AS (
            SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, n, 1000 * c.f * n // (l.f * r.f) AS score
            FROM (SELECT *, unnest(range(1, len(phrase))) AS k FROM c) c
            JOIN f l ON l.lang = c.lang AND l.phrase = c.phrase[1 : k]
            JOIN f r ON r.lang = c.lang AND r.phrase = c.phrase[k + 1 : len(c.phrase)]
            JOIN t ON t.lang = c.lang
        ), s AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), part AS (
            SELECT c.lang, c.f AS more, c.phrase[i : i + m - 1] AS phrase
            FROM (SELECT *, unnest(range(1, len(phrase) + 1)) AS i FROM c) c, (SELECT unnest(range(2, 5)) AS m)
            WHERE i + m - 1 <= len(c.phrase) AND m < len(c.phrase)
        ), best AS (
            SELECT s.* FROM s WHERE NOT EXISTS (
                SELECT 1 FROM part WHERE part.lang = s.lang AND part.phrase = s.phrase AND 100 * part.more >= 100 * s.a)
        ), o AS (
            SELECT *, array_to_string(phrase, ' ') AS told FROM best
        ), q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, told) AS rank FROM o)
        SELECT lang, rank, told AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
               score::BIGINT AS score
        FROM q WHERE rank <= 2000
    """,
}
