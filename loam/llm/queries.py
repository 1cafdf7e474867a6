"""Queries of this subpackage: (spark, folder of the tables) -> DataFrame, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.llm import bpe, chat_format, decontaminate, exact_dedup, language_id, license_scan, near_dedup, quality, token_store, toxicity
from loam.llm.sampling import bucket_of


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.find_licenses(_table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(_table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), k=3, percent=85)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = bucket_of(F.col("doc_id"), 4) == 2
    model = language_id.train(docs, ~held_out)
    return language_id.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.report(_table(spark, sf_dir, "conversations"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = bucket_of(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_and_read(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.round_trip(_table(spark, sf_dir, "documents"), ranks, pattern)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = bucket_of(F.col("doc_id"), 5) == 0
    model = quality.train(docs, _table(spark, sf_dir, "labels"), ~held_out)
    scored = quality.score(docs.select("doc_id", held_out.alias("held_out"), "text", "lang", "source", "n_chars"), model)
    scored = scored.select("doc_id", "held_out", "score_text", "score_meta", "score")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op4_language_id": op4_language_id,
    "op5_chat_format": op5_chat_format,
    "op6_toxicity": op6_toxicity,
    "op7_token_store": op7_token_store,
    "op8_decontaminate": op8_decontaminate,
    "op9_bpe": op9_bpe,
    "op10_quality": op10_quality,
}

SQL: dict[str, str] = {
    "op1_license_scan": license_scan.oracle(),
    "op5_chat_format": chat_format.SQL,
    "op2_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY body)
    """,
    "op3_near_dedup": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, g FROM (
                SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                    ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS g
                FROM d)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
              FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
        e AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
        r AS (SELECT doc_id, doc_id AS reach FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reach = e.a)
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.reach) AS component_id, d.doc_id = min(r.reach) AS kept
        FROM d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
    """,
    "op8_decontaminate": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        b AS (
            SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        p AS (
            SELECT item, m, array_to_string(w[i : i + m - 1], ' ') AS win FROM (
                SELECT item, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
        o AS (
            SELECT doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') AS win FROM (
                SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
                FROM d, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)),
        h AS (SELECT DISTINCT o.doc_id, o.i, o.m, p.item FROM o JOIN p USING (m, win)),
        n AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM h) GROUP BY doc_id),
        t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(n.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
               sha256(coalesce(t.items, '')) AS items_sha256, coalesce(n.n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
    """,
}
