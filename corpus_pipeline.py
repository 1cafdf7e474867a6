"""The corpus pipeline: language identification, exact and near deduplication, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and gives the documents that it keeps, in the columns of documents; the last
gives their ids. run() writes each stage's rows to the shared folder and reads them back for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.llm import bpe, decontaminate, exact_dedup, language_id, near_dedup
from loam.llm.sampling import bucket_of
from loam.session import materialize

#: A document goes if no language is found or its calibrated probability is lower; a clean text is far above.
MIN_LANGUAGE_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without an identified language: a null text, or one without a letter, goes.

    With two learnt languages or more the score of the best is at least one over their number, so with up to three of
    them MIN_LANGUAGE_SCORE drops nothing more. Without a usable row to learn from all documents go.
    """
    return language_id.identified(docs, bucket_of(F.col("doc_id"), 4) != 2, MIN_LANGUAGE_SCORE)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each text, that of the largest id; null counts as empty, rows that repeat the id of the one
    that stays, with its text, are one document."""
    return exact_dedup.keep_one_of_each(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group, that of the smallest id: five-word shingles, a similarity of 0.8.

    Documents without words or without an integer id stay.
    """
    return near_dedup.keep_one_of_each_group(docs, k=5, percent=80)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of the benchmark; those without words stay, an empty benchmark drops none."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text; an empty text has no ids and is lossless."""
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "lossless")


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_duplicates),
    ("near dedup", near_duplicates),
    ("decontamination", contamination),
    ("BPE", encoding),
]

#: The language model and the merges are beyond SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; an empty table gives an empty result, columns of other names are kept up to
    the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
