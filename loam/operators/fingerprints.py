"""The store of document fingerprints across runs, and the verdict of a second round over all of them.

A run writes one row for each of its documents below run=<name>; a run that is written again replaces its part. Documents
that the run dropped are written too, as tombstones, so that an earlier row of them no longer counts. The verdict takes the
latest row of each document and elects representatives anew, best priority first.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.functions import text as T
from loam.functions.types import kind
from loam.operators import minhash
from loam.operators.dedup import latest
from loam.session import materialize, ship

COLUMNS = "dedup_group string, doc_id long, source string, sha string, minhash binary, score double, priority int, rights string, n_chunks long, n_tokens long, alive boolean, written_at timestamp"


def of_documents(docs: DataFrame, text: str, group: Column, source: Column, score: Column, priority: Column, rights: Column, alive: Column, written_at: Column, chunks: Column | None = None, tokens: Column | None = None) -> DataFrame:
    """Rows of COLUMNS for documents (doc_id and a text column); only documents that are alive have a signature."""
    ship(docs.sparkSession)
    body = T.body(F.col(text))
    return docs.select(
        group.alias("dedup_group"), F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), F.sha2(body, 256).alias("sha"),
        F.when(alive, minhash.signatures(F.when(alive, body))).alias("minhash"), score.cast("double").alias("score"), priority.cast("int").alias("priority"), rights.alias("rights"),
        (F.lit(1) if chunks is None else chunks).cast("long").alias("n_chunks"), (T.word_count(body) if tokens is None else tokens).cast("long").alias("n_tokens"),
        alive.alias("alive"), written_at.cast("timestamp").alias("written_at"),
    )


def write_run(rows: DataFrame, store: str, run: str) -> None:
    """The rows of a run, in place of what it wrote before."""
    rows.write.mode("overwrite").parquet(f"{store}/run={run}")


def read_store(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema(f"{COLUMNS}, run string").option("basePath", store).parquet(store)


def verdict(store: DataFrame, threshold: float = 0.8, priority: Column | None = None, enforce: tuple[str, ...] | None = None, block: int = minhash.BLOCK) -> DataFrame:
    """(dedup_group, doc_id, source, verdict, dup_kind, dup_of, family_id, family_size) for every document of the store.

    verdict is dropped (the latest row is a tombstone), rights (with enforce, the rights that are open: any other),
    duplicate or kept. Groups never mix. In a family of equal texts and near-duplicates the row of the smallest priority
    stays (given anew, or as stored), then of the highest score, then of the smallest id; rows without a score come last.
    dup_kind is exact if an earlier row of the family in that order has the same text, else fuzzy. Rows without a doc_id
    are left out.
    """
    ship(store.sparkSession)
    rows = store if priority is None else store.withColumn("priority", priority.cast("int"))
    rows = latest(rows.where("doc_id IS NOT NULL"), ["dedup_group", "doc_id"], ["written_at", "run"])
    state = F.when(~F.coalesce("alive", F.lit(True)), "dropped")
    if enforce is not None:
        state = state.when(~F.coalesce(F.col("rights").isin(*enforce), F.lit(False)), "rights")
    rows, _ = materialize(rows.withColumn("state", state), "latest")
    live = rows.where("state IS NULL").withColumn("gsha", F.sha2(F.concat_ws(":", F.coalesce("dedup_group", F.lit("")), "sha"), 256))

    # Signatures of different groups differ, as the group's hash is mixed into them.
    mixed = mix_group("minhash", F.crc32(F.coalesce("dedup_group", F.lit("")).cast("binary")))
    numbered = live.select(F.xxhash64("dedup_group", "doc_id").alias("id"), F.col("gsha").alias("sha"), mixed.alias("sig"), "dedup_group", "doc_id", "source", "priority", "score")
    numbered, _ = materialize(numbered, "live")
    parts, _ = minhash.linked(numbered.select("id", "sha", "sig"), threshold, block)
    order = F.struct("priority", F.coalesce(-F.col("score"), F.lit(float("inf"))).alias("s"), "doc_id")
    members = numbered.drop("sig").join(parts.select("id", "component"), "id").withColumn("rank", order)
    heads = members.groupBy("component").agg(F.min_by("doc_id", "rank").alias("head"), F.count(F.lit(1)).alias("family_size"))
    firsts = members.groupBy("sha").agg(F.min("rank").alias("first"))
    judged = members.join(heads, "component").join(firsts, "sha")
    stays = F.col("doc_id") == F.col("head")
    judged = judged.select(
        "dedup_group", "doc_id", "source", F.when(stays, "kept").otherwise("duplicate").alias("verdict"),
        F.when(~stays, F.when(F.col("rank") != F.col("first"), "exact").otherwise("fuzzy")).alias("dup_kind"), F.when(~stays, F.col("head")).alias("dup_of"),
        T.family_id(F.col("head")).alias("family_id"), "family_size",
    )
    null = F.lit(None)
    gone = rows.where("state IS NOT NULL").select(
        "dedup_group", "doc_id", "source", F.col("state").alias("verdict"), null.cast("string").alias("dup_kind"), null.cast("long").alias("dup_of"),
        T.family_id(F.col("doc_id")).alias("family_id"), F.lit(1).cast("long").alias("family_size"),
    )
    return judged.unionByName(gone)


def mix_group(sig: str, code: Column) -> Column:
    """A signature with its values shifted by the group's code, so that no slot of two groups agrees by more than chance."""
    return _shifted(F.col(sig), code)


@F.pandas_udf(kind("binary"))
def _shifted(sig: pd.Series, code: pd.Series) -> pd.Series:
    return sig.combine(code, lambda s, c: None if s is None else (np.frombuffer(s, "<u4") ^ np.uint32(c)).tobytes())


def stats(verdicts: DataFrame) -> DataFrame:
    """For each group: documents, exact and fuzzy duplicates, those held back, families of several, the largest family."""
    is_ = lambda c, x: F.count_if(F.col(c) == x)
    head = (F.col("verdict") == "kept") & (F.col("family_size") > 1)
    return verdicts.groupBy("dedup_group").agg(
        F.count_if(F.col("verdict").isin("kept", "duplicate")).alias("docs"), is_("dup_kind", "exact").alias("exact"), is_("dup_kind", "fuzzy").alias("fuzzy"),
        is_("verdict", "rights").alias("rights_blocked"), is_("verdict", "dropped").alias("dropped"), F.count_if(head).alias("families_multi"), F.max("family_size").alias("largest_family"),
    )
