"""Families of equal documents, repeated chunks, contained documents, run verdicts.

All groups are keyed by digests of the text; rows of one document are aggregated before anything is shuffled by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.functions import text as T
from loam.operators.order import numbered


def with_families(docs: DataFrame, id_col: str, digest_col: str, order: list) -> DataFrame:
    """docs with representative, family_id, family_size and dup_kind: the first row in order represents equal digests.

    order is a list of columns that ends in the id; the representative is found by aggregation and joined by the digest,
    so a frequent text isn't gathered in one task, and rows that repeat an id or have none stay as many as they are.
    """
    heads = docs.groupBy(F.col(digest_col).alias("__digest")).agg(F.min_by(id_col, F.struct(*order)).alias("representative"), F.count(F.lit(1)).alias("family_size"))
    out = docs.join(heads, F.col(digest_col) == F.col("__digest")).drop("__digest")
    return out.withColumn("family_id", T.family_id(F.col("representative"))).withColumn("dup_kind", F.when(F.col(id_col) != F.col("representative"), F.lit("exact")))


def paragraphs(docs: DataFrame, id_col: str, text_col: str, separator: str, min_words: int) -> DataFrame:
    """(id, place, para): paragraphs of min_words at least, white space collapsed."""
    parts = docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(T.body(F.col(text_col)), separator)).alias("place", "para"))
    parts = parts.withColumn("para", F.trim(F.regexp_replace("para", r"[ \t\n\r]+", " ")))
    return parts.where(T.word_count(F.col("para")) >= min_words)


def contained(docs: DataFrame, id_col: str, text_col: str, separator: str = "\n", min_words: int = 20, min_paras: int = 3, share: float = 0.8, most_docs: int = 50) -> DataFrame:
    """(id, container, shared, n_paras) for documents most of whose paragraphs lie in a larger one.

    Documents rank by the number of distinct paragraphs (more first), then by id. A paragraph of more than most_docs
    documents is boilerplate: it doesn't count as shared but stays in the denominator; with it no paragraph joins more
    than most_docs rows. The container is that of the largest overlap, the better rank on ties.
    """
    own = paragraphs(docs, id_col, text_col, separator, min_words).select("id", F.md5("para").alias("h")).distinct()
    counts = own.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    rare = own.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where((F.col("df") <= most_docs) & (F.col("df") > 1)).select("h")
    known = own.join(rare, "h").join(counts, "id")
    small = known.where(F.col("n") >= min_paras)
    large = known.select(F.col("id").alias("other"), F.col("n").alias("m"), "h")
    pair = small.join(large, "h").where((F.col("m") > F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("other") < F.col("id"))))
    pair = pair.groupBy("id", "n", "other", "m").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= share * F.col("n"))
    best = F.min_by(F.struct("other", "shared"), F.struct(-F.col("shared"), -F.col("m"), "other")).alias("b")
    return pair.groupBy("id", "n").agg(best).select(F.col("id").alias(id_col), F.col("b.other").alias("container"), F.col("b.shared").alias("shared"), F.col("n").alias("n_paras"))


def first_chunks(chunks: DataFrame, text: str, order: list[str]) -> DataFrame:
    """chunks with n_before: how many equal chunks come earlier in order (0 for the one that stays).

    Chunks are numbered by ranges of (digest, order), so one that repeats in very many documents is dealt to many tasks.
    """
    made, _ = numbered(chunks.withColumn("__sha", F.sha2(text, 256)), ["__sha"], order, "n_before")
    return made.drop("__sha")


def latest(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The last row of each key in order; a map-side aggregate, no window."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return best.select(*keys, "r.*")


def apply_verdict(chunks: DataFrame, verdict: DataFrame, key: str) -> DataFrame:
    """Chunks with the status that a later round gives their documents; chunks without a verdict keep theirs.

    verdict has (key, verdict, kind, representative).
    """
    out = chunks.join(verdict, key, "left")
    status = (
        F.when((F.col("status") == "kept") & (F.col("verdict") == "duplicate"), "rejected:duplicate")
        .when((F.col("status") == "kept") & (F.col("verdict") == "rights"), "rejected:rights")
        .otherwise(F.col("status"))
    )
    kind = F.when((F.col("status") == "kept") & (F.col("verdict") == "duplicate"), F.concat(F.lit("global_"), F.col("kind")))
    return out.withColumn("final_kind", kind).withColumn("status", status).drop("verdict", "kind")
