"""Exact deduplication by skew-safe combining, with DataFrame functions only.

Three stages, each keyed by digest AND full text, so that a digest collision never merges two texts:
rows of a task are combined before they leave it (partial aggregation), then the groups of
(digest, text, salt) are combined, then the winners of all salts. Whatever share of the rows one text
holds, a reducer reads at most one row of it from each task of the stage before.

Defined results: a null text counts as empty. Of equal texts the largest doc_id stays; a null doc_id
loses to every other. Repeated rows (same doc_id, same text) each count in group_size and each get a row
from duplicate_groups(); keep_one_of_each() returns exactly one row for each distinct text. Columns
besides the id and the text are passed through, whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.session import materialize

#: Salts for one digest; rows of a text are spread over so many reducers in the first merge.
SALTS = 16


def _salt(id_col: Column, salts: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row for each row of docs: id, keep_id, group_size, kept, text_sha256.

    The groups are found on full texts. A document then looks up its group by the digest; digests that
    several texts share (a collision) are looked up by digest and text.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    rows = rows.withColumn("digest", F.sha2(F.col("body").cast("binary"), 256))
    salted = rows.groupBy("digest", "body", _salt(F.col("id"), salts).alias("salt")).agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    texts = salted.groupBy("digest", "body").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    digests = texts.groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"),
        F.sum("group_size").alias("group_size"),
        F.count(F.lit(1)).alias("texts"),
    )
    # Written without the texts: the lookup below then splits a digest that many rows share over several tasks.
    digests, _ = materialize(digests, "digests")
    found = rows.select("id", "digest").join(digests.where("texts = 1").drop("texts"), "digest")
    clash = digests.where("texts > 1").select("digest")
    if clash.limit(1).count():
        odd = rows.join(clash, "digest", "left_semi").join(texts, ["digest", "body"])
        found = found.unionByName(odd.select(found.columns))
    return found.select(
        F.col("id").alias(id_col),
        F.col("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """docs with one row for each distinct text: that of the largest id, with all its columns.

    The winning row travels through the same three stages, so no join brings the columns back. Of rows
    with the same id and text, the one whose other columns hash highest stays.
    """
    names = docs.columns
    rest = [c for c in names if c != text_col]
    hashed = [f.name for f in docs.schema if f.name != text_col and "map<" not in f.dataType.simpleString()]
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    packed = docs.select(
        digest.alias("__digest"),
        F.coalesce(F.col(text_col), F.lit("")).alias("__body"),
        F.col(text_col).isNull().alias("__null"),
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("__row"),
        F.struct(F.col(id_col).alias("id"), F.xxhash64(*[F.col(f"`{c}`") for c in hashed]).alias("h")).alias("__order"),
        _salt(F.col(id_col), salts).alias("__salt"),
    )

    def combine(df: DataFrame, *keys: str) -> DataFrame:
        best = F.max_by(F.struct("__row", "__null", "__order"), F.col("__order")).alias("__best")
        return df.groupBy(*keys).agg(best).select(*keys, "__best.*")

    won = combine(combine(packed, "__digest", "__body", "__salt").drop("__salt"), "__digest", "__body")
    text = F.when(~F.col("__null"), F.col("__body"))
    return won.select(*[text.alias(c) if c == text_col else F.col("__row").getField(c).alias(c) for c in names])
