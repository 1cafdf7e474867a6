"""Allocation of sample sizes and stratified samples by hash rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def level_fill(total: int, room: dict[str, int]) -> dict[str, int]:
    """Counts as even as possible that add up to total (or to all the room), none above its room.

    The common level is found by filling the smallest rooms first; what can't be shared evenly goes to the first keys.
    """
    left, out = min(total, sum(room.values())), {}
    for i, key in enumerate(sorted(room, key=lambda k: (room[k], k))):
        out[key] = min(room[key], left // (len(room) - i))
        left -= out[key]
    for key in sorted(room):
        extra = min(left, room[key] - out[key], 1)
        out[key] += extra
        left -= extra
    return {key: out[key] for key in sorted(room)}


def pool(docs: DataFrame, id_col: str, digest_col: str, size: Column, source: str, passes: Column) -> DataFrame:
    """Distinct texts (by digest, the smallest id) that have words, with a stratum of source and length, and whether they
    pass the rules."""
    length = F.when(size < 100, "short").when(size < 400, "medium").otherwise("long")
    rows = docs.where(size > 0).select(F.col(id_col).alias("id"), F.col(digest_col).alias("sha"), F.concat_ws("/", source, length).alias("stratum"), passes.alias("rule_pass"))
    best = F.min_by(F.struct("id", "stratum", "rule_pass"), F.col("id")).alias("b")
    return rows.groupBy("sha").agg(best).select("b.*")


def stratified(rows: DataFrame, total: int, pass_share: float = 0.7, seed: int = 42) -> DataFrame:
    """A sample of the pool: pass_share of it passes the rules, the rest fails, each spread evenly over the strata.

    Missing failures are made up by passes and the other way round. Only the strata's counts reach the driver.
    """
    spark = rows.sparkSession
    counts = [r.asDict() for r in rows.groupBy("stratum", "rule_pass").agg(F.count(F.lit(1)).alias("n")).collect()]
    room = {p: {c["stratum"]: c["n"] for c in counts if c["rule_pass"] is p} for p in (True, False)}
    have = {p: sum(room[p].values()) for p in room}
    fail = min(round(total * (1 - pass_share)), have[False])
    good = min(total - fail, have[True])
    fail = min(total - good, have[False])
    quota = [(s, p, n) for p, want in ((True, good), (False, fail)) for s, n in level_fill(want, room[p]).items()]
    limits = spark.createDataFrame(quota, "stratum string, rule_pass boolean, quota int")
    key = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")), 256)
    ranked = rows.withColumn("k", F.row_number().over(Window.partitionBy("stratum", "rule_pass").orderBy(key)))
    # No quota is above the total: each task keeps that many rows of a stratum before anything is shuffled.
    return ranked.where(F.col("k") <= total).join(F.broadcast(limits), ["stratum", "rule_pass"]).where(F.col("k") <= F.col("quota")).drop("k", "quota")
