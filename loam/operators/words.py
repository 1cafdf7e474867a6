"""Frequent words as lists of bounded size: what they settle is settled in the task, and only the other words are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.session import materialize


def least_of_frequent(counts: DataFrame, most: int = 200_000) -> int:
    """The smallest n that at most most rows of counts (n) reach. Only how many rows have each n is collected."""
    left, least = most, (1 << 63) - 1
    for n, rows in sorted(((r["n"], r["rows"]) for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).collect()), reverse=True):
        left -= rows
        if left < 0:
            break
        least = n
    return least


def surely_common(docs: DataFrame, id_col: str, words: Column, most: int = 200_000) -> DataFrame:
    """(w): most frequent words at most, each of which three different ids have for sure.

    docs may have several rows of an id, and null counts as an id. Of each word the least and largest of two hashes of the
    id are kept: three different values are three ids. A word of which they show fewer isn't in the list, so those who use it look at the words
    that are not in it exactly.
    """
    again = lambda h: F.xxhash64(h, F.lit(1))
    rows = docs.select(F.xxhash64(id_col).alias("h"), F.explode(F.array_distinct(words)).alias("w")).withColumn("g", again("h"))
    found = rows.groupBy("w").agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in "hg"])
    sure = F.size(F.array_distinct(F.array(again("min_h"), again("max_h"), "min_g", "max_g"))) > 2
    found, _ = materialize(found.where(sure).select("w", "n"), "words")
    return found.where(F.col("n") >= least_of_frequent(found, most)).select("w")
