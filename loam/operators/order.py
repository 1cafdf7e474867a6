"""Running sums and row numbers of groups of any size: ranges of (group, order) are summed apart, and the ranges' totals
added up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.session import materialize


def running(rows: DataFrame, groups: list[str], order: list[str], weight: Column, name: str) -> tuple[DataFrame, str]:
    """rows with the sum of weight over the rows before each in its group by order, nulls first; and its scratch path.

    The rows are written, sorted by ranges of (groups, order), so that a large group lies in several ranges. Within a
    range a group's rows are summed; what stands in earlier ranges is a sum over (group, range) pairs, of which there are
    at most as many as groups and ranges together. Rows that agree in groups and order follow each other arbitrarily.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("__w", weight).repartitionByRange(parts, *groups, *order).withColumn("__range", F.spark_partition_id())
    dealt, path = materialize(dealt, "ranges")
    inside = Window.partitionBy("__range", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("__range", *groups).agg(F.sum("__w").alias("__n"))
    earlier = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("__range", *groups, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    same = [F.col("d.__range") == F.col("c.__range"), *(F.col(f"d.{g}").eqNullSafe(F.col(f"c.{g}")) for g in groups)]
    placed = dealt.withColumn("__k", F.coalesce(F.sum("__w").over(inside), F.lit(0))).alias("d").join(totals.alias("c"), same)
    return placed.select(*[F.col(f"d.{c}") for c in rows.columns], (F.col("__k") + F.col("__before")).alias(name)), path


def numbered(rows: DataFrame, groups: list[str], order: list[str], name: str) -> tuple[DataFrame, str]:
    """rows with the place of each row (from 0) in its group by order, nulls first; and its scratch path."""
    return running(rows, groups, order, F.lit(1).cast("long"), name)


def order_statistics(values: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """(group, n, one column for each share): the element at floor(n * share) of the sorted values, without interpolation.

    Equal values are counted before anything is ordered.
    """
    counts = values.groupBy(group, value).agg(F.count(F.lit(1)).alias("__c"))
    total = counts.groupBy(group).agg(F.sum("__c").alias("n"))
    run, _ = running(counts, [group], [value], F.col("__c"), "__first")
    run = run.withColumnRenamed(group, "__g").join(total, F.col("__g").eqNullSafe(F.col(group)))
    at = lambda q: F.least(F.floor(F.col("n") * q), F.col("n") - 1)
    hit = lambda q: (F.col("__first") <= at(q)) & (at(q) < F.col("__first") + F.col("__c"))
    return run.groupBy(group).agg(F.max("n").alias("n"), *[F.max(F.when(hit(q), F.col(value))).alias(name) for name, q in shares.items()])
