"""Connected components of a links table by smallest label, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.session import discard, materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for every end of a link the smallest id it reaches.

    Each round joins the links with the labels, takes the smallest label among the neighbours and then
    follows the label of the label (pointer jumping), so a chain of n links takes about log n rounds. Labels
    are written to the shared folder after each round. Loops and repeated links do no harm; no links give
    no rows.
    """
    spark = edges.sparkSession
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both, both_path = materialize(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    labels, path = materialize(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")).select(F.col("x").alias("id"), "label"), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("y"), F.col("label").alias("l")), "y").groupBy("x").agg(F.min("l").alias("near"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        step = (
            labels.join(near.withColumnRenamed("x", "id"), "id", "left")
            .join(jump, "label", "left")
            .select("id", F.least("label", "near", "far").alias("label"), (F.least("label", "near", "far") < F.col("label")).alias("moved"))
        )
        step, next_path = materialize(step, "labels")
        moved = step.where("moved").limit(1).count()
        discard(spark, path)
        labels, path = step.select("id", "label"), next_path
        if not moved:
            discard(spark, both_path)
            return labels.select("id", F.col("label").alias("component"))
