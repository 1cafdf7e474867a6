"""Streams: first-seen deduplication into a fingerprint store, and windowed counts with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.session import scratch_path

STORE = "sha string, doc_id long, written_at timestamp"


def stream_of(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def dedup_into(stream: DataFrame, store: str, checkpoint: str, id_col: str = "doc_id", text_col: str = "text"):
    """A streaming query (all that is there now) that appends each text's first fingerprint to a Parquet store.

    A batch is combined by digest, then texts that the store knows already are dropped by an anti-join on the digest;
    the store is partitioned by batch, so a batch that runs again replaces its own part.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.groupBy(F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("sha")).agg(F.min(id_col).alias("doc_id"))
        known = spark.read.schema(f"{STORE}, batch long").parquet(store).where(F.col("batch") != number).select("sha") if number else None
        fresh = fresh if known is None else fresh.join(known, "sha", "left_anti")
        fresh.withColumn("written_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{store}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str = "ts", key: str = "event_type", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by key and tumbling window; rows later than the watermark are dropped by the stream."""
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))


def run_to_table(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over all that is there now and gives its result, from files in the shared scratch folder.

    Each batch is written to a folder of its own, so one that runs again replaces it; in complete mode the last batch is
    the result, in append mode all batches together.
    """
    spark = stream.sparkSession
    path, done = scratch_path(spark, f"stream-{name}"), set()

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{number:09d}")
        done.add(number)

    query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", scratch_path(spark, f"checkpoint-{name}")).trigger(availableNow=True).start()
    query.awaitTermination()
    wanted = [max(done)] if done and mode == "complete" else sorted(done)
    return spark.read.schema(stream.schema).parquet(*[f"{path}/{n:09d}" for n in wanted]) if wanted else spark.createDataFrame([], stream.schema)
