"""Incremental merging of sample tables, and windows over event streams, with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def merge_new_samples(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str) -> StreamingQuery:
    """Add the files of source that haven't been seen to a long matrix (feature, sample, value) under target.

    Each batch is a folder of its own, so that a repeated batch overwrites itself; read_merged
    reads all of them.
    """

    def add(batch: DataFrame, number: int) -> None:
        batch.groupBy("feature", "sample").agg(F.sum("value").alias("value")).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_merged(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).groupBy("feature", "sample").agg(F.sum("value").alias("value"))


def windowed_counts(events: DataFrame, size: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and sums per type and window; on a stream, with a watermark for late rows."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("v")).select(F.col("w.start").alias("start"), "event_type", "n", "v")
