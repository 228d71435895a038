"""Run metrics as a stream: the hourly totals of plans.registry.metrics_by_hour with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hourly(events: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """stage, start, n, total, longest by hour of event time; rows later than ``lateness`` are dropped. Batch or stream."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", lateness) if events.isStreaming else timed
    grouped = timed.groupBy(F.window("ts", "1 hour").alias("w"), F.col("event_type").alias("stage"))
    return grouped.agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"), F.round(F.max("value"), 6).alias("longest")).select("stage", F.col("w.start").alias("start"), "n", "total", "longest")


def read_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    """A folder of Parquet files of events as a stream."""
    return spark.readStream.schema(schema).parquet(folder)
