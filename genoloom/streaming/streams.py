"""Hint multiplicities over arriving files, and windowed counts of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hint_stream(spark: SparkSession, path: str, schema: str = "contig string, start bigint, end bigint, mult bigint") -> DataFrame:
    """Running sum of mult per intron over Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).parquet(path).groupBy("contig", "start", "end").agg(F.sum("mult").alias("mult"))


def event_windows(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per window and type (ts, event_type, value); rows later than the watermark are dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("window_start"), "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of a user: spans of events no further apart than the gap."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")
