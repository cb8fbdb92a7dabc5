"""Streaming forms of detection queries; each works on a batch or a stream alike.

Input columns: event_id, ts, cell, value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _timed(df: DataFrame, late: str) -> DataFrame:
    """Watermarks need a time zone's timestamp; a plain one is taken in the session's zone."""
    return df.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def tumbling_max(df: DataFrame, late: str = "1 day", size: str = "1 day") -> DataFrame:
    return _timed(df, late).groupBy(F.window("ts", size).alias("w"), "cell").agg(F.max("value").alias("peak"), F.count("*").alias("n")).select(F.col("w.start").alias("start"), "cell", "peak", "n")


def sliding_sum(df: DataFrame, late: str = "1 day", size: str = "7 days", step: str = "1 day") -> DataFrame:
    return _timed(df, late).groupBy(F.window("ts", size, step).alias("w"), "cell").agg(F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "cell", "total")


def episodes(df: DataFrame, gap: str = "12 hours", late: str = "1 day") -> DataFrame:
    s = _timed(df, late).groupBy(F.session_window("ts", gap).alias("w"), "cell").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return s.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "cell", "n", "total")


def deduplicated(df: DataFrame, late: str = "1 day") -> DataFrame:
    """First arrival of each event_id; on a stream within the watermark."""
    marked = _timed(df, late)
    return marked.dropDuplicatesWithinWatermark(["event_id"]) if df.isStreaming else marked.dropDuplicates(["event_id"])
