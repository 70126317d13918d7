"""The batch tile and run operators on an event stream: watermarked counts by fixed tile, and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _timed(events: DataFrame) -> DataFrame:
    """Watermarks need instants; times without a zone are read in the session's."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def tile_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events and summed value by type and tumbling window; later rows than the watermark are dropped by the engine."""
    window = _timed(events).withWatermark("ts", late).groupBy(F.window("ts", width), "event_type")
    return window.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Runs of a user's events no further apart than the gap."""
    runs = _timed(events).withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id")
    return runs.agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("start"), F.col("session_window.end").cast("timestamp_ntz").alias("end"), "n")
