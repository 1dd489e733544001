"""Structured Streaming forms of the feed walk and of the run-over-run refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .refresh import reconciled, refresh

__all__ = ["feed_entries", "reconciled", "refresh", "windowed_counts"]


def feed_entries(entries: DataFrame, horizon: str = "60 days") -> DataFrame:
    """Active entries of a stream (uuid, status, changed timestamp, ...), each uuid once within the horizon."""
    return entries.where(F.col("status") == "ACTIVE").withWatermark("changed", horizon).dropDuplicatesWithinWatermark(["uuid"])


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by kind and window of event time; later rows than the watermark are dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"))
