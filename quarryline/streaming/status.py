"""Streams: sessions with late data, and deduplicated arrivals. An extension: the batch operators need none of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_arrivals(stream: DataFrame, keys: list[str], arrival: str, late: str = "2 days") -> DataFrame:
    """Each key once, as it arrives first; redeliveries within the watermark are dropped and state older than it is freed."""
    return stream.withWatermark(arrival, late).dropDuplicatesWithinWatermark(keys)


def session_counts(stream: DataFrame, key: str, at: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """``key, start, end, events``: sessions that a pause of ``gap`` ends, given out once no late row can change them."""
    sessions = stream.withWatermark(at, late).groupBy(F.session_window(at, gap), key).agg(F.count("*").alias("events"))
    return sessions.select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "events")


def period_counts(stream: DataFrame, at: str, by: str, width: str = "1 hour", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """``by, start, events`` per tumbling or sliding period of event time."""
    window = F.window(at, width, slide) if slide else F.window(at, width)
    counted = stream.withWatermark(at, late).groupBy(window, by).agg(F.count("*").alias("events"))
    return counted.select(by, F.col("window.start").alias("start"), "events")
