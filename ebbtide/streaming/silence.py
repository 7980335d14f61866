"""A source that has stopped sending, noticed in the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def silent_sources(events: DataFrame, source: str, time: str = "event_timestamp", minutes: int = 15, delay: str = "1 minute") -> DataFrame:
    """One row per source and silence, with the last time it was heard.

    A silence is the end of a session whose gap is the tolerated time; it is known once the
    watermark, which the other sources push on, has passed it. The state is one open session per
    source, and the sessions of a batch are merged before the shuffle.
    """
    return (
        events.withWatermark(time, delay)
        .groupBy(F.col(source).alias("source"), F.session_window(time, f"{minutes} minutes").alias("s"))
        .agg(F.max(time).alias("last_seen"))
        .select("source", "last_seen")
    )
