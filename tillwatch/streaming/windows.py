"""Windowed sums on the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WATERMARK = "10 seconds"


def with_watermark(stream: DataFrame) -> DataFrame:
    """Bounded disorder of ten seconds.

    Spark takes the largest event time over all input of a batch, so a silent partition holds
    nothing back. A watermark by partition, with a time-out for silent ones, is in ``idle.py``.
    """
    return stream.withWatermark("event_ts", WATERMARK)


def minute_panes(decided: DataFrame) -> DataFrame:
    """Sum per user and minute, once the minute is closed. Late rows must be branched off before."""
    return (
        with_watermark(decided).groupBy("user_id", F.window("event_ts", "1 minute").alias("w"))
        .agg(F.sum("amount_vnd").alias("amount_vnd"))
        .select("user_id", F.col("w.start").alias("minute"), "amount_vnd"))


def sliding_sums(decided: DataFrame) -> DataFrame:
    """Sum per user over 15 minutes, every minute, as the engine's own sliding window."""
    return (
        with_watermark(decided)
        .groupBy("user_id", F.window("event_ts", "15 minutes", "1 minute").alias("w"))
        .agg(F.sum("amount_vnd").alias("total"))
        .select("user_id", F.col("w.start").alias("window_start"), "total"))
