"""Sliding sums from one-minute panes.

A sliding window of 15 minutes that moves every minute puts every row into 15 windows. Rows are therefore
summed per user and minute first; a pane is then shuffled at most twice, to the hour of the first and of the
last window that it counts in. There a running sum over the panes in order gives the windows; they are written
out last, so no task holds them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwatch.operators.slices import MINUTE, slice_of

WINDOW_MINUTES = 15
HOUR_MINUTES = 60


def panes_of(rows: DataFrame) -> DataFrame:
    """``user_id minute amount_vnd`` of a table of rows."""
    return rows.groupBy("user_id", F.date_trunc("minute", "event_ts").alias("minute")).agg(
        F.sum("amount_vnd").alias("amount_vnd"))


def sliding_from_panes(panes: DataFrame, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """``user_id window_start total``: every window of ``minutes`` minutes that holds a pane."""
    at = slice_of(F.unix_millis("minute"), MINUTE)
    first, hour = at - (minutes - 1), F.col("hour")
    dealt = (
        panes.select("user_id", "amount_vnd", at.alias("at"), F.explode(F.sequence(
            F.floor(first / HOUR_MINUTES), F.floor(at / HOUR_MINUTES))).alias("hour"))
        .repartition("user_id", "hour"))
    # a pane enters the sum with the first window of this hour that counts it and leaves it after the last one
    end = (hour + 1) * HOUR_MINUTES

    def change(start: Column, sign: int) -> Column:
        return F.struct(start.alias("start"), (F.col("amount_vnd") * sign).alias("d"), F.lit(sign).alias("panes"),
                        F.when(F.col("amount_vnd").isNotNull(), sign).otherwise(0).alias("known"))

    enter = change(F.greatest(F.col("at") - (minutes - 1), hour * HOUR_MINUTES), 1)
    leave = change(F.least(F.col("at") + 1, end), -1)
    by_start = W.partitionBy("user_id", "hour").orderBy("start")
    upto = by_start.rangeBetween(W.unboundedPreceding, W.currentRow)
    stretches = dealt.select("user_id", "hour", F.inline(F.array(enter, leave))).select(
        "user_id", "hour", "start", F.sum("d").over(upto).alias("d"), F.sum("panes").over(upto).alias("panes"),
        F.sum("known").over(upto).alias("known"), F.lead("start").over(by_start).alias("next"))
    # of changes at one start only the last one reaches further; every window up to the next change has this sum
    held = stretches.where("panes > 0 AND next > start")
    return held.select(
        "user_id", F.explode(F.sequence("start", F.col("next") - 1)).alias("at"), F.when(F.col("known") > 0, F.col("d")).alias("total"),
    ).select("user_id", F.timestamp_millis(F.col("at") * MINUTE).alias("window_start"), "total")
