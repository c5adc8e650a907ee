"""Loyalty points of a transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.operators.slices import MINUTE
from tillwatch.operators.trailing import trailing_sums

VND_PER_POINT = 100_000
DOUBLE_FROM_VND = 5_000_000
SPAN_MS = 15 * MINUTE


def earns_points() -> Column:
    """Blocked and failed transactions neither count nor earn; refunds are not purchases."""
    return ((F.col("decision") != "BLOCK") & (F.col("status") != "FAILED")
            & (F.col("txn_type") == "PAYMENT"))


def loyalty_points(decided: DataFrame) -> DataFrame:
    """Add ``eligible``, ``total_15m`` (current row included), ``multiplier`` and ``points``.

    Rows that cannot earn are kept with no points, so one pass serves revenue and points.
    """
    doubled = (F.col("total_15m") >= DOUBLE_FROM_VND) & (F.col("experiment_group") == "TREATMENT")
    counted = F.when(F.col("eligible"), F.col("amount_vnd")).otherwise(F.lit(0))
    base = F.floor(F.col("amount_vnd") / VND_PER_POINT).cast("bigint")
    return (
        trailing_sums(decided.withColumn("eligible", earns_points()), ["user_id"],
                      F.unix_millis("event_ts"), SPAN_MS, {"total_15m": counted})
        .withColumn("multiplier", F.when(F.col("eligible") & doubled, 2).otherwise(1).cast("bigint"))
        .withColumn("points", F.when(F.col("eligible"), base * F.col("multiplier"))
                    .otherwise(F.lit(0).cast("bigint")))
    )
