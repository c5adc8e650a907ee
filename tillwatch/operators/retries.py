"""Blocked transactions that the same user soon repeated with success at the same merchant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwatch.operators.slices import HOUR, MINUTE, with_carry


def blocked_then_retried(
    decided: DataFrame, within_ms: int = 30 * MINUTE, slice_ms: int = HOUR,
) -> DataFrame:
    """Blocked rows with a passed SUCCESS of the same user and merchant in (t, t + within].

    Proxy for a false positive while labels are missing. The next success is found by one running
    minimum in backwards time order; rows are never paired.
    """
    narrow = decided.select(
        "user_id", "merchant_id", "transaction_id", "event_ts", "amount_vnd",
        F.unix_millis("event_ts").alias("ms"), (F.col("decision") == "BLOCK").alias("blocked"),
        "status")
    relevant = narrow.where("blocked OR status = 'SUCCESS'")
    later = (W.partitionBy("user_id", "merchant_id", "slice").orderBy(F.desc("ms"))
             .rangeBetween(W.unboundedPreceding, -1))
    success_ms = F.when(~F.col("blocked") & (F.col("status") == "SUCCESS"), F.col("ms"))
    return (
        with_carry(relevant, "ms", slice_ms, within_ms, ahead=True)
        .withColumn("next_ms", F.min(success_ms).over(later))
        .where(F.col("blocked") & ~F.col("carried"))
        .where(F.col("next_ms") - F.col("ms") <= within_ms)
        .select("transaction_id", "user_id", "merchant_id", "event_ts", "amount_vnd",
                (F.col("next_ms") - F.col("ms")).alias("retry_after_ms"))
    )
