"""Card testing: a run of small failures on one device, directly followed by a large success."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwatch.operators.slices import MINUTE, slice_of, with_carry


@dataclass(frozen=True)
class CardTestingLimits:
    small_below_vnd: int = 20_000
    large_above_vnd: int = 10_000_000
    min_failures: int = 5
    within_ms: int = 2 * MINUTE
    slice_ms: int = 10 * MINUTE


def _labelled_failures(payments: DataFrame, lim: CardTestingLimits, also: tuple[str, ...] = ()) -> DataFrame:
    """Small failures whose next other row on the device is a large success within the limit."""
    narrow = payments.select(
        "device_id", "transaction_id", "user_id", "event_ts", "amount_vnd",
        F.unix_millis("event_ts").alias("ms"),
        ((F.col("status") == "FAILED") & (F.col("amount_vnd") < lim.small_below_vnd)).alias("small"),
        ((F.col("status") == "SUCCESS") & (F.col("amount_vnd") > lim.large_above_vnd)).alias("large"), *also)
    sliced = with_carry(narrow, "ms", lim.slice_ms, lim.within_ms)
    # Large successes are rare: only their (device, slice) groups need the window and its shuffle.
    suspects = (narrow.where("large")
                .select("device_id", slice_of(F.col("ms"), lim.slice_ms).alias("slice")).distinct())
    backwards = (W.partitionBy("device_id", "slice").orderBy(F.desc("ms"), F.desc("transaction_id"))
                 .rowsBetween(W.unboundedPreceding, -1))
    breaker = F.when(~F.col("small"), F.struct(
        "transaction_id", "user_id", "event_ts", "ms", "amount_vnd",
        (F.col("large") & ~F.col("carried")).alias("hit"), *also))
    return (
        sliced.join(suspects, ["device_id", "slice"], "left_semi")
        .withColumn("b", F.last(breaker, ignorenulls=True).over(backwards))
        .where("small AND b.hit")
        .where(F.col("b.ms") - F.col("ms") <= lim.within_ms)
    )


def card_testing(
    payments: DataFrame, lim: CardTestingLimits = CardTestingLimits(), also: tuple[str, ...] = (),
) -> DataFrame:
    """One row per attack, on the large success, with the size of the chain before it.

    A small failure belongs to at most one attack (the next row that is not a small failure), so
    the labelled failures are counted, never paired. Columns in ``also`` are those of the large success.
    """
    return (
        _labelled_failures(payments, lim, also)
        .groupBy("device_id", "slice", F.col("b.transaction_id").alias("transaction_id"))
        .agg(F.first("b.user_id").alias("user_id"), F.first("b.event_ts").alias("event_ts"),
             F.first("b.amount_vnd").alias("large_amount_vnd"),
             F.count("*").alias("chain_len"), F.min("event_ts").alias("chain_start"),
             F.sum("amount_vnd").alias("chain_vnd"), *[F.first(f"b.{c}").alias(c) for c in also])
        .where(F.col("chain_len") >= lim.min_failures)
        .drop("slice")
    )


def card_testing_evidence(
    payments: DataFrame, lim: CardTestingLimits = CardTestingLimits(),
) -> DataFrame:
    """The chain of every attack in long form: one row per small failure, however long the chain."""
    attack = W.partitionBy("device_id", "slice", "alert_txn")
    return (
        _labelled_failures(payments, lim)
        .select("device_id", "slice", F.col("b.transaction_id").alias("alert_txn"),
                "transaction_id", "event_ts", "amount_vnd")
        .withColumn("chain_len", F.count("*").over(attack))
        .where(F.col("chain_len") >= lim.min_failures)
        .drop("slice", "chain_len")
    )
