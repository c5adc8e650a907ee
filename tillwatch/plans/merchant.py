"""Merchant margin: what is left of the volume after interchange, refunds, fraud and processing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.exprs import is_gmv, money, ratio, rounded_money, sum_if
from tillwatch.plans.assumptions import per_scenario
from tillwatch.sources.seeds import Seeds

MONEY = ["gross_revenue", "interchange_fee", "refund_cost", "fraud_cost", "processing_cost", "net_revenue"]


def channel_days(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Day x merchant x channel sums. After the partial aggregation a hot merchant is a few rows.

    The join keeps the partitioning by transaction that the dedup made.
    """
    chargebacks = (
        labels.where("is_fraud_confirmed AND label_source = 'CHARGEBACK'")
        .select("transaction_id", F.lit(True).alias("_cb")))
    gmv = is_gmv(F.col("status"), F.col("txn_type"))
    refund = (F.col("txn_type") == "REFUND") & (F.col("status") == "SUCCESS")
    charged = F.coalesce(F.col("_cb"), F.lit(False))
    amount = F.col("amount_vnd")
    return (
        rows.select("transaction_id", "dt", "merchant_id", "channel", "status", "txn_type", "amount_vnd")
        .join(chargebacks, "transaction_id", "left")
        .groupBy(F.col("dt").alias("date_day"), "merchant_id", "channel")
        .agg(
            F.count("*").alias("txn_count"), sum_if(gmv, amount).alias("gmv"),
            sum_if(refund, amount).alias("refund_amount"), F.count_if(refund).alias("refund_count"),
            sum_if(charged, amount).alias("chargeback_amount"),
            F.count_if(charged).alias("chargeback_count")))


def fct_merchant_profitability(rows: DataFrame, labels: DataFrame, seeds: Seeds) -> DataFrame:
    """Grain: day x merchant x industry (x scenario).

    Interchange depends on the channel, so it is charged before the channels are summed up; the
    chargeback penalty is per case.
    """
    priced = (
        channel_days(rows, labels)
        .join(seeds.interchange_rate, "channel", "left")
        .groupBy("date_day", "merchant_id")
        .agg(*[F.sum(c).alias(c) for c in (
            "txn_count", "gmv", "refund_amount", "refund_count", "chargeback_amount", "chargeback_count")],
            F.sum(money(F.col("gmv")) * F.col("rate")).alias("_interchange"))
        .join(seeds.merchant_industry, "merchant_id", "left")
        .join(seeds.take_rate, "industry", "left"))
    gross = money(F.col("gmv")) * F.col("take_rate")
    refund = (money(F.col("refund_amount")) * F.col("c.refund_fee_rate")
              + money(F.col("refund_count")) * F.col("c.fixed_refund_cost"))
    fraud = (money(F.col("chargeback_amount"))
             + money(F.col("chargeback_count")) * F.col("c.chargeback_penalty_fee"))
    processing = money(F.col("txn_count")) * F.col("c.cost_per_txn")
    return (
        per_scenario(priced, seeds.cost_assumptions)
        .select(
            "date_day", "merchant_id", "industry", "scenario", "txn_count", "gmv", "refund_amount",
            "take_rate", gross.alias("_gross"), "_interchange", refund.alias("_refund"),
            fraud.alias("_fraud"), processing.alias("_processing"))
        .withColumn("_net", F.col("_gross") - F.col("_interchange") - F.col("_refund")
                    - F.col("_fraud") - F.col("_processing"))
        .select(
            "date_day", "merchant_id", "industry", "scenario", "txn_count", "gmv", "refund_amount",
            F.col("take_rate").cast("double").alias("take_rate"),
            rounded_money(F.col("_gross")).alias("gross_revenue"),
            rounded_money(F.col("_interchange")).alias("interchange_fee"),
            rounded_money(F.col("_refund")).alias("refund_cost"),
            rounded_money(F.col("_fraud")).alias("fraud_cost"),
            rounded_money(F.col("_processing")).alias("processing_cost"),
            rounded_money(F.col("_net")).alias("net_revenue"))
        .withColumn("net_take_rate", ratio(F.col("net_revenue"), F.col("gmv")))
        .withColumn("is_margin_negative", F.coalesce(F.col("net_take_rate") < 0, F.col("net_revenue") < 0)))


def roll_up(fact: DataFrame, by: list[str]) -> DataFrame:
    """The mart at a coarser grain. Money columns have two decimals, so they add up exactly."""
    exact = [F.sum(F.col(c).cast("decimal(28,2)")).cast("double").alias(c) for c in MONEY]
    return (
        fact.groupBy(*by).agg(F.sum("txn_count").alias("txn_count"), F.sum("gmv").alias("gmv"), *exact)
        .withColumn("net_take_rate", ratio(F.col("net_revenue"), F.col("gmv"))))


def waterfall(fact: DataFrame) -> DataFrame:
    """Cost steps per industry in long form: gross down to net."""
    steps = F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("step_no"), F.lit(name).alias("step"),
                 (F.col(name) if name in ("gross_revenue", "net_revenue") else -F.col(name)).alias("amount_vnd"))
        for i, name in enumerate(MONEY)])
    return roll_up(fact, ["industry"]).select("industry", F.inline(steps))


def refund_links(rows: DataFrame) -> DataFrame:
    """Refunds next to their original payment; an orphan is flagged, not dropped.

    Refunds that name no original never meet one, so they stay out of the join instead of filling
    one partition with empty keys.
    """
    refunds = rows.where("txn_type = 'REFUND'").select(
        "original_txn_id", "transaction_id", "merchant_id", "amount_vnd")
    originals = rows.select(
        F.col("transaction_id").alias("original_txn_id"), F.col("amount_vnd").alias("original_vnd"),
        F.lit(True).alias("_hit"))
    linked = refunds.where("original_txn_id IS NOT NULL").join(originals, "original_txn_id", "left")
    return (
        linked.unionByName(refunds.where("original_txn_id IS NULL"), allowMissingColumns=True)
        .withColumn("orphan", F.col("_hit").isNull()).drop("_hit"))
