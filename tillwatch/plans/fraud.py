"""Fraud economics: alerts, outcomes against labels, and the daily fraud mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwatch.functions.exprs import money, ratio, rounded_money, sum_if
from tillwatch.plans.assumptions import per_scenario

GRAIN = ["date_day", "rule_type", "account_tier", "channel"]


def alert_stream(decided: DataFrame, card: DataFrame, travel: DataFrame) -> DataFrame:
    """Alerts of the rule engine and of both detectors with one schema."""

    def alerts(rows: DataFrame, kind: str, severity: str) -> DataFrame:
        return rows.select(
            F.concat(F.lit(kind + ":"), F.col("transaction_id")).alias("alert_id"),
            F.lit(kind).alias("alert_type"), F.lit(severity).alias("severity"),
            "transaction_id", "user_id", "device_id", "event_ts")

    return (
        alerts(decided.where("decision = 'BLOCK'"), "RULE_BLOCK", "MEDIUM")
        .unionByName(alerts(card, "CARD_TESTING", "CRITICAL"))
        .unionByName(alerts(travel, "IMPOSSIBLE_TRAVEL", "MEDIUM")))


def detector_flags(card: DataFrame, travel: DataFrame) -> DataFrame:
    both = (card.select("transaction_id", F.lit(True).alias("ct"), F.lit(False).alias("it"))
            .unionByName(travel.select("transaction_id", F.lit(False).alias("ct"),
                                       F.lit(True).alias("it"))))
    return both.groupBy("transaction_id").agg(F.max("ct").alias("ct"), F.max("it").alias("it"))


def outcomes(decided: DataFrame, card: DataFrame, travel: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per transaction: what the system said, and the label when it has arrived."""
    ruled = F.when(F.col("decision").isin("BLOCK", "ALERT", "REVIEW"), F.col("rule_type"))
    kinds = F.array_compact(F.array(
        ruled, F.when(F.col("ct"), F.lit("CARD_TESTING")), F.when(F.col("it"), F.lit("IMPOSSIBLE_TRAVEL"))))
    return (
        decided.select(
            "transaction_id", "user_id", "merchant_id", "channel", "status", "txn_type", "dt",
            "event_ts", "amount_vnd", "decision", "rule_type",
            F.coalesce("account_tier", F.lit("UNKNOWN")).alias("account_tier"))
        .join(detector_flags(card, travel), "transaction_id", "left")
        .join(labels.select("transaction_id", "is_fraud_confirmed", "label_source", "resolved_at"),
              "transaction_id", "left")
        .withColumn("kinds", kinds)
        .withColumn("flagged", F.size("kinds") > 0)
        .drop("ct", "it")
    )


def _fraud() -> Column:
    return F.coalesce(F.col("is_fraud_confirmed"), F.lit(False))


def _legit() -> Column:
    return F.coalesce(~F.col("is_fraud_confirmed"), F.lit(False))


def confusion(rows: DataFrame, by: list[str]) -> DataFrame:
    """TP, FP, FN, TN over labelled transactions, with the three rates."""
    seen = F.col("flagged")
    counted = rows.groupBy(*by).agg(
        F.count_if(seen & _fraud()).alias("tp"), F.count_if(seen & _legit()).alias("fp"),
        F.count_if(~seen & _fraud()).alias("fn"), F.count_if(~seen & _legit()).alias("tn"))
    return with_rates(counted)


def with_rates(counted: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counted.withColumns({
        "false_positive_rate": ratio(fp, fp + tp),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn)})


def fct_fraud_performance(outcome: DataFrame, costs: DataFrame) -> DataFrame:
    """Grain: day x rule type x tier x channel; what no detector saw sits in rule type NONE.

    Recall needs the missed fraud, which has no rule type: it is computed per day x tier x channel
    over distinct transactions and repeated on the rows of that group.
    """
    kinds = F.when(F.col("flagged"), F.col("kinds")).otherwise(F.array(F.lit("NONE")))
    seen = F.col("kind") != "NONE"
    own_rule = F.col("kind") == F.col("rule_type")
    blocked = own_rule & (F.col("decision") == "BLOCK")
    vip = F.col("account_tier") == "VIP"
    counted = (
        outcome.select("*", F.posexplode(kinds).alias("pos", "kind")).withColumn("date_day", F.col("dt"))
        .groupBy("date_day", F.col("kind").alias("rule_type"), "account_tier", "channel")
        .agg(
            F.count_if(seen).alias("alerts_fired"),
            F.count_if(blocked).alias("txns_blocked"),
            F.count_if(seen & _fraud()).alias("tp"),
            F.count_if(seen & _legit()).alias("fp"),
            F.count_if(~seen & _fraud()).alias("fn"),
            F.count_if(seen & _fraud() & (F.col("pos") == 0)).alias("_tp_txns"),
            F.count_if(seen & _legit() & vip).alias("_fp_vip"),
            F.count_if(own_rule & (F.col("decision") == "REVIEW")).alias("_reviews"),
            sum_if(blocked & _fraud(), F.col("amount_vnd")).alias("gross_fraud_blocked_vnd"),
            sum_if(seen & _legit(), F.col("amount_vnd")).alias("_fp_vnd"),
            sum_if(~seen & _fraud(), F.col("amount_vnd")).alias("_leaked_vnd"),
            F.count("*").alias("_rows"), F.count("is_fraud_confirmed").alias("_labelled")))
    cell = W.partitionBy("date_day", "account_tier", "channel")
    tp_txns, fn_txns = F.sum("_tp_txns").over(cell), F.sum("fn").over(cell)
    friction = (money(F.col("_fp_vnd")) * F.col("c.gross_margin_rate")
                + money(F.col("_fp_vip")) * (F.col("c.vip_churn_risk") * F.col("c.vip_annual_value"))
                .cast("decimal(18,2)"))
    rated = with_rates(counted).withColumn("recall", ratio(tp_txns, tp_txns + fn_txns))
    return (
        per_scenario(rated, costs)
        .withColumn("_friction", friction)
        .withColumn("_net",
                    money(F.col("gross_fraud_blocked_vnd")) * F.col("c.prevention_efficacy")
                    - F.col("_leaked_vnd") - F.col("_friction")
                    - money(F.col("_reviews")) * F.col("c.review_cost_per_case"))
        .select(
            *GRAIN, "alerts_fired", "txns_blocked", "tp", "fp", "fn", "false_positive_rate",
            "precision", "recall", "gross_fraud_blocked_vnd",
            rounded_money(F.col("_friction")).alias("friction_cost_vnd"),
            rounded_money(F.col("_net")).alias("net_loss_prevented_vnd"),
            ratio(F.col("_labelled"), F.col("_rows")).alias("label_coverage_rate"), "scenario")
    )


def label_coverage(outcome: DataFrame) -> DataFrame:
    """Share of labelled transactions per day; immature below 80 %."""
    return (
        outcome.groupBy(F.col("dt").alias("date_day"))
        .agg(F.count("*").alias("txns"), F.count("is_fraud_confirmed").alias("labelled"))
        .withColumn("label_coverage_rate", ratio(F.col("labelled"), F.col("txns")))
        .withColumn("mature", F.col("label_coverage_rate") >= 0.8))


def missed_fraud(outcome: DataFrame, alerts: DataFrame, labels: DataFrame) -> DataFrame:
    """Confirmed fraud for which no alert exists."""
    confirmed = labels.where("is_fraud_confirmed")
    return (
        confirmed.join(alerts.select("transaction_id"), "transaction_id", "left_anti")
        .select("transaction_id", "label_source")
        .join(outcome.select("transaction_id", "merchant_id", "channel", "amount_vnd", "dt"),
              "transaction_id"))


def recall_by_scenario(injected: DataFrame, alerts: DataFrame) -> DataFrame:
    """Detector evaluation: an injected attack is found when any of its transactions has an alert."""
    ids = injected.select(
        "fraud_type", F.col("transaction_ids")[0].alias("attack"),
        F.explode("transaction_ids").alias("transaction_id"))
    found = alerts.select("transaction_id").distinct().withColumn("_hit", F.lit(1))
    return (
        ids.join(found, "transaction_id", "left")
        .groupBy("fraud_type", "attack").agg(F.max("_hit").alias("hit"))
        .groupBy("fraud_type")
        .agg(F.count("*").alias("attacks"), F.count("hit").alias("detected"))
        .withColumn("recall", ratio(F.col("detected"), F.col("attacks"))))


def lineage(
    payments: DataFrame, alerts: DataFrame, silver: DataFrame, outcome: DataFrame,
) -> DataFrame:
    """Which of the six stages each transaction reached: topic, alert, feed, Bronze, Silver, mart."""
    stages = [
        (payments, "in_topic"), (alerts, "in_alerts"), (alerts.where("severity = 'CRITICAL'"), "in_feed"),
        (payments.where("dt IS NOT NULL"), "in_bronze"),
        (silver.where("device_hash IS NOT NULL"), "in_silver"), (outcome, "in_mart")]
    names = [name for _, name in stages]
    rows = None
    for df, name in stages:
        part = df.select("transaction_id", *[F.lit(n == name).alias(n) for n in names])
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("transaction_id").agg(*[F.max(n).alias(n) for n in names])
