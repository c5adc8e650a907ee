"""Data behind the screens and the business questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwatch.functions.exprs import grid_cell, is_gmv, money, ratio, rounded_money, sum_if
from tillwatch.operators.quantiles import exact_percentiles, selected_percentiles
from tillwatch.operators.slices import slice_of
from tillwatch.plans import fraud
from tillwatch.plans.assumptions import per_scenario
from tillwatch.plans.merchant import roll_up


def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def spine(bounds: DataFrame, lo: str, hi: str, step: str, name: str) -> DataFrame:
    """Every step between the two columns of a one-row frame; its size depends on time only."""
    return bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi), F.expr(f"interval {step}"))).alias(name))


def zero_filled(counted: DataFrame, at: str, step: str, values: list[str]) -> DataFrame:
    """Add the missing steps between the first and the last one, with zeros."""
    bounds = counted.agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    return spine(bounds, "lo", "hi", step, at).join(counted, at, "left").fillna(0, values)


def kpi_minute(rows: DataFrame) -> DataFrame:
    """Volume, transactions and success rate per minute; an empty minute is zero."""
    gmv = is_gmv(F.col("status"), F.col("txn_type"))
    counted = rows.groupBy(F.window("event_ts", "1 minute").start.alias("minute")).agg(
        sum_if(gmv, F.col("amount_vnd")).alias("gmv"), F.count("*").alias("txns"),
        F.count_if(F.col("status") == "SUCCESS").alias("_ok"))
    return (
        zero_filled(counted, "minute", "1 minute", ["gmv", "txns", "_ok"])
        .withColumn("success_rate", ratio(F.col("_ok"), F.col("txns"))).drop("_ok"))


def alerts_per_minute(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy(minute_of(F.col("event_ts")).alias("minute"), "alert_type").agg(
        F.count("*").alias("alerts"))


def alert_feed(alerts: DataFrame, n: int = 50) -> DataFrame:
    """Newest alerts first."""
    return alerts.orderBy(F.desc("event_ts"), "alert_id").limit(n)


def geo_heatmap(rows: DataFrame, cell_degrees: float = 0.01) -> DataFrame:
    return rows.groupBy(
        grid_cell(F.col("location.lat"), cell_degrees).alias("lat_cell"),
        grid_cell(F.col("location.lon"), cell_degrees).alias("lon_cell"),
    ).agg(F.count("*").alias("txns"), F.sum("amount_vnd").alias("amount_vnd"))


def top_devices(alerts: DataFrame, n: int = 10) -> DataFrame:
    return (
        alerts.groupBy("device_hash").agg(F.count("*").alias("alerts"),
                                          F.max("event_ts").alias("last_alert"))
        .orderBy(F.desc("alerts"), "device_hash").limit(n))


def block_rate_hourly(decided: DataFrame) -> DataFrame:
    """Hourly block rate, the same hour one week earlier, and the last 24 counts as a sparkline."""
    hours = zero_filled(
        decided.groupBy(F.date_trunc("hour", "event_ts").alias("hour")).agg(
            F.count("*").alias("txns"), F.count_if(F.col("decision") == "BLOCK").alias("blocked")),
        "hour", "1 hour", ["txns", "blocked"],
    ).withColumn("block_rate", ratio(F.col("blocked"), F.col("txns")))
    week_ago = hours.select((F.col("hour") + F.expr("interval 7 days")).alias("hour"),
                            F.col("block_rate").alias("week_ago_rate"))
    # One row per hour: the ordered window is small whatever the number of transactions.
    last_day = W.orderBy("hour").rowsBetween(-23, 0)
    return (
        hours.join(week_ago, "hour", "left")
        .withColumn("delta", F.col("block_rate") - F.col("week_ago_rate"))
        .withColumn("sparkline", F.array_join(F.collect_list("blocked").over(last_day), ",")))


def _lags() -> tuple[Column, Column]:
    """Event-time lag and watermark lag of a row, in milliseconds."""
    return (F.col("arrived_ms") - F.col("event_ms"), F.col("arrived_ms") - F.col("watermark_ms"))


def stream_health(with_watermark: DataFrame, period_ms: int = 10_000) -> DataFrame:
    """Lag, disorder and rate per arrival period."""
    rows = with_watermark.withColumn("period", slice_of(F.col("arrived_ms"), period_ms))
    lag, wm_lag = _lags()
    rates = rows.groupBy("period").agg(
        F.count("*").alias("events"),
        F.avg(F.col("out_of_order").cast("int")).alias("out_of_order_rate"),
        F.avg(F.col("late").cast("int")).alias("late_rate"))
    event_lag = exact_percentiles(rows, ["period"], lag, {
        "event_lag_p50_ms": 0.5, "event_lag_p95_ms": 0.95, "event_lag_p99_ms": 0.99}).drop("n")
    watermark_lag = exact_percentiles(
        rows, ["period"], wm_lag, {"watermark_lag_p99_ms": 0.99}).drop("n")
    return (
        rates.join(event_lag, "period").join(watermark_lag, "period", "left")
        .select(
            F.timestamp_millis(F.col("period") * period_ms).alias("period_start"), "events",
            (F.col("events") / (period_ms / 1000)).alias("events_per_s"), "event_lag_p50_ms",
            "event_lag_p95_ms", "event_lag_p99_ms", "watermark_lag_p99_ms", "out_of_order_rate",
            "late_rate"))


def data_completeness(with_watermark: DataFrame) -> DataFrame:
    """Per day: is the data complete enough to be read."""
    rows = with_watermark.withColumn("date_day", F.col("dt"))
    rates = rows.groupBy("date_day").agg(
        F.count("*").alias("events"), F.avg(F.col("late").cast("int")).alias("late_rate"))
    lag = selected_percentiles(rows, ["date_day"], _lags()[1], {"watermark_lag_p99_ms": 0.99}).drop("n")
    return rates.join(lag, "date_day", "left")


def success_by_channel(rows: DataFrame) -> DataFrame:
    """Success rate per channel and day with the split of the failures by reason."""
    failed = F.col("status") == "FAILED"

    def share(reason: str) -> Column:
        return ratio(F.count_if(failed & (F.col("failure_reason") == reason)), F.count_if(failed))

    return rows.groupBy("channel", F.col("dt").alias("date_day")).agg(
        F.count("*").alias("txns"),
        ratio(F.count_if(F.col("status") == "SUCCESS"), F.count("*")).alias("success_rate"),
        share("INSUFFICIENT_FUND").alias("share_insufficient_fund"),
        share("CARD_DECLINED").alias("share_card_declined"),
        share("TIMEOUT").alias("share_timeout"))


def gmv_band(rows: DataFrame, as_of: str) -> DataFrame:
    """Volume per minute of a day against the median and p10-p90 of the last four same weekdays."""
    day = F.lit(as_of).cast("date")
    days = F.array(*[F.date_sub(day, 7 * w) for w in range(5)])
    per_minute = (
        rows.where(is_gmv(F.col("status"), F.col("txn_type")) & F.array_contains(days, F.col("dt")))
        .groupBy("dt", (F.hour("event_ts") * 60 + F.minute("event_ts")).cast("bigint").alias("minute_of_day"))
        .agg(F.sum("amount_vnd").alias("gmv")))
    grid = rows.sparkSession.range(1440).withColumnRenamed("id", "minute_of_day").withColumn(
        "dt", F.explode(days))
    filled = grid.join(per_minute, ["dt", "minute_of_day"], "left").fillna(0, ["gmv"])
    past = F.when(F.col("dt") < day, F.col("gmv"))
    return filled.groupBy("minute_of_day").agg(
        F.sum(F.when(F.col("dt") == day, F.col("gmv"))).alias("gmv"),
        F.percentile(past, F.lit(0.5)).alias("expected"),
        F.percentile(past, F.lit(0.1)).alias("p10"), F.percentile(past, F.lit(0.9)).alias("p90"),
    ).withColumn("below_band", F.col("gmv") < F.col("p10"))


def kpi_row(rows: DataFrame, merchant_fact: DataFrame, fraud_fact: DataFrame) -> DataFrame:
    """Five headline numbers per day, each with the change to the day before and a 30-day series."""
    base = rows.groupBy(F.col("dt").alias("date_day")).agg(
        ratio(F.count_if(F.col("status") == "SUCCESS"), F.count("*")).alias("success_rate"))
    margin = merchant_fact.groupBy("date_day").agg(
        F.sum("gmv").alias("gmv"),
        F.sum(F.col("net_revenue").cast("decimal(28,2)")).cast("double").alias("net_revenue"))
    saved = fraud_fact.groupBy("date_day").agg(
        F.sum(F.col("net_loss_prevented_vnd").cast("decimal(28,2)")).cast("double")
        .alias("net_fraud_prevented"))
    daily = (
        base.join(margin, "date_day", "left").join(saved, "date_day", "left")
        .withColumn("net_take_rate", ratio(F.col("net_revenue"), F.col("gmv"))))
    # One row per day: the ordered windows stay small.
    by_day = W.orderBy("date_day")
    last_30 = by_day.rowsBetween(-29, 0)
    names = ["gmv", "net_revenue", "net_take_rate", "success_rate", "net_fraud_prevented"]
    return daily.select(
        "date_day", *names,
        *[(F.col(n) - F.lag(n).over(by_day)).alias(f"{n}_delta") for n in names],
        F.array_join(F.collect_list("gmv").over(last_30), ",").alias("gmv_series"))


def indexed(series: DataFrame, by: str, at: str, value: str) -> DataFrame:
    """Index each series to 100 at its first row, so that different scales share one axis."""
    first = W.partitionBy(by).orderBy(at).rowsBetween(W.unboundedPreceding, W.currentRow)
    return series.withColumn("index_100", ratio(
        F.col(value) * 100, F.first(value).over(first)))


def shift_series(rows: DataFrame, alerts: DataFrame) -> DataFrame:
    """Hourly volume and hourly alerts as two series on one index."""
    hour = F.date_trunc("hour", "event_ts").alias("hour")
    gmv = rows.where(is_gmv(F.col("status"), F.col("txn_type"))).groupBy(hour).agg(
        F.sum("amount_vnd").alias("value")).withColumn("series", F.lit("GMV"))
    fired = alerts.groupBy(hour).agg(F.count("*").alias("value")).withColumn("series", F.lit("ALERTS"))
    return indexed(gmv.unionByName(fired), "series", "hour", "value").select(
        "series", "hour", "value", "index_100")


def rule_before_after(fraud_fact: DataFrame, deployed: str, min_coverage: float = 0.0) -> DataFrame:
    """Seven days from the deployment against the seven days before, same weekday by same weekday.

    The days before are moved a week ahead and counted negative, so the mart is read once.
    """
    start, values = F.lit(deployed).cast("date"), ("net_loss_prevented_vnd", "friction_cost_vnd")
    later = F.col("date_day") >= start
    daily = (
        fraud_fact.where(F.col("date_day").between(F.date_sub(start, 7), F.date_add(start, 6)))
        .groupBy("date_day", "rule_type").agg(
            *[F.sum(F.col(c).cast("decimal(28,2)")).alias(c) for c in values],
            F.avg("label_coverage_rate").alias("coverage"))
        .where(F.col("coverage") >= min_coverage))
    paired = daily.groupBy(
        F.when(later, F.col("date_day")).otherwise(F.date_add("date_day", 7)).alias("weekday"), "rule_type").agg(
        *[F.sum(F.coalesce(F.when(later, F.col(c)).otherwise(-F.col(c)), F.lit(0))).alias(c) for c in values])

    def delta(name: str) -> Column:
        return F.sum(name).cast("double")

    return (
        paired.groupBy("rule_type").agg(
            F.count("*").alias("weekday_pairs"),
            delta("net_loss_prevented_vnd").alias("delta_net_loss_prevented"),
            delta("friction_cost_vnd").alias("delta_friction_cost"))
        .withColumn("switch_off", F.col("delta_friction_cost") > F.col("delta_net_loss_prevented")))


def vip_wrongly_blocked(outcome: DataFrame, costs: DataFrame) -> DataFrame:
    """VIP users with blocked legitimate transactions and what the blocks cost, one row per user.

    The cost is the margin of the lost sales plus the expected value lost if the customer leaves.
    """
    counted = outcome.where("account_tier = 'VIP' AND decision = 'BLOCK' AND is_fraud_confirmed = false").groupBy(
        "user_id").agg(F.count("*").alias("fp_count"), F.sum("amount_vnd").alias("amount_vnd"))
    friction = (money(F.col("amount_vnd")) * F.col("c.gross_margin_rate")
                + money(F.col("fp_count")) * (F.col("c.vip_churn_risk") * F.col("c.vip_annual_value"))
                .cast("decimal(18,2)"))
    return per_scenario(counted, costs).select(
        "user_id", "fp_count", "amount_vnd", rounded_money(friction).alias("friction_cost_vnd"))


def card_testing_devices(alerts: DataFrame, attacks: DataFrame, decided: DataFrame) -> DataFrame:
    """Attacking devices by hash: chains, and the large transactions split into blocked and passed."""
    blocked = F.col("decision") == "BLOCK"
    return (
        alerts.where("alert_type = 'CARD_TESTING'").select("transaction_id", "device_hash")
        .join(attacks.select("transaction_id", "large_amount_vnd", "chain_len"), "transaction_id")
        .join(decided.select("transaction_id", "decision"), "transaction_id")
        .groupBy("device_hash").agg(
            F.count("*").alias("chains"), F.sum("chain_len").alias("test_transactions"),
            sum_if(blocked, F.col("large_amount_vnd")).alias("blocked_vnd"),
            sum_if(~blocked, F.col("large_amount_vnd")).alias("passed_vnd")))


def missed_by_segment(
    outcome: DataFrame, alerts: DataFrame, labels: DataFrame, industry: DataFrame,
) -> DataFrame:
    """Confirmed fraud without an alert per channel and industry."""
    return (
        fraud.missed_fraud(outcome, alerts, labels).join(industry, "merchant_id", "left")
        .groupBy("channel", "industry").agg(
            F.count("*").alias("missed"), F.sum("amount_vnd").alias("amount_vnd")))


def loss_making(merchant_fact: DataFrame, n: int = 20) -> DataFrame:
    """Merchants with a negative net take rate, largest volume first."""
    return (
        roll_up(merchant_fact, ["merchant_id", "industry"]).where("net_take_rate < 0")
        .orderBy(F.desc("gmv"), "merchant_id").limit(n))


def what_if(merchant_fact: DataFrame) -> DataFrame:
    """Net take rate per industry for every scenario and whether it turns negative."""
    return roll_up(merchant_fact, ["industry", "scenario"]).withColumn(
        "is_margin_negative", F.col("net_take_rate") < 0)


def points_reconciliation(emitted: DataFrame, recomputed: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Points the stream emitted against points computed again, per day."""
    left = emitted.groupBy("dt").agg(F.sum("points").alias("points_stream"))
    right = recomputed.groupBy("dt").agg(F.sum("points").alias("points_batch"))
    return (
        left.join(right, "dt", "full").fillna(0, ["points_stream", "points_batch"])
        .withColumn("difference", F.col("points_stream") - F.col("points_batch"))
        .withColumn("relative", ratio(F.abs("difference"), F.col("points_batch")))
        .withColumn("ok", F.coalesce(F.col("relative") < tolerance, F.col("difference") == 0)))


def layer_reconciliation(merchant_fact: DataFrame, silver: DataFrame) -> DataFrame:
    """Volume of Gold against volume of Silver per day, same definition on both sides."""
    gold = merchant_fact.groupBy(F.col("date_day").alias("dt")).agg(F.sum("gmv").alias("gold_gmv"))
    base = silver.groupBy("dt").agg(
        sum_if(is_gmv(F.col("status"), F.col("txn_type")), F.col("amount_vnd")).alias("silver_gmv"))
    return (
        gold.join(base, "dt", "full").fillna(0, ["gold_gmv", "silver_gmv"])
        .withColumn("difference", F.col("gold_gmv") - F.col("silver_gmv")))
