"""Registered batch queries: one entry per operator, data test, business question and panel."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch import schemas
from tillwatch.context import Context
from tillwatch.functions.exprs import (
    device_hash, event_time, experiment_group, is_gmv, iso_millis, mask_ip, ratio,
)
from tillwatch.operators import arrival, enrich, latest, panes, points, retries, slices
from tillwatch.operators import card_testing as card
from tillwatch.operators.rules import active_rules, decide, matches_by_type
from tillwatch.plans import fraud, lifecycle, loyalty, merchant, quality, screens
from tillwatch.plans.refresh import refresh_days, touched_days
from tillwatch.plans.silver import clean, merge_late, protect
from tillwatch.sources import changelog, files, seeds
from tillwatch.sources.manifest import DatedTable
from tillwatch.testbed import LIFECYCLE_AS_OF, SALT

QUERIES: dict[str, Callable[[Context], DataFrame]] = {}

AS_OF = LIFECYCLE_AS_OF
WEEK_BEFORE = "2024-06-24"
LAST_WEEK = ["2024-06-24", "2024-06-25", "2024-06-26", "2024-06-27", "2024-06-28", "2024-06-29",
             "2024-06-30", "2024-07-01"]
BAND_DAY = "2024-01-29"
PROGRAMME_START = "2024-01-08"
DEPLOYED = "2024-01-15"


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


# ---- sources -----------------------------------------------------------------------------------

@query("s3_parse_json")
def _(c: Context):
    good, bad = files.parse_events(c.tb.raw_payments, schemas.PAYMENT_EVENT)
    return (
        good.select("dt", F.lit(0).alias("bad")).unionByName(bad.select("dt", F.lit(1).alias("bad")))
        .groupBy("dt").agg(F.count_if(F.col("bad") == 0).alias("parsed"), F.sum("bad").alias("quarantined")))


@query("s5_bronze_layout")
def _(c: Context):
    """Bronze landed in three commits of small files, then compacted; rows and files come from the new manifest."""
    rows = c.tb.payments
    bronze = DatedTable(c.spark, c.scratch("bronze"), rows.schema)
    for third in range(3):
        bronze.append(rows.where(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == third))
    bronze.compact()
    of_day = bronze.files().groupBy("dt").agg(F.count("*").alias("files"), F.sum("rows").alias("rows_in_files"))
    return bronze.read().groupBy("dt").agg(F.count("*").alias("rows"), F.sum("amount").alias("amount")).join(of_day, "dt")


@query("s9_lake_scan")
def _(c: Context):
    path = files.write_bronze(c.tb.payments, c.scratch("lake"))
    return (
        files.lake_scan(c.spark, path, "2024-01-05", "2024-01-08")
        .groupBy("dt", "channel").agg(F.count("*").alias("rows"), F.sum("amount").alias("amount")))


@query("s10_seed_scan")
def _(c: Context):
    folder = c.scratch("seeds")
    seeds.save(c.seeds, folder)
    s = seeds.load(c.spark, folder)
    return (
        c.tb.payments.join(s.fx_rate.withColumnRenamed("date", "dt"), ["dt", "currency"])
        .join(s.merchant_industry, "merchant_id").join(s.take_rate, "industry")
        .join(s.interchange_rate, "channel")
        .groupBy("industry", "channel").agg(
            F.count("*").alias("rows"), F.max("take_rate").alias("take_rate"),
            F.max("rate").alias("interchange_rate"), F.max("rate_to_vnd").alias("max_fx")))


@query("s11_cdc_scan")
def _(c: Context):
    changes = changelog.unwrap(c.tb.raw_profile_changes, schemas.USER_PROFILE, "user_id")
    return changelog.current(changes, "user_id")


@query("s12_compacted_profiles")
def _(c: Context):
    flat = c.tb.raw_profile_changes.select(
        F.coalesce(F.get_json_object("value", "$.after"), F.get_json_object("value", "$.before"))
        .alias("value"))
    rows = changelog.unwrap(flat, schemas.USER_PROFILE, "user_id")
    return changelog.current(rows, "user_id").select("user_id", "account_tier", "kyc_status", "updated_at")


@query("s13_ground_truth")
def _(c: Context):
    folder = c.scratch("truth")
    c.tb.injected.withColumn("injected_at", iso_millis(F.col("injected_at"))).write.json(folder)
    return files.ground_truth(c.spark, folder).select("fraud_type", "transaction_id")


@query("s14_rules_source")
def _(c: Context):
    return active_rules(c.tb.rule_changes).select(
        "rule_id", "version", "priority", "action", "max_amount_vnd")


@query("s15_fraud_labels")
def _(c: Context):
    return (
        c.wh.facts.select("transaction_id", "event_ts").join(c.wh.labels, "transaction_id")
        .groupBy("label_source", F.datediff("resolved_at", "event_ts").alias("delay_days"))
        .agg(F.count("*").alias("labels"), F.count_if("is_fraud_confirmed").alias("confirmed")))


@query("s15_redemptions")
def _(c: Context):
    return c.wh.redemptions.groupBy("user_id").agg(
        F.count("*").alias("redemptions"), F.sum("points_spent").alias("points_spent"))


# ---- projections and predicates ----------------------------------------------------------------

@query("p1_event_time")
def _(c: Context):
    text = F.get_json_object("value", "$.timestamp")
    return c.tb.raw_payments.select(
        F.get_json_object("value", "$.transaction_id").alias("transaction_id"),
        F.unix_millis(event_time(text)).alias("event_ms"), "ingested_at").where("event_ms IS NOT NULL")


@query("p2_profile_projection")
def _(c: Context):
    return changelog.public_profile(c.tb.profile_changes)


@query("p3_enrich_projection")
def _(c: Context):
    return _enriched_once(c).select(
        "transaction_id", "account_tier", "kyc_status", "risk_score_baseline", "profile_missing")


@query("p4_serialise")
def _(c: Context):
    return _enriched_once(c).select("transaction_id", F.to_json(F.struct(
        "transaction_id", "account_tier", "kyc_status", "risk_score_baseline", "profile_missing")).alias("value"))


def _enriched_once(c: Context) -> DataFrame:
    return enrich.enrich(c.wh.facts, c.wh.profiles)


def _rule_hits(c: Context, rules: DataFrame):
    return (
        decide(_enriched_once(c), rules).where("rule_id IS NOT NULL")
        .groupBy("rule_id", "rule_type", "decision").agg(F.count("*").alias("txns")))


@query("p5_scope_match")
def _(c: Context):
    scoped = c.wh.rules.where("scope IS NOT NULL")
    return _rule_hits(c, scoped)


@query("p6_rule_active")
def _(c: Context):
    return _rule_hits(c, c.wh.rules.where("rule_id IN ('R-014', 'R-030', 'R-070')"))


@query("p7_rule_predicates")
def _(c: Context):
    return matches_by_type(_enriched_once(c), c.wh.rules).groupBy("rule_id", "rule_type", "decision").agg(
        F.count("*").alias("txns"))


@query("p8_device_hash")
def _(c: Context):
    return c.tb.payments.groupBy(device_hash(F.col("device_id"), SALT).alias("device_hash")).agg(
        F.count("*").alias("rows"))


@query("p9_ip_mask")
def _(c: Context):
    return c.tb.payments.groupBy(mask_ip(F.col("ip_address")).alias("ip_network")).agg(
        F.count("*").alias("rows"))


@query("p10_loyalty_eligible")
def _(c: Context):
    return c.wh.decided.where(points.earns_points()).groupBy("dt").agg(
        F.count("*").alias("txns"), F.sum("amount_vnd").alias("amount_vnd"))


@query("p11_margin_negative")
def _(c: Context):
    return c.wh.fct_merchant_profitability.where("is_margin_negative").select(
        "date_day", "merchant_id", "net_revenue", "net_take_rate")


@query("p12_kyc_abuse")
def _(c: Context):
    return (
        decide(_enriched_once(c), c.wh.rules.where("rule_id = 'R-001'")).where("decision = 'BLOCK'")
        .select("transaction_id", "user_id", "amount_vnd", "rule_id"))


@query("p13_vip")
def _(c: Context):
    return _enriched_once(c).where("account_tier = 'VIP'").groupBy("user_id").agg(
        F.count("*").alias("txns"), F.sum("amount_vnd").alias("amount_vnd"))


@query("p14_holdout")
def _(c: Context):
    return c.tb.payments.select("user_id").distinct().select(
        "user_id", experiment_group(F.col("user_id")).alias("experiment_group"))


# ---- joins -------------------------------------------------------------------------------------

@query("j1_enrich")
def _(c: Context):
    return _enriched_once(c).select(
        "transaction_id", "user_id", "event_ts", "amount_vnd", *enrich.PROFILE_COLUMNS, "profile_missing")


@query("j2_enrich_as_of")
def _(c: Context):
    return enrich.enrich_as_of(c.wh.facts, c.tb.profile_changes).select(
        "transaction_id", "user_id", "event_ts", "amount_vnd", *enrich.PROFILE_COLUMNS, "profile_missing")


@query("j3_rule_join")
def _(c: Context):
    # compile_limit 0 forces the joined form
    return decide(c.wh.enriched, c.wh.rules, compile_limit=0).select(
        "transaction_id", "decision", "rule_id", "rule_type")


@query("j4_fx")
def _(c: Context):
    return c.wh.clean.select("transaction_id", "dt", "currency", "amount", "rate_to_vnd", "amount_vnd")


@query("j5_seed_joins")
def _(c: Context):
    s = c.seeds
    return (
        c.wh.facts.join(s.merchant_industry, "merchant_id", "left").join(s.take_rate, "industry", "left")
        .join(s.interchange_rate, "channel", "left")
        .groupBy("industry", "channel", "take_rate", F.col("rate").alias("interchange_rate"))
        .agg(F.count("*").alias("txns"), F.sum("amount_vnd").alias("amount_vnd")))


def _scenario_fact(c: Context) -> DataFrame:
    return merchant.fct_merchant_profitability(
        c.wh.facts, c.wh.labels, c.seeds.with_costs(seeds.costs(c.spark, seeds.WHAT_IF)))


@query("j6_scenarios")
def _(c: Context):
    return _scenario_fact(c).select(
        "date_day", "merchant_id", "industry", "scenario", "processing_cost", "net_revenue")


@query("j7_alerts_labels")
def _(c: Context):
    return c.wh.outcomes.select(
        "transaction_id", "account_tier", "decision", "flagged",
        F.array_join("kinds", ",").alias("kinds"), "is_fraud_confirmed", "label_source")


@query("j8_missed_fraud")
def _(c: Context):
    return fraud.missed_fraud(c.wh.outcomes, c.wh.alerts, c.wh.labels)


@query("j9_fp_proxy")
def _(c: Context):
    return retries.blocked_then_retried(c.wh.decided)


@query("j10_refund_links")
def _(c: Context):
    return merchant.refund_links(c.wh.facts)


@query("j11_relationships")
def _(c: Context):
    return quality.unrelated(c.wh.facts, c.wh.profiles, "user_id")


@query("j12_layer_reconciliation")
def _(c: Context):
    return screens.layer_reconciliation(c.wh.merchant_margin(c.wh.facts), c.wh.facts)


@query("j13_detector_recall")
def _(c: Context):
    return fraud.recall_by_scenario(c.tb.injected, c.wh.alerts)


@query("j14_lineage")
def _(c: Context):
    return fraud.lineage(c.tb.payments, c.wh.alerts, protect(c.wh.facts, SALT), c.wh.outcomes)


# ---- aggregations ------------------------------------------------------------------------------

@query("a1_confusion_matrix")
def _(c: Context):
    return fraud.confusion(c.wh.outcomes, []).select("tp", "fp", "fn", "tn")


@query("a2_rates")
def _(c: Context):
    return fraud.confusion(c.wh.outcomes, ["account_tier", "channel"])


@query("a3_friction_cost")
def _(c: Context):
    return c.wh.fct_fraud_performance.groupBy("account_tier").agg(
        F.sum("fp").alias("fp"),
        F.sum(F.col("friction_cost_vnd").cast("decimal(28,2)")).alias("friction_cost_vnd"))


@query("a4_net_loss_prevented")
def _(c: Context):
    return c.wh.fct_fraud_performance.groupBy("rule_type").agg(
        F.sum("gross_fraud_blocked_vnd").alias("gross_fraud_blocked_vnd"),
        F.sum(F.col("net_loss_prevented_vnd").cast("decimal(28,2)")).alias("net_loss_prevented_vnd"))


@query("a5_label_coverage")
def _(c: Context):
    return fraud.label_coverage(c.wh.outcomes)


@query("a6_fraud_performance")
def _(c: Context):
    return c.wh.fct_fraud_performance


@query("a7_incremental_lift")
def _(c: Context):
    return loyalty.lift(loyalty.group_totals(c.wh.loyalty_users, ["account_tier"]), ["account_tier"],
                        c.seeds.cost_assumptions).select(
        "account_tier", "active_users_t", "active_users_c", "arpu_t", "arpu_c", "incremental_lift",
        "incremental_revenue")


@query("a8_program_roi")
def _(c: Context):
    return loyalty.lift(loyalty.group_totals(c.wh.loyalty_users, []), [],
                        c.seeds.cost_assumptions).select(
        "points_issued_t", "points_issued_c", "point_cost", "program_roi")


@query("a9_liability")
def _(c: Context):
    return loyalty.liability(c.wh.loyalty_users, c.wh.redeemed, ["account_tier"], c.seeds.cost_assumptions)


@query("a10_loyalty_analytics")
def _(c: Context):
    return c.wh.fct_loyalty_analytics


@query("a11_holdout_balance")
def _(c: Context):
    return loyalty.holdout_balance(c.wh.loyalty_users, PROGRAMME_START)


@query("a12_roi_interval")
def _(c: Context):
    return loyalty.roi_interval(c.wh.loyalty_users, c.seeds.cost_assumptions)


@query("a13_merchant_profitability")
def _(c: Context):
    return c.wh.fct_merchant_profitability


@query("a14_chargeback_penalty")
def _(c: Context):
    return (
        merchant.channel_days(c.wh.facts, c.wh.labels)
        .groupBy("merchant_id").agg(F.sum("chargeback_count").alias("chargebacks"),
                                    F.sum("chargeback_amount").alias("chargeback_amount"))
        .where("chargebacks > 0"))


@query("a15_lifecycle_features")
def _(c: Context):
    return lifecycle.features(c.history, [AS_OF])


@query("a16_population_p80")
def _(c: Context):
    return lifecycle.population_p80(lifecycle.features(c.history, [WEEK_BEFORE, AS_OF]))


@query("a17_customer_lifecycle")
def _(c: Context):
    return lifecycle.states(c.history, c.wh.suspended, [AS_OF]).select(
        "user_id", "state", "days_silent", "silence_ratio", "txn_count_30d", "txn_count_90d", "gmv_30d")


def _two_weeks(c: Context) -> DataFrame:
    return lifecycle.states(c.history, c.wh.suspended, [WEEK_BEFORE, AS_OF])


@query("a18_transitions")
def _(c: Context):
    return lifecycle.transitions(_two_weeks(c), WEEK_BEFORE, AS_OF)


def _watermarked(c: Context) -> DataFrame:
    return c.stage(arrival.with_arrival_watermark(c.tb.payments), "watermarked")


@query("a19_stream_health")
def _(c: Context):
    return screens.stream_health(_watermarked(c))


@query("a20_kpi_minute")
def _(c: Context):
    return screens.kpi_minute(c.wh.facts)


@query("a21_alerts_per_minute")
def _(c: Context):
    return screens.alerts_per_minute(c.wh.alerts)


@query("a22_geo_heatmap")
def _(c: Context):
    return screens.geo_heatmap(c.wh.facts)


@query("a23_success_by_channel")
def _(c: Context):
    return screens.success_by_channel(c.wh.facts)


@query("a24_block_rate")
def _(c: Context):
    return screens.block_rate_hourly(c.wh.decided)


@query("a25_gmv_band")
def _(c: Context):
    return screens.gmv_band(c.wh.facts, BAND_DAY)


@query("a26_cost_waterfall")
def _(c: Context):
    return merchant.waterfall(c.wh.fct_merchant_profitability)


@query("a27_card_testing_economics")
def _(c: Context):
    return screens.card_testing_devices(c.wh.alerts, c.wh.card_testing, c.wh.decided)


@query("a28_kpi_row")
def _(c: Context):
    return screens.kpi_row(c.wh.facts, c.wh.merchant_margin(c.wh.facts), c.wh.fct_fraud_performance)


@query("a29_index_100")
def _(c: Context):
    return screens.shift_series(c.wh.facts, c.wh.alerts)


# ---- windows -----------------------------------------------------------------------------------

@query("w1_dedup")
def _(c: Context):
    return latest.dedup(c.tb.payments).select(
        "transaction_id", "user_id", "amount", "currency", "event_ts", "ingested_at", "status")


@query("w2_impossible_travel")
def _(c: Context):
    return c.wh.travel.select("transaction_id", "user_id", "event_ts", "prev_transaction_id",
                              F.round("km", 3).alias("km"), "gap_ms")


@query("w3_gaps")
def _(c: Context):
    return lifecycle.gaps(c.history).groupBy("user_id").agg(
        F.count("*").alias("gaps"), F.sum("gap_ms").alias("total_ms"), F.max("gap_ms").alias("longest_ms"))


@query("w4_trailing_15m")
def _(c: Context):
    return c.wh.points.where("eligible").select("transaction_id", "user_id", "event_ts", "total_15m")


@query("w5_card_testing")
def _(c: Context):
    return c.wh.card_testing


@query("w5_card_testing_evidence")
def _(c: Context):
    return card.card_testing_evidence(c.wh.facts)


@query("w6_lifecycle_history")
def _(c: Context):
    return lifecycle.history(lifecycle.states(c.history, c.wh.suspended, LAST_WEEK))


@query("w6_history_by_day")
def _(c: Context):
    """The same history, one day after the other merged into the written table."""
    suspended = c.stage(c.wh.suspended, "suspended")
    # gaps and days of activity are worked out once for all days that are merged
    states = c.stage(lifecycle.states(c.history, suspended, LAST_WEEK), "states")
    opened = states.select("user_id", "state", *lifecycle.OPENED, F.col("as_of").alias("dt"))
    table = DatedTable(c.spark, c.scratch("lifecycle"), opened.schema)
    for day in LAST_WEEK:
        lifecycle.merge_day(table, states, date.fromisoformat(day))
    return lifecycle.written_history(table)


@query("w7_points_overspent")
def _(c: Context):
    return quality.overspent(c.wh.points, c.wh.redemptions)


@query("w8_rule_before_after")
def _(c: Context):
    return screens.rule_before_after(c.wh.fct_fraud_performance, DEPLOYED)


@query("w9_arrival_watermark")
def _(c: Context):
    return arrival.with_arrival_watermark(c.tb.payments, by=["src_partition"]).select(
        "transaction_id", "ingested_at", "src_partition", "max_seen_ms", "out_of_order", "late")


# ---- top-k and set operations ------------------------------------------------------------------

@query("t1_alert_feed")
def _(c: Context):
    return screens.alert_feed(c.wh.alerts)


@query("t2_top_devices")
def _(c: Context):
    return screens.top_devices(c.wh.alerts)


@query("t3_loss_making")
def _(c: Context):
    return screens.loss_making(c.wh.fct_merchant_profitability, 10)


def _slipping(c: Context) -> DataFrame:
    return lifecycle.moves(_two_weeks(c), WEEK_BEFORE, AS_OF).where(
        "state_from = 'HIGHLY_ACTIVE' AND state_to = 'AT_RISK'")


@query("t4_churn_risk")
def _(c: Context):
    return lifecycle.moves(_two_weeks(c), WEEK_BEFORE, AS_OF).where("state_to = 'AT_RISK'").orderBy(
        F.desc("gmv_30d_before"), "user_id")


def _ordered_transitions(c: Context) -> DataFrame:
    slip = (F.col("state_from") == "HIGHLY_ACTIVE") & (F.col("state_to") == "AT_RISK")
    return (
        lifecycle.transitions(_two_weeks(c), WEEK_BEFORE, AS_OF)
        .withColumn("highlight", slip).orderBy(F.desc("highlight"), "state_from", "state_to"))


@query("t5_transition_table")
def _(c: Context):
    return _ordered_transitions(c)


@query("u1_merge_late")
def _(c: Context):
    marked = _watermarked(c).select(*c.tb.payments.columns, "late")
    merged = merge_late(marked.where("NOT late").drop("late"), marked.where("late"))
    return clean(merged, c.seeds.fx_rate).groupBy("dt").agg(
        F.count("*").alias("txns"), F.count("late").alias("late_txns"),
        F.sum("amount_vnd").alias("amount_vnd"))


@query("u2_alert_stream")
def _(c: Context):
    return c.wh.alerts


# ---- batch twins of streaming operators --------------------------------------------------------

@query("x4_late_classification")
def _(c: Context):
    return _watermarked(c).select(
        "transaction_id", "event_ts", "ingested_at", "max_seen_ms", "out_of_order", "late")


@query("x7_rules_not_ready")
def _(c: Context):
    return decide(_enriched_once(c), c.wh.rules.where("false")).groupBy("decision", "rules_not_ready").agg(
        F.count("*").alias("txns"))


@query("x8_rule_engine")
def _(c: Context):
    return c.wh.decided.select(
        "transaction_id", "user_id", "event_ts", "amount_vnd", "decision", "rule_id", "rule_type",
        "rules_not_ready")


@query("x11_loyalty_points")
def _(c: Context):
    return c.wh.points.where("eligible").select(
        "transaction_id", "user_id", "amount_vnd", "total_15m", "multiplier", "points")


@query("x12_sliding_sums")
def _(c: Context):
    return panes.sliding_from_panes(panes.panes_of(c.wh.decided.where(points.earns_points())))


# ---- data tests --------------------------------------------------------------------------------

@query("qa_unique_bronze")
def _(c: Context):
    return quality.not_unique(c.tb.payments, "transaction_id")


@query("qa_unique_silver")
def _(c: Context):
    return quality.not_unique(c.wh.silver, "transaction_id")


@query("qa_not_null")
def _(c: Context):
    return quality.is_null(_enriched_once(c), ["transaction_id", "user_id", "amount_vnd", "account_tier"])


@query("qb_accepted_values")
def _(c: Context):
    rows = enrich.enrich(clean(c.tb.unruly_payments, c.seeds.fx_rate), c.wh.profiles)
    return quality.not_accepted(rows, {
        "status": schemas.STATUSES, "channel": schemas.CHANNELS, "account_tier": schemas.TIERS})


@query("qb_lifecycle_states")
def _(c: Context):
    return quality.not_accepted(
        lifecycle.states(c.history, c.wh.suspended, [AS_OF]), {"state": schemas.LIFECYCLE_STATES})


@query("qc_relationships")
def _(c: Context):
    return quality.unrelated(c.wh.fct_merchant_profitability, c.seeds.merchant_industry, "merchant_id")


@query("qd_merchant_invariants")
def _(c: Context):
    return quality.merchant_invariants(c.wh.fct_merchant_profitability).select(
        "date_day", "merchant_id", "gmv", "refund_amount", "gross_revenue", "net_revenue")


@query("qe_fpr_range")
def _(c: Context):
    return quality.violating(
        c.wh.fct_fraud_performance, F.col("false_positive_rate").between(0, 1)).select(*fraud.GRAIN)


@query("qf_gmv_mismatch")
def _(c: Context):
    return quality.gmv_mismatch(c.wh.merchant_margin(c.wh.facts), c.wh.facts)


@query("a13_refreshed_by_late_rows")
def _(c: Context):
    """The merchant mart written before the late rows came: the data test finds its days, and only theirs are rewritten."""
    marked, silver = _watermarked(c), c.wh.facts
    early = clean(marked.where("NOT late").select(*c.tb.payments.columns), c.seeds.fx_rate)
    mart = c.wh.merchant_margin(early).withColumn("dt", F.col("date_day"))
    table = DatedTable(c.spark, c.scratch("merchant_mart"), mart.schema)
    first = table.append(mart)
    wrong = c.stage(quality.gmv_mismatch(table.read(), silver).select("dt", F.col("gold_gmv").alias("gold_gmv_before")), "wrong")
    refresh_days(table, touched_days(marked.where("late"), silver), lambda days: c.wh.merchant_margin(
        silver.where(F.col("dt").isin(days))).withColumn("dt", F.col("date_day")))
    rewritten = table.files().groupBy("dt").agg((F.max("commit") > first).alias("rewritten"))
    return (
        screens.layer_reconciliation(table.read(), silver).join(rewritten, "dt", "left")
        .join(wrong.withColumn("was_wrong", F.lit(True)), "dt", "left").fillna(False, ["was_wrong"]))


def _stream_points(c: Context) -> DataFrame:
    """Points as the stream would emit them: only rows that were on time when they arrived."""
    on_time = _watermarked(c).where("NOT late").select(*c.tb.payments.columns)
    wh = c.wh
    rows = c.stage(clean(on_time, c.seeds.fx_rate), "on_time")
    decided = decide(enrich.enrich(rows, wh.profiles), wh.rules)
    return points.loyalty_points(decided.withColumn("experiment_group", loyalty.group_of_user()))


@query("qg_points_reconciliation")
def _(c: Context):
    return screens.points_reconciliation(_stream_points(c), c.wh.points)


@query("qh_freshness")
def _(c: Context):
    return quality.stale(c.tb.payments, "2024-01-31 12:00:00")


@query("q_holdout_contamination")
def _(c: Context):
    return quality.wrong_group(c.wh.silver, experiment_group(F.col("user_id")))


# ---- business questions ------------------------------------------------------------------------

@query("q1_rule_worth")
def _(c: Context):
    return screens.rule_before_after(c.wh.fct_fraud_performance, DEPLOYED, min_coverage=0.3)


@query("q2_vip_wrongly_blocked")
def _(c: Context):
    return screens.vip_wrongly_blocked(c.wh.outcomes, c.seeds.cost_assumptions)


@query("q3_card_testing_devices")
def _(c: Context):
    return screens.card_testing_devices(c.wh.alerts, c.wh.card_testing, c.wh.decided).orderBy(
        F.desc("blocked_vnd"), F.desc("passed_vnd"), "device_hash")


@query("q4_missed_fraud")
def _(c: Context):
    return screens.missed_by_segment(
        c.wh.outcomes, c.wh.alerts, c.wh.labels, c.seeds.merchant_industry)


@query("q5_loss_making")
def _(c: Context):
    return screens.loss_making(c.wh.fct_merchant_profitability, 20)


@query("q6_travel_margin")
def _(c: Context):
    return merchant.waterfall(c.wh.fct_merchant_profitability).where("industry = 'Travel'")


@query("q7_cost_what_if")
def _(c: Context):
    return screens.what_if(_scenario_fact(c))


@query("q8_success_drift")
def _(c: Context):
    from pyspark.sql import Window as W

    daily = screens.success_by_channel(c.wh.facts)
    by_day = W.partitionBy("channel").orderBy("date_day")
    return daily.withColumn("delta", F.col("success_rate") - F.lag("success_rate").over(by_day))


@query("q9_incremental_revenue")
def _(c: Context):
    return loyalty.lift(loyalty.group_totals(c.wh.loyalty_users, []), [], c.seeds.cost_assumptions).select(
        "active_users_t", "active_users_c", "incremental_lift", "incremental_revenue", "point_cost",
        "program_roi")


@query("q10_tier_budget")
def _(c: Context):
    return loyalty.lift(loyalty.group_totals(c.wh.loyalty_users, ["account_tier"]), ["account_tier"],
                        c.seeds.cost_assumptions).select("account_tier", "incremental_lift", "program_roi")


@query("q11_point_liability")
def _(c: Context):
    return loyalty.liability(c.wh.loyalty_users, c.wh.redeemed, [], c.seeds.cost_assumptions)


@query("q12_slipping_customers")
def _(c: Context):
    return _slipping(c).orderBy(F.desc("gmv_30d_before"), "user_id")


@query("m1_data_complete")
def _(c: Context):
    return screens.data_completeness(_watermarked(c))


@query("m2_labels_mature")
def _(c: Context):
    return fraud.label_coverage(c.wh.outcomes).where("NOT mature")


@query("m3_points_meet")
def _(c: Context):
    daily = screens.points_reconciliation(_stream_points(c), c.wh.points)
    return daily.agg(
        F.sum("points_stream").alias("points_stream"), F.sum("points_batch").alias("points_batch"),
    ).withColumn("relative", ratio(F.abs(F.col("points_stream") - F.col("points_batch")), F.col("points_batch")))


@query("m4_layers_meet")
def _(c: Context):
    return screens.layer_reconciliation(c.wh.merchant_margin(c.wh.facts), c.wh.facts).agg(
        F.sum("gold_gmv").alias("gold_gmv"), F.sum("silver_gmv").alias("silver_gmv"),
        F.count_if(F.col("difference") != 0).alias("days_off"))


# ---- screens -----------------------------------------------------------------------------------

@query("r1_alert_feed")
def _(c: Context):
    return screens.alert_feed(c.wh.alerts, 100).select(
        "event_ts", "severity", "alert_type", "transaction_id", "user_id")


@query("r2_geo_alerts")
def _(c: Context):
    where = c.wh.facts.select("transaction_id", "location", "amount_vnd")
    return screens.geo_heatmap(where.join(
        c.wh.alerts.select("transaction_id").distinct(), "transaction_id", "left_semi"), 0.1)


@query("r3_alerts_by_type")
def _(c: Context):
    return c.wh.alerts.groupBy(screens.minute_of(F.col("event_ts")).alias("minute")).agg(*[
        F.count_if(F.col("alert_type") == t).alias(t.lower())
        for t in ("CARD_TESTING", "IMPOSSIBLE_TRAVEL", "RULE_BLOCK")])


@query("r4_block_rate_tile")
def _(c: Context):
    return screens.block_rate_hourly(c.wh.decided).orderBy(F.desc("hour")).limit(1)


@query("r5_suspect_devices")
def _(c: Context):
    return screens.top_devices(c.wh.alerts, 10)


@query("r6_stream_health")
def _(c: Context):
    return screens.stream_health(_watermarked(c)).select(
        "period_start", "watermark_lag_p99_ms", "late_rate", "events_per_s")


@query("e1_kpi_row")
def _(c: Context):
    return (
        screens.kpi_row(c.wh.facts, c.wh.merchant_margin(c.wh.facts), c.wh.fct_fraud_performance)
        .orderBy(F.desc("date_day")).limit(1))


@query("e2_gmv_vs_band")
def _(c: Context):
    return screens.gmv_band(c.wh.facts, "2024-01-30")


@query("e3_success_by_channel")
def _(c: Context):
    return screens.success_by_channel(c.wh.facts).select("channel", "date_day", "success_rate")


@query("e4_take_rate_by_industry")
def _(c: Context):
    return merchant.roll_up(c.wh.fct_merchant_profitability, ["industry"]).select(
        "industry", "gmv", "net_revenue", "net_take_rate")


@query("e5_negative_merchants")
def _(c: Context):
    return screens.loss_making(c.wh.fct_merchant_profitability, 10).select(
        "merchant_id", "industry", "gmv", "net_take_rate")


@query("e6_prevented_vs_friction")
def _(c: Context):
    return c.wh.fct_fraud_performance.groupBy("date_day").agg(*[
        F.sum(F.col(n).cast("decimal(28,2)")).alias(n)
        for n in ("net_loss_prevented_vnd", "friction_cost_vnd")])


@query("e7_lifecycle_flow")
def _(c: Context):
    return _ordered_transitions(c)


@query("e8_roi_and_liability")
def _(c: Context):
    tile = loyalty.roi_interval(c.wh.loyalty_users, c.seeds.cost_assumptions).select(
        F.lit(1).alias("k"), "program_roi", "roi_low", "roi_high")
    owed = loyalty.liability(c.wh.loyalty_users, c.wh.redeemed, [], c.seeds.cost_assumptions).select(
        F.lit(1).alias("k"), "liability_vnd", "redemption_rate", "breakage_rate")
    return tile.unionByName(owed, allowMissingColumns=True).groupBy("k").agg(*[
        F.max(n).alias(n) for n in ("program_roi", "roi_low", "roi_high", "liability_vnd",
                                    "redemption_rate", "breakage_rate")]).drop("k")


@query("blocked_by_rule_and_tier")
def _(c: Context):
    return (
        c.wh.decided.where("decision = 'BLOCK'")
        .groupBy(F.col("dt").alias("date_day"), "rule_id", "rule_type",
                 F.coalesce("account_tier", F.lit("UNKNOWN")).alias("account_tier"))
        .agg(F.count("*").alias("blocked_txns"), F.sum("amount_vnd").alias("blocked_vnd")))


@query("suspended_by_risk")
def _(c: Context):
    return c.wh.suspended
