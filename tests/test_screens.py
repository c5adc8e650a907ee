"""Business answers on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from tillwatch.plans import lifecycle, loyalty, screens
from tillwatch.sources.seeds import default_seeds


@pytest.fixture(scope="module")
def costs(spark):
    return default_seeds(spark).cost_assumptions


def test_only_blocked_legitimate_vip_payments_count(spark, costs):
    rows = spark.createDataFrame([
        ("v1", "VIP", "BLOCK", True, False, 1_000_000), ("v1", "VIP", "BLOCK", True, False, 3_000_000),
        ("v1", "VIP", "ALERT", True, False, 9_000_000), ("v2", "VIP", "BLOCK", True, True, 1_000_000),
        ("v3", "VIP", "BLOCK", True, None, 1_000_000), ("g1", "GOLD", "BLOCK", True, False, 1_000_000)],
        "user_id string, account_tier string, decision string, flagged boolean, is_fraud_confirmed boolean, amount_vnd bigint")
    got = screens.vip_wrongly_blocked(rows, costs).collect()
    c = costs.first()
    want = 4_000_000 * float(c["gross_margin_rate"]) + 2 * float(c["vip_churn_risk"]) * float(c["vip_annual_value"])
    assert [(r.user_id, r.fp_count, r.amount_vnd) for r in got] == [("v1", 2, 4_000_000)]
    assert float(got[0].friction_cost_vnd) == pytest.approx(want, abs=0.01)


def test_money_of_an_attack_is_split_by_decision(spark):
    alerts = spark.createDataFrame([("b1", "CARD_TESTING", "h"), ("b2", "CARD_TESTING", "h"), ("b2", "RULE_BLOCK", "h")],
                                   "transaction_id string, alert_type string, device_hash string")
    attacks = spark.createDataFrame([("b1", 100, 5), ("b2", 30, 6)], "transaction_id string, large_amount_vnd bigint, chain_len bigint")
    decided = spark.createDataFrame([("b1", "PASS"), ("b2", "BLOCK")], "transaction_id string, decision string")
    got = screens.card_testing_devices(alerts, attacks, decided).collect()
    assert [tuple(r) for r in got] == [("h", 2, 11, 30, 100)]


def test_any_number_of_scenarios(spark, costs):
    from tillwatch.plans.assumptions import per_scenario

    many = costs.crossJoin(spark.range(1_500)).withColumn("scenario", F.col("id").cast("string")).drop("id")
    rows = per_scenario(spark.range(3), many)
    assert rows.count() == 4_500 and rows.select("scenario").distinct().count() == 1_500


def test_days_before_and_after_meet_by_weekday(spark):
    """One rule on both sides, one only before, one only after; days out of reach or without coverage stay out."""
    rows = spark.createDataFrame([
        ("2024-01-15", "A", 10.0, 1.0, 1.0), ("2024-01-15", "A", None, 2.0, 1.0), ("2024-01-08", "A", 4.0, 5.0, 1.0),
        ("2024-01-16", "A", 7.0, 0.0, 0.1), ("2024-01-10", "B", 6.0, 1.0, 1.0), ("2024-01-21", "C", 1.0, 9.0, 1.0),
        ("2024-01-22", "A", 99.0, 99.0, 1.0), ("2024-01-07", "A", 99.0, 99.0, 1.0)],
        "date_day string, rule_type string, net_loss_prevented_vnd double, friction_cost_vnd double, label_coverage_rate double",
    ).withColumn("date_day", F.col("date_day").cast("date"))
    got = screens.rule_before_after(rows, "2024-01-15", 0.3).orderBy("rule_type").collect()
    assert [tuple(r) for r in got] == [
        ("A", 1, 6.0, -2.0, False), ("B", 1, -6.0, -1.0, True), ("C", 1, 1.0, 9.0, True)]


def test_moves_need_a_user_at_both_dates(spark):
    rows = spark.createDataFrame([
        ("u1", "2024-01-01", "NEW", 5), ("u1", "2024-01-08", "ACTIVE", 6), ("u1", "2024-01-09", "CHURNED", 7),
        ("u2", "2024-01-01", "NEW", 1), ("u3", "2024-01-08", "NEW", 2)],
        "user_id string, as_of string, state string, gmv_30d bigint").withColumn("as_of", F.col("as_of").cast("date"))
    got = lifecycle.moves(rows, "2024-01-01", "2024-01-08").collect()
    assert [r.asDict() for r in got] == [
        {"user_id": "u1", "state_from": "NEW", "gmv_30d_before": 5, "state_to": "ACTIVE"}]


def test_loyalty_mart_of_one_sided_days(spark, costs):
    """A day with one group only has nothing to compare; a day with redemptions only still owes them."""
    users = spark.createDataFrame([
        ("2024-01-01", "t1", "GOLD", "TREATMENT", 300, 1, 30), ("2024-01-01", "c1", "GOLD", "CONTROL", 200, 1, 10),
        ("2024-01-02", "t1", "GOLD", "TREATMENT", 100, 1, 10)],
        "date_day string, user_id string, account_tier string, experiment_group string, gmv bigint, txns bigint, points_issued bigint")
    spent = spark.createDataFrame(
        [("2024-01-03", "t1", "GOLD", "TREATMENT", 5)],
        "date_day string, user_id string, account_tier string, experiment_group string, points_redeemed bigint")
    got = {(r.date_day, r.experiment_group): r for r in loyalty.fct_loyalty_analytics(users, spent, costs).collect()}
    assert len(got) == 4
    assert got["2024-01-01", "TREATMENT"].incremental_lift == 0.5 and got["2024-01-01", "CONTROL"].incremental_lift is None
    assert got["2024-01-02", "TREATMENT"].incremental_lift is None
    last = got["2024-01-03", "TREATMENT"]
    assert (last.gmv, last.points_redeemed, last.outstanding_points, last.outstanding_points_to_date) == (0, 5, -5, 35)
