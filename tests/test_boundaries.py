"""Strict comparisons and edge rows of the detectors, rules, points and lifecycle."""

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import HANOI, HCMC, at, ids, payment
from tillwatch import testbed
from tillwatch.functions import exprs
from tillwatch.operators import card_testing as card
from tillwatch.operators.enrich import enrich, enrich_as_of
from tillwatch.operators.latest import dedup
from tillwatch.operators.points import loyalty_points
from tillwatch.operators.retries import blocked_then_retried
from tillwatch.operators.rules import active_rules, decide
from tillwatch.operators.travel import impossible_travel
from tillwatch.plans import lifecycle, merchant
from tillwatch.sources import changelog, files
from tillwatch.schemas import PAYMENT_EVENT, USER_PROFILE


def burst(n=5, start=0.0, step=10, amount=19_999, device="d1", name="a"):
    return [payment(f"{name}{i}", start + i * step, amount=amount, status="FAILED", device_id=device)
            for i in range(n)]


def big(txn, seconds, amount=10_000_001, device="d1", **kw):
    return payment(txn, seconds, amount=amount, device_id=device, **kw)


@pytest.mark.parametrize("rows, hits", [
    (burst(5) + [big("B", 60)], ["B"]),
    (burst(4) + [big("B", 60)], []),
    (burst(5, amount=20_000) + [big("B", 60)], []),
    (burst(5) + [big("B", 60, amount=10_000_000)], []),
    # the five latest failures lie within two minutes, to the millisecond
    (burst(5, step=1) + [big("B", 120)], ["B"]),
    (burst(5, step=1) + [big("B", 120.001)], []),
    # any other row breaks the run
    (burst(5) + [payment("n", 45), big("B", 60)], []),
    # a run that starts before the two minutes still has five rows inside
    (burst(8, step=20) + [big("B", 141)], ["B"]),
    # over a slice border (the base time is the start of a slice)
    (burst(5, start=-50) + [big("B", 5)], ["B"]),
    (burst(5, start=-50) + [payment("n", -1), big("B", 5)], []),
    # another device does not interfere
    (burst(5) + [payment("n", 45, device_id="d2"), big("B", 60)], ["B"]),
])
def test_card_testing(payments, rows, hits):
    assert ids(card.card_testing(payments(*rows))) == hits


def test_card_testing_counts_only_recent_rows_and_shows_them(payments):
    df = payments(*burst(8, step=20), big("B", 141))
    assert card.card_testing(df).first()["chain_len"] == 6
    assert ids(card.card_testing_evidence(df)) == ["a2", "a3", "a4", "a5", "a6", "a7"]


@pytest.mark.parametrize("gap, place, hit", [
    (599.999, HCMC, True), (600, HCMC, False), (0, HCMC, True), (60, HANOI, False),
    (240, (18.33, 105.8342), False), (240, (18.3298, 105.8342), True),
])
def test_impossible_travel(payments, gap, place, hit):
    for base in (0, 3599 - int(gap / 2)):
        df = payments(payment("a", base), payment("b", base + gap, location=place))
        assert ids(impossible_travel(df)) == (["b"] if hit else [])


def test_distance_threshold_is_strict(spark):
    km = spark.range(1).select(exprs.haversine_km(
        F.lit(21.0278), F.lit(105.8342), F.lit(10.7769), F.lit(106.7009))).first()[0]
    assert km == pytest.approx(1143.6, abs=0.1)


def test_travel_only_compares_neighbours(payments):
    df = payments(payment("a", 0), payment("b", 60, location=HCMC), payment("c", 120, location=HCMC))
    assert ids(impossible_travel(df)) == ["b"]


def points_of(payments, *rows):
    df = payments(*rows).withColumn("decision", F.lit("PASS"))
    return {r["transaction_id"]: (r["total_15m"], r["points"]) for r in loyalty_points(df).collect()}


def test_total_includes_current_and_excludes_exactly_15_minutes(payments):
    got = points_of(payments, payment("a", 0, amount=4_000_000), payment("b", 899.999, amount=1_000_000),
                    payment("c", 1800 - 0.001, amount=4_999_999))
    assert got["b"] == (5_000_000, 20)
    assert got["c"] == (4_999_999, 49)
    got = points_of(payments, payment("a", 0, amount=4_000_000), payment("b", 900, amount=1_000_000))
    assert got["b"] == (1_000_000, 10)


def test_rows_that_do_not_count(payments):
    got = points_of(payments, payment("f", 0, amount=9_000_000, status="FAILED"),
                    payment("r", 1, amount=9_000_000, txn_type="REFUND"),
                    payment("p", 2, amount=5_000_000, status="PENDING"),
                    payment("c", 3, amount=100_000, experiment_group="CONTROL"))
    assert got["f"][1] == got["r"][1] == 0
    assert got["p"] == (5_000_000, 100)
    assert got["c"] == (5_100_000, 1)


def rule(rule_id="R", scope=None, params=None, action="BLOCK", prio=1, enabled=True, version=1,
         kind="AMOUNT_THRESHOLD", eff="2024-01-01T00:00:00Z"):
    return (rule_id, kind, scope, params or {"max_amount_vnd": "0"}, action, prio, enabled, eff, version, eff)


@pytest.fixture
def judged(spark, payments):
    def run(rules, *rows, limit=200):
        profiles = spark.sql(
            "SELECT 'U1' user_id, 'GOLD' account_tier, 'VERIFIED' kyc_status, 0.1D risk_score_baseline, 'VN' home_country")
        out = decide(enrich(payments(*rows), profiles), active_rules(testbed.rules(spark, rules)), limit)
        return {r["transaction_id"]: (r["decision"], r["rule_id"]) for r in out.collect()}
    return run


@pytest.mark.parametrize("limit", [200, 0])
def test_rule_choice(judged, limit):
    one = payment("a")
    assert judged([rule()], one, limit=limit)["a"] == ("BLOCK", "R")
    # null scope matches, a scope on another tier does not, nor does one on a missing profile
    assert judged([rule(scope={"account_tier": "VIP"})], one, limit=limit)["a"] == ("PASS", None)
    assert judged([rule(scope={"account_tier": "GOLD"})], payment("a", user_id="U9"), limit=limit)["a"] == ("PASS", None)
    # higher priority wins; then the version, then the id
    assert judged([rule("R1", prio=5, action="ALLOW"), rule("R2", prio=4)], one, limit=limit)["a"] == ("ALLOW", "R1")
    assert judged([rule("R1", version=2), rule("R2", version=1)], one, limit=limit)["a"][1] == "R1"
    assert judged([rule("R1"), rule("R2")], one, limit=limit)["a"][1] == "R2"
    # strict threshold
    assert judged([rule(params={"max_amount_vnd": "100000"})], one, limit=limit)["a"][0] == "PASS"
    assert judged([rule(params={"max_amount_vnd": "99999"})], one, limit=limit)["a"][0] == "BLOCK"
    # effective exactly now, one millisecond later, disabled, older version disabled by the newer
    assert judged([rule(eff="2024-01-10T12:00:00Z")], one, limit=limit)["a"][0] == "BLOCK"
    assert judged([rule(eff="2024-01-10T12:00:00.001Z")], one, limit=limit)["a"][0] == "PASS"
    assert judged([rule(version=1), rule(version=2, enabled=False), rule("X", scope={"channel": "POS"})], one,
                  limit=limit)["a"][0] == "PASS"


@pytest.mark.parametrize("limit", [200, 0])
@pytest.mark.parametrize("devices", [3, 20_000])
def test_device_blacklist(judged, limit, devices):
    listed = ",".join(f"d{i}" for i in range(devices))
    rules = [rule("L", kind="DEVICE_BLACKLIST", params={"device_ids": listed}, scope={"channel": "APP"}),
             rule("A", prio=0, params={"max_amount_vnd": "1"}, action="ALERT")]
    got = judged(rules, payment("a"), payment("b", device_id=f"d{devices}"), payment("c", channel="POS"), limit=limit)
    assert got == {"a": ("BLOCK", "L"), "b": ("ALERT", "A"), "c": ("ALERT", "A")}


@pytest.mark.parametrize("limit", [200, 0])
def test_velocity_counts_the_current_row(judged, limit):
    rules = [rule(kind="VELOCITY", params={"max_count": "3", "window_sec": "900"}, action="ALERT")]
    three = [payment(f"t{i}", i * 300) for i in range(3)]
    inside = judged(rules, *three, payment("x", 899.999), limit=limit)
    assert {k for k, v in inside.items() if v[0] == "ALERT"} == {"x"}
    # exactly 15 minutes later the first row has left the window
    outside = judged(rules, *three, payment("x", 900), limit=limit)
    assert {k for k, v in outside.items() if v[0] == "ALERT"} == set()


def test_retry_proxy(payments):
    rows = payments(payment("b", 0), payment("s", 1800), payment("b2", 0, user_id="U2"),
                    payment("s2", 1800.001, user_id="U2"), payment("b3", 3500, user_id="U3"),
                    payment("s3", 3700, user_id="U3"), payment("s4", 3500, user_id="U3"))
    decided = rows.withColumn("decision", F.when(F.col("transaction_id").startswith("b"), "BLOCK").otherwise("PASS"))
    got = {r["transaction_id"]: r["retry_after_ms"] for r in blocked_then_retried(decided).collect()}
    assert got == {"b": 1_800_000, "b3": 200_000}


def test_dedup_takes_the_latest_copy(payments):
    df = payments(payment("a", 0, status="PENDING"), payment("a", 0, status="SUCCESS", ingested_at=at(90)), payment("b"))
    rows = {r["transaction_id"]: r["status"] for r in dedup(df).collect()}
    assert rows == {"a": "SUCCESS", "b": "SUCCESS"}


def test_profile_as_of_event_time(spark, payments):
    t = at(0)
    changes = spark.createDataFrame([
        ("U1", "c", t - timedelta(days=40), "BRONZE", "VERIFIED", 0.1, "VN"),
        ("U1", "u", t, "GOLD", "VERIFIED", 0.1, "VN"),
        ("U1", "d", t + timedelta(minutes=5), "GOLD", "VERIFIED", 0.1, "VN"),
    ], "user_id string, op string, updated_at timestamp, account_tier string, kyc_status string, "
       "risk_score_baseline double, home_country string")
    out = enrich_as_of(payments(payment("before", -0.001), payment("same", 0), payment("gone", 301),
                                payment("next_day", 90_000), payment("other", 0, user_id="U2")), changes)
    got = {r["transaction_id"]: (r["account_tier"], r["profile_missing"]) for r in out.collect()}
    assert got == {"before": ("BRONZE", False), "same": ("GOLD", False), "gone": (None, True),
                   "next_day": (None, True), "other": (None, True)}


def test_changelog_accepts_both_forms_and_deletes(spark):
    values = [
        '{"user_id":"A","account_tier":"GOLD","updated_at":"2024-01-01T00:00:00Z"}',
        '{"before":null,"after":{"user_id":"B","account_tier":"VIP","updated_at":"2024-01-01T00:00:00.5Z"},"op":"c","ts_ms":1}',
        '{"before":{"user_id":"B","account_tier":"VIP"},"after":null,"op":"d","ts_ms":2}',
        '{"before":null,"after":{"user_id":"C","account_tier":"GOLD"},"op":"c","ts_ms":1}',
        'not json',
    ]
    raw = spark.createDataFrame([(v,) for v in values], "value string")
    assert ids(changelog.current(changelog.unwrap(raw, USER_PROFILE, "user_id"), "user_id"), "user_id") == ["A", "C"]


def test_parsing_keeps_bad_records(spark):
    good = '{"transaction_id":"%s","timestamp":"%s","amount":1}'
    values = [good % ("a", "2024-01-01T00:00:00.123Z"), good % ("b", "2024-01-01T00:00:00Z"),
              good % ("c", "yesterday"), '{"transaction_id":"d"', '{"timestamp":"2024-01-01T00:00:00Z"}']
    raw = spark.createDataFrame([(v,) for v in values], "value string")
    ok, bad = files.parse_events(raw, PAYMENT_EVENT)
    assert {r[0]: r[1] for r in ok.select("transaction_id", F.unix_millis("event_ts")).collect()} == {
        "a": 1704067200123, "b": 1704067200000}
    assert sorted(r["value"] for r in bad.collect()) == sorted(values[2:])


def test_small_functions(spark):
    row = spark.sql("SELECT '115.78.42.9' a, '115.78.x.x' b, 'd-1' d").select(
        exprs.mask_ip(F.col("a")), exprs.mask_ip(F.col("b")), exprs.device_hash(F.col("d"), "s"),
        exprs.ratio(F.lit(1), F.lit(0)), F.crc32(F.lit("U000123"))).first()
    assert row[0] == "115.78.42.x" and row[1] == "115.78.x.x" and len(row[2]) == 64
    assert row[3] is None and row[4] == 3472417828


AS_OF = date(2024, 7, 1)


def state_of(spark, *days_ago, suspended=False):
    rows = [(f"t{i}", "U1", datetime(2024, 7, 1, tzinfo=timezone.utc) - timedelta(days=d), 1000)
            for i, d in enumerate(days_ago)]
    # a busier user sets the percentile
    rows += [(f"o{i}", "U2", datetime(2024, 6, 30, tzinfo=timezone.utc) - timedelta(hours=i), 1000) for i in range(90)]
    activity = spark.createDataFrame(rows, "transaction_id string, user_id string, event_ts timestamp, amount_vnd bigint")
    flagged = spark.createDataFrame([("U1",)] if suspended else [], "user_id string")
    out = lifecycle.states(activity, flagged, ["2024-07-01"])
    return out.where("user_id = 'U1'").first()["state"]


@pytest.mark.parametrize("days, state", [
    ([30], "NEW"), ([31], "ACTIVE"), ([200, 91], "CHURNED"), ([200, 90], "DORMANT"), ([200, 61], "DORMANT"),
    ([200, 60], "ACTIVE"),
    # own median gap of two days: silent for four is twice, for five more than twice
    ([40, 8, 6, 4], "ACTIVE"), ([40, 9, 7, 5], "AT_RISK"),
    # silent for long against the own habit, but fewer than three transactions in 90 days
    ([200, 95, 45, 43], "ACTIVE"),
])
def test_lifecycle_states(spark, days, state):
    assert state_of(spark, *days) == state


def test_suspended_comes_first(spark):
    assert state_of(spark, 200, 91, suspended=True) == "HIGH_RISK_SUSPENDED"


def test_refunds_and_orphans(payments):
    rows = payments(payment("p"), payment("r1", txn_type="REFUND", original_txn_id="p"),
                    payment("r2", txn_type="REFUND"), payment("r3", txn_type="REFUND", original_txn_id="zz"))
    got = {r["transaction_id"]: r["orphan"] for r in merchant.refund_links(rows).collect()}
    assert got == {"r1": False, "r2": True, "r3": True}
