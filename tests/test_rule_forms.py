"""The two forms of the rule engine answer alike, on random rules and on the awkward ones."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import BASE, PAYMENT, payment
from tillwatch.operators.rules import checked_rules, decide, matches_by_type

RULE = ("rule_id string, rule_type string, scope map<string,string>, params map<string,string>, action string, "
        "priority bigint, enabled boolean, effective_from timestamp, version bigint, updated_at timestamp")


def rule(rule_id, kind, params, scope=None, action="BLOCK", priority=1, version=1, effective=BASE):
    return (rule_id, kind, scope, params, action, priority, True, effective, version, effective)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(6)
    made = [payment(f"t{i:03}", rng.randrange(4_000), user_id=f"U{rng.randrange(4)}", device_id=f"d{rng.randrange(5)}",
                    channel=rng.choice(["APP", "WEB", "a|b=c", None]), amount=rng.choice([1, 100, 5_000]))
            for i in range(160)]
    df = spark.createDataFrame(made, PAYMENT).withColumns({
        "account_tier": F.when(F.col("user_id") == "U1", "VIP").when(F.col("user_id") == "U2", "x|channel=APP"),
        "kyc_status": F.lit("VERIFIED"), "home_country": F.when(F.col("user_id") != "U3", "VN")})
    return df.cache()


def verdicts(rows, rules, limit):
    return {r.transaction_id: (r.decision, r.rule_id, r.rule_type, r.rules_not_ready)
            for r in decide(rows, rules, compile_limit=limit).collect()}


def random_rule(rng, i):
    scope = {k: rng.choice(v) for k, v in (
        ("account_tier", ["VIP", "x|channel=APP", "none"]), ("channel", ["APP", "a|b=c"]), ("device_id", ["d1", "d2"]),
        ("merchant_id", ["M0001"]), ("no_such_column", ["1"])) if rng.random() < (0.05 if k == "no_such_column" else 0.3)}
    kind = rng.choice(["AMOUNT_THRESHOLD", "COUNTRY_BLOCK", "DEVICE_BLACKLIST", "VELOCITY", "CHANNEL_BLOCK", "MOON_PHASE"])
    params = {
        "AMOUNT_THRESHOLD": {"max_amount_vnd": rng.choice(["99", "100", "many", "0050"])},
        "COUNTRY_BLOCK": {"country": rng.choice(["VN", "SG"])},
        "DEVICE_BLACKLIST": {"device_ids": rng.choice(["d1", "d1,d2,d1", "", "zz"])},
        "VELOCITY": {"max_count": rng.choice(["1", "3", "x"]), "window_sec": rng.choice(["900", "0900", "60", "-5", "3600"])},
        "CHANNEL_BLOCK": {"channel": rng.choice(["APP", "WEB", "a|b=c"])},
        "MOON_PHASE": {"phase": "full"}}[kind]
    if rng.random() < 0.1:
        params = rng.choice([None, {}])
    return rule(f"R{i}", kind, params, scope or None, rng.choice(["BLOCK", "ALERT", "REVIEW"]), rng.randrange(4),
                rng.randrange(3), BASE + timedelta(seconds=rng.choice([-10, 0, 2_000])))


@pytest.mark.parametrize("seed", range(4))
def test_random_rules(spark, rows, seed):
    rng = random.Random(seed)
    rules = spark.createDataFrame([random_rule(rng, i) for i in range(14)], RULE)
    compiled, joined = verdicts(rows, rules, 200), verdicts(rows, rules, 0)
    assert compiled == joined and len(compiled) == 160
    assert len({v[1] for v in compiled.values()}) > 1


def test_awkward_rules(spark, rows):
    cases = [
        [rule("W", "VELOCITY", {"max_count": "3", "window_sec": "0900"})],
        [rule("P", "AMOUNT_THRESHOLD", {"max_amount_vnd": "0"}, {"account_tier": "x|channel=APP"})],
        [rule("S", "DEVICE_BLACKLIST", {"device_ids": "d1,d2"}, {"device_id": "d1"})],
        [rule("M", "AMOUNT_THRESHOLD", {}), rule("N", "VELOCITY", {"max_count": "1"}), rule("T", "COUNTRY_BLOCK", None)],
    ]
    for rules in cases:
        table = spark.createDataFrame(rules, RULE)
        assert verdicts(rows, table, 200) == verdicts(rows, table, 0)
    hit = verdicts(rows, spark.createDataFrame(cases[2], RULE), 0)
    assert {k for k, v in hit.items() if v[0] == "BLOCK"} == {
        r.transaction_id for r in rows.where("device_id = 'd1'").collect()}


def test_problems_are_named(spark):
    table = spark.createDataFrame([
        rule("ok", "COUNTRY_BLOCK", {"country": "VN"}), rule("a", "AMOUNT_THRESHOLD", {"max_amount_vnd": "1e3x"}),
        rule("b", "VELOCITY", {"max_count": "1", "window_sec": "0"}), rule("c", "CHANNEL_BLOCK", {}),
        rule("d", "DEVICE_BLACKLIST", None), rule("e", "COUNTRY_BLOCK", {"country": "VN"}, {"colour": "red"}),
        rule("f", "OTHER", {}), rule("g", "COUNTRY_BLOCK", {"country": "VN"}, action=None),
        rule("h", "COUNTRY_BLOCK", {"country": "VN"}, {"channel": None})], RULE)
    assert {r.rule_id: r.problem for r in checked_rules(table).collect()} == {
        "ok": None, "a": "limit", "b": "window", "c": "word", "d": "devices", "e": "scope", "f": "type", "g": "incomplete",
        "h": "scope"}


@pytest.mark.parametrize("seed", range(3))
def test_matches_by_type_are_the_decisions_of_each_type_alone(spark, rows, seed):
    rng = random.Random(100 + seed)
    rules = spark.createDataFrame([random_rule(rng, i) for i in range(14)], RULE)
    want = set()
    for kind in [r.rule_type for r in rules.select("rule_type").distinct().collect()]:
        alone = decide(rows, rules.where(F.col("rule_type") == kind)).where("rule_id IS NOT NULL")
        want |= {tuple(r) for r in alone.select("transaction_id", "rule_id", "rule_type", "decision").collect()}
    for limit in (200, 0):
        assert {tuple(r) for r in matches_by_type(rows, rules, limit).collect()} == want
    assert len({w[2] for w in want}) > 1
    assert matches_by_type(rows, rules.where("false")).count() == 0
