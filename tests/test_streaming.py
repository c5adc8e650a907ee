"""Streams: landing, restarts, late data, rule changes, keyed state."""

import json
import os
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import HCMC, PAYMENT, at, payment
from tillwatch import testbed
from tillwatch.operators.latest import dedup
from tillwatch.operators.rules import active_rules
from tillwatch.session import scratch, tune
from tillwatch.sources.seeds import default_seeds
from tillwatch.streaming import detectors, landing, sinks, topics, windows
from tillwatch.streaming.decisions import DecisionStream, progress_metrics

PROFILES = ("SELECT 'U1' user_id, 'BRONZE' account_tier, 'VERIFIED' kyc_status, 0.1D risk_score_baseline, "
            "'VN' home_country")


def record(txn, seconds=0, partition=0, arrival=None, **kw):
    p = dict(zip([c.split()[0] for c in PAYMENT.replace("struct<lat: double, lon: double>", "struct").split(", ")],
                 payment(txn, seconds, **kw)))
    value = {k: p[k] for k in ("transaction_id", "user_id", "merchant_id", "amount", "currency", "ip_address",
                               "device_id", "channel", "status", "failure_reason", "txn_type",
                               "original_txn_id", "experiment_group")}
    value["location"] = {"lat": p["location"][0], "lon": p["location"][1]}
    value["timestamp"] = p["event_ts"].strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"
    return (p["user_id"], json.dumps(value), partition, at(seconds + 1 if arrival is None else arrival))


@pytest.fixture
def topic(spark):
    t = topics.Topic("payment_events", path=scratch(spark, "topic"))

    def publish(*records):
        topics.write_topic(spark.createDataFrame(list(records), topics.ROW).coalesce(1), t)
    t_publish = publish
    return t, t_publish


@pytest.fixture
def stream(spark, topic):
    t, _ = topic
    out, ck = scratch(spark, "out"), scratch(spark, "ck")
    seeds = default_seeds(spark)
    state = {"rules": testbed.RULES}

    def run(cls=DecisionStream, drain=True):
        d = cls(spark, out, lambda: spark.sql(PROFILES),
                lambda: active_rules(testbed.rules(spark, state["rules"])), lambda: seeds.fx_rate)
        return d.run(topics.read_stream(spark, t), ck, finite=True, drain=drain)

    def decided():
        return {r["transaction_id"]: r for r in spark.read.parquet(f"{out}/decided").collect()}

    def route(name):
        rows = sinks.read_routes(spark, f"{out}/topics").where(F.col("route") == name).collect()
        return sorted((json.loads(r["value"]) for r in rows), key=str)

    run.decided, run.route, run.state, run.out = decided, route, state, out
    return run


def test_landing_keeps_everything_and_resumes(spark, topic):
    t, publish = topic
    path, ck = scratch(spark, "bronze"), scratch(spark, "ck")
    publish(record("a"), ("k", "broken {", 0, at(5)))
    landing.land_bronze(topics.read_stream(spark, t), path, ck, finite=True)
    publish(record("b"), record("b"))
    landing.land_bronze(topics.read_stream(spark, t), path, ck, finite=True)
    rows = spark.read.parquet(path)
    assert rows.where("kind = 'event'").count() == 3
    assert [r["value"] for r in rows.where("kind = 'quarantine'").collect()] == ["broken {"]
    # at-least-once is repaired by the dedup
    typed = rows.where("kind = 'event'").drop("kind", "value", "key", "partition")
    assert dedup(typed).count() == 2


def test_rules_change_without_restart_of_the_checkpoint(stream, topic):
    _, publish = topic
    stream.state["rules"] = [r for r in testbed.RULES if r[0] == "R-060"]  # only a disabled rule
    publish(record("a", amount=3_000_000, channel="WEB"))
    stream()
    stream.state["rules"] = [("R-9", "AMOUNT_THRESHOLD", {"account_tier": "BRONZE", "channel": "WEB"},
                              {"max_amount_vnd": "2000000"}, "BLOCK", 1, True, "2024-01-01T00:00:00Z", 1,
                              "2024-01-01T00:00:00Z")]
    publish(record("b", 60, amount=3_000_000, channel="WEB"))
    stream()
    got = stream.decided()
    assert (got["a"]["decision"], got["a"]["rules_not_ready"]) == ("PASS", True)
    assert (got["b"]["decision"], got["b"]["rules_not_ready"]) == ("BLOCK", False)
    assert [r["transaction_id"] for r in stream.route("blocked_transactions")] == ["b"]
    # the kill switch: same rule, next version, downgraded action
    stream.state["rules"].append(("R-9", "AMOUNT_THRESHOLD", {"account_tier": "BRONZE", "channel": "WEB"},
                                  {"max_amount_vnd": "2000000"}, "ALERT", 1, True, "2024-01-01T00:00:00Z", 2,
                                  "2024-01-01T00:00:00Z"))
    publish(record("c", 120, amount=3_000_000, channel="WEB"))
    stream()
    assert stream.decided()["c"]["decision"] == "ALERT"


def test_missing_profile_is_flagged_not_dropped(stream, topic):
    _, publish = topic
    publish(record("a"), record("b", user_id="nobody"))
    stream()
    got = stream.decided()
    assert not got["a"]["profile_missing"] and got["b"]["profile_missing"]


def test_late_rows_take_the_side_output(stream, topic):
    _, publish = topic
    publish(record("a", 0), record("b", 600))
    stream()
    publish(record("on_time", 590, arrival=700), record("late", 589.999, arrival=700))
    stream()
    assert [r["transaction_id"] for r in stream.route("late_events")] == ["late"]
    assert set(stream.decided()) == {"a", "b", "on_time", "late"}
    assert "late" not in {r["transaction_id"] for r in stream.route("loyalty_points")}


def test_windows_reach_over_micro_batches(stream, topic):
    """Points, card testing and travel see the rows of earlier batches; repeats are not judged twice."""
    _, publish = topic
    small = [record(f"f{i}", i * 5, device_id="evil", user_id=f"V{i}", amount=9_000, status="FAILED") for i in range(5)]
    publish(*small, record("p1", 10, user_id="U2", amount=3_000_000), record("t1", 20, user_id="U3"))
    stream()
    publish(record("B", 40, device_id="evil", user_id="V9", amount=15_000_000),
            record("p2", 50, user_id="U2", amount=2_000_000), record("p1", 10, user_id="U2", amount=3_000_000),
            record("t2", 60, user_id="U3", location=HCMC))
    stream()
    alerts = {(r["alert_type"], r["transaction_id"]) for r in stream.route("fraud_alerts")}
    assert alerts == {("CARD_TESTING", "B"), ("IMPOSSIBLE_TRAVEL", "t2")}
    by_txn = {}
    for r in stream.route("loyalty_points"):
        assert r["transaction_id"] not in by_txn
        by_txn[r["transaction_id"]] = r["total_15m"]
    assert by_txn["p1"] == 3_000_000 and by_txn["p2"] == 5_000_000


class Crashing(DecisionStream):
    def _mark(self, mark, reach):
        raise RuntimeError("executor gone")


def test_resume_after_a_crash_repeats_the_batch_without_duplicates(stream, topic, spark):
    _, publish = topic
    publish(record("a", 0), record("b", 10, amount=6_000_000))
    with pytest.raises(Exception, match="executor gone"):
        stream(Crashing)
    stream()
    publish(record("c", 20))
    stream()
    assert spark.read.parquet(f"{stream.out}/decided").count() == 3
    assert len(stream.route("loyalty_points")) == 3
    kpis = sinks.serving_table(spark, f"{stream.out}/kpi_minute").first()
    assert (kpis["txns"], kpis["gmv"]) == (3, 6_200_000)


def test_marks_stay_few_and_survive_a_restart(stream, topic, spark):
    """Only batches within reach are remembered, in a running stream and after a restart."""
    _, publish = topic
    for hour in range(4):
        publish(record(f"h{hour}", hour * 3600))
        stream(drain=False)
    top = int(at(3 * 3600).timestamp() * 1000)
    d = DecisionStream(spark, stream.out, None, None, None)
    assert d._before(9).top_ms == top and d._before(9).batch_id == 3
    assert sorted(m.batch_id for m in d._marks_from(top - 3_600_000, 9)) == [2, 3]
    d._forget(top)
    assert sorted(d.marks) == [3]
    # an older floor is read again from the marks on disk
    assert sorted(m.batch_id for m in d._marks_from(top - 2 * 3_600_000, 9)) == [1, 2, 3]


VELOCITY = [("R-V", "VELOCITY", None, {"max_count": "1", "window_sec": "3600"}, "BLOCK", 1, True,
             "2024-01-01T00:00:00Z", 1, "2024-01-01T00:00:00Z")]


def test_the_look_back_is_as_long_as_the_longest_rule_window(stream, topic):
    _, publish = topic
    stream.state["rules"] = VELOCITY
    publish(record("a", 0))
    stream(drain=False)
    publish(record("b", 1_800))
    stream(drain=False)
    publish(record("c", 5_401))
    stream()
    assert {k: r["decision"] for k, r in stream.decided().items()} == {"a": "PASS", "b": "BLOCK", "c": "PASS"}


def test_a_row_out_of_order_counts_for_its_successors(stream, topic):
    """The later neighbour came one batch earlier: the pair and the velocity count are found all the same."""
    _, publish = topic
    stream.state["rules"] = VELOCITY
    publish(record("hcmc", 60, location=HCMC))
    stream(drain=False)
    publish(record("hanoi", 55, arrival=62), record("last", 200, user_id="U9"))
    stream()
    assert [(r["alert_type"], r["transaction_id"]) for r in stream.route("fraud_alerts")] == [
        ("IMPOSSIBLE_TRAVEL", "hcmc"), ("RULE_BLOCK", "hcmc")]
    assert stream.decided()["hanoi"]["decision"] == "PASS" and stream.route("late_events") == []


def test_a_chain_completed_or_broken_out_of_order(stream, topic):
    _, publish = topic

    def attack(device, user):
        return [record(f"{device}{i}", i * 5, device_id=device, user_id=user, amount=9_000, status="FAILED") for i in range(4)]

    big = {"amount": 15_000_000}
    publish(*attack("d1", "A"), *attack("d2", "B"), record("d24", 20, device_id="d2", user_id="B", amount=9_000, status="FAILED"),
            record("big1", 25, device_id="d1", user_id="A", **big), record("big2", 25, device_id="d2", user_id="B", **big))
    stream(drain=False)
    publish(record("d14", 22, arrival=28, device_id="d1", user_id="A", amount=9_000, status="FAILED"),
            record("break", 23, arrival=28, device_id="d2", user_id="B"))
    stream()
    assert {r["transaction_id"] for r in stream.route("fraud_alerts") if r["alert_type"] == "CARD_TESTING"} == {"big1"}


def test_a_repeat_after_an_hour_counts_once(stream, topic, spark):
    _, publish = topic
    for rows in ([record("a", 0)], [record("b", 3_600)], [record("a", 0, arrival=3_700)], [record("a", 0, arrival=3_800)]):
        publish(*rows)
        stream(drain=False)
    stream()
    assert spark.read.parquet(f"{stream.out}/decided").count() == 2
    kpis = sinks.serving_table(spark, f"{stream.out}/kpi_minute").agg(F.sum("txns")).first()[0]
    assert kpis == 2 and stream.route("late_events") == []


def test_rules_that_cannot_be_read_are_reported(stream, topic, spark):
    _, publish = topic
    stream.state["rules"] = VELOCITY + [
        ("R-B", "VELOCITY", None, {"max_count": "x", "window_sec": "60"}, "BLOCK", 9, True, "2024-01-01T00:00:00Z", 1,
         "2024-01-01T00:00:00Z")]
    publish(record("a", 0))
    stream()
    assert stream.decided()["a"]["decision"] == "PASS"
    bad = spark.read.parquet(f"{stream.out}/rules_quarantine").select("rule_id", "problem").distinct().collect()
    assert [tuple(r) for r in bad] == [("R-B", "limit")]


def run_detector(spark, build, *batches):
    tune(spark, streaming=True)
    source, path, ck = scratch(spark, "src"), scratch(spark, "alerts"), scratch(spark, "ck")
    schema = spark.createDataFrame([], PAYMENT).schema
    query = None
    for rows in batches:
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)
        stream = build(spark.readStream.schema(schema).parquet(source))
        query = sinks.start(stream.writeStream.format("parquet").option("path", path)
                            .option("checkpointLocation", ck), finite=True)
    return [r.asDict() for r in spark.read.schema(stream.schema).parquet(path).collect()], query


def fails(n, start=0, step=10, name="f"):
    return [payment(f"{name}{i}", start + i * step, device_id="evil", amount=9_000, status="FAILED") for i in range(n)]


LATER = payment("later", 400, device_id="other", user_id="U77")


def test_streak_survives_between_batches(spark):
    big = payment("B", 60, device_id="evil", amount=15_000_000)
    got, _ = run_detector(spark, detectors.card_testing_stream, fails(3), fails(2, 30, name="g"), [big], [LATER])
    assert {r["evidence_id"] for r in got} == {"f0", "f1", "f2", "g0", "g1"}
    assert {r["transaction_id"] for r in got} == {"B"}


def test_anchored_streak_differs_from_the_declared_pattern(spark):
    """Eight failures every 20 s: the state machine restarts after two minutes, the pattern does not."""
    rows = fails(8, step=20) + [payment("B", 141, device_id="evil", amount=15_000_000)]
    got, _ = run_detector(spark, detectors.card_testing_stream, [*rows, LATER])
    assert got == []
    from tillwatch.operators.card_testing import card_testing
    assert card_testing(spark.createDataFrame(rows, PAYMENT)).count() == 1


def test_another_row_clears_the_streak(spark):
    rows = fails(5) + [payment("n", 55, device_id="evil"), payment("B", 60, device_id="evil", amount=15_000_000)]
    assert run_detector(spark, detectors.card_testing_stream, [*rows, LATER])[0] == []


def test_keyed_detectors_order_rows_across_batches(spark):
    """Rows on time but out of order complete a streak, break one, and make a pair of positions."""
    fifth = payment("f4", 40, device_id="evil", amount=9_000, status="FAILED")
    big = payment("B", 45, device_id="evil", amount=15_000_000)
    got, _ = run_detector(spark, detectors.card_testing_stream, [*fails(4), big], [fifth], [LATER])
    assert len(got) == 5
    got, _ = run_detector(spark, detectors.card_testing_stream, [*fails(5), big],
                          [payment("n", 42, device_id="evil")], [LATER])
    assert got == []
    got, _ = run_detector(spark, detectors.travel_stream, [payment("b", 60, location=HCMC)], [payment("a", 55)],
                          [payment("z", 900, user_id="U2")])
    assert [(r["prev_transaction_id"], r["transaction_id"]) for r in got] == [("a", "b")]


def test_travel_state_between_batches_and_its_expiry(spark):
    first = [payment("a", 0)]
    second = [payment("b", 300, location=HCMC)]
    got, _ = run_detector(spark, detectors.travel_stream, first, second, [payment("later", 700, user_id="U77")])
    assert [(r["prev_transaction_id"], r["transaction_id"]) for r in got] == [("a", "b")]
    # a day later the position is forgotten: the state store holds only the newest user
    day = 24 * 3600
    _, query = run_detector(spark, detectors.travel_stream, first, [payment("z", day + 60, user_id="U2")],
                            [payment("y", day + 90, user_id="U2")])
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 6


def test_silent_partition_holds_nothing_back(spark):
    """Only one of two partitions sends rows; windows still close."""
    tune(spark, streaming=True)
    source, path, ck = scratch(spark, "src"), scratch(spark, "sums"), scratch(spark, "ck")
    schema = spark.createDataFrame([], PAYMENT).schema
    for rows in ([payment("a", 0, src_partition=0), payment("b", 0, src_partition=1)],
                 [payment("c", 4000, src_partition=0)], [payment("d", 4100, src_partition=0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = windows.sliding_sums(spark.readStream.schema(schema).parquet(source))
        query = sinks.start(stream.writeStream.format("parquet").option("path", path)
                            .option("checkpointLocation", ck), finite=True)
    # all 15 windows of the first two rows, and the two of the third that end before the watermark
    totals = sorted(r["total"] for r in spark.read.parquet(path).collect())
    assert totals == [100_000] * 2 + [200_000] * 15
    assert progress_metrics(query)["watermark"] is not None


def test_state_machines_reach_workers_that_do_not_have_the_package():
    """Run from another folder, without the repository on any path of the workers."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {repo!r})
import __spark_entry__ as registered
from tillwatch.session import local_session
spark = local_session(2, "elsewhere")
for name in ("x9_card_testing_stream", "x10_travel_stream"):
    print(name, registered.queries()[name](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(), env=env, timeout=300,
                          capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "x9_card_testing_stream 66" in done.stdout and "x10_travel_stream" in done.stdout
