"""Steps whose memory, traffic or passes over the data must not grow faster than the input."""

from datetime import date, timedelta
from types import SimpleNamespace

from pyspark.sql import functions as F

from conftest import HANOI, HCMC, PAYMENT, at, payment
from test_streaming import record, stream, topic  # noqa: F401  (fixtures)
from tillwatch import catalog, stream_catalog  # noqa: F401  (registers the streaming queries)
from tillwatch.operators.arrival import with_arrival_watermark
from tillwatch.operators.card_testing import card_testing
from tillwatch.operators.panes import panes_of, sliding_from_panes
from tillwatch.operators.travel import impossible_travel
from tillwatch.plans import lifecycle
from tillwatch.session import scratch, size_shuffles, tune
from tillwatch.streaming import decisions, detectors, idle, sinks, topics


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_never_go_to_every_task_for_their_marks(spark, payments):
    path = scratch(spark, "narrow")
    payments(payment("a", 0), payment("b", 30), payment("c", 5, ingested_at=at(40)), payment("d", 1, ingested_at=None)).write.parquet(path)
    marked = with_arrival_watermark(spark.read.parquet(path).select("transaction_id", "event_ts", "ingested_at"))
    assert {r["transaction_id"]: r["late"] for r in marked.collect()} == {"a": False, "b": False, "c": True}
    assert "LeftOuter" in _plan(marked)


def test_points_are_summed_over_narrow_rows(stream, topic, monkeypatch):  # noqa: F811
    seen = []
    real = decisions.loyalty_points
    monkeypatch.setattr(decisions, "loyalty_points", lambda rows: seen.append(rows.columns) or real(rows))
    t, publish = topic
    publish(record("a", 0, amount=3_000_000), record("f", 1, status="FAILED", amount=9_000_000))
    stream(drain=False)
    publish(record("b", 60, amount=3_000_000), record("x", 90, amount=100_000))
    stream()
    assert seen and all(set(c) == {
        "transaction_id", "user_id", "dt", "event_ts", "amount_vnd", "status", "txn_type", "decision", "_ours",
        "experiment_group"} for c in seen)
    assert [(p["transaction_id"], p["total_15m"]) for p in sorted(stream.route("loyalty_points"), key=lambda p: p["event_ts"])] == [
        ("a", 3_000_000), ("b", 6_000_000), ("x", 6_100_000)]


def test_detectors_carry_a_mark_of_the_row_that_alerts(payments):
    rows = payments(*[payment(f"f{n}", n, amount=5_000, status="FAILED") for n in range(5)], payment("big", 9, amount=20_000_000),
                    payment("far", 60, location=(10.7769, 106.7009))).withColumn("_ours", F.col("transaction_id") != "far")
    assert [(r["transaction_id"], r["_ours"]) for r in card_testing(rows, also=("_ours",)).collect()] == [("big", True)]
    assert [(r["transaction_id"], r["_ours"]) for r in impossible_travel(rows, also=("_ours",)).collect()] == [("far", False)]


def test_windows_are_written_out_last(spark):
    rows = [("u", 0, 5), ("u", 70_000, None), ("u", 20 * 60_000, None), (None, 0, 3), ("u", 70_000, 2)]
    table = spark.createDataFrame(rows, "user_id string, ms bigint, amount_vnd bigint").withColumn("event_ts", F.timestamp_millis("ms"))
    got = sliding_from_panes(panes_of(table))
    want = {}
    for user, ms, amount in rows:
        for k in range(15):
            key = (user, ms // 60_000 - k)
            parts = [x for x in (want.get(key), amount) if x is not None]
            want[key] = sum(parts) if parts else None
    found = got.select("user_id", (F.unix_millis("window_start") / 60_000).cast("bigint"), "total").collect()
    assert len(found) == len(want) and {(r[0], r[1]): r[2] for r in found} == want
    assert _plan(got).count("HashAggregate") == 2  # the panes; no table of windows


def test_the_days_of_the_history_share_their_states(spark, monkeypatch):
    calls = []
    real = lifecycle.gaps
    monkeypatch.setattr(lifecycle, "gaps", lambda *a, **kw: calls.append(1) or real(*a, **kw))
    first = date.fromisoformat(catalog.LAST_WEEK[0])
    rows = [(f"t{u}-{n}", f"u{u}", first - timedelta(days=40 * u - 3 * n), 10 * u) for u in range(1, 4) for n in range(8)]
    history = spark.createDataFrame(rows, "transaction_id string, user_id string, day date, amount_vnd bigint").withColumn(
        "event_ts", F.col("day").cast("timestamp"))
    suspended = spark.createDataFrame([("u1",)], "user_id string")

    def stage(df, name):
        path = scratch(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    c = SimpleNamespace(spark=spark, stage=stage, history=history, wh=SimpleNamespace(suspended=suspended),
                        scratch=lambda name: scratch(spark, name))
    got = catalog.QUERIES["w6_history_by_day"](c).collect()
    assert len(calls) == 1
    want = lifecycle.history(lifecycle.states(history, suspended, catalog.LAST_WEEK)).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_the_clock_parses_text_once(spark, topic, monkeypatch):  # noqa: F811
    plans = []
    real = idle.with_partition_watermark
    monkeypatch.setattr(idle, "with_partition_watermark", lambda rows, **kw: plans.append(
        rows._jdf.queryExecution().optimizedPlan().toString()) or real(rows, **kw))
    t, publish = topic
    publish(record("a", 0, 0), record("b", 50, 1), ("k", "{cut", 2, at(3)))
    clock = idle.PartitionClock(spark, scratch(spark, "clock"))
    clock.run(topics.read_stream(spark, t), scratch(spark, "ck"), finite=True)
    assert plans and not any("from_json" in p or "SQLExecutionRDD" in p for p in plans)
    assert {r["transaction_id"] for r in clock.rows().collect()} == {"a", "b"}
    assert [tuple(r) for r in spark.read.parquet(f"{clock.out}/quarantine").select("key", "value", "partition").collect()] == [("k", "{cut", 2)]


def test_shuffles_grow_with_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    path = scratch(spark, "events")
    spark.range(1_600_000).select(F.xxhash64("id").alias("id")).coalesce(1).write.parquet(path)  # about 13 MB
    before, split = spark.conf.get(key, None), spark.conf.get("spark.sql.files.maxPartitionBytes")
    shuffled = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        size_shuffles(spark, spark.read.parquet(path))
        assert 3 <= int(spark.conf.get(key)) <= 5
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_keys_share_their_calls_to_the_state_store(spark):
    """Two hundred devices and users in four pools: as many cells, and what each key keeps and alerts is its own."""
    rows = [payment(f"f{u:03}-{n}", n * 10 + u % 7, device_id=f"d{u}", user_id=f"u{u}", amount=9_000, status="FAILED")
            for u in range(200) for n in range(5)]
    rows += [payment(f"b{u:03}", 60, device_id=f"d{u}", user_id=f"u{u}", amount=15_000_000, location=HCMC if u % 2 else HANOI)
             for u in range(0, 200, 5)]
    rows += [payment(f"o{n}", 20 + n, device_id=None, user_id=None, location=HCMC if n else HANOI) for n in range(2)]
    rows.append(payment("later", 100, device_id="z", user_id="z"))
    got, query, ck = {}, {}, {}
    for name, build in (("card", detectors.card_testing_stream), ("travel", detectors.travel_stream)):
        tune(spark, streaming=True)
        source, path, ck[name] = scratch(spark, "src"), scratch(spark, "alerts"), scratch(spark, "ck")
        spark.createDataFrame(rows, PAYMENT).repartition(3).write.parquet(source)
        stream = build(spark.readStream.schema(spark.createDataFrame([], PAYMENT).schema).parquet(source), pools=4)
        sinks.start(stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", ck[name]), finite=True)
        got[name] = spark.read.schema(stream.schema).parquet(path).collect()
    assert {r["transaction_id"] for r in got["card"]} == {f"b{u:03}" for u in range(0, 200, 5)}
    assert all(r["evidence_id"][1:4] == r["transaction_id"][1:4] for r in got["card"]) and len(got["card"]) == 5 * 40
    assert {(r["prev_transaction_id"], r["transaction_id"]) for r in got["travel"]} == {
        (f"f{u:03}-4", f"b{u:03}") for u in range(5, 200, 10)} | {("o0", "o1")}
    cells = {name: detectors.state_of(spark, ck[name]) for name in ck}
    assert all(0 < c.count() <= 4 for c in cells.values())
    kept = {name: [tuple(r) for r in c.select(F.inline("kept")).select("key", "transaction_id").collect()] for name, c in cells.items()}
    assert sorted(kept["card"]) == sorted((f"d{u}", f"f{u:03}-{n}") for u in range(200) if u % 5 for n in range(5))
    assert sorted(kept["travel"], key=str) == sorted(
        [(f"u{u}", f"f{u:03}-4" if u % 5 else f"b{u:03}") for u in range(200)] + [(None, "o1")], key=str)


def test_pools_grow_with_the_traffic(spark):
    assert detectors.pools_of(spark.range(10)) == detectors.LEAST_POOLS
    assert detectors.pools_of(spark.range(detectors.POOL_ROWS * 3 * detectors.LEAST_POOLS)) == 3 * detectors.LEAST_POOLS


def test_a_registered_detector_takes_its_pools_from_the_traffic(spark, monkeypatch):
    monkeypatch.setattr(detectors, "POOL_ROWS", 30)
    monkeypatch.setattr(detectors, "LEAST_POOLS", 2)
    asked, real = [], detectors.travel_stream
    monkeypatch.setattr(detectors, "travel_stream", lambda rows, **kw: asked.append(kw.get("pools")) or real(rows, **kw))
    rows = [payment(f"t{u:02}-{n}", u + 240 * n, user_id=f"u{u}", location=HCMC if n and u % 3 == 0 else HANOI) for u in range(60) for n in range(2)]
    path = scratch(spark, "own")
    spark.createDataFrame(rows, PAYMENT).write.parquet(path)
    facts = spark.read.schema(spark.createDataFrame([], PAYMENT).schema).parquet(path)
    c = SimpleNamespace(spark=spark, wh=SimpleNamespace(facts=facts), scratch=lambda name: scratch(spark, f"own-{name}"),
                        stream_of=lambda staged, name: spark.readStream.schema(staged.schema).parquet(path))
    got = catalog.QUERIES["x10_travel_stream"](c).collect()
    assert asked == [4]
    assert sorted((r["prev_transaction_id"], r["transaction_id"]) for r in got) == [(f"t{u:02}-0", f"t{u:02}-1") for u in range(0, 60, 3)]
