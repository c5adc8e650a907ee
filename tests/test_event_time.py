"""Watermarks by partition, state and its end, hot keys, topics with a current state, tables by manifest."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from conftest import BASE, HCMC, PAYMENT, at, payment
from tillwatch.operators.card_testing import card_testing_evidence
from tillwatch.operators.idle import CLOCK, clock_after, with_partition_watermark
from tillwatch.operators.panes import panes_of, sliding_from_panes
from tillwatch.operators.quantiles import exact_percentiles, selected_percentiles
from tillwatch.operators.travel import impossible_travel
from tillwatch.plans import lifecycle, quality
from tillwatch.plans.silver import merge_late_into
from tillwatch.schemas import FRAUD_RULE
from tillwatch.session import scratch, tune
from tillwatch.sources.manifest import DatedTable
from tillwatch.streaming import detectors, sinks, topics
from tillwatch.streaming.closing import Closable
from tillwatch.streaming.compacted import CompactedTopic, RuleBook

START = int(BASE.timestamp() * 1000)


# ---- watermark by partition ---------------------------------------------------------------------

def plain_watermarks(rows, bound=10_000, idle=30_000):
    """Rows (id, partition, event ms, arrival ms): the watermark seen by each."""
    marks, mark = {}, None
    for t in sorted({r[3] for r in rows}):
        known = {}
        for _, p, ms, arrived in rows:
            if arrived < t:
                top, last = known.get(p, (ms, arrived))
                known[p] = (max(top, ms), max(last, arrived))
        if known:
            newest = max(last for _, last in known.values())
            now = min(top for top, last in known.values() if last >= min(t - idle, newest)) - bound
            mark = now if mark is None else max(mark, now)
        marks[t] = mark
    return sorted((r[0], marks[r[3]], marks[r[3]] is not None and r[2] < marks[r[3]]) for r in rows)


def arrivals(seed, n=160):
    rng, rows, now = random.Random(seed), [], 0
    for i in range(n):
        now += rng.choice([0, 0, 1, 400, 9_000, 29_999, 30_000, 30_001, 70_000, 400_000])
        p = rng.choice([0, 0, 0, 1, 2, None]) if not 40 < i < 90 else rng.choice([0, 1])
        rows.append((f"r{i}", p, now - rng.choice([0, 500, 9_999, 10_000, 10_001, 60_000]), now))
    # a backlog of a silent partition at the end
    return rows + [(f"b{i}", 2, 5_000 * i, now + 5 + i) for i in range(20)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, src_partition bigint, ms bigint, arrived bigint").select(
        "id", "src_partition", F.timestamp_millis(F.col("ms") + START).alias("event_ts"),
        F.timestamp_millis(F.col("arrived") + START).alias("ingested_at"))


def got_of(marked):
    return sorted((r["id"], None if r["watermark_ms"] is None else r["watermark_ms"] - START, r["late"]) for r in marked.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_partition_watermark_equals_brute_force(spark, seed):
    rows = [r if r[1] is not None else (r[0], 3, *r[2:]) for r in arrivals(seed)]
    assert got_of(with_partition_watermark(frame(spark, rows))) == plain_watermarks(rows)


def test_partition_watermark_is_the_same_in_pieces(spark):
    rows = [r if r[1] is not None else (r[0], 3, *r[2:]) for r in arrivals(7)]
    times, before, got = sorted({r[3] for r in rows}), spark.createDataFrame([], CLOCK), []
    cuts = [times[len(times) // 3], times[len(times) // 2], times[-1] + 1]
    for lo, hi in zip([-1, *cuts], cuts):
        piece = frame(spark, [r for r in rows if lo <= r[3] < hi])
        marked = with_partition_watermark(piece, before=before)
        got += got_of(marked)
        before = spark.createDataFrame(clock_after(marked, before=before).collect(), CLOCK)
    assert sorted(got) == plain_watermarks(rows)


def test_a_silent_partition_holds_nothing_back_for_longer_than_its_time_out(spark):
    """Both speak, one falls silent: its last event time counts for 30 s of arrivals, then no more."""
    rows = [("a", 0, 0, 0), ("b", 1, 0, 0)] + [(f"x{n}", 0, n * 1000, n * 1000) for n in range(1, 60)]
    marks = {r[0]: r[1] for r in got_of(with_partition_watermark(frame(spark, rows)))}
    assert marks["x30"] == -10_000 and marks["x31"] == 20_000
    assert got_of(with_partition_watermark(frame(spark, []))) == []


# ---- keyed detectors: the end of the input, hot keys, state -------------------------------------

def detect(spark, build, rows, pieces=1):
    """Alerts over a finite input in pieces, drained; the query's state folder."""
    tune(spark, streaming=True)
    source, path, ck = scratch(spark, "src"), scratch(spark, "alerts"), scratch(spark, "ck")
    schema = spark.createDataFrame([], PAYMENT).schema
    spark.createDataFrame([], schema).write.parquet(source)
    ends = Closable(spark, spark.readStream.schema(schema).parquet(source), scratch(spark, "closing"))
    stream = build(ends.stream)
    rows = sorted(rows, key=lambda r: r[9])
    for n in range(pieces):
        part = rows[len(rows) * n // pieces:len(rows) * (n + 1) // pieces]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        if n == pieces - 1:
            ends.advance(round(rows[-1][9].timestamp() * 1000) + 60_000)
        sinks.start(stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", ck), finite=True)
    return spark.read.schema(stream.schema).parquet(path), ck


def traffic(seed=5, n=900):
    """One device and user with a third of all rows, attacks across slice borders among them."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        hot = i % 3 == 0
        kind = rng.random()
        rows.append(payment(
            f"t{i:04}", i * 7.0, device_id="hot" if hot else f"d{i % 11}", user_id="hot" if hot else f"u{i % 13}",
            status="FAILED" if kind < 0.75 else "SUCCESS", amount=9_000 if kind < 0.75 else 15_000_000,
            location=HCMC if rng.random() < 0.5 else (21.0278, 105.8342)))
    return rows


def test_hot_keys_are_split_and_give_what_the_batch_operators_give(spark):
    rows = traffic()
    table = spark.createDataFrame(rows, PAYMENT)
    assert [r[0] for r in detectors.hot_keys(table, "device_id", share=4).collect()] == ["hot"]
    hot = detectors.hot_keys(table, "device_id", share=4)
    got, ck = detect(spark, lambda s: detectors.card_testing_stream(s, hot=hot), rows, 2)
    want = card_testing_evidence(table).select("alert_txn", "transaction_id")
    assert sorted(map(tuple, got.select("transaction_id", "evidence_id").collect())) == sorted(map(tuple, want.collect()))
    assert got.where("device_id = 'hot'").count() > 0
    hot = detectors.hot_keys(table, "user_id", share=4)
    got, ck = detect(spark, lambda s: detectors.travel_stream(s, hot=hot, slice_ms=600_000), rows, 2)
    want = impossible_travel(table).select("transaction_id", "prev_transaction_id")
    assert sorted(map(tuple, got.select("transaction_id", "prev_transaction_id").collect())) == sorted(map(tuple, want.collect()))


def test_a_hot_key_is_served_by_several_tasks(spark):
    tune(spark, streaming=True)
    rows = [payment(f"t{i:04}", i * 60.0, device_id="hot", status="FAILED", amount=9_000) for i in range(300)]
    schema = spark.createDataFrame([], PAYMENT).schema
    source, ck = scratch(spark, "src"), scratch(spark, "ck")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    hot = spark.createDataFrame([("hot",)], "device_id string")
    stream = detectors.card_testing_stream(spark.readStream.schema(schema).parquet(source), hot=hot)
    query = stream.writeStream.format("parquet").option("path", scratch(spark, "o")).option("checkpointLocation", ck)
    query.trigger(availableNow=True).start().awaitTermination()
    # the state of the first micro-batch, before the watermark passed anything
    cells = spark.read.format("statestore").option("path", ck).option("operatorId", 0).option(
        "stateVarName", "cell").option("batchId", 0).load()
    per_task = [r["count"] for r in cells.groupBy("partition_id").count().collect()]
    assert len(per_task) > 3 and sum(per_task) >= 30


def test_state_ends_when_its_time_is_over(spark):
    """A position for a day, a streak for two minutes; a closing record moves the clock alone."""
    tune(spark, streaming=True)
    schema = spark.createDataFrame([], PAYMENT).schema
    rows = [payment(f"f{i}", i * 10, device_id="evil", amount=9_000, status="FAILED") for i in range(3)]
    for build, moves, kept in ((detectors.card_testing_stream, (110, 600), [3, 0]),
                               (detectors.travel_stream, (23 * 3_600, 24 * 3_600 + 21), [1, 0])):
        source, ck = scratch(spark, "src"), scratch(spark, "ck")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
        ends, seen = Closable(spark, spark.readStream.schema(schema).parquet(source), scratch(spark, "closing")), []
        out = scratch(spark, "o")
        for later in moves:
            ends.advance(START + later * 1000)
            sinks.start(build(ends.stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", ck), finite=True)
            seen.append(detectors.state_of(spark, ck).select(F.explode("kept")).count())
        assert seen == kept


def test_a_missing_number_does_not_reach_the_state_of_others(spark):
    rows = [payment(f"f{i}", i * 10, device_id="evil", amount=9_000, status="FAILED") for i in range(5)]
    rows += [payment("B", 55, device_id="evil", amount=15_000_000), payment("n", 3, device_id="other", amount_vnd=None)]
    got, _ = detect(spark, detectors.card_testing_stream, rows)
    assert got.count() == 5


# ---- compacted topics ---------------------------------------------------------------------------

def rule(rule_id, version, limit, enabled=True):
    return ('{"rule_id":"%s","rule_type":"AMOUNT_THRESHOLD","params":{"max_amount_vnd":"%d"},"action":"BLOCK","priority":1,'
            '"enabled":%s,"effective_from":"2024-01-01T00:00:00.000Z","version":%d,"updated_at":"2024-01-01T00:00:00.000Z"}'
            % (rule_id, limit, str(enabled).lower(), version))


def test_a_compacted_topic_keeps_the_current_record_over_restarts(spark):
    topic = topics.Topic("rules", path=scratch(spark, "topic"))
    out, ck, seen = scratch(spark, "rules"), scratch(spark, "ck"), []

    def publish(*records):
        rows = [(k, v, 0, at(s)) for k, v, s in records]
        topics.write_topic(spark.createDataFrame(rows, topics.ROW).coalesce(1), topic)
        rules = CompactedTopic(spark, out, FRAUD_RULE, "rule_id", ("version",), compact_every=2)
        rules.run(topics.read_stream(spark, topic), ck, finite=True)
        seen.append(sorted((r["rule_id"], r["version"]) for r in rules.snapshot().collect()))
        return rules

    empty = CompactedTopic(spark, scratch(spark, "none"), FRAUD_RULE, "rule_id")
    assert empty.snapshot().count() == 0 and empty.version() == -1
    publish(("A", rule("A", 1, 10), 0), ("B", rule("B", 1, 10), 0), ("x", "{broken", 0))
    publish(("A", '{"before":null,"after":%s,"op":"u"}' % rule("A", 2, 20), 10))
    publish(("B", None, 20), ("C", rule("C", 1, 5), 20))
    publish(("A", '{"before":%s,"after":null,"op":"d"}' % rule("A", 2, 20), 30))
    rules = publish(("B", rule("B", 3, 30, enabled=False), 40), ("A", rule("A", 9, 1), 5))  # an old record of A comes late
    assert seen == [[("A", 1), ("B", 1)], [("A", 2), ("B", 1)], [("A", 2), ("C", 1)], [("C", 1)], [("B", 3), ("C", 1)]]
    # every version can still be read, and the unreadable record is kept
    assert [sorted((r["rule_id"], r["version"]) for r in rules.snapshot(v).collect()) for v in range(5)] == seen
    assert [(r["key"], r["value"]) for r in rules.quarantine().collect()] == [("x", "{broken")]
    book = RuleBook(rules, scratch(spark, "used"))
    assert [r["rule_id"] for r in book.of_batch(7).collect()] == ["C"]
    publish(("D", rule("D", 1, 1), 50))
    # a repeated batch of decisions sees the rules of its first attempt, a new one the newest
    assert [r["rule_id"] for r in book.of_batch(7).collect()] == ["C"]
    assert sorted(r["rule_id"] for r in book.of_batch(8).collect()) == ["C", "D"]


# ---- tables by manifest -------------------------------------------------------------------------

def dated(spark, *rows):
    return spark.createDataFrame([(t, d, n, at(s)) for t, d, n, s in rows], "transaction_id string, dt date, n bigint, ingested_at timestamp")


def test_a_table_changes_by_whole_commits_and_only_where_it_must(spark):
    day = [date(2024, 1, n) for n in range(1, 5)]
    table = DatedTable(spark, scratch(spark, "table"), dated(spark).schema)
    assert table.read().count() == 0 and table.commit() == 0
    table.append(dated(spark, ("a", day[0], 1, 0), ("b", day[1], 1, 0), ("c", day[2], 1, 0)))
    before, files = table.read(), {r["file"]: r["dt"] for r in table.files().collect()}
    # late rows: a new one, and a later copy of one that is there
    assert merge_late_into(table, dated(spark, ("d", day[1], 2, 9), ("b", day[1], 5, 9), ("e", day[3], 1, 9))) == 2
    rows = sorted((r["transaction_id"], r["n"]) for r in table.read().collect())
    assert rows == [("a", 1), ("b", 5), ("c", 1), ("d", 2), ("e", 1)]
    kept = {r["file"]: r["dt"] for r in table.files().where("commit = 1").collect()}
    assert kept == {f: d for f, d in files.items() if d != day[1]}
    assert sorted(r["transaction_id"] for r in before.collect()) == ["a", "b", "c"]  # a reader keeps what it has begun
    assert merge_late_into(table, dated(spark)) == 2
    assert table.read([day[0]]).count() == 1


def test_a_write_that_dies_leaves_the_table_as_it_was(spark, monkeypatch):
    table = DatedTable(spark, scratch(spark, "table"), dated(spark).schema)
    table.append(dated(spark, ("a", date(2024, 1, 1), 1, 0)))
    monkeypatch.setattr(DatedTable, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError):
        table.append(dated(spark, ("b", date(2024, 1, 1), 1, 0)))
    assert [r["transaction_id"] for r in table.read().collect()] == ["a"]


def test_small_files_are_packed_and_large_ones_left(spark):
    table = DatedTable(spark, scratch(spark, "table"), dated(spark).schema)
    days = [date(2024, 1, 1), date(2024, 1, 2)]
    for n in range(6):
        table.append(dated(spark, *[(f"x{n}-{i}", days[0], i, 0) for i in range(50)], *([("y", days[1], 1, 0)] if n == 0 else [])))
    sizes = [r["bytes"] for r in table.files().where(F.col("dt") == F.lit(days[0])).collect()]
    assert len(sizes) == 6
    want = sorted((r["transaction_id"], r["n"]) for r in table.read().collect())
    one = max(sizes)
    table.compact(target=2 * one + 1)  # two or three files to a bin
    assert 2 <= table.files().where(F.col("dt") == F.lit(days[0])).count() <= 3
    alone = table.files().where(F.col("dt") == F.lit(days[1])).first()
    assert alone["commit"] == 1
    assert sorted((r["transaction_id"], r["n"]) for r in table.read().collect()) == want
    n = table.commit()
    assert table.compact(target=1) == n  # nothing is small


# ---- panes, ranks, history ----------------------------------------------------------------------

def test_panes_make_every_sliding_window(spark):
    rng = random.Random(2)
    rows = [(f"u{rng.randrange(3)}", rng.randrange(0, 3 * 3600 * 1000), rng.randrange(100)) for _ in range(400)]
    table = spark.createDataFrame(rows, "user_id string, ms bigint, amount_vnd bigint").withColumn(
        "event_ts", F.timestamp_millis(F.col("ms") + START))
    want = {}
    for user, ms, amount in rows:
        for k in range(15):
            key = (user, (START + ms) // 60_000 - k)
            want[key] = want.get(key, 0) + amount
    got = sliding_from_panes(panes_of(table))
    assert {(r[0], r[1]): r[2] for r in got.select("user_id", (F.unix_millis("window_start") / 60_000).cast("bigint"), "total").collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # panes, then panes by hour; never windows


@pytest.mark.parametrize("ranges", [1, 4, 64])
def test_selection_by_rank_equals_the_sorted_group(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, rng.randrange(-50, 50), 7, rng.randrange(10**9)])) for _ in range(500)]
    rows += [("one", 3), ("same", 5), ("same", 5), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    probs = {"p0": 0.0, "p5": 0.5, "p9": 0.99, "p1": 1.0}
    got = selected_percentiles(df, ["g"], F.col("v"), probs, ranges)
    want = exact_percentiles(df, ["g"], F.col("v"), probs)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    whole = selected_percentiles(df, [], F.col("v"), probs, ranges).collect()
    assert [str(r) for r in whole] == [str(r) for r in exact_percentiles(df, [], F.col("v"), probs).collect()]


def test_a_group_of_all_rows_is_ranked_range_by_range(spark):
    """No sort holds more than a range of the values."""
    rows = spark.range(20_000).select(F.lit("all").alias("g"), (F.col("id") * 7919 % 20_011).alias("v"))
    out = selected_percentiles(rows, ["g"], F.col("v"), {"p50": 0.5, "p99": 0.99})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "_c#" in line]
    assert windows and all("_r#" in line for line in windows)
    values = sorted(n * 7919 % 20_011 for n in range(20_000))
    row = out.first()
    assert (row["p50"], row["n"]) == ((values[9_999] + values[10_000]) / 2, 20_000)


def test_history_by_day_equals_the_rebuild(spark):
    rng = random.Random(1)
    days = [date(2024, 5, 1) + timedelta(days=n) for n in range(6)]
    rows = []
    for user in range(40):
        state = "NEW"
        for n, day in enumerate(days):
            state = rng.choice([state, state, "ACTIVE", "AT_RISK"])
            rows.append((f"u{user}", state, day, 1.0 * n, n, 0.5, n, n, n))
    states = spark.createDataFrame(rows, "user_id string, state string, as_of date, median_gap double, days_silent bigint, "
                                   "silence_ratio double, txn_count_30d bigint, txn_count_90d bigint, gmv_30d bigint")
    schema = states.select("user_id", "state", *lifecycle.OPENED, F.col("as_of").alias("dt")).schema
    table = DatedTable(spark, scratch(spark, "history"), schema)
    for day in [*days[:3], days[2], *days[3:]]:  # one day is merged twice
        lifecycle.merge_day(table, states, day)
    want = lifecycle.history(states)
    got = lifecycle.written_history(table).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # only users that changed were written
    changed = states.withColumn("b", F.lag("state").over(W.partitionBy("user_id").orderBy("as_of"))).where(
        F.col("b").isNull() | (F.col("b") != F.col("state")))
    assert table.read().count() == changed.count()
    # a user that leaves closes its stretch, and may come back
    rest = states.where("user_id <> 'u0'").withColumn("as_of", F.date_add("as_of", 10))
    lifecycle.merge_day(table, rest, days[0] + timedelta(days=10))
    last = lifecycle.written_history(table).where("user_id = 'u0'").orderBy(F.desc("valid_from")).first()
    assert last["valid_to"] == days[0] + timedelta(days=10) and not last["is_current"]


# ---- data tests that fail -----------------------------------------------------------------------

def test_data_tests_find_what_they_look_for(spark):
    facts = spark.createDataFrame(
        [("2024-01-01", "M1", 100, 50, 10.0, 5.0, 0.02), ("2024-01-01", "M2", 100, 150, 10.0, 5.0, 0.02),
         ("2024-01-01", "M3", 100, 0, 10.0, 11.0, 0.02), ("2024-01-01", "M4", 100, 0, 10.0, 5.0, 0.2)],
        "date_day string, merchant_id string, gmv bigint, refund_amount bigint, gross_revenue double, net_revenue double, take_rate double")
    assert sorted(r["merchant_id"] for r in quality.merchant_invariants(facts).collect()) == ["M2", "M3", "M4"]
    dim = spark.createDataFrame([("M1",), ("M2",)], "merchant_id string")
    assert sorted(r["merchant_id"] for r in quality.unrelated(facts, dim, "merchant_id").collect()) == ["M3", "M4"]
    assert [r["copies"] for r in quality.not_unique(facts.unionAll(facts.limit(1)), "merchant_id").collect()] == [2]
    rates = spark.createDataFrame([(0.5,), (1.5,), (-0.1,), (None,)], "false_positive_rate double")
    assert quality.violating(rates, F.col("false_positive_rate").between(0, 1)).count() == 2
    states = spark.createDataFrame([("ACTIVE",), ("SLEEPY",), (None,)], "state string")
    assert [tuple(r) for r in quality.not_accepted(states, {"state": ("ACTIVE", "NEW")}).collect()] == [("state", "SLEEPY", 1)]
