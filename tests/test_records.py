"""Topics of records: what is kept, what is set aside, what a repeated micro-batch does, which days are rewritten."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tillwatch.plans.refresh import refresh_days, touched_days
from tillwatch.schemas import FRAUD_LABEL
from tillwatch.sources.manifest import DatedTable
from tillwatch.streaming.records import RecordTopic

RAW = "key string, value string, partition bigint, ingested_at timestamp"
NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)


def label(txn, at="2024-01-20T00:00:00.000Z"):
    return f'{{"transaction_id":"{txn}","is_fraud_confirmed":true,"label_source":"COMPLAINT","resolved_at":"{at}"}}'


@pytest.fixture
def topic(spark, tmp_path):
    return RecordTopic(spark, f"{tmp_path}/labels", FRAUD_LABEL, "transaction_id", "resolved_at", "resolved_at")


def batch(spark, *values):
    return spark.createDataFrame([(f"k{i}", v, 0, NOW) for i, v in enumerate(values)], RAW)


def test_what_cannot_be_used_is_set_aside_as_it_came(spark, topic):
    broken = [label("a")[:25], None, label("b", "soon"), '{"label_source":"COMPLAINT"}', "",
              f'{{"before":{label("c")},"after":null,"op":"d"}}']
    wrapped = f'{{"before":null,"after":{label("w")},"op":"c"}}'
    topic.process(batch(spark, label("x"), wrapped, *broken), 0)
    assert sorted(r.transaction_id for r in topic.records().collect()) == ["w", "x"]
    assert sorted((r.value or "-") for r in topic.quarantine().collect()) == sorted((v or "-") for v in broken)
    assert topic.records().where("resolved_at IS NULL").count() == 0


def test_a_repeated_micro_batch_replaces_itself(spark, topic):
    topic.process(batch(spark, label("x")), 0)
    topic.process(batch(spark, label("y"), label("z")), 1)
    topic.process(batch(spark, label("y"), label("z")), 1)
    assert topic.records().count() == 3 and topic.newest_batch() == 1
    assert sorted(r.transaction_id for r in topic.records(after=0).collect()) == ["y", "z"]
    assert topic.records(after=1).count() == 0


def test_nothing_has_come_yet(spark, topic):
    assert topic.newest_batch() == -1 and topic.records().count() == 0 and topic.quarantine().count() == 0
    topic.process(batch(spark), 0)
    assert topic.newest_batch() == -1 and topic.records().count() == 0


def test_only_the_named_days_are_computed_and_written(spark, tmp_path):
    days = [date(2024, 1, d) for d in (1, 2, 3)]
    facts = spark.createDataFrame([(f"t{i}", days[i % 3]) for i in range(9)], "transaction_id string, dt date")
    asked = []

    def mart_of(wanted):
        asked.append(list(wanted))
        return facts.where(F.col("dt").isin(wanted)).groupBy("dt").agg(
            F.count("*").alias("n"), F.lit(len(asked)).alias("run"))

    table = DatedTable(spark, f"{tmp_path}/mart", mart_of(days).schema)
    refresh_days(table, days, mart_of)
    records = spark.createDataFrame([("t1",), ("t4",), ("gone",)], "transaction_id string")
    assert touched_days(records, facts) == [days[1]]
    before = {r.dt: r.file for r in table.files().collect()}
    refresh_days(table, touched_days(records, facts), mart_of)
    after = {r.dt: r.file for r in table.files().collect()}
    assert asked[1:] == [days, [days[1]]]
    assert [d for d in days if before[d] != after[d]] == [days[1]]
    commit = table.commit()
    assert refresh_days(table, touched_days(records.where("false"), facts), mart_of) == commit == table.commit()
    assert {r.dt: r.n for r in table.read().collect()} == {d: 3 for d in days}
