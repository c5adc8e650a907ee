"""The stages one by one and together."""

import zlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from test_documents import brute

SF = "/root/testdata/sf0.001"
EXTRA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, toxic string, `group` string"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stage(step(spark, docs, SF), name)
        out.append((name, before, docs))
    return out


def test_columns_and_order(steps):
    assert [n for n, _, _ in steps] == ["quality", "toxicity", "near_duplicates", "packing"]
    for _, before, after in steps[:-1]:
        assert after.schema == before.schema


def test_classifiers_follow_the_labels(spark, steps):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, good in (("quality", lambda r: r.quality == 1), ("toxicity", lambda r: r.toxic == 0)):
        before, after = next((b, a) for n, b, a in steps if n == name)
        kept = {r.doc_id for r in after.collect()}
        seen = [r.doc_id for r in before.collect() if r.doc_id in labels]
        assert sum((i in kept) == good(labels[i]) for i in seen) >= 0.9 * len(seen)
        assert sum(i in kept for i in seen if good(labels[i])) >= 0.95 * sum(good(labels[i]) for i in seen)


def test_one_document_of_each_group_stays(steps):
    before, after = next((b, a) for n, b, a in steps if n == "near_duplicates")
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = sorted(eval(x)[0] for x in brute(rows, 80) if eval(x)[0] == eval(x)[2])
    assert sorted(r.doc_id for r in after.collect()) == want


def test_packing_holds_every_document(steps):
    _, before, after = steps[-1]
    assert {r.doc_id for r in after.select("doc_id").collect()} == {r.doc_id for r in before.select("doc_id").collect()}


def test_run_gives_the_last_stage(spark, steps):
    def digest(df):
        return zlib.crc32(repr(sorted(map(tuple, df.select("doc_id", "piece", "length", "ids_crc32").collect()))).encode())

    assert digest(corpus_pipeline.run(spark, SF)) == digest(steps[-1][2])


def test_odd_rows_through_every_stage(spark):
    base = "the quick brown fox jumps over the lazy dog again and again until it rests"
    rows = [(1, base, None, None, None, 0.5, "x", "g"), (1, base, None, None, None, 0.5, "x", "g"),
            (1, "an unrelated text of the very same id that must stay", "en", "s", 1, None, None, None),
            (None, base, "en", "s", 1, None, None, None), (None, "only a null id here", "", "", 0, 0.0, "", ""),
            (2, None, None, None, None, None, None, None), (3, "", "", "", 0, 0.0, "", ""), (4, base.upper(), "", "", 0, 0.0, "", ""),
            (5, "word " * 60_000, "", "", 0, 0.0, "", "")]
    docs = spark.createDataFrame(rows, EXTRA)
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, SF)
        assert out.schema == docs.schema
        assert step(spark, docs.limit(0), SF).count() == 0
        out.collect()
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    got = sorted(map(str, kept.select("doc_id", F.substring("text", 1, 9).alias("t")).collect()))
    assert got == sorted(map(str, [
        F_row(1, "the quick"), F_row(1, "an unrela"), F_row(None, "only a nu"), F_row(2, None), F_row(3, ""), F_row(5, "word word")]))
    assert {r.doc_id for r in corpus_pipeline.packing(spark, kept, SF).collect()} == {1, None, 2, 3, 5}


def test_helper_columns_leave_the_documents_columns_alone(spark):
    base = "the quick brown fox jumps over the lazy dog again and again until it rests"
    rows = [(1, base, 10, 7, "a"), (2, base, 20, 8, "b"), (3, "another text", 30, 9, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id bigint, MARK bigint, nth string")
    assert sorted(map(tuple, corpus_pipeline.near_duplicates(spark, docs, SF).collect())) == [rows[0], rows[2]]


def F_row(i, t):
    from pyspark.sql import Row
    return Row(doc_id=i, t=t)
