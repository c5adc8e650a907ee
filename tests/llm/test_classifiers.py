"""Held-out accuracy, the solvers against plain formulas, and odd inputs."""

import numpy as np
import pytest

from tillwatch.llm import quality, toxicity
from tillwatch.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_quality_held_out(spark, labels):
    rows = QUERIES["op2_quality"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [(r.predicted, labels[r.doc_id].quality) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 40
    assert np.mean([a == b for a, b in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_toxicity_held_out(spark, labels):
    rows = QUERIES["op8_toxicity"](spark, SF).collect()
    seen = [(r.toxic, labels[r.doc_id].toxic == 1) for r in rows if r.doc_id in labels]
    assert np.mean([a == b for a, b in seen]) >= 0.95
    assert all(r.severity >= r.score - 1e-9 and r.toxic == (r.score >= 0.2) for r in rows)


DOCS = "doc_id bigint, text string, score string, label string"


def odd_docs(spark):
    return spark.createDataFrame([
        (None, "no id", "", ""), (1, None, "", ""), (2, "", "", ""), (3, " \n\t", "", ""),
        (4, "word " * 50_000, "", ""), (5, "a b", "", ""), (5, "a b", "", ""), (6, "x" * 200_000, "", "")], DOCS)


@pytest.mark.parametrize("labels", [
    [], [(1, 1)], [(1, None), (None, 1)], [(1, 1), (2, 1)], [(4, 0), (5, 1), (5, 0), (99, 1), (6, 1)]])
def test_odd_inputs_and_labels(spark, labels):
    docs = odd_docs(spark)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int").selectExpr("*", "quality as toxic", "'x' as text")
    a = quality.score_quality(docs, quality.fit_quality(docs, marks)).collect()
    b = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, marks)).collect()
    assert len(a) == len(b) == 8
    assert all(0 <= r.score <= 1 for r in a) and all(0 <= r.score <= 1 and r.severity >= 0 for r in b)
    assert len({r.score for r in a if r.doc_id in (1, 2, 3)}) == 1
    assert quality.score_quality(docs.limit(0), quality.fit_quality(docs.limit(0), marks)).count() == 0


def test_dual_descent_reaches_the_primal_optimum():
    rng = np.random.default_rng(1)
    rows = [np.flatnonzero(rng.random(12) < 0.4) for _ in range(60)]
    values = [rng.random(len(r)) + 0.1 for r in rows]
    signs = np.where(rng.random(60) < 0.5, 1, -1)
    cost = np.full(60, 0.7)

    def objective(w):
        return w @ w / 2 + sum(c * max(0, 1 - y * (w[r] @ v + w[-1])) for r, v, y, c in zip(rows, values, signs, cost))

    w = quality.dual_coordinate_descent(rows, values, signs, cost, epochs=3000, tolerance=1e-9)
    best = objective(w)
    for _ in range(400):
        step = np.zeros_like(w)
        step[np.r_[0:12, -1]] = rng.normal(size=13) * rng.choice([1e-3, 1e-2, 1e-1])
        assert objective(w + step) >= best - 1e-6


def test_log_count_ratio_by_hand():
    rows = [np.array([0, 1]), np.array([1]), np.array([2])]
    r = quality.log_count_ratios(rows, np.array([1, 1, 0]))
    p, q = quality.BUCKETS + 3, quality.BUCKETS + 1
    assert np.isclose(r[1], np.log((3 / p) / (1 / q))) and np.isclose(r[2], np.log((1 / p) / (2 / q)))


def test_thresholds_are_ordered_and_severity_grows():
    rng = np.random.default_rng(3)
    grades = rng.integers(0, 4, 600)
    rows = [np.unique(np.concatenate([rng.integers(10, 60, 5), np.arange(g)])) for g in grades]
    m = toxicity.fit_severity(rows, grades)
    assert (np.diff(m.thresholds) > 0).all()
    expected = [m.at_least(np.arange(g)).sum() for g in range(4)]
    assert expected == sorted(expected) and expected[3] - expected[0] > 1.5
    hit = np.mean([np.argmax(-np.diff(np.concatenate([[1.0], m.at_least(x), [0.0]]))) == g for x, g in zip(rows, grades)])
    assert hit > 0.9


def test_long_words_count_to_their_last_character():
    forms = quality.Forms()
    head, tail = "文" * 64, "終" * 100
    one = quality.form_ngrams(head + "本。" * 300 + tail, forms)
    two = quality.form_ngrams(head + "a1,B2;" * 300 + tail, forms)
    assert len(set(one) ^ set(two)) > 10
    rng = np.random.default_rng(2)
    text = "".join(rng.choice(list("aB0,;字"), 5_000))
    for at in range(0, 5_000, 250):  # every part of the word has its own features
        changed = text[:at] + "#%" * 30 + text[at + 60:]
        assert set(quality.form_ngrams(changed, forms)) != set(quality.form_ngrams(text, forms))
    assert set(quality.form_ngrams("end" + "." * 20, forms)) != set(quality.form_ngrams("end" + "." * 30, forms))


def test_the_sample_bounds_rows_and_takes_documents_at_hand(spark):
    docs = spark.createDataFrame(
        [(1, f"copy {i % 7}", "", "") for i in range(60)] + [(i, f"text {i}", "", "") for i in range(2, 30)] + [(None, "x", "", "")],
        DOCS).repartition(4)
    marks = spark.createDataFrame([(i, i % 2) for i in range(2_000)] + [(None, 1)], "doc_id bigint, quality int")

    def sample(rows, labels, most):
        return quality.fit_on_sample(
            rows, labels, "doc_id", "text", "quality", most, quality.Forms, quality.form_ngrams, lambda x, y: (len(x), int(y.sum())))

    assert sample(docs, marks, 100) == (29, 15)  # ids 1 to 29, once each
    assert sample(docs, marks, 10)[0] == 10  # not fewer, though most labelled ids have no document
    assert sample(docs.limit(0), marks, 10) == (0, 0)
