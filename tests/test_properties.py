"""Operators against brute force on random small inputs, with a hot key in every one of them."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import PAYMENT, payment
from tillwatch.operators import arrival, card_testing, quantiles, slices, trailing

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
MINUTE = slices.MINUTE

rows_of_keys = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]), st.integers(0, 5 * 60 * MINUTE // 1000),
              st.integers(0, 10)), min_size=1, max_size=60)


@QUICK
@given(rows=rows_of_keys, slice_min=st.sampled_from([1, 7, 15, 60]), span_min=st.sampled_from([1, 15, 40]))
def test_trailing_sum(spark, rows, slice_min, span_min):
    data = [(i, k, s * 1000, v) for i, (k, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, k string, ms bigint, v bigint")
    span = span_min * MINUTE
    got = {r["id"]: (r["total"], r["n"]) for r in trailing.trailing_sums(
        df, ["k"], F.col("ms"), span, {"total": F.col("v"), "n": F.lit(1).cast("bigint")},
        slice_min * MINUTE).collect()}
    want = {i: (sum(v2 for _, k2, m2, v2 in data if k2 == k and m - span < m2 <= m),
                sum(1 for _, k2, m2, _ in data if k2 == k and m - span < m2 <= m)) for i, k, m, _ in data}
    assert got == want


@QUICK
@given(values=st.lists(st.tuples(st.sampled_from(["hot", "hot", "x"]), st.integers(-50, 50)), min_size=1, max_size=80))
def test_percentiles(spark, values):
    df = spark.createDataFrame(values, "g string, v bigint")
    probs = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    got = {r["g"]: [r[n] for n in probs] for r in quantiles.exact_percentiles(df, ["g"], F.col("v"), probs).collect()}
    for g in {g for g, _ in values}:
        want = np.quantile([v for h, v in values if h == g], list(probs.values()))
        np.testing.assert_allclose(got[g], want, atol=1e-9)


@QUICK
@given(rows=st.lists(st.tuples(st.integers(0, 300), st.integers(-120, 0)), min_size=1, max_size=60))
def test_arrival_watermark(spark, rows):
    data = [payment(f"t{i}", seconds=arrive + lag) for i, (arrive, lag) in enumerate(rows)]
    cols = [c.split()[0] for c in PAYMENT.replace("struct<lat: double, lon: double>", "struct").split(", ")]
    base = cols.index("ingested_at")
    from conftest import at
    data = [r[:base] + (at(arrive),) + r[base + 1:] for r, (arrive, _) in zip(data, rows)]
    out = arrival.with_arrival_watermark(spark.createDataFrame(data, PAYMENT))
    got = {r["transaction_id"]: (r["out_of_order"], r["late"]) for r in out.collect()}
    for i, (arrive, lag) in enumerate(rows):
        seen = [a + lg for a, lg in rows if a < arrive]
        top = max(seen) if seen else None
        assert got[f"t{i}"] == (top is not None and arrive + lag < top, top is not None and arrive + lag < top - 10)


kinds = st.sampled_from(["small", "small", "small", "small", "big", "other"])


@QUICK
@given(rows=st.lists(st.tuples(st.sampled_from(["hot", "hot", "d2"]), st.integers(0, 900), kinds), min_size=1, max_size=70))
def test_card_testing_against_brute_force(spark, rows):
    shape = {"small": ("FAILED", 10_000), "big": ("SUCCESS", 15_000_000), "other": ("SUCCESS", 50_000)}
    data = [payment(f"t{i:03d}", s, device_id=d, status=shape[k][0], amount=shape[k][1])
            for i, (d, s, k) in enumerate(rows)]
    got = {r["transaction_id"]: r["chain_len"]
           for r in card_testing.card_testing(spark.createDataFrame(data, PAYMENT)).collect()}
    want = {}
    for device in {d for d, _, _ in rows}:
        line = sorted((s, f"t{i:03d}", k) for i, (d, s, k) in enumerate(rows) if d == device)
        for pos, (s, txn, k) in enumerate(line):
            if k != "big":
                continue
            run = 0
            for s2, _, k2 in reversed(line[:pos]):
                if k2 != "small" or s - s2 > 120:
                    break
                run += 1
            if run >= 5:
                want[txn] = run
    assert got == want
