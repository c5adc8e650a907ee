"""Vector joins and searches against brute force."""

import math

import numpy as np
import pytest

from tillwatch.llm.components import components
from tillwatch.llm.near_vectors import near_vectors
from tillwatch.llm.top_products import cut, hash_sample, narrow, top_products, wide

VECS = "vec_id bigint, embedding array<float>, label int, key string"


def closure(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def mixed_vectors(seed=4, dims=12):
    """Groups of near copies, chains, exact and scaled copies, and unusable rows."""
    rng = np.random.default_rng(seed)
    rows = []
    for size in (1, 1, 1, 2, 5, 40, 150):
        base = rng.normal(size=dims)
        for _ in range(size):
            rows.append(base + rng.normal(size=dims) * 0.12)
    chain = rng.normal(size=dims)
    for _ in range(30):
        chain = chain + rng.normal(size=dims) * 0.2
        rows.append(chain.copy())
    rows += [rng.normal(size=dims) for _ in range(120)]
    rows += [rows[3]] * 60 + [rows[5] * 7] * 3
    rows = [[float(np.float32(v)) for v in r] for r in rows]
    rows += [None, [], [0.0] * dims, [math.nan] * dims, [1.0] * (dims - 1) + [math.inf], [None] + [1.0] * (dims - 1),
             [1.0, 2.0], [2.0, 4.0], [1e30, 0.0], [-0.0, 1.0], [0.0, 3.0]]
    order = rng.permutation(len(rows))
    return [(int(i) * 3 + 1, rows[j]) for i, j in enumerate(order)]


def brute_near(rows, least):
    unit = []
    for _, v in rows:
        ok = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v, dtype=float) if ok else None
        unit.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if ok else None)
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if unit[i] is not None and unit[j] is not None
             and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= least]
    links = [0] * len(rows)
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    root = closure(len(rows), pairs)
    first = {}
    for (key, _), r in zip(rows, root):
        first[r] = min(first.get(r, key), key)
    return {key: (n, first[r], first[r] == key) for (key, _), n, r in zip(rows, links, root)}


@pytest.mark.parametrize("cell_rows, block", [(20, 16), (60, 4096), (10_000, 64)])
def test_near_vectors(spark, cell_rows, block):
    rows = mixed_vectors()
    df = spark.createDataFrame([(i, v, 0, "clash") for i, v in rows], VECS).repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept)
           for r in near_vectors(df, 0.95, cell_rows=cell_rows, block=block).collect()}
    assert got == brute_near(rows, 0.95)


def test_near_vectors_repeats_and_null_ids(spark):
    df = spark.createDataFrame([(5, [1.0, 0.0], 0, ""), (5, [1.0, 0.0], 0, ""), (None, [1.0, 0.01], 0, ""),
                                (9, [0.0, 1.0], 0, "")], VECS)
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect())
    assert got == [("5", 2, 5, True), ("5", 2, 5, True), ("9", 0, 9, True), ("None", 2, 5, False)]
    assert near_vectors(df.limit(0)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(500, 560)]
    pairs += [(600, i) for i in range(601, 700)] + [(7, 7), (8, 9), (9, 8)]
    df = spark.createDataFrame([*pairs, (None, 3)], "a bigint, b bigint")
    want = {x: r for x, r in enumerate(closure(700, pairs)) if any(x in p and p[0] != p[1] for p in pairs)}
    assert {r.node: r.component for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0


def brute_top(rows, queries, k, scale=64):
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v)

    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if usable(v) and i is not None]
    out = []
    for i, q in {(i, tuple(v)) for i, v in good if i in queries}:
        found = sorted((-sum(a * b for a, b in zip(q, v)), c) for c, v in good if c != i and len(v) == len(q))[:k]
        out += [(i, n + 1, c, -s) for n, (s, c) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("pivot_rows, block, k", [(30, 8, 5), (100, 64, 20), (10_000, 2_048, 500)])
def test_top_products(spark, pivot_rows, block, k):
    rows = [(i, v) for i, v in mixed_vectors(9) if not (v and v[0] == 1e30)]
    rows += [(2000 + i, rows[0][1] or [1.0] * 12) for i in range(40)]
    df = spark.createDataFrame([(i, v, 0, "clash") for i, v in rows], VECS).repartition(4)
    asked = {i for i, _ in rows if i % 5 == 0}
    got = top_products(df, df.where("vec_id % 5 = 0"), k, pivot_rows=pivot_rows, block=block)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, asked, k)


def test_top_products_beyond_doubles_and_odd_ids(spark):
    big = float(2 ** 24)
    rows = [(0, [big, 1.0]), (1, [big, 1.0]), (2, [big, 2.0]), (3, [-big, 0.0]), (0, [big, 1.0])]
    df = spark.createDataFrame([(i, v, 0, "") for i, v in rows] + [(None, [1.0, 1.0], 0, "")], VECS)
    got = top_products(df, df.where("vec_id = 0"), 3)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, {0}, 3)
    assert top_products(df.limit(0), df, 3).count() == 0
    assert top_products(df, df.limit(0), 3).count() == 0


def test_top_products_sends_the_driver_one_sample_not_one_per_task(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(v)) for v in x]) for i, x in enumerate(rng.normal(size=(12_000, 32)))]
    df = spark.createDataFrame([(i, v, 0, "") for i, v in rows], VECS).repartition(24)
    conf = spark.sparkContext._jsc.sc().conf()
    before = conf.get("spark.driver.maxResultSize", "1g")
    conf.set("spark.driver.maxResultSize", "2m")  # 12,000 rows of 256 bytes are more
    try:
        got = top_products(df, df.where("vec_id % 2000 = 0"), 5).collect()
    finally:
        conf.set("spark.driver.maxResultSize", before)
    assert sorted(map(tuple, got)) == brute_top(rows, {i for i, _ in rows if i % 2000 == 0}, 5)


def test_hash_sample_takes_the_smallest_hashes(spark):
    rows = [(i, int(i).to_bytes(8, "little")) for i in range(3_000)] + [(7, b"copied")] * 2_000 + [(None, b"no id")]
    df = spark.createDataFrame(rows, "id bigint, vec binary").repartition(6)
    hashed = sorted((r.hash, bytes(r.vec)) for r in df.selectExpr("xxhash64(vec, id) hash", "vec").collect())
    for most in (1, 100, 1_400, 4_999, 6_000):
        assert [bytes(v) for v in hash_sample(df, len(rows), most)] == [v for _, v in hashed[:most]]
    assert hash_sample(df.limit(0), 0) == []


def test_top_products_with_several_blocks_and_lots_in_a_place(spark, monkeypatch):
    monkeypatch.setattr("tillwatch.llm.top_products.PLACES_A_TASK", 1)
    monkeypatch.setattr("tillwatch.llm.top_products.QUERIES_A_LOT", (700, 700))
    rng = np.random.default_rng(6)
    many = [[float(np.float32(v)) for v in x] for x in rng.normal(size=(1_300, 4))]
    many[900:] = [many[0]] * 60 + [[*v[:2]] for v in many[960:]]  # copies, and vectors of another length
    rows = [(i, v) for i, v in enumerate(many)] + [(5, many[0]), (5, many[0])]
    df = spark.createDataFrame([(i, v, 0, "") for i, v in rows], VECS).repartition(4)
    got = top_products(df, df, 3, pivot_rows=300, block=16).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, {i for i, _ in rows}, 3)


@pytest.mark.parametrize("dtype", [np.float32, np.float64, np.int64, object])
def test_cut_takes_the_largest_scores_and_equal_ones_by_id(dtype):
    low = -(1 << 63) if dtype in (np.int64, object) else -9.0
    found = [(1, 7, 5), (0, 3, low), (0, 2, 1), (0, 9, 1), (0, 1, -1), (1, 6, 5), (0, 3, low)]
    query, ids, score = zip(*found)
    query, ids, score = cut(np.array(query), np.array(ids), np.array(score, dtype=dtype), 4)
    assert list(zip(query.tolist(), ids.tolist(), score.tolist())) == [
        (0, 2, 1), (0, 9, 1), (0, 1, -1), (0, 3, low), (1, 6, 5), (1, 7, 5)]


def test_narrow_numbers_come_back_as_they_were():
    for most, size in ((0, 1), (127, 1), (128, 2), (-128, 2), (32_767, 2), (40_000, 4), (2**31 - 1, 4), (-2**31, 8), (2.0**80, 8)):
        x = np.array([most, -1.0, 0.0, 3.0])
        assert len(narrow(x.tobytes())) == 2 + 4 * size
        assert wide(narrow(x.tobytes())).tobytes() == x.tobytes()
