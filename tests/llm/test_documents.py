"""The shingle join against brute force, and the properties its index rests on."""

import random

import numpy as np
import pytest

from tillwatch.llm import shingle_join
from tillwatch.llm.shingle_join import WordHashes, near_documents, shingles, signatures

DOCS = "doc_id bigint, text string, n_shingles string, component_id string"


def plain_set(text, words=5):
    parts = []
    for raw in (text or "").encode().split():
        parts.append(raw.lower())
    if not parts:
        return frozenset()
    n = min(len(parts), words)
    return frozenset(tuple(parts[i:i + n]) for i in range(len(parts) - n + 1))


def brute(rows, percent):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    first = {}
    for i, (key, _) in enumerate(rows):
        r = find(i)
        first[r] = min([x for x in (first.get(r), key) if x is not None], default=None)
    return sorted(str((key, len(sets[i]), first[find(i)])) for i, (key, _) in enumerate(rows))


def copies(seed, vocabulary):
    """Groups of near copies around the bound, shared passages, exact copies and odd texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    passage = [rng.choice(words) for _ in range(40)]
    texts = []
    for size in (2, 3, 8, 40):
        base = [rng.choice(words) for _ in range(rng.randint(30, 160))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    for _ in range(60):
        own = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        at = rng.randint(0, len(own))
        texts.append(" ".join(own[:at] + passage + own[at:]))
    for n in range(1, 14):
        texts += [" ".join(words[:n]), " ".join(words[:n]).upper(), " \t".join(words[:n]) + "\n" + words[50]]
    texts += [None, "", " \n", "One  two", "one two", "é É", "é é", "x " * 4_000, "x " * 300, texts[5], texts[5], texts[5].upper()]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    return rows + [rows[3], (rows[4][0], "another text of the same id altogether"), (None, texts[0]), (None, "lonely text here")]


@pytest.mark.parametrize("class_from, hot, percent, vocabulary", [
    ((64, 2_048), 4_096, 80, 400), ((1, 4), 4_096, 80, 60), ((0, 1), 2, 80, 400), ((2, 10), 3, 90, 60), ((0, 0), 1, 70, 80)])
def test_components_equal_brute_force(spark, monkeypatch, class_from, hot, percent, vocabulary):
    monkeypatch.setattr(shingle_join, "CLASS_FROM", class_from)
    monkeypatch.setattr(shingle_join, "HOT_ROWS", hot)
    rows = copies(11, vocabulary)
    df = spark.createDataFrame([(i, t, "clash", "") for i, t in rows], DOCS).repartition(4)
    got = near_documents(df, percent=percent).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == brute(rows, percent)


def test_empty_table(spark):
    assert near_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_linked_sets_always_share_an_entry(monkeypatch):
    rng = np.random.default_rng(8)
    for classes in ((64, 2_048), (1, 3), (0, 2)):
        monkeypatch.setattr(shingle_join, "CLASS_FROM", classes)
        for _ in range(400):
            n = int(rng.integers(1, 200))
            a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            drop = int(rng.integers(0, len(a) // 8 + 1))
            b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 1 << 62, drop).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both < 80 * (len(a) + len(b) - both):
                continue
            heat = {int(t): int(t) % 5 for t in np.union1d(a, b)}
            x, hx = signatures(a, np.array([heat[int(t)] for t in a]), 80)
            y, hy = signatures(b, np.array([heat[int(t)] for t in b]), 80)
            shared = set(x.tolist()) & set(y.tolist())
            assert shared
            mine, yours = dict(zip(x.tolist(), hx.tolist())), dict(zip(y.tolist(), hy.tolist()))
            assert all(mine[s] == yours[s] for s in shared)  # the salt of an entry is the same for all its sets


def test_shingles_follow_the_definition():
    known = WordHashes()
    for text in ("", "a", "A b c d", "a b c d e", "a b c d e f", "a b c d e a b c d e a b c d e", "x\x0by\x0cz w é É"):
        assert len(shingles(text, known)) == len(plain_set(text))
    assert (shingles("A B C D E", known) == shingles("a\tb\nc d  e", known)).all()
    assert (shingles("a b c d e", known) != shingles("a b c e d", known)).all()
    assert len(np.intersect1d(shingles("a b", known), shingles("b a", known))) == 0


def test_parity_bits_bound_the_difference():
    rng = np.random.default_rng(5)
    sets = []
    for n in (1, 3, 15, 16, 17, 60, 64, 65, 300, 1_000):
        base = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        sets += [base, np.unique(np.concatenate([base[n // 5:], rng.integers(0, 1 << 62, n // 9).astype(np.uint64)])), base]
    bits = [shingle_join.parity_bits(s) for s in sets]
    bound = shingle_join.apart(bits, bits)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert bound[i, j] == bound[j, i] <= len(np.setxor1d(a, b))
    assert bound[24, 25] > 0.5 * len(np.setxor1d(sets[24], sets[25]))


def test_blocks_of_a_cluster_meet(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK", 7)
    monkeypatch.setattr(shingle_join, "STRIP", 3)
    monkeypatch.setattr(shingle_join, "CLASS_FROM", (1, 4))
    rows = copies(17, 90)
    df = spark.createDataFrame([(i, t, "", "") for i, t in rows], DOCS).repartition(3)
    got = near_documents(df).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == brute(rows, 80)
