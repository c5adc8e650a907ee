"""Line dedup, source divergence and turn repair against brute force, with odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from tillwatch.llm.divergence import divergence, terms
from tillwatch.llm.line_dedup import HASH, LineRuns, batch_keys, dedup_lines, hashed_lines
from tillwatch.llm.turn_repair import (
    NEXT, BlockTables, damaged, edits_of, repair_report, repaired_rows)

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- lines --------------------------------------------------------------------------------------

def plain_lines(rows, min_chars=20, min_docs=3):
    """Rows (id, text); a missing id is one document below all others."""
    def key(line):
        return line.strip(WHITE).translate(LOWER)

    def order(i):
        return -(1 << 63) if i is None else i

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(order(i))
    owner = {k: max(h) for k, h in holders.items() if len(h) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if owner.get(key(x), order(i)) == order(i)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def line_rows(seed=3):
    rng = random.Random(seed)
    shared = [f"shared line number {n} of this corpus" for n in range(12)]
    lines = shared + [f"  {x.upper()}\t" for x in shared] + ["short", "", " ", "\r", "Ä" * 20, "ä" * 20, "x" * 19, "x" * 20]
    rows = []
    for i in range(120):
        mine = [rng.choice(lines) if rng.random() < 0.6 else f"own line {i} {n} with enough text" for n in range(rng.randint(0, 14))]
        rows.append((i * 13 % 127, "\n".join(mine)))
    rows += [(None, shared[0]), (None, shared[1] + "\n\n" + shared[0]), (5, None), (6, ""), (500, "\n\n\n"), (500, "\n\n\n")]
    rows += [rows[3], rows[3], (rows[4][0], shared[2] + "\nanother text of an id"), (900, "\n".join([shared[3]] * 3000)),
             (-7, "\n".join(f"long text {n} with many lines" for n in range(4000)) + "\n" + shared[3])]
    rows += [(1000 + n, "very common line of text here\nand " + "z" * 40) for n in range(60)]
    return rows


@pytest.mark.parametrize("batches, fanout", [(1, 3), (4, 2), (7, 3)])
def test_lines_equal_brute_force(spark, batches, fanout):
    rows = line_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = dedup_lines(docs, batches=batches, fanout=fanout).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got), key=repr) == plain_lines(rows)


def test_heavy_lines_take_the_same_way(spark, monkeypatch):
    """With every hash heavy, and with none, the result is the same."""
    rows = line_rows(5)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for heavy in (10**9, 0):
        monkeypatch.setattr("tillwatch.llm.line_dedup.HEAVY", heavy)
        got = dedup_lines(docs, batches=3).collect()
        assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got), key=repr) == plain_lines(rows)


def test_lines_keep_other_columns(spark):
    rows = [(n, "a line of more than twenty characters\nown", n, "h", None, -1, "`") for n in range(4)]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, `order` bigint, h1 string, mark string, n_lines bigint, `own_text` string")
    got = {r.doc_id: r for r in dedup_lines(docs, batches=2).collect()}
    assert dedup_lines(docs).columns == ["doc_id", "text", "order", "h1", "mark", "own_text", "n_lines", "n_dropped"]
    assert [got[n].text for n in range(4)] == ["own"] * 3 + [rows[3][1]]
    assert [(got[n].order, got[n].h1, got[n].n_lines, got[n].own_text) for n in range(4)] == [(n, "h", 2, "`") for n in range(4)]


def test_no_documents_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")
    assert dedup_lines(docs).collect() == [] and divergence(docs).collect() == []


def test_runs_compact_by_level_and_tell_new_lines_from_known_ones(spark):
    runs, seen, texts = LineRuns(spark, buckets=4, fanout=3), Counter(), []
    for n in range(10):
        texts.append("\n".join(f"line {k} of the shared stock of lines" for k in range(n, n + 5)))
        rows = spark.createDataFrame([(100 - n, n, texts[-1])], "`order` bigint, mark bigint, text string")
        keys = batch_keys(hashed_lines(rows, 20)).persist()
        fresh = runs.anti_join(keys).where("owner is not null").count()
        assert fresh == sum(line not in seen for line in texts[-1].split("\n"))
        seen.update(texts[-1].split("\n"))
        runs.add(keys)
        assert all(len(level) < 3 for level in runs.levels)
    whole = runs.compact()
    assert whole.select(*HASH).distinct().count() == whole.count() == len(seen)
    assert sorted(r.docs for r in whole.collect()) == sorted(seen.values())


def test_runs_are_joined_without_shuffling_them(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = LineRuns(spark, buckets=8, fanout=4)
        rows = spark.range(100).selectExpr("id h1", "id h2", "id docs", "id rows", "id owner")
        for _ in range(2):
            runs.add(rows)
        plan = runs.anti_join(rows.repartition(8, *HASH))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("SortMergeJoin") == 2 and plan.count("Sort [") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- terms --------------------------------------------------------------------------------------

def plain_divergence(rows, min_docs, top):
    """Rows (lang, source, text), all terms of all groups, integer arithmetic."""
    import re

    word = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs, freq, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in ((a or "", b or "", c or "") for a, b, c in rows):
        found = Counter(word.findall(text.translate(LOWER)))
        docs[lang].update(found.keys())
        freq[lang, source].update(found)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)

        def values(counts, kept=kept):
            total = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // total for t in kept}

        p = {s: values(freq[lang, s]) for s in sources}
        q = values(sum((freq[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            over = [(q[t] - p[s][t], t.encode(), t) for t in kept if freq[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(over)[:top])):
                out += [(lang, s, part, name, -v, n) for n, (v, _, name) in enumerate(found, 1)]
    return sorted(out)


def term_rows():
    rng = random.Random(8)
    words = [f"w{'abcdefghij'[n % 10]}{'xyz'[n % 3]}{'é' * (n % 4)}" for n in range(40)] + ["Straße", "naïve", "日本", "ǅ", " x"]
    rows = []
    for n in range(260):
        lang = ["en", "de", "", None, "fr"][rng.randrange(5)]
        source = ["hot"] * 3 + ["b", "c", None, "é", "Z"]
        picked = [rng.choice(words[: rng.randint(3, 45)]) for _ in range(rng.randint(0, 25))]
        rows.append((lang, rng.choice(source), rng.choice([" ", "-", "1", "\x00"]).join(picked).title()))
    rows += [("solo", "one", "a b c"), ("solo", None, "a"), ("empty", "x", None), ("empty", "y", "123 --- \x7f"), ("single", "s", "word " * 50),
             ("en", "long", "abc DEF " * 40_000), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("min_docs, top", [(30, 50), (4, 3), (1, 1000)])
def test_divergence_equals_brute_force(spark, min_docs, top, monkeypatch):
    rows = term_rows()
    docs = spark.createDataFrame(
        [(a, b, c, 1, "x") for a, b, c in rows], "lang string, source string, text string, n bigint, `term` string").repartition(3)
    got = divergence(docs, min_docs=min_docs, top_terms=top)
    assert sorted(map(tuple, got.collect())) == plain_divergence(rows, min_docs, top)


def test_terms_are_letters_and_anything_beyond_ascii():
    import re

    text = "".join(map(chr, range(0x250))) + "日本 ẞ İ K     áB"
    assert [t.decode() for t in terms(text.encode())] == re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))


def test_counts_are_emitted_in_bounded_parts(spark, monkeypatch):
    import pyarrow as pa

    from tillwatch.llm import divergence as module

    monkeypatch.setattr(module, "HELD", 10)
    batch = pa.RecordBatch.from_pylist(
        [{"lang": "en", "source": f"s{n % 3}", "text": " ".join(["a", "b", f"t{chr(97 + n)}", f"u{chr(97 + n)}"])} for n in range(20)])
    parts = list(module.count_terms(iter([batch])))
    assert len(parts) > 5 and max(p.num_rows for p in parts) <= 14
    sums = Counter()
    for p in parts:
        for row in p.to_pylist():
            sums[row["source"], row["term"]] += row["n"]
    assert sums["s0", "a"] == 7 and sum(sums.values()) == 80


# ---- turns --------------------------------------------------------------------------------------

def plain_best(symbols):
    """(cost, audit), cheapest first and then ASCII-least, by trying everything."""
    @lru_cache(None)
    def best(i, state, inserted):
        found = []
        if i == len(symbols):
            if state in (0, 3):
                found.append((0, ""))
        else:
            for letter, cost, into in edits_of(symbols[i], state):
                rest = best(i + 1, into, 0)
                if rest:
                    found.append((cost + rest[0], letter + rest[1]))
        if inserted < 4:
            rest = best(i, NEXT[state], inserted + 1)
            if rest:
                found.append((2 + rest[0], "I" + rest[1]))
        return min(found) if found else None

    return best(0, 0, 0)


@pytest.mark.parametrize("block", [1, 3, 4])
def test_blocks_give_the_least_of_the_cheapest_repairs(block):
    tables, rng = BlockTables(block), random.Random(block)
    assert len(tables.vectors) < 40
    for _ in range(1500):
        symbols = bytes(rng.randrange(9) for _ in range(rng.randrange(0, 15)))
        cost, edits, tail = tables.repair(symbols)
        assert (cost, "".join(edits) + tail) == plain_best(symbols)
        assert len(edits) == len(symbols) and all(e[-1] in "DKR" and set(e[:-1]) <= {"I"} for e in edits)


def plain_report(rows):
    """Rows (conv_id, turn, role, text) as given; one line per conversation and the repaired rows."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 1:
            text = ""
        if hit == 2:
            text = "".join(c for c in text if c not in ".!?")
        if hit == 4:
            role = "user"
        convs[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(hit, 1)
    reports, repaired = [], []
    for conv, found in convs.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        turns, seen, symbols, faults = {t for t, _, _ in found if t is not None}, set(), [], Counter()
        for _, role, text in found:
            body = text.strip(WHITE)
            fault = ("blank" if not body else "duplicate" if (role, text) in seen
                     else "" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
            faults[fault] += 1
            initial = "sua".find(role[:1]) if role else 3
            symbols.append(0 if fault in ("blank", "duplicate") else 1 + 2 * (initial if initial >= 0 else 3) + (fault == "truncated"))
        first = [role[:1] for _, role, _ in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        cost, audit = plain_best(tuple(symbols))
        state, at, lines = 0, iter(found), []
        for letter in audit:
            _, role, text = (None, None, "") if letter == "I" else next(at)
            if letter != "D":
                if letter in "IR":
                    role = "assistant" if state == 2 else "user"
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
                lines.append((letter, role, text))
        repaired += [(conv, n, *line) for n, line in enumerate(lines)]
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        reports.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
                        hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in lines).encode()).hexdigest()))
    return sorted(reports, key=repr), sorted(repaired, key=repr)


def turn_rows():
    rng, rows = random.Random(4), []
    texts = ["Fine.", "Fine!", "cut off", "", " \t\x0b", "ends with blank? \r\n", "é。", "Same words.", None, "a.b.c", "\x00"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User", "sage", "under", "ant"]
    for conv in range(150):
        start = rng.choice([0, 1, -3, 10])
        for turn in range(start, start + rng.randint(1, 9)):
            if rng.random() < 0.9:
                rows.append((conv, None if rng.random() < 0.05 else turn, rng.choice(roles), rng.choice(texts)))
    rows += [(None, 1, "user", "Hello."), (None, None, "assistant", "Yes."), (900, None, None, None), (901, 2, "user", "x" * 300_000)]
    rows += [(902, turn, rng.choice(roles[:5]), f"Row {turn % 300}.") for turn in range(2500)]
    drop = next(n for n in range(10**4) if zlib.crc32(f"903:{n}".encode()) % 20 == 0)
    return rows + [(903, drop, "user", "gone"), rows[0], rows[0]]


def test_repairs_equal_brute_force(spark):
    import sys

    sys.setrecursionlimit(20_000)
    rows = turn_rows()
    table = spark.createDataFrame(
        [(*r, 1, "c") for r in rows], "conv_id bigint, turn bigint, role string, text string, gone bigint, conv string").repartition(4)
    reports, repaired = plain_report(rows)
    assert sorted(map(tuple, repair_report(damaged(table)).collect()), key=repr) == reports
    assert sorted(map(tuple, repaired_rows(damaged(table)).collect()), key=repr) == repaired
    assert any(r[0] == 903 and r[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in reports)
    for conv in {r[0] for r in repaired}:
        roles = "".join(r[3][0] for r in sorted((x for x in repaired if x[0] == conv), key=lambda x: x[1]))
        assert roles.removeprefix("s") == "ua" * (len(roles) // 2)


def test_no_conversations_no_reports(spark):
    table = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert repair_report(damaged(table)).collect() == [] and repaired_rows(damaged(table)).collect() == []


def test_a_task_keeps_no_texts():
    """Long conversations: a byte and a shared string of edits per row."""
    from tillwatch.llm.turn_repair import Conversation

    one = Conversation(1, BlockTables())
    for n in range(20_000):
        one.note(n, 1 + n % 2, 0)
    for n in range(20_000):
        assert list(one.take("user" if n % 2 == 0 else "assistant", "text")) != []
    assert len(one.symbols) == 20_000 and one.report()[6:8] == (0, "K" * 20_000)
    assert {id(e) for e in one.plan[1]} == {id(one.plan[1][0]), id(one.plan[1][1])} or len({id(e) for e in one.plan[1]}) < 100


def test_documents_with_the_same_lines_lose_only_what_others_own(spark):
    """A hot group of equal texts: one copy keeps its lines, short lines stay everywhere."""
    rows = [(n, "the very same line of all copies\nshort\nanother long line of all copies") for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    got = dedup_lines(docs).groupBy("text", "n_dropped").agg(F.count("*").alias("n"), F.max("doc_id").alias("top")).collect()
    assert sorted((r.text, r.n_dropped, r.n, r.top) for r in got) == [("short", 2, 299, 298), (rows[0][1], 0, 1, 299)]
