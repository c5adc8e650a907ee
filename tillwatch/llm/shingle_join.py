"""Near-duplicate documents by a Jaccard join on word shingles with token-combination prefixes.

Two documents link when their shingle sets overlap by at least ``percent`` per cent of their union, so
each holds all but t = n - ceil(percent * n / 100) of its n shingles in common with the other. Shingles
have one global order, from rare to frequent, and fall into classes by frequency; class k is indexed by
combinations of k shingles. A document's prefix is extended until the sum over its parts of
max(0, shingles in the part - (k - 1)) exceeds t: t missing shingles then leave at least one part of
class k with k shared ones, and since both prefixes follow one order, both hold that combination. Class 1
(rare) is one part. A frequent class is cut by hash into parts of a few shingles, so that combinations
stay linear in the length of a document; the number of parts follows from a band of set sizes, and a set
is indexed for its own band and the next, since linked sets differ by at most one band.

Frequencies are counted over all documents in a table of fixed width (shingles that share a cell share a
count): order and classes steer cost only, never results.

Equal sets are one node. Of the sets that share an entry each is first compared with one hub, the set that
shares most entries, so a group of near copies costs as many comparisons as it has members. Where the
members of an entry are not yet one linked group, members of different groups are compared with each
other, first by parity bits, which bound their difference from below. Links are verified on the full sets. Entries with
frequent shingles are salted, so that each task sees a bounded share of them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwatch.llm.common import bound_batches, per_process, settings, small_side, stage, stage_observed
from tillwatch.llm.components import components

WORDS = 5
PERCENT = 80
KEPT_WORDS = 100_000
SKETCH_BITS = 20
SLICE_BITS = 14
#: Frequencies (above the table's background) from which combinations of 2 and 3 shingles are indexed.
CLASS_FROM = (64, 2_048)
SMALL_SET = 16
PART_SHINGLES = 8
HOT_ROWS = 4_096
LEAST_PERCENT = 70
BLOCK = 4_096
STRIP = 256
#: For the tables written on the way: one join plan at every size, no relations built on the driver for each of
#: some dozens of joins, and shuffle files that go as soon as the table they led to is written.
ON_THE_WAY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * ODD[0]
    return x ^ (x >> np.uint64(29))


def shingles(text: str, known: WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; A-Z lower-cased, words cut at ASCII white space.

    A text with fewer words is one shingle, a text without words has none.
    """
    parts = text.encode().lower().split()
    n = len(parts)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, parts), np.uint64, n)
    width = min(n, words)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total += hashes[k:n - width + 1 + k] * ODD[k % len(ODD)] * np.uint64(2 * (k // len(ODD)) + 1)
    return np.unique(mixed(total))


def parity_bits(tokens: np.ndarray) -> bytes:
    """A bit per hash place, set where an odd number of shingles falls; about four places per shingle.

    Two sets differ in at least as many shingles as their bits differ in places. Halves of a longer row of
    bits fold onto each other, so rows of different length compare at the shorter one.
    """
    places = 1 << max(6, (4 * len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def apart(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Least number of shingles by which each of ``left`` differs from each of ``right``."""
    out = np.zeros((len(left), len(right)), np.int64)
    sizes = sorted({len(x) for x in (*left, *right)})
    for p in sizes:
        a = [i for i, x in enumerate(left) if len(x) == p]
        if not a:
            continue
        x = np.frombuffer(b"".join(left[i] for i in a), "<u8").reshape(len(a), -1)
        for q in sizes:
            b = [i for i, y in enumerate(right) if len(y) == q]
            if not b:
                continue
            y = np.frombuffer(b"".join(right[i] for i in b), "<u8").reshape(len(b), -1)
            z = x
            while y.shape[1] > z.shape[1]:
                y = y[:, :y.shape[1] // 2] ^ y[:, y.shape[1] // 2:]
            while z.shape[1] > y.shape[1]:
                z = z[:, :z.shape[1] // 2] ^ z[:, z.shape[1] // 2:]
            for i, row in zip(a, z, strict=True):
                out[i, b] = np.bitwise_count(row ^ y).sum(axis=1)
    return out


def may_link(x: bytes, y: bytes, n: int, m: int, percent: int) -> bool:
    """Whether two sets of n and m shingles can link, by their parity bits.

    With an overlap of o they differ in d = n + m - 2 o, and 100 o >= percent (n + m - o).
    """
    differ = int(apart([x], [y])[0, 0])
    return (100 + percent) * (n + m - differ) >= 2 * percent * (n + m)


def cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def band_of(size: int, percent: int) -> int:
    """Sets that link differ by at most one band."""
    return int(math.log(size) / math.log(100 / percent) + 1e-9) if percent < 100 else 0


def allowed_missing(size: int, percent: int) -> int:
    return size - -(-percent * size // 100)


def _combined(tokens) -> int:
    return xxhash.xxh3_64_intdigest(np.array(tokens, np.uint64).tobytes())


def signatures(tokens: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a set's index entries and for each the frequency of its rarest shingle.

    ``tokens`` are distinct, ``counts`` their frequencies above background.
    """
    n = len(tokens)
    order = np.lexsort((tokens, counts))
    tokens, counts = tokens[order], counts[order]
    missing = allowed_missing(n, percent)
    rare = int(np.searchsorted(counts, CLASS_FROM[0]))
    if rare > missing:  # rare shingles alone fill the prefix
        return tokens[:missing + 1], counts[:missing + 1]
    out, heat = tokens[:rare].tolist(), counts[:rare].tolist()
    kinds = 2 + (counts >= CLASS_FROM[1]).astype(int)
    for band in (band_of(n, percent), band_of(n, percent) + 1):
        least = int((100 / percent) ** band) if percent < 100 else n
        if least < SMALL_SET or percent == 100:
            # in bands of small sets every shingle is of class 1
            out += tokens[rare:missing + 1].tolist()
            heat += counts[rare:missing + 1].tolist()
            continue
        # Parts lose at most 1 + 2 shingles each, and n is at least least * percent / 100: with fewer
        # than least / PART_SHINGLES parts the whole set always has more slack than it may miss.
        parts = max(1, least // PART_SHINGLES)
        held: dict[tuple[int, int], list[int]] = {}
        slack = rare
        for i in range(rare, n):
            part = (int(kinds[i]), int(tokens[i] % np.uint64(parts)))
            held.setdefault(part, []).append(i)
            slack += len(held[part]) >= part[0]
            if slack > missing:
                break
        assert slack > missing, "the prefix must leave a shared combination"
        for (kind, _), members in held.items():
            for chosen in combinations(members, kind):
                out.append(_combined((*sorted(int(tokens[i]) for i in chosen), kind, band)))
                heat.append(int(counts[chosen[0]]))
    return np.array(out, np.uint64), np.array(heat, np.int64)


def _first_pass(docs: DataFrame, words: int) -> DataFrame:
    """Per row its node (hash of its set) and set size; per task the shingle counts by cell, in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = per_process("shingle words", WordHashes)
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        names = ["id", "mark", "node", "size", "bits", "slice", "counts"]
        for batch in batches:
            node, size, bits = [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), known, words)
                size.append(len(found))
                bits.append(parity_bits(found))
                node.append(int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())))) if len(found) else None)
                np.add.at(counts, cells(found), 1)
            n = len(node)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("mark"), pa.array(node, pa.int64()), pa.array(size, pa.int64()),
                 pa.array(bits, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        slices = np.flatnonzero(counts.reshape(-1, 1 << SLICE_BITS).any(axis=1))
        n = len(slices)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
             pa.nulls(n, pa.binary()), pa.array(slices, pa.int32()),
             pa.array([zlib.compress(counts.reshape(-1, 1 << SLICE_BITS)[k].astype("<i4").tobytes(), 1) for k in slices],
                      pa.binary())],
            names)

    return stage(docs.mapInArrow(
        run, "id bigint, mark bigint, node bigint, size bigint, bits binary, slice int, counts binary"), "nodes")


def _frequencies(first: DataFrame) -> np.ndarray:
    """Counts by cell above the median cell: a table of fixed size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("slice").to_pylist(), batch.column("counts"), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(zlib.decompress(raw.as_py()), "<i4").astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
            ["slice", "counts"])

    slices = first.where("slice is not null").select("slice", "counts")
    many = 1 << (SKETCH_BITS - SLICE_BITS)
    table = np.zeros((many, 1 << SLICE_BITS), np.int64)
    for row in slices.repartition(many, "slice").mapInArrow(add, "slice int, counts binary").collect():
        table[row["slice"]] += np.frombuffer(row["counts"], "<i8")
    table = table.ravel()
    return np.minimum(np.maximum(table - int(np.median(table)), 0), np.iinfo(np.int32).max).astype(np.int32)


def _entries(docs: DataFrame, table: Broadcast, words: int, percent: int) -> DataFrame:
    """Index entries of the sets; ``table`` holds the frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, done, counts = per_process("shingle words", WordHashes), set(), table.value
        for batch in batches:
            sig, salt, salted, node, size = [], [], [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), known, words)
                if not len(found):
                    continue
                name = xxhash.xxh3_64_intdigest(found.tobytes())
                if name in done:
                    continue
                done.add(name)
                entries, heat = signatures(found, counts[cells(found)], percent)
                sig.append(entries)
                salt.append(np.uint64(name) % (1 + heat // HOT_ROWS).astype(np.uint64))
                salted.append(heat >= HOT_ROWS)
                node.append(np.full(len(entries), name, np.uint64))
                size.append(np.full(len(entries), len(found), np.int32))
            if sig:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.concatenate(salt).astype(np.int32)),
                     pa.array(np.concatenate(salted)), pa.array(np.concatenate(node).view(np.int64)),
                     pa.array(np.concatenate(size))],
                    ["sig", "salt", "salted", "node", "size"])

    return docs.mapInArrow(run, "sig bigint, salt int, salted boolean, node bigint, size int")


def _fits(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _sets(docs: DataFrame, first: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """The shingle sets of all nodes in ``pairs``, from one row each."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    rows = first.where("node is not null").groupBy("node").agg(F.min(F.struct("id", "mark")).alias("row"))
    wanted, many = stage_observed(rows.join(nodes, "node", "left_semi").select(
        F.coalesce("row.id", F.lit(0)).alias("want_id"), F.col("row.id").isNull().alias("want_null"),
        F.col("row.mark").alias("want_mark")).distinct(), "wanted", n=F.count(F.lit(1)))
    one = docs.join(
        small_side(wanted, many["n"]),
        (F.coalesce("id", F.lit(0)) == F.col("want_id")) & (F.col("id").isNull() == F.col("want_null"))
        & (F.col("mark") == F.col("want_mark")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, done = per_process("shingle words", WordHashes), set()
        for batch in batches:
            node, sets = [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), known, words)
                name = xxhash.xxh3_64_intdigest(found.tobytes())
                if name not in done:
                    done.add(name)
                    node.append(int(np.int64(np.uint64(name))))
                    sets.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["node", "tokens"])

    return stage(one.select("text").mapInArrow(run, "node bigint, tokens array<bigint>"), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    b = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(a, "a").join(b, "b").where(
        100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b").distinct()


def _ordered_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()


def _linked(rows, first, pairs, known, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs compared so far, these included, and the links among these."""
    fresh = stage(pairs if known is None else pairs.join(known, ["a", "b"], "left_anti"), "pairs")
    links = stage(_verified(fresh, _sets(rows, first, fresh, words), percent), "verified")
    return fresh if known is None else known.union(fresh), links


def _bits_of(first: DataFrame, nodes: DataFrame) -> DataFrame:
    """``of, size, bits`` of the given nodes."""
    nodes, many = stage_observed(nodes, "nodes", n=F.count(F.lit(1)))
    return first.where("node is not null").select(F.col("node").alias("of"), "size", "bits").join(
        small_side(nodes, many["n"]), "of", "left_semi").groupBy("of").agg(
        F.max("size").alias("of_size"), F.max("bits").alias("bits"))


def _possible(pairs: DataFrame, first: DataFrame, percent: int) -> DataFrame:
    """Pairs that the parity bits, a fraction of the size of the sets, do not rule out."""
    pairs = stage(pairs, "stars")
    bits = _bits_of(first, pairs.select(F.col("a").alias("of")).union(pairs.select("b")).distinct())
    a = bits.select(F.col("of").alias("a"), F.col("of_size").alias("n"), F.col("bits").alias("x"))
    b = bits.select(F.col("of").alias("b"), F.col("of_size").alias("m"), F.col("bits").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("x", "y", "n", "m")]
            yield batch.select(["a", "b"]).filter(pa.array([may_link(*row, percent) for row in zip(*cols, strict=True)], pa.bool_()))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y", "n", "m").mapInArrow(run, "a bigint, b bigint")


def _across_groups(ranked: DataFrame, groups: DataFrame, first: DataFrame, percent: int) -> DataFrame:
    """Pairs of different groups that share an entry and whose parity bits allow a link.

    Entries whose hubs are in one group are one cluster, so a pair is looked at once for all the entries it
    shares there. Clusters are cut into blocks that meet pairwise.
    """
    grouped = ranked.select("sig", "node", "size", "entries", "hub", "hub_entries").join(
        groups.withColumnRenamed("component", "group"), "node", "left").withColumn("group", F.coalesce("group", "node"))
    mixed_up = grouped.groupBy("sig").agg(
        F.min("group").alias("low"), F.max("group").alias("high"),
        F.max(F.struct("hub_entries", "hub"))["hub"].alias("top")).where("low <> high").join(
        groups.select(F.col("node").alias("top"), "component"), "top", "left").select(
        "sig", F.coalesce("component", "top").alias("cluster"))
    open_ = stage(grouped.join(mixed_up, "sig").select("cluster", "node", "size", "group").distinct(), "open")
    bits = _bits_of(first, open_.select(F.col("node").alias("of")).distinct())
    blocks = open_.groupBy(F.col("cluster").alias("c")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = open_.join(bits, F.col("node") == F.col("of")).join(blocks, F.col("cluster") == F.col("c")).select(
        "cluster", "node", "size", "group", "bits", "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own")).select(
        "*", F.explode(F.expr("transform(sequence(0, blocks - 1), k -> struct(least(k, own) as i, greatest(k, own) as j))"))
        .alias("t")).select("cluster", "t.i", "t.j", "own", "node", "size", "group", "bits")

    def compare(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        own, node, size, group = (table.column(c).to_numpy() for c in ("own", "node", "size", "group"))
        bits = table.column("bits").to_pylist()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        pairs: list[np.ndarray] = []
        for at in range(0, len(left), STRIP):
            strip = left[at:at + STRIP]
            n, m = size[strip][:, None].astype(np.int64), size[right][None, :].astype(np.int64)
            may = (group[strip][:, None] != group[right][None, :]) & (
                100 * np.minimum(n, m) >= percent * np.maximum(n, m))
            if i == j:
                may &= strip[:, None] < right[None, :]
            rows, cols = may.any(axis=1), may.any(axis=0)
            if not rows.any():
                continue
            strip, others, may = strip[rows], right[cols], may[np.ix_(rows, cols)]
            n, m = size[strip][:, None].astype(np.int64), size[others][None, :].astype(np.int64)
            differ = apart([bits[k] for k in strip], [bits[k] for k in others])
            may &= (100 + percent) * (n + m - differ) >= 2 * percent * (n + m)
            x, y = np.nonzero(may)
            pairs.append(np.stack([node[strip[x]], node[others[y]]]))
        found = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
        return pa.table({"a": found[0], "b": found[1]})

    return _ordered_pairs(placed.groupBy("cluster", "i", "j").applyInArrow(compare, "a bigint, b bigint"), "a", "b")


def _grouped(rows: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Each row with its node, and the component of each node that links with another."""
    first = _first_pass(rows, words)
    frequencies = rows.sparkSession.sparkContext.broadcast(_frequencies(first))
    entries = _entries(rows.select("text"), frequencies, words, percent)

    # Each set that shares an entry, with the smallest node of the entry (and salt) as its hub.
    spot = Window.partitionBy("sig", "salt").orderBy("node")
    so_far = spot.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shared = stage(
        entries.withColumn("hub", F.first("node").over(so_far)).withColumn("hub_size", F.first("size").over(so_far))
        .withColumn("before", F.lag("node").over(spot))
        # a set alone under its salt still meets the sets of the other salts
        .where("before <> node or (salted and before is null)").drop("before", "salted"), "shared")
    frequencies.destroy()
    # Of the sets of an entry the one that shares most entries is the hub: the text that others copied.
    everyone = shared.select("sig", "salt", "node", "size").union(
        shared.select("sig", "salt", F.col("hub").alias("node"), F.col("hub_size").alias("size"))).distinct()
    known_by = everyone.groupBy("node").agg(F.count("*").alias("entries"))
    best = Window.partitionBy("sig", "salt").orderBy(F.desc("entries"), "node")
    ranked = stage(
        everyone.join(known_by, "node").withColumn("nth", F.row_number().over(best))
        .withColumn("hub", F.first("node").over(best)).withColumn("hub_size", F.first("size").over(best))
        .withColumn("hub_entries", F.first("entries").over(best)), "ranked")
    # hubs of one entry's salts are compared with the best hub of the entry
    tops = ranked.where("nth = 1").groupBy("sig").agg(
        F.max(F.struct("entries", "node", "size")).alias("top"), F.count("*").alias("salts")).where("salts > 1")
    spread = ranked.where("nth = 1").join(tops, "sig").select("node", "size", "top.node", "top.size")
    stars = ranked.select("node", "size", "hub", "hub_size").union(spread).where(F.col("node") != F.col("hub"))
    known = _possible(_ordered_pairs(stars.where(_fits("size", "hub_size", percent)), "node", "hub"), first, percent)
    known, links = _linked(rows, first, known, None, words, percent)

    # Then the members of entries that are not yet one group, against those of other groups. In the end the groups
    # found so far stand for their links.
    groups = components(links)
    more = _across_groups(ranked, groups, first, percent)
    late = _linked(rows, first, more, known, words, percent)[1]
    return first.where("slice is null"), components(
        groups.select(F.col("node").alias("a"), F.col("component").alias("b")).union(late))


def near_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """One row per document: its id, ``n_shingles``, ``component_id``, ``mark`` (hash of its text), ``group``.

    ``group`` names the linked group of sets, also where ids repeat; it is null for an empty set.
    ``component_id`` is the smallest id reachable by links, itself included. Null and empty texts and
    texts without words have an empty set and link with nothing; documents with equal sets link. Rows
    that repeat an id are documents of their own; a null id is never the smallest. An empty table gives
    no rows; other columns are ignored. ``percent`` is from 70 to 100. Sets and shingles are compared by
    64-bit hashes.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must lie between {LEAST_PERCENT} and 100")
    bound_batches(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    with settings(docs.sparkSession, ON_THE_WAY):
        members, final = _grouped(rows, words, percent)

    # Smallest id per node, then per component, then back to the rows.
    least = members.where("node is not null").groupBy("node").agg(F.min("id").alias("least"))
    least = least.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = least.groupBy("component").agg(F.min("least").alias("component_id"))
    by_node = least.join(smallest, "component").select("node", "component_id", F.col("component").alias("group"))
    out = members.select("id", "mark", "node", "size").join(by_node, "node", "left")
    return out.select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"), "mark", "group")
