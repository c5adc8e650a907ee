"""Exact top-k inner products by a pivot-distance index.

Components are quantised to integers. With M the largest norm, a further component sqrt(M^2 - |x|^2) turns
the largest inner product into the smallest distance: |q - x|^2 = |q|^2 + M^2 - 2 q.x. Every vector is
keyed by its nearest pivot and its distance to it; the index holds them in that order in blocks of at most
``BLOCK`` rows, each with its ring of distances. Blocks are cut by position in the sorted order, so a
pivot, or one vector that a third of all rows share, spans as many blocks and tasks as its rows need.

A query first looks into the blocks whose rings are closest to it around its nearest pivots. Its k-th
score there bounds the distance r of every row that can still matter, and by the triangle inequality such
a row lies in a ring that meets [d(q, p) - r, d(q, p) + r] for its pivot p. All those blocks, and only
those, are searched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillwatch.llm.common import shuffle_partitions, small_side, stage
from tillwatch.llm.vectors import keyed_vectors, spread_pivots, stacked

BLOCK = 2_048
PIVOT_ROWS = 4_000
MOST_PIVOTS = 512
SAMPLE_ROWS = 4_096
#: Queries that meet a place in one task: as many as LOT_BYTES and k allow, between these.
QUERIES_A_LOT = 4_096, 16_384
LOT_BYTES = 8 << 20
QUERIES_AT_ONCE = 256
#: Blocks in a place: as many as leave so many places a task, and no more than these.
PLACES_A_TASK = 8
MOST_TOGETHER = 16
PLACE_BYTES = 16 << 20
FIRST_PIVOTS = 2
EXACT = float(1 << 53)
EXACT_FLOAT = float(1 << 24)
NARROW = "<i1", "<i2", "<i4"
LONG = (1 << 63) - 1


@dataclass
class Space:
    """Pivots of the vectors of one length, in the widened space, and the largest squared norm."""

    pivots: np.ndarray
    top: float

    def distances(self, x: np.ndarray, as_query: bool) -> np.ndarray:
        more = 0.0 if as_query else math.sqrt(max(0.0, self.top - float(x @ x)))
        return np.sqrt(((self.pivots - np.append(x, more)) ** 2).sum(axis=1))


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors: floats or doubles where they hold every partial sum, else whole numbers."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if bound < EXACT_FLOAT:
        return queries.astype(np.float32) @ rows.T.astype(np.float32)
    if bound < EXACT:
        return queries @ rows.T
    exact = [[int(v) for v in r] for r in queries.tolist()], [[int(v) for v in r] for r in rows.tolist()]
    return np.array([[sum(a * b for a, b in zip(q, x, strict=True)) for x in exact[1]] for q in exact[0]], dtype=object)


def narrow(raw: bytes) -> bytes:
    """Whole numbers, given as doubles, in the fewest bytes that hold each of them, behind two that name their type."""
    x = np.frombuffer(raw, "<f8")
    most = float(np.abs(x).max(initial=0))
    kind = next((t for t in NARROW if most <= np.iinfo(t).max), "<f8")
    return kind[1:].encode() + x.astype(kind).tobytes()


def wide(raw: bytes | pa.Buffer) -> np.ndarray:
    """The doubles that ``narrow`` was given."""
    return np.frombuffer(raw, "<" + bytes(memoryview(raw)[:2]).decode(), offset=2).astype(np.float64)


def quantiser(scale: int):
    def quantised(x: np.ndarray) -> np.ndarray | None:
        with np.errstate(over="ignore"):
            y = np.floor(x * scale)
        return y if np.isfinite(y).all() and float(np.abs(y).max()) < 1e150 else None

    return quantised


def hash_sample(rows: DataFrame, n: int, most: int = SAMPLE_ROWS) -> list[bytes]:
    """Vectors of the ``most`` rows with the smallest hashes, in that order, out of the ``n`` of ``rows``.

    Rows whose hash may be among the smallest meet in a task and only the sample is sent to the driver; were it
    collected from the tasks that read the rows, each of them would send as many.
    """
    hashed = rows.select(F.xxhash64("vec", "id").alias("hash"), "vec")
    share = 2 * most / max(1, n)
    while True:
        low = hashed if share >= 1 else hashed.where(F.col("hash") < int(share * (1 << 64)) - (1 << 63))
        found = stage(low.orderBy("hash").limit(most), "sample").collect()
        if len(found) >= min(most, n) or share >= 1:
            return [r.vec for r in sorted(found, key=lambda r: r.hash)]
        share *= 8  # rows that repeat id and vector share a hash


def build_index(keyed: DataFrame, pivot_rows: int = PIVOT_ROWS, block: int = BLOCK) -> tuple[DataFrame, dict[int, Space]]:
    """Blocks of the usable rows of ``keyed`` in order of (length, pivot, distance, id), staged.

    Pivots come from a bounded sample; every row is indexed.
    """
    spark = keyed.sparkSession
    rows = keyed.where("key is not null").select("id", "vec")

    def norms(batches):
        for batch in batches:
            x = [np.frombuffer(v.as_py(), "<f8") for v in batch.column("vec")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(v) for v in x], pa.int32()), pa.array([float(v @ v) for v in x], pa.float64())],
                ["size", "norm"])

    tops = {r["size"]: (r["top"], r["n"]) for r in rows.mapInArrow(norms, "size int, norm double").groupBy("size").agg(
        F.max("norm").alias("top"), F.count("*").alias("n")).collect()}
    sample = hash_sample(rows, sum(n for _, n in tops.values()))
    spaces = {}
    for size, (top, n) in sorted(tops.items()):
        seen = [v for v in sample if len(v) == 8 * size]
        base = stacked(seen) if seen else np.zeros((1, size))
        wide = np.column_stack([base, np.sqrt(np.maximum(0, top - (base ** 2).sum(axis=1)))])
        many = min(MOST_PIVOTS, max(1, math.ceil(n / pivot_rows)))
        spaces[size] = Space(wide[spread_pivots(wide, many)], top)

    def place(batches):
        for batch in batches:
            size, pivot, away = [], [], []
            for v in batch.column("vec"):
                x = np.frombuffer(v.as_py(), "<f8")
                d = spaces[len(x)].distances(x, as_query=False)
                size.append(len(x))
                pivot.append(int(np.argmin(d)))
                away.append(float(d[pivot[-1]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(size, pa.int32()), pa.array(pivot, pa.int32()), pa.array(away, pa.float64()), *batch.columns],
                ["size", "pivot", "away", *batch.schema.names])

    def pack(batches):
        part, made, held = TaskContext.get().partitionId(), 0, []

        def block_of():
            nonlocal made
            made += 1
            ids = np.array([h[3] for h in held], "<i8")
            return pa.RecordBatch.from_arrays(
                [pa.array([x], k) for x, k in (
                    ((part << 32) + made, pa.int64()), (held[0][0], pa.int32()), (held[0][1], pa.int32()),
                    (held[0][2], pa.float64()), (held[-1][2], pa.float64()), (ids.tobytes(), pa.binary()),
                    (narrow(b"".join(h[4] for h in held)), pa.binary()))],
                ["block", "size", "pivot", "near", "far", "ids", "vecs"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("size", "pivot", "away", "id", "vec")), strict=True):
                if held and (held[0][:2] != row[:2] or len(held) >= block):
                    yield block_of()
                    held = []
                held.append(row)
        if held:
            yield block_of()

    placed = rows.where("id is not null").mapInArrow(place, "size int, pivot int, away double, id bigint, vec binary")
    order = ["size", "pivot", "away", "id"]
    index = placed.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).mapInArrow(
        pack, "block bigint, size int, pivot int, near double, far double, ids binary, vecs binary")
    return stage(index, "index"), spaces


def cut(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k largest scores of each query, equal ones by id."""
    if score.dtype == object:
        order = np.array(sorted(range(len(query)), key=lambda n: (query[n], -score[n], ids[n])), dtype=np.int64)
    else:  # ~ turns longs around where - has no room for the least
        order = np.lexsort((ids, ~score if score.dtype == np.int64 else -score, query))
    order = order[np.arange(len(order)) - np.searchsorted(query[order], query[order]) < k]
    return query[order], ids[order], score[order]


def best_rows(table: np.ndarray, ids: np.ndarray, own: np.ndarray, least: list, k: int):
    """Of scores of some queries (down) by the rows ``ids``: (query, id, score) of the best k, as longs.

    Rows with a query's own id and scores below its ``least`` are out.
    """
    kept = ids[None, :] != own[:, None]
    if table.dtype == object:
        floor = np.array([-math.inf if x is None else int(x) for x in least], dtype=object)
        kept &= (table >= floor[:, None]).astype(bool)
    else:
        kept &= table >= np.array([-math.inf if x is None else float(x) for x in least])[:, None]
        many = np.flatnonzero(kept.sum(axis=1) > 4 * k)
        if len(many):  # keep ties at the k-th place
            part = np.where(kept[many], table[many], -np.inf)
            part.partition(part.shape[1] - k, axis=1)
            kept[many] &= table[many] >= part[:, [part.shape[1] - k]]
    query, at = np.nonzero(kept)
    query, found, score = cut(query, ids[at], table[query, at], k)
    if score.dtype == object:
        score = np.array([max(-LONG - 1, min(LONG, v)) for v in score.tolist()], dtype=np.int64)
    return query, found, score.astype(np.int64)


def search(visits: DataFrame, asked: DataFrame, index: DataFrame, k: int, chunks: int, together: int) -> DataFrame:
    """Best k rows for each query among those of its visited blocks in a place: (query, own, id, score).

    A place is up to ``together`` blocks that follow each other. A query comes to it once, with a bit for each block
    that it visits.
    """
    schema = T.StructType.fromDDL("query binary, own bigint, id bigint, score decimal(38,0)")

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        at, found, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if left.num_rows and right.num_rows:
            blocks = []
            for n, ids, vecs in zip(*(right.column(c) for c in ("nth", "ids", "vecs")), strict=True):
                ids = np.frombuffer(ids.as_buffer(), "<i8")
                blocks.append((n.as_py(), ids, wide(vecs.as_buffer()).reshape(len(ids), -1)))
            own, bits = left.column("own").to_numpy(), left.column("bits").to_numpy()
            for first in range(0, left.num_rows, QUERIES_AT_ONCE):
                few = slice(first, first + QUERIES_AT_ONCE)
                least = left.column("least")[few].to_pylist()
                vecs = [wide(v) for v in left.column("vec")[few].to_pylist()]
                some = []
                for nth, ids, rows in blocks:
                    here = np.flatnonzero(bits[few] >> nth & 1)
                    if len(here):
                        query, *rest = best_rows(
                            scores(np.stack([vecs[i] for i in here]), rows), ids, own[few][here],
                            [least[i] for i in here], k)
                        some.append((here[query], *rest))
                if some:
                    query, ids, values = cut(*(np.concatenate(x) for x in zip(*some, strict=True)), k)
                    at.append(query + first)
                    found.append(ids)
                    score.append(values)
        at = pa.array(np.concatenate(at))
        return pa.table({
            "query": left.column("query").take(at), "own": left.column("own").take(at),
            "id": pa.array(np.concatenate(found)),
            "score": pa.array(np.concatenate(score)).cast(pa.decimal128(38, 0))})

    nth = F.col("block") % (1 << 32) % together
    dealt = visits.groupBy("query", (F.col("block") - nth).alias("place")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(block % {1 << 32} % {together} as int))")).alias("bits")).join(
        asked, "query").select("query", "own", "vec", "least", "place", "bits",
                               F.pmod(F.xxhash64("query"), F.lit(chunks)).cast("int").alias("lot"))
    blocks = index.select((F.col("block") - nth).alias("group"), nth.cast("int").alias("nth"), "ids", "vecs",
                          F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    return dealt.groupBy("place", "lot").cogroup(blocks.groupBy("group", "chunk")).applyInArrow(best, schema)


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_products(
    vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64, id_col: str = "vec_id",
    vec_col: str = "embedding", pivot_rows: int = PIVOT_ROWS, block: int = BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of ``vectors`` with the largest inner product.

    Components x become floor(scale * x). Candidates are all rows but those with the query's own id; equal
    scores go to the smaller id, and a query with fewer candidates gets all of them. Vectors that are null
    or empty, hold null or non-finite components, or are too large to quantise take no part, nor do rows
    with a null id; vectors of different length do not meet. Queries repeating both id and vector count
    once, candidates count row by row. Scores beyond a long are cut to its range. Empty tables give no
    rows; other columns are ignored.
    """
    quantised = quantiser(scale)
    keyed = keyed_vectors(vectors, id_col, vec_col, quantised)
    index, spaces = build_index(keyed, pivot_rows, block)

    def narrowed(batches):
        for batch in batches:
            vecs = pa.array([narrow(v) for v in batch.column("vec").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("own"), vecs], ["query", "own", "vec"])

    asked = stage(
        keyed_vectors(queries, id_col, vec_col, quantised).where("key is not null and id is not null")
        .dropDuplicates(["id", "key"]).select(
            F.concat(F.col("key"), F.encode(F.col("id").cast("string"), "utf-8")).alias("query"), F.col("id").alias("own"), "vec")
        .mapInArrow(narrowed, "query binary, own bigint, vec binary"),
        "queries")
    longest = max(spaces, default=1)
    lot = max(QUERIES_A_LOT[0], min(QUERIES_A_LOT[1], LOT_BYTES // (8 * longest), 20 * QUERIES_A_LOT[1] // k))
    chunks = max(1, math.ceil(asked.count() / lot))
    blocks = index.count()
    together = max(1, min(MOST_TOGETHER, PLACE_BYTES // (8 * longest * block),
                          blocks * chunks // (PLACES_A_TASK * shuffle_partitions(keyed.sparkSession))))

    def rings(nearest: int | None):
        def run(batches):
            for batch in batches:
                for few in (batch.slice(n, 128) for n in range(0, batch.num_rows, 128)):
                    take, pivot, away, size, norm = ([np.zeros(0)] for _ in range(5))
                    for i, v in enumerate(few.column("vec")):
                        x = wide(v.as_py())
                        if (space := spaces.get(len(x))) is None:
                            continue
                        d = space.distances(x, as_query=True)
                        near = np.argsort(d, kind="stable")[:nearest]
                        take.append(np.full(len(near), i))
                        pivot.append(near)
                        away.append(d[near])
                        size.append(np.full(len(near), len(x)))
                        norm.append(np.full(len(near), float(x @ x) + space.top))
                    take, pivot, away, size, norm = map(np.concatenate, (take, pivot, away, size, norm))
                    own = few.select(["query", "least"]).take(pa.array(take.astype(np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [*own.columns, *(pa.array(x.astype(np.int32)) for x in (size, pivot)), pa.array(away), pa.array(norm)],
                        ["query", "least", "size", "pivot", "away", "norm"])

        return run

    ring = "query binary, least decimal(38,0), size int, pivot int, away double, norm double"
    directory = small_side(index.select("block", "size", "pivot", "near", "far"), blocks)
    gap = F.greatest(F.lit(0.0), F.col("near") - F.col("away"), F.col("away") - F.col("far"))
    asked = asked.withColumn("least", F.lit(None).cast("decimal(38,0)"))
    first = asked.mapInArrow(rings(FIRST_PIVOTS), ring).join(directory, ["size", "pivot"]).groupBy("query", "pivot").agg(
        F.min_by("block", F.struct(gap, "block")).alias("block")).select("query", "block")
    bounds = best_of(search(first, asked, index, k, chunks, together), k).where(F.col("rank") == k).select(
        "query", F.col("score").alias("least"))
    bounds = stage(asked.drop("least").join(bounds, "query", "left"), "bounds")
    # |q - x|^2 <= |q|^2 + M^2 - 2 * least, with room for rounding
    reach = F.when(F.col("least").isNull(), F.lit(float("inf"))).otherwise(
        F.sqrt(F.greatest(F.lit(0.0), F.col("norm") - 2 * F.col("least").cast("double"))) + F.sqrt("norm") * 1e-6 + 1e-6)
    visits = bounds.mapInArrow(rings(None), ring).withColumn("reach", reach).join(directory, ["size", "pivot"]).where(
        (F.col("near") <= F.col("away") + F.col("reach")) & (F.col("far") >= F.col("away") - F.col("reach"))).select(
        "query", "block")
    return best_of(search(visits, bounds, index, k, chunks, together), k).select(
        F.col("own").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"),
        F.col("score").cast("bigint").alias("score"))
