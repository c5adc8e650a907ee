"""Near-duplicate vectors by an exact metric range join.

On unit vectors a cosine of at least c is a Euclidean distance of at most r = sqrt(2 - 2c). Pivots cut the
space into cells of nearest vectors. A vector lives in the cell of its nearest pivot and visits each cell
that can hold a vector within r: the triangle inequality asks for d(v, q) <= d(v, p) + 2r, and in this
space the distance to the plane halfway between the two pivots gives the sharper
(d(v, q)^2 - d(v, p)^2) / (2 d(p, q)) <= r. A pair of two cells is judged in the lower-numbered one only,
so each pair is judged once and each cell joins on its own.

Equal vectors are one class with a count, collapsed before the join. A cell with more than ``BLOCK``
vectors is cut into blocks that are joined pairwise, so no task holds a cell. A block join returns link
counts and a spanning star of each linked group, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.common import stage
from tillwatch.llm.components import components
from tillwatch.llm.vectors import keyed_vectors, spread_pivots, stacked

CELL_ROWS = 4_000
MOST_PIVOTS = 512
SAMPLE_ROWS = 4_096
BLOCK = 4_096
STRIP = 1_024


def unit(x: np.ndarray) -> np.ndarray | None:
    """The direction of x, or None for zero. Scaling first keeps tiny and huge components exact enough."""
    top = np.abs(x).max()
    if top == 0:
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def link_block(a: np.ndarray, b: np.ndarray | None, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of a strip of unit vectors a to b as a Boolean matrix, decided in double precision.

    Products in single precision settle every pair that is clearly on one side of the bound.
    """
    margin = max(1e-5, 5e-7 * a.shape[1])
    rough = a.astype(np.float32) @ b.astype(np.float32).T
    links = rough >= least + margin
    i, j = np.nonzero((rough >= least - margin) & ~links)
    for at in range(0, len(i), 1 << 16):
        x, y = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
        links[x, y] = np.einsum("ij,ij->i", a[x], b[y]) >= least
    return links


def roots_of(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest label reachable within one Boolean block, for its rows and its columns."""
    far = np.iinfo(np.int64).max
    while True:
        new_right = np.minimum(right, np.where(links, left[:, None], far).min(axis=0, initial=far))
        new_left = np.minimum(left, np.where(links, new_right[None, :], far).min(axis=1, initial=far))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def near_vectors(
    vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding",
    cell_rows: int = CELL_ROWS, block: int = BLOCK,
) -> DataFrame:
    """One row per vector: its id, ``n_links``, ``component_id`` and ``kept``.

    ``n_links`` counts the other rows with a cosine of at least ``least`` (above 0), copies included;
    ``component_id`` is the smallest id reachable by links; ``kept`` tells whether it is the row's own id.
    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and
    neither do vectors of different length. A null id is never the smallest. Rows that repeat an id are
    vectors of their own. An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    keyed = keyed_vectors(vectors, id_col, vec_col, unit)
    classes = stage(
        keyed.where("key is not null").groupBy("key").agg(
            F.min("id").alias("first"), F.count("*").alias("copies"), F.first("vec").alias("vec")), "vectors")
    n = classes.count()
    # the pivots come from a bounded sample; every class is placed
    sample = [r.vec for r in classes.orderBy(F.xxhash64("key")).limit(SAMPLE_ROWS).select("vec").collect()]
    pivots: dict[int, np.ndarray] = {}
    for size in sorted({len(v) // 8 for v in sample}):
        rows = stacked([v for v in sample if len(v) == 8 * size])
        share = max(1, math.ceil(n * len(rows) / max(1, len(sample)) / cell_rows))
        pivots[size] = rows[spread_pivots(rows, min(share, MOST_PIVOTS))]
    reach = math.sqrt(max(0.0, 2 - 2 * least)) * (1 + 1e-9) + 1e-9

    def place(batches):
        for batch in batches:
            raw = batch.column("vec").to_pylist()
            take, cell, home = [], [], []
            for i, v in enumerate(raw):
                size = len(v) // 8
                at = pivots.get(size)
                if at is None:
                    take, cell, home = take + [i], cell + [f"{size}/0"], home + [True]
                    continue
                near = at @ np.frombuffer(v, "<f8")
                p = int(np.argmax(near))
                apart = np.sqrt(np.maximum(0, 2 - 2 * (at @ at[p])))
                visits = np.flatnonzero(near[p] - near[:p] <= reach * apart[:p] + 1e-12)
                take += [i] * (len(visits) + 1)
                cell += [f"{size}/{p}", *(f"{size}/{q}" for q in visits)]
                home += [True] + [False] * len(visits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.string()), pa.array(home, pa.bool_()), *batch.take(pa.array(take, pa.int64())).columns],
                ["cell", "home", *batch.schema.names])

    placed = classes.select("key", "copies", "vec").mapInArrow(
        place, "cell string, home boolean, key binary, copies bigint, vec binary")
    # rows per cell: at most two numbers for each of at most MOST_PIVOTS cells and vector length
    sizes = placed.groupBy("cell").agg(
        F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("guests"))
    cuts = stage(sizes.select(
        "cell", F.ceil(F.col("homes") / block).cast("int").alias("h"),
        F.ceil(F.col("guests") / block).cast("int").alias("g")), "cells")
    salt = F.xxhash64("key")
    cut = placed.join(F.broadcast(cuts), "cell").where("h > 0")
    own = F.pmod(salt, F.col("h")).cast("int")
    # block join (i, j): home block i with home block j >= i, or with guest block j - h
    at_home = cut.where("home").select("*", own.alias("c")).select(
        "*", F.explode(F.expr(
            "transform(sequence(0, h + g - 1), k -> struct(least(k, c) as i, greatest(k, c) as j))")).alias("t"))
    visiting = cut.where("not home").select(
        "*", (F.col("h") + F.pmod(salt, F.col("g")).cast("int")).alias("c")).select(
        "*", F.explode(F.expr("transform(sequence(0, h - 1), i -> struct(i as i, c as j))")).alias("t"))
    blocks = at_home.unionByName(visiting).select(
        "cell", F.col("t.i").alias("i"), F.col("t.j").alias("j"), "c", "key", "copies", "vec")

    def join_block(group: pa.Table) -> pa.Table:
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        c = group.column("c").to_numpy()
        keys, copies = group.column("key").to_pylist(), group.column("copies").to_numpy()
        x = stacked(group.column("vec").to_pylist())
        rows, cols = np.flatnonzero(c == i), np.flatnonzero(c == j)
        count = np.zeros(len(keys), np.int64)
        a_keys, b_keys = [], []
        for at in range(0, len(rows), STRIP):
            strip = rows[at:at + STRIP]
            side = cols[at:] if i == j else cols  # a block with itself: the upper triangle
            links = link_block(x[strip], x[side], least)
            if i == j:
                links &= np.arange(len(strip))[:, None] < np.arange(len(side))[None, :]
            up, across = links.any(axis=1), links.any(axis=0)
            if not up.any():
                continue
            strip, side, links = strip[up], side[across], links[np.ix_(up, across)]
            count[strip] += links @ copies[side]
            count[side] += links.T @ copies[strip]
            left, right = roots_of(links, strip.astype(np.int64), side.astype(np.int64))
            for node, root in {*zip(strip.tolist(), left.tolist()), *zip(side.tolist(), right.tolist())}:
                if node != root:
                    a_keys.append(keys[node])
                    b_keys.append(keys[root])
        linked = np.flatnonzero(count)
        return pa.table({
            "a": pa.array(a_keys + [keys[k] for k in linked], pa.binary()),
            "b": pa.array(b_keys + [None] * len(linked), pa.binary()),
            "links": pa.array([0] * len(a_keys) + count[linked].tolist(), pa.int64())})

    found = stage(blocks.groupBy("cell", "i", "j").applyInArrow(
        join_block, T.StructType.fromDDL("a binary, b binary, links bigint")), "found")
    linked = components(found.where("b is not null").select("a", "b"))
    roots = classes.select("key", "first", "copies").join(
        linked.select(F.col("node").alias("key"), "component"), "key", "left")
    roots = roots.withColumn("component", F.coalesce("component", "key"))
    least_id = roots.groupBy("component").agg(F.min("first").alias("component_id"))
    counts = found.where("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    per_class = roots.join(least_id, "component").join(counts, "key", "left").select(
        "key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = keyed.select("id", "key").join(per_class, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
