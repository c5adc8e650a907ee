"""Vector best-fit packing of token pieces into sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared lengths). A
piece's demand follows from its length, so all pieces of one length are alike and the plan needs only the
histogram of lengths, which has at most ``max_tokens`` entries however large the corpus is. The plan
places lengths from long to short; open sequences in the same state form one range of sequence numbers,
and a placement takes a whole run of equal pieces into a whole run of equal sequences. Pieces then find
their sequence by their rank among the pieces of their length: a number within the task that wrote them
plus the count of that length in earlier tasks. No group of equal lengths meets in one task.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tillwatch.llm.common import bound_batches, per_process, stage


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence, the weight of each, and how a sequence is chosen.

    ``norm``: the sequence whose weighted residual is smallest after placing (tight fit). ``dot``: the
    one whose residual has the largest weighted dot product with the demand (balanced fit).
    """

    max_tokens: int
    max_docs: int
    max_cost: int
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    score: str = "norm"


@dataclass
class Plan:
    """Placements (length, first rank, last rank + 1, first sequence, pieces per sequence, offset)."""

    placements: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0


def plan_best_fit(counts: dict[int, int], limits: Limits) -> Plan:
    caps = np.array([limits.max_tokens, limits.max_docs, limits.max_cost], dtype=np.float64)
    weights, plan = np.array(limits.weights), Plan()
    # Ranges of sequences in one state: first number, how many, residual capacities.
    first = np.zeros(0, np.int64)
    many = np.zeros(0, np.int64)
    left = np.zeros((0, 3), np.int64)
    for length in sorted(counts, reverse=True):
        demand = np.array([length, 1, length * length], dtype=np.int64)
        if length < 1 or (demand > caps).any():
            raise ValueError(f"a piece of {length} tokens does not fit an empty sequence")
        todo, rank = counts[length], 0
        while todo:
            fits = np.flatnonzero((left >= demand).all(axis=1))
            if len(fits):
                if limits.score == "norm":
                    score = -((((left[fits] - demand) / caps) ** 2) * weights).sum(axis=1)
                else:
                    score = ((left[fits] / caps) * (demand / caps) * weights).sum(axis=1)
                at = int(fits[np.argmax(score)])
            else:
                at = len(first)
                first, many = np.append(first, plan.sequences), np.append(many, todo)
                left = np.vstack([left, caps.astype(np.int64)])
            # A tight fit goes on with the sequence it has just made tighter; a balanced one moves on.
            each = int((left[at] // demand).min()) if limits.score == "norm" else 1
            if todo < each:
                each = todo
            bins = min(int(many[at]), todo // each)
            placed = bins * each
            plan.placements.append((length, rank, rank + placed, int(first[at]), each, int(caps[0] - left[at][0])))
            plan.sequences = max(plan.sequences, int(first[at]) + bins)
            rank, todo = rank + placed, todo - placed
            rest = left[at] - each * demand
            if bins == many[at]:
                left[at] = rest
            else:
                fresh = not len(fits)
                if not fresh:
                    first, many = np.append(first, first[at] + bins), np.append(many, many[at] - bins)
                    left = np.vstack([left, left[at]])
                many[at], left[at] = bins, rest
        low = min((x for x in counts if x < length), default=None)
        if low is not None:  # sequences too full for the shortest piece need no more looks
            open_ = (left >= np.array([low, 1, low * low])).all(axis=1)
            first, many, left = first[open_], many[open_], left[open_]
    return plan


def numbered(items: DataFrame, length_col: str = "length") -> DataFrame:
    """Adds the number of the writing task and the rank among its items of the same length; staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            nth = []
            for n in batch.column(length_col).to_pylist():
                nth.append(seen.get(n, 0))
                seen[n] = nth[-1] + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(nth), pa.int32()), pa.array(nth, pa.int64())],
                [*batch.schema.names, "__part", "__nth"])

    return stage(items.mapInArrow(run, T.StructType([
        *items.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__nth", T.LongType())])),
        "numbered")


def pack(staged: DataFrame, limits: Limits, length_col: str = "length") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table of :func:`numbered` items.

    Every item gets a place; items of one sequence lie side by side from offset 0. A length of null or
    below 1 gets a null place. A length that no empty sequence can hold raises ValueError. Equal items
    are interchangeable; which of them gets which of the equal places follows the staged order.
    """
    rows = staged.withColumnRenamed(length_col, "__length")
    good = F.col("__length") >= 1
    per_task = rows.where(good).groupBy("__part", "__length").agg(F.count("*").alias("__n"))
    counts = {r["__length"]: r["n"] for r in per_task.groupBy("__length").agg(F.sum("__n").alias("n")).collect()}
    plan = plan_best_fit(counts, limits)
    earlier = Window.partitionBy("__length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("__part", "__length", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    table = np.array(sorted(plan.placements), dtype=np.int64).reshape(-1, 6)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stride = int(table[:, 2].max()) + 1 if len(table) else 1
        starts = table[:, 0] * stride + table[:, 1]
        for batch in batches:
            length = batch.column("__length").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = (batch.column("__nth").to_numpy(zero_copy_only=False)
                    + batch.column("__before").fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
            ok = length >= 1
            row = np.searchsorted(starts, length * stride + rank, side="right") - 1
            hit = table[np.where(ok, row, 0)] if len(table) else np.zeros((len(length), 6), np.int64)
            step, each = rank - hit[:, 1], np.maximum(hit[:, 4], 1)
            out = [pa.array(x, pa.int64(), mask=~ok)
                   for x in (hit[:, 3] + step // each, hit[:, 5] + (step % each) * length)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column("__length" if f.name == length_col else f.name) for f in fields), *out],
                [*(f.name for f in fields), "sequence_id", "offset"])

    fields = [f for f in staged.schema.fields if f.name not in ("__part", "__nth")]
    return rows.join(before, ["__part", "__length"], "left").mapInArrow(place, T.StructType([
        *fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def tokenizer(json_path: str, ranks_path: str, pattern: str):
    """Ids of a text as the tokenizer file gives them by its default settings.

    The rank file holds the same vocabulary and merges and is several times faster. Texts with code
    points beyond Latin-1 go to the tokenizer itself, so that the two libraries' Unicode tables, which
    may be of different age, never decide; so do texts that hold an added token of the file.
    """
    def load():
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("same", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        exact = Tokenizer.from_file(json_path)
        return fast, exact, [t.content for t in exact.get_added_tokens_decoder().values()]

    fast, exact, added = per_process(f"both {json_path} {ranks_path}", load)

    def ids(text: str) -> list[int]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return exact.encode(text, add_special_tokens=False).ids
        if any(token in text for token in added):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return ids


def token_pieces(
    docs: DataFrame, json_path: str, ranks_path: str, pattern: str, max_tokens: int, end_id: int,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document, numbered for :func:`pack` and staged.

    A document's ids are its text's ids and ``end_id``; a null text is empty, so every row has a piece.
    Only a longer document is cut, into pieces of ``max_tokens`` of which the first may be shorter.
    Repeated rows are documents of their own, other columns are ignored.
    """
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), *T.StructType.fromDDL(
        "piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, __part int, __nth bigint").fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = tokenizer(json_path, ranks_path, pattern), TaskContext.get().partitionId(), {}
        for batch in batches:
            rows, kind = [], batch.column("id").type
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                ids = np.array([*encode(text.as_py()), end_id], dtype="<u4")
                head = len(ids) % max_tokens or max_tokens
                for piece, end in enumerate(range(head, len(ids) + 1, max_tokens)):
                    start = max(0, end - max_tokens) if piece else 0
                    data = ids[start:end].tobytes()
                    nth = seen.get(end - start, 0)
                    seen[end - start] = nth + 1
                    rows.append((key, piece, start, end - start, zlib.crc32(data), data if with_ids else None, part, nth))
            kinds = [kind, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 8, kinds, strict=True)],
                [f.name for f in fields])

    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    pieces = rows.mapInArrow(run, T.StructType(fields))
    return stage(pieces if with_ids else pieces.drop("ids"), "pieces")
