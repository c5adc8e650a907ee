"""Document quality by support vectors on Naive Bayes scaled n-gram indicators.

Features are the 1- to 3-grams of word forms (``Word,`` is ``Aa,``; a word equal to the one before it is
marked), hashed to ``BUCKETS`` indicators. Longer words, as in scripts without blanks, are read as consecutive
units of ``UNIT`` characters. Forms do not depend on language or vocabulary. Each indicator
is scaled by the log ratio of its class shares, and a linear hinge-loss model on the scaled vectors is
fitted by dual coordinate descent. A logistic curve fitted on rows that the descent did not see turns
margins into probabilities.

The fit uses a bounded sample of labelled rows (``fit_rows``, those with the smallest hash of their id)
inside one task; scoring reads every whole text and never moves it.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.common import bound_batches, per_process

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
FIT_ROWS = 8_000
KEPT_WORDS = 100_000
UNIT = 64
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


class Forms(dict):
    """Hash of the form of each word of at most ``UNIT`` characters, kept for words seen before."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        form = "".join(
            "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
        form = re.sub(r"(.)\1+", r"\1", form) if len(form) > 1 else form
        tail = re.search(r"[^\w]*$", word)[0]
        self[word] = value = xxhash.xxh3_64_intdigest(f"{form} {tail}")
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * ODD[0]
    return x ^ (x >> np.uint64(29))


def form_ngrams(text: str, forms: Forms) -> np.ndarray:
    """Sorted distinct buckets of a text's 1- to 3-grams of forms; empty for a text without words."""
    words = text.split()
    if len(max(words, key=len, default="")) > UNIT:
        words = [w[i:i + UNIT] for w in words for i in range(0, len(w), UNIT)]
    n = len(words)
    if not n:
        return np.zeros(0, np.int32)
    one = np.fromiter(map(forms.__getitem__, words), np.uint64, n)
    if n > 1:
        one[1:] += np.fromiter(map(operator.eq, words[1:], words), np.uint64, n - 1) * ODD[2]
    grams = [mixed(one)]
    if n > 1:
        grams.append(mixed(one[:-1] * ODD[0] + one[1:] * ODD[1]))
    if n > 2:
        grams.append(mixed(one[:-2] * ODD[1] + one[1:-1] * ODD[2] + one[2:] * ODD[0]))
    return np.unique((np.concatenate(grams) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))


@dataclass
class Model:
    """Weight and squared ratio per bucket, bias, and the curve 1 / (1 + exp(-(slope * margin + shift)))."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, buckets: np.ndarray) -> float:
        # unit length keeps long texts, which hold more n-grams, comparable with short ones
        size = max(float(self.squares[buckets].sum()) ** 0.5, 1e-9)
        return float(self.weights[buckets].sum()) / size + self.bias

    def score(self, buckets: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(buckets) + self.shift, -500, 500))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    shares = []
    for label in (1, 0):
        counts = np.full(BUCKETS, smooth)
        for x in (r for r, y in zip(rows, labels, strict=True) if y == label):
            counts[x] += 1
        shares.append(counts / counts.sum())
    return np.log(shares[0] / shares[1])


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, cost: np.ndarray, epochs: int = 20,
    seed: int = 5, tolerance: float = 1e-3,
) -> np.ndarray:
    """Weights (the last is the bias) minimising |w|^2 / 2 + sum cost * max(0, 1 - sign * w.x)."""
    w, alpha = np.zeros(BUCKETS + 1), np.zeros(len(rows))
    norms = np.array([float(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            x, v, y = rows[i], values[i], signs[i]
            gradient = y * (float(w[x] @ v) + w[-1]) - 1
            wanted = min(max(alpha[i] - gradient / norms[i], 0.0), cost[i])
            step = wanted - alpha[i]
            if step:
                w[x] += step * y * v
                w[-1] += step * y
                alpha[i] = wanted
                worst = max(worst, abs(step) * norms[i] ** 0.5)
        if worst < tolerance:
            break
    return w


def logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps on smoothed targets."""
    ones = labels.sum()
    zeros = len(labels) - ones
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    design = np.column_stack([margins, np.ones(len(margins))])
    at = np.array([0.0, np.log((ones + 1) / (zeros + 1))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        gradient = design.T @ (p - target) + 1e-6 * at
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5 / max(abs(step).max(), 1e-12))
        at -= step
        if abs(step).max() < 1e-9:
            break
    return max(float(at[0]), 0.0), float(at[1])


def fit_model(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Every fifth row only sets the curve. Without both classes every score is their smoothed share."""
    ones = int(labels.sum())
    if not ones or ones == len(labels):
        share = (ones + 1) / (len(labels) + 2)
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0, float(np.log(share / (1 - share))))
    curve = np.arange(len(rows)) % 5 == 0
    if len(set(labels[~curve])) < 2 or len(set(labels[curve])) < 2:
        fit, y, seen, seen_y = rows, labels, rows, labels
    else:
        fit, y = [r for r, c in zip(rows, curve, strict=True) if not c], labels[~curve]
        seen, seen_y = [r for r, c in zip(rows, curve, strict=True) if c], labels[curve]
    ratios = log_count_ratios(fit, y)
    cost = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    values = [ratios[r] / max(float(np.linalg.norm(ratios[r])), 1e-9) for r in fit]
    w = dual_coordinate_descent(fit, values, np.where(y == 1, 1, -1), cost)
    model = Model(w[:-1] * ratios, ratios ** 2, float(w[-1]))
    model.slope, model.shift = logistic_curve(np.array([model.margin(r) for r in seen]), seen_y)
    return model


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    fit_rows: int = FIT_ROWS,
) -> Model:
    """The model of at most ``fit_rows`` documents with labelled ids, those with the smallest hash of their id.

    Null labels and ids are left out, an id labelled twice counts once with its smaller label, and of an
    id's documents the one with the smallest hash of its text. Without labels every score is one half.
    """
    return fit_on_sample(docs, labels, id_col, text_col, label_col, fit_rows, Forms, form_ngrams, fit_model)


def fit_on_sample(docs, labels, id_col, text_col, label_col, fit_rows, vocabulary, featurise, fit):
    """Features of a bounded, hash-ordered sample of labelled documents, and ``fit`` on them in one task.

    The sample is taken from the labels of ``docs``, one document per id, so ``fit_rows`` bounds its rows.
    """
    bound_batches(docs.sparkSession)
    marked = docs.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("id")).agg(
        F.min(F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))).alias("mark"))
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.min(label_col).cast("int").alias("label"))
        .join(marked, "id").withColumn("place", F.xxhash64("id")).orderBy("place", "id").limit(fit_rows))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    ).withColumn("mark", F.xxhash64("text")).join(F.broadcast(chosen), ["id", "mark"])  # at most fit_rows narrow rows
    rows = rows.dropDuplicates(["id"])  # equal copies

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = per_process(f"words {vocabulary.__name__}", vocabulary)
        for batch in batches:
            found = [featurise(t.as_py(), known).astype("<i4").tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("label"), pa.array(found, pa.binary())], ["place", "label", "found"])

    def fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, marks = [], []
        for batch in batches:
            found += [np.frombuffer(x.as_py(), "<i4") for x in batch.column("found")]
            marks += batch.column("label").to_pylist()
        model = fit(found, np.array(marks, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(model)], pa.binary())], ["model"])

    fitted = (
        rows.mapInArrow(features, "place bigint, label int, found binary").repartition(1)
        .sortWithinPartitions("place", "found").mapInArrow(fit_all, "model binary").collect())
    return cloudpickle.loads(fitted[0]["model"]) if fitted else fit([], np.zeros(0, np.int64))


def held_out(id_column: Column) -> Column:
    """Whether CRC-32 of the id as text leaves no rest by five; false for a null id."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_quality(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Id, ``score`` (0 to 1) and ``predicted`` of every row, and the columns in ``carry``.

    Null and empty texts have no n-grams and get the score of the bias alone. Repeated rows are scored
    one by one; an empty table gives no rows.
    """
    kept = list(dict.fromkeys([id_col, *carry]))
    rows = docs.select(*kept, *([] if text_col in kept else [text_col]))
    bound_batches(docs.sparkSession)
    scorer = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))  # with its class

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, fitted = per_process("words Forms", Forms), cloudpickle.loads(scorer.value)
        for batch in batches:
            scores = [fitted.score(form_ngrams(t.as_py() or "", known)) for t in batch.column(text_col)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())],
                [*kept, "score", "predicted"])

    return rows.mapInArrow(run, T.StructType([
        *(docs.schema[c] for c in kept), T.StructField("score", T.DoubleType()),
        T.StructField("predicted", T.IntegerType())]))
