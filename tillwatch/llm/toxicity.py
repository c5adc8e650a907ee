"""Severity of toxic language by cumulative-link ordinal regression on sparse text features.

Features are the distinct words of a text and their first four and five letters, lower-cased and hashed.
One weight vector serves all grades: P(grade <= k) = 1 / (1 + exp(-(threshold_k - w.x))) with ordered
thresholds. The fit keeps the features most associated with the grades and shrinks the rest to zero
(proximal gradient steps with momentum). The result is the expected severity, the sum of P(grade >= k).

The fit uses a bounded sample of labelled rows inside one task; scoring reads every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillwatch.llm.common import bound_batches, per_process
from tillwatch.llm.quality import KEPT_WORDS, fit_on_sample

BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
FIT_ROWS = 16_000
KEPT_FEATURES = 4_096
PARTS = re.compile(r"\w+")


class Words(dict):
    """Buckets of the features of each blank-separated token, kept for tokens seen before."""

    def __missing__(self, token: str) -> np.ndarray:
        if len(self) >= KEPT_WORDS:
            self.clear()
        names = set()
        for part in PARTS.findall(token.lower()):
            names.add(part)
            names.update(f"{part[:n]}*" for n in (4, 5) if len(part) > n)
        self[token] = value = np.array(
            [xxhash.xxh3_64_intdigest(x) >> (64 - BUCKET_BITS) for x in names], dtype=np.int32)
        return value


def word_features(text: str, words: Words) -> np.ndarray:
    tokens = set(text.split())
    if not tokens:
        return np.zeros(0, np.int32)
    return np.unique(np.concatenate([words[t] for t in tokens]))


@dataclass
class Severity:
    """Weights by bucket and the ordered thresholds between grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, buckets: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        level = float(self.weights[buckets].sum())
        return 1 / (1 + np.exp(np.clip(self.thresholds - level, -500, 500)))


def associated(rows: list[np.ndarray], grades: np.ndarray, most: int, least_rows: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Buckets whose presence speaks most for or against grades above 0, and their log odds."""
    high, low = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for x, g in zip(rows, grades, strict=True):
        (high if g else low)[x] += 1
    n_high, n_low = max(1, int((grades > 0).sum())), max(1, int((grades == 0).sum()))
    odds = np.log((high + 0.5) / (n_high - high + 0.5)) - np.log((low + 0.5) / (n_low - low + 0.5))
    spread = np.sqrt(1 / (high + 0.5) + 1 / (low + 0.5))
    z = np.where(high + low >= least_rows, np.abs(odds) / spread, 0)
    best = np.argsort(-z, kind="stable")[:most]
    return best[z[best] > 0], odds


def graded(rows: list[np.ndarray], toxic: np.ndarray, levels: int = 3) -> np.ndarray:
    """Grades 0..levels from two-valued labels: toxic rows by how many telling features they hold."""
    best, odds = associated(rows, toxic, KEPT_FEATURES)
    telling = np.zeros(BUCKETS, bool)
    telling[best[odds[best] > 2]] = True
    amount = np.array([telling[x].sum() for x in rows])
    cuts = np.quantile(amount[toxic > 0], np.arange(1, levels) / levels) if (toxic > 0).any() else []
    return np.where(toxic > 0, 1 + np.searchsorted(cuts, amount, side="left"), 0)


def fit_severity(
    rows: list[np.ndarray], grades: np.ndarray, sparse: float = 2e-4, ridge: float = 1e-4, steps: int = 600,
) -> Severity:
    """Grades are 0, 1, ...; with fewer than two grades in the rows the severity is that grade's share."""
    top = int(grades.max()) if len(grades) else 0
    if top == 0:
        return Severity(np.zeros(BUCKETS), np.array([6.0]))
    best, _ = associated(rows, grades, KEPT_FEATURES)
    place = np.full(BUCKETS, -1, np.int64)
    place[best] = np.arange(len(best))
    kept = [place[x][place[x] >= 0] for x in rows]
    n, d = len(rows), len(best)
    row_of = np.repeat(np.arange(n), [len(k) for k in kept])
    cols = np.concatenate(kept) if n else np.zeros(0, np.int64)
    share = np.array([(grades <= k).mean() for k in range(top)]).clip(1e-3, 1 - 1e-3)
    cut = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(top))
    w, momentum, cut_momentum, t = np.zeros(d), np.zeros(d), cut.copy(), 1.0
    hits = np.bincount(cols, minlength=d)
    pace = 4.0 / np.maximum(hits / n, 8 / n) ** 0.5 / max(1.0, np.sqrt(np.mean([len(k) for k in kept]) + 1))
    for _ in range(steps):
        level = np.bincount(row_of, weights=momentum[cols], minlength=n)
        edges = np.concatenate([[-np.inf], cut_momentum, [np.inf]])
        upper = 1 / (1 + np.exp(-np.clip(edges[grades + 1] - level, -60, 60)))
        lower = 1 / (1 + np.exp(-np.clip(edges[grades] - level, -60, 60)))
        inside = np.maximum(upper - lower, 1e-12)
        pull = 1 - upper - lower
        slope = np.bincount(cols, weights=pull[row_of], minlength=d) / n + ridge * momentum
        new = momentum - pace * slope
        new = np.sign(new) * np.maximum(np.abs(new) - pace * sparse, 0)
        cut_slope = np.zeros(top)
        for k in range(top):
            cut_slope[k] = (np.where(grades == k + 1, lower * (1 - lower), 0)
                            - np.where(grades == k, upper * (1 - upper), 0)).dot(1 / inside) / n
        new_cut = np.sort(cut_momentum - 2.0 * cut_slope)
        following = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum = new + (t - 1) / following * (new - w)
        cut_momentum = np.sort(new_cut + (t - 1) / following * (new_cut - cut))
        w, cut, t = new, new_cut, following
        if _ % 50 == 49:  # restart keeps the momentum from overshooting
            t = 1.0
    weights = np.zeros(BUCKETS)
    weights[best] = w
    return Severity(weights, cut)


def fit_toxic_labels(rows: list[np.ndarray], toxic: np.ndarray) -> Severity:
    return fit_severity(rows, graded(rows, np.where(toxic > 0, 1, 0)))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    fit_rows: int = FIT_ROWS, fit=fit_toxic_labels,
) -> Severity:
    """The model of at most ``fit_rows`` documents with labelled ids, those with the smallest hash of their id.

    ``fit`` is :func:`fit_toxic_labels` for 0/1 labels, :func:`fit_severity` for labels that are grades.
    Null labels and ids are left out, an id labelled twice counts once with its smaller label, and of
    an id's documents the one with the smallest hash of its text. Without labels, or without any above 0, no
    document is toxic.
    """
    return fit_on_sample(docs, labels, id_col, text_col, label_col, fit_rows, Words, word_features, fit)


def score_toxicity(
    docs: DataFrame, model: Severity, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.2,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Id, expected ``severity``, likeliest ``grade``, ``score`` = P(grade >= 1) and ``toxic`` of every row.

    A row is toxic if its score reaches ``threshold``. Null and empty texts have no features and get the
    severity of the thresholds alone. Repeated rows are scored one by one.
    """
    kept = list(dict.fromkeys([id_col, *carry]))
    rows = docs.select(*kept, *([] if text_col in kept else [text_col]))
    bound_batches(docs.sparkSession)
    scorer = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))  # with its class

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, fitted = per_process("words Words", Words), cloudpickle.loads(scorer.value)
        for batch in batches:
            over = [fitted.at_least(word_features(t.as_py() or "", known)) for t in batch.column(text_col)]
            grade = [int(np.argmax(-np.diff(np.concatenate([[1.0], p, [0.0]])))) for p in over]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array([float(p.sum()) for p in over], pa.float64()),
                 pa.array(grade, pa.int32()), pa.array([float(p[0]) for p in over], pa.float64()),
                 pa.array([bool(p[0] >= threshold) for p in over], pa.bool_())],
                [*kept, "severity", "grade", "score", "toxic"])

    return rows.mapInArrow(run, T.StructType([
        *(docs.schema[c] for c in kept), *T.StructType.fromDDL(
            "severity double, grade int, score double, toxic boolean").fields]))
