"""Vectors as bytes: reading Arrow lists, validity, and pivots."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.common import bound_batches


def as_arrays(column: pa.Array) -> list[np.ndarray | None]:
    """Each list as float64; None if the list is null, empty or holds a null or non-finite component."""
    out: list[np.ndarray | None] = []
    for item in column:
        values = item.values if item.is_valid else None
        if values is None or len(values) == 0 or values.null_count:
            out.append(None)
            continue
        x = values.to_numpy(zero_copy_only=False).astype(np.float64)
        out.append(x if np.isfinite(x).all() else None)
    return out


def keyed_vectors(vectors: DataFrame, id_col: str, vec_col: str, usable) -> DataFrame:
    """``id, key, vec``: a 16-byte key of equal vectors and their float64 bytes; both null if unusable."""
    bound_batches(vectors.sparkSession)
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vec_col}`").alias("vec"))

    def run(batches):
        for batch in batches:
            raw = []
            for x in as_arrays(batch.column("vec")):
                x = None if x is None else usable(x)
                raw.append(None if x is None else (x + 0.0).astype("<f8").tobytes())  # -0.0 equals 0.0
            keys = [None if r is None else xxhash.xxh3_128_digest(r) for r in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], ["id", "key", "vec"])

    return rows.mapInArrow(run, T.StructType.fromDDL("id bigint, key binary, vec binary"))


def stacked(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)


def spread_pivots(sample: np.ndarray, how_many: int) -> np.ndarray:
    """Row numbers of a sample, each farthest from those before it; fewer if the rest are copies."""
    chosen = [0]
    away = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(how_many, len(sample)):
        at = int(np.argmax(away))
        if away[at] <= 0:
            break
        chosen.append(at)
        away = np.minimum(away, ((sample - sample[at]) ** 2).sum(axis=1))
    return np.array(chosen)
