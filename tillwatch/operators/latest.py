"""Latest row per key, and the reduction of a change stream to its current rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that comes first in ``order``.

    Spark turns ``row_number() = 1`` into a group limit that also runs before the shuffle, so a key
    with very many copies sends one row per map task, not all of them.
    """
    return (
        df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
        .where("_rn = 1").drop("_rn")
    )


def content_order(df: DataFrame) -> Column:
    """Settles equal times by the content of the row, so that a rerun picks the same one."""
    return F.xxhash64(*df.columns).desc()


def dedup(payments: DataFrame) -> DataFrame:
    """One row per transaction: the copy ingested last; equal times fall back to the content."""
    content = F.xxhash64(*[c for c in payments.columns if c not in ("transaction_id", "ingested_at")])
    return latest(payments, ["transaction_id"], [F.col("ingested_at").desc(), content.desc()])


def current_rows(changes: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Current state of a change stream: newest change per key, deleted keys removed."""
    return latest(changes, keys, order).where(F.col("op") != "d")
