"""Small helpers shared by the operators."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillwatch.session import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends here and lost executors cost nothing."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_observed(df: DataFrame, name: str, **figures: Column) -> tuple[DataFrame, dict]:
    """``stage`` and aggregates over the rows written, from the writing job itself."""
    seen = Observation()
    staged = stage(df.observe(seen, *(c.alias(k) for k, c in figures.items())), name)
    return staged, seen.get


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs started inside; what was set before comes back."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def free_names(columns: list[str], *names: str) -> list[str]:
    """``names``, with underscores in front until none is a column, whatever the case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 1,000 rows and, where the version knows the setting, about 8 MB.

    A worker then holds a few MB of text at a time however long the documents are.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_side(df: DataFrame, rows: int, most: int = 200_000) -> DataFrame:
    """Broadcast a narrow table of ``rows`` counted rows when they are few; else leave the join to Spark."""
    return F.broadcast(df) if rows <= most else df


def per_process(key: str, make):
    """An object that a worker process builds once and keeps for its later tasks."""
    kept = sys.__dict__.setdefault("_tillwatch_llm", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]
