"""A watermark by source partition that does not wait for silent partitions.

The watermark is the smallest newest event time over the active partitions, less the bound of disorder. A
partition is active until nothing has arrived from it for ``idle_ms`` of arrival time; the one that spoke
last always counts. The watermark never goes back: a partition that returns with a backlog finds it where
the others have left it, and its rows are late or on time by that alone.

Arrival time is the clock, so a replay gives what the live stream gave.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwatch.operators.slices import MINUTE, SECOND, slice_of

IDLE_MS = 30 * SECOND
BOUND_MS = 10 * SECOND
#: State of a clock: per partition the last arrival and the newest event time, and the watermark so far.
CLOCK = "source bigint, arrived_ms bigint, top bigint, floor_ms bigint"
SWEPT = "bucket bigint, arrived_ms bigint, mark bigint"


def _sweep(idle_ms: int):
    """Buckets of arrival time in order: at every instant the smallest top of the active partitions."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = instant = None
        idle: dict[int, int] = {}  # newest event time of partitions that are not active
        active: dict[int, tuple[int, int]] = {}  # last arrival and newest event time, by last arrival
        new: dict[int, int] = {}  # what arrives in this instant and is not seen yet
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for b, source, at, top, known in zip(
                    *(batch.column(n).to_pylist() for n in ("bucket", "source", "arrived_ms", "top", "known")), strict=True):
                if b != bucket:
                    bucket, instant = b, None
                    idle.clear(), active.clear(), new.clear()
                if known:  # in order of arrival, before the rows of the bucket
                    _, before = active.pop(source, (at, top))
                    active[source] = (at, max(top, before))
                    continue
                if at != instant:
                    for s, t in new.items():
                        before = max(active.pop(s, (0, t))[1], idle.pop(s, t))
                        active[s] = (instant, max(before, t))
                    new.clear()
                    instant = at
                    if active:
                        oldest = min(at - idle_ms, next(reversed(active.values()))[0])
                        for s in [s for s, (last, _) in active.items() if last < oldest]:
                            idle[s] = active.pop(s)[1]
                    for column, x in zip(out, (b, at, min((t for _, t in active.values()), default=None)), strict=True):
                        column.append(x)
                new[source] = max(new.get(source, top), top)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["bucket", "arrived_ms", "mark"])

    return sweep


def with_partition_watermark(
    rows: DataFrame, source: str = "src_partition", bound_ms: int = BOUND_MS, idle_ms: int = IDLE_MS,
    bucket_ms: int = MINUTE, before: DataFrame | None = None,
) -> DataFrame:
    """Add ``watermark_ms`` as it stood when the row arrived, and ``late``.

    Rows of one millisecond do not see each other. ``before`` is the :data:`CLOCK` of earlier rows. Rows are
    reduced to one per partition and millisecond of arrival first; a task then sweeps one bucket of arrival
    time, which opens with what the partitions of the bucket before left. A row needs its arrival time.
    """
    if idle_ms > bucket_ms:
        raise ValueError("a partition must go idle within one bucket")
    timed = rows.withColumns({"arrived_ms": F.unix_millis("ingested_at"), "event_ms": F.unix_millis("event_ts")})
    instants = timed.groupBy(F.col(source).cast("bigint").alias("source"), "arrived_ms").agg(
        F.max("event_ms").alias("top")).withColumn("known", F.lit(False))
    if before is not None:
        instants = instants.unionByName(
            before.select("source", "arrived_ms", "top").withColumn("known", F.lit(True)))
    instants = instants.withColumn("bucket", slice_of(F.col("arrived_ms"), bucket_ms))
    by_bucket = instants.groupBy("source", "bucket").agg(F.max("top").alias("top"), F.max("arrived_ms").alias("arrived_ms"))
    of_source = W.partitionBy("source").orderBy("bucket")
    upto = by_bucket.withColumn("top", F.max("top").over(of_source.rowsBetween(W.unboundedPreceding, W.currentRow)))
    # one row per bucket with arrivals
    following = upto.select("bucket").distinct().withColumn("next", F.lead("bucket").over(W.orderBy("bucket")))
    handed = upto.join(following, "bucket").where("next IS NOT NULL").select(
        "source", "arrived_ms", "top", F.lit(True).alias("known"), F.col("next").alias("bucket"))
    own = upto.select(
        "source", F.lag("arrived_ms").over(of_source).alias("arrived_ms"), F.lag("top").over(of_source).alias("top"),
        F.lit(True).alias("known"), "bucket").where("top IS NOT NULL")
    swept = (
        instants.unionByName(handed).unionByName(own).repartition("bucket")
        .sortWithinPartitions("bucket", F.desc("known"), "arrived_ms").mapInArrow(_sweep(idle_ms), SWEPT)
        .withColumn("mark", F.col("mark") - bound_ms))
    tops = swept.groupBy("bucket").agg(F.max("mark").alias("top"))
    floor = F.lit(None if before is None else before.agg(F.max("floor_ms")).first()[0]).cast("bigint")
    earlier = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    tops = tops.select("bucket", F.greatest(F.max("top").over(earlier), floor).alias("before_bucket"))
    inside = W.partitionBy("bucket").orderBy("arrived_ms").rowsBetween(W.unboundedPreceding, W.currentRow)
    marks = swept.withColumn("mark", F.max("mark").over(inside)).join(tops, "bucket").select(
        "arrived_ms", F.greatest("mark", "before_bucket").alias("watermark_ms"))
    # every row has its mark; a left join never sends the rows to all tasks
    return (
        timed.where("arrived_ms IS NOT NULL").join(marks, "arrived_ms", "left")
        .withColumn("late", F.coalesce(F.col("event_ms") < F.col("watermark_ms"), F.lit(False)))
        .drop("arrived_ms", "event_ms"))


def clock_after(marked: DataFrame, source: str = "src_partition", before: DataFrame | None = None) -> DataFrame:
    """The :data:`CLOCK` after rows that :func:`with_partition_watermark` has marked."""
    now = marked.select(
        F.col(source).cast("bigint").alias("source"), F.unix_millis("ingested_at").alias("arrived_ms"),
        F.unix_millis("event_ts").alias("top"), F.col("watermark_ms").alias("floor_ms"))
    if before is not None:
        now = now.unionByName(before)
    by_source = now.groupBy("source").agg(
        F.max("arrived_ms").alias("arrived_ms"), F.max("top").alias("top"), F.max("floor_ms").alias("floor_ms"))
    everywhere = W.partitionBy(F.lit(0))  # one row per partition of the topic
    return by_source.withColumn("floor_ms", F.max("floor_ms").over(everywhere)).select(
        "source", "arrived_ms", "top", "floor_ms")
