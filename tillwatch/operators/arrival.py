"""The watermark a replayed table would have had when each row arrived."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwatch.operators.slices import MINUTE, SECOND, slice_of


def with_arrival_watermark(
    payments: DataFrame, by: list[str] | None = None, bound_ms: int = 10 * SECOND,
    bucket_ms: int = MINUTE,
) -> DataFrame:
    """Add the largest event time that arrived strictly earlier, and two flags from it.

    ``out_of_order``: older than that maximum; ``late``: older by more than ``bound_ms``. Rows that
    arrive in the same millisecond do not see each other. The prefix maximum has two levels: over
    whole arrival buckets (their number grows with time, not with rows) and inside one bucket over
    distinct arrival instants (at most ``bucket_ms`` of them), so no window ever holds fact rows.
    """
    by = by or []
    rows = payments.withColumns({
        "arrived_ms": F.unix_millis("ingested_at"), "event_ms": F.unix_millis("event_ts")})
    instants = (
        rows.groupBy(*by, "arrived_ms").agg(F.max("event_ms").alias("top"))
        .withColumn("bucket", slice_of(F.col("arrived_ms"), bucket_ms)))
    buckets = instants.groupBy(*by, "bucket").agg(F.max("top").alias("bucket_top"))
    earlier = W.partitionBy(*by).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = buckets.withColumn("before_bucket", F.max("bucket_top").over(earlier))
    inside = (W.partitionBy(*by, "bucket").orderBy("arrived_ms")
              .rowsBetween(W.unboundedPreceding, -1))
    marks = (
        instants.withColumn("in_bucket", F.max("top").over(inside))
        .join(buckets.drop("bucket_top"), [*by, "bucket"])
        .select(*by, "arrived_ms", F.greatest("in_bucket", "before_bucket").alias("max_seen_ms")))
    # every row has its mark; a left join never sends the rows to all tasks, however narrow they are
    timed = rows.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in [*by, "arrived_ms"]]))
    return (
        timed.join(marks, [*by, "arrived_ms"], "left")
        .withColumns({
            "out_of_order": F.coalesce(F.col("event_ms") < F.col("max_seen_ms"), F.lit(False)),
            "late": F.coalesce(F.col("event_ms") < F.col("max_seen_ms") - bound_ms, F.lit(False)),
            "watermark_ms": F.col("max_seen_ms") - bound_ms,
        })
    )
