"""Trailing sums over a half-open time range, in linear time and safe against hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwatch.operators.slices import HOUR, slice_of


def trailing_sums(
    df: DataFrame, keys: list[str], ms: Column, span_ms: int, measures: dict[str, Column],
    slice_ms: int = HOUR,
) -> DataFrame:
    """Add, for every row at t, the sums of ``measures`` over the rows of its keys in (t - span, t].

    A RANGE frame would rescan up to the whole frame for every row. Instead each row enters the
    running sum at its own time and leaves it again ``span_ms`` later, so one running sum per
    (keys, slice) gives the answer. A row that is still counted when the next slice starts enters
    that slice at its first millisecond. Rows with equal time see each other.
    """
    names = list(measures)
    slice_, at = F.col("_slice"), F.col("_at")
    own, end = slice_of(at, slice_ms), at + span_ms
    end_slice = slice_of(end, slice_ms)
    payload = F.struct(*[F.col(c) for c in df.columns])

    def entry(when: Column, sign: int, row: Column) -> Column:
        return F.struct(when.alias("_entry_at"), row.alias("_row"),
                        *[(F.col(f"_m_{n}") * sign).alias(f"_d_{n}") for n in names])

    # enters at its own time, or at the start of a later slice it still counts in
    enter = entry(F.greatest(at, slice_ * slice_ms), 1, F.when(slice_ == own, payload))
    leave = entry(end, -1, F.when(F.lit(False), payload))
    keys_of = [f"_k_{k}" for k in keys]
    running = (W.partitionBy(*keys_of, "_slice").orderBy("_entry_at")
               .rangeBetween(W.unboundedPreceding, W.currentRow))
    return (
        df.select(
            *[F.col(k).alias(f"_k_{k}") for k in keys],
            ms.alias("_at"), *[c.alias(f"_m_{n}") for n, c in measures.items()], *df.columns)
        .withColumn("_slice", F.explode(F.sequence(own, end_slice)))
        .select(*keys_of, "_slice", F.inline(
            F.when(slice_ == end_slice, F.array(enter, leave)).otherwise(F.array(enter))))
        .withColumns({n: F.sum(f"_d_{n}").over(running) for n in names})
        .where("_row IS NOT NULL")
        .select("_row.*", *names)
    )
