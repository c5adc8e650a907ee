"""Time slices: windows that a hot key cannot turn into one huge task.

A window partitioned by (key, slice) spreads the rows of a busy key over many tasks. Rows near the
edge of a slice are also handed to the neighbouring slice (``carried``), so an operator that looks
back or ahead by at most ``reach_ms`` sees everything it needs and then drops the carried rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND, MINUTE, HOUR, DAY = 1_000, 60_000, 3_600_000, 86_400_000


def slice_of(ms: Column, slice_ms: int) -> Column:
    return F.floor(ms / F.lit(slice_ms)).cast("bigint")


def with_carry(df: DataFrame, ms: str, slice_ms: int, reach_ms: int, ahead: bool = False) -> DataFrame:
    """Add ``slice`` and ``carried``; rows within ``reach_ms`` of the next slice appear there too.

    With ``ahead`` the rows are carried into the previous slice instead, for operators that look
    forward in time.
    """
    own = slice_of(F.col(ms), slice_ms)
    if ahead:
        slices = F.sequence(slice_of(F.col(ms) - reach_ms, slice_ms), own)
    else:
        slices = F.sequence(own, slice_of(F.col(ms) + reach_ms, slice_ms))
    return (
        df.withColumn("slice", F.explode(slices))
        .withColumn("carried", F.col("slice") != own)
    )
