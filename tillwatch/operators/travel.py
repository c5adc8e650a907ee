"""Impossible travel: two neighbouring transactions of a user, too far apart in too little time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwatch.functions.exprs import haversine_km
from tillwatch.operators.slices import HOUR, MINUTE, with_carry


def impossible_travel(
    payments: DataFrame, min_km: float = 300.0, max_gap_ms: int = 10 * MINUTE, slice_ms: int = HOUR,
    also: tuple[str, ...] = (),
) -> DataFrame:
    """Rows whose predecessor (same user, by time then id) is > min_km away and < max_gap_ms ago.

    A predecessor older than the gap can never alert, so only the last ``max_gap_ms`` of a slice
    is carried into the next one. Columns in ``also`` stay with the row.
    """
    order = W.partitionBy("user_id", "slice").orderBy("ms", "transaction_id")
    narrow = payments.select(
        "user_id", "transaction_id", "device_id", "event_ts",
        F.unix_millis("event_ts").alias("ms"), F.col("location.lat").alias("lat"),
        F.col("location.lon").alias("lon"), *also)
    pairs = with_carry(narrow, "ms", slice_ms, max_gap_ms).withColumns({
        f"prev_{c}": F.lag(c).over(order) for c in ("transaction_id", "ms", "lat", "lon")})
    return (
        pairs.where(~F.col("carried") & (F.col("ms") - F.col("prev_ms") < max_gap_ms))
        .withColumn("km", haversine_km(F.col("prev_lat"), F.col("prev_lon"), F.col("lat"), F.col("lon")))
        .where(F.col("km") > min_km)
        .select("transaction_id", "user_id", "device_id", "event_ts", "prev_transaction_id", "km",
                (F.col("ms") - F.col("prev_ms")).alias("gap_ms"), *also)
    )
