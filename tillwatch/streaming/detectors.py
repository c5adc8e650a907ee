"""Detectors with keyed state, for a stream that must alert before a batch operator would run.

Rows of one key are ordered by time and id before the state sees them. A key is served by one task, as in
any keyed-state engine; keys that dominate the traffic are named (``hot``) and split into time slices, so
that their rows meet in many tasks. The end of a slice, as long as the detector looks back, is handed to
the next one. Keys share the calls to the state store: it is asked once for a pool of them. The number of
pools goes by the traffic, so that a pool stays small; it must stay the same over a checkpoint.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData

from tillwatch.functions.exprs import EARTH_RADIUS_KM
from tillwatch.operators.card_testing import CardTestingLimits
from tillwatch.operators.slices import HOUR, MINUTE, slice_of
from tillwatch.streaming import processors
from tillwatch.streaming.windows import with_watermark

cloudpickle.register_pickle_by_value(processors)

# A key with more than this share of all rows is hot. There are fewer of them than that, so they fit anywhere.
HOT_SHARE = 1000
# A pool gets about so many rows of the earlier traffic; there are never fewer pools than LEAST_POOLS.
POOL_ROWS, LEAST_POOLS = 4096, 256


def hot_keys(rows: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """Keys that hold more than one row in ``share``, from a table of earlier traffic."""
    total = rows.count()
    return rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") * share > total).select(key)


def pools_of(rows: DataFrame) -> int:
    """How many pools the keys of a stream should form, from a table of earlier traffic."""
    return max(LEAST_POOLS, rows.count() // POOL_ROWS)


def _split(narrow: DataFrame, key: str, hot: DataFrame | None, slice_ms: int, reach_ms: int) -> DataFrame:
    """Add ``slice`` and ``carried``. Rows near the end of a slice of a hot key also open the next one."""
    if hot is None:
        return narrow.withColumns({"slice": F.lit(processors.WHOLE).cast("bigint"), "carried": F.lit(False)})
    own = slice_of(F.col("ms"), slice_ms)
    marked = narrow.join(F.broadcast(hot.select(key, F.lit(True).alias("is_hot"))), key, "left")
    slices = F.when(F.col("is_hot"), F.sequence(own, slice_of(F.col("ms") + reach_ms, slice_ms))).otherwise(
        F.array(F.lit(processors.WHOLE).cast("bigint")))
    return marked.withColumn("slice", F.explode(slices)).withColumn(
        "carried", (F.col("slice") != processors.WHOLE) & (F.col("slice") != own)).drop("is_hot")


def _pooled(split: DataFrame, key: str, pools: int) -> GroupedData:
    """A key of a slice is in one pool; the slices of a key are dealt to one pool after the other."""
    n = F.lit(pools).cast("bigint")
    pool = F.pmod(F.pmod(F.xxhash64(key), n) + F.col("slice"), n)
    return split.withColumn("pool", pool).withColumnRenamed(key, "key").groupBy("pool")


def card_testing_stream(
    payments: DataFrame, lim: CardTestingLimits = CardTestingLimits(), hot: DataFrame | None = None,
    pools: int = LEAST_POOLS,
) -> DataFrame:
    """Attacks per device as they complete; input has ``amount_vnd`` and ``event_ts``.

    Without ``hot`` a streak counts from its first failure. With it, keys are split and a streak is what
    failed in a row within the limit, as in the batch operator; the two differ on streaks that go on for
    longer.
    """
    narrow = with_watermark(payments).select(
        "device_id", "transaction_id", "event_ts", F.unix_millis("event_ts").alias("ms"),
        "amount_vnd", "status")
    return _pooled(_split(narrow, "device_id", hot, lim.slice_ms, lim.within_ms), "device_id", pools).transformWithStateInPandas(
        processors.CardTestingState(
            lim.small_below_vnd, lim.large_above_vnd, lim.min_failures, lim.within_ms, hot is None, lim.slice_ms),
        processors.CARD_ALERT, "Append", "EventTime")


def travel_stream(
    payments: DataFrame, min_km: float = 300.0, max_gap_ms: int = 10 * MINUTE, ttl_ms: int = 24 * HOUR,
    hot: DataFrame | None = None, slice_ms: int = HOUR, pools: int = LEAST_POOLS,
) -> DataFrame:
    """Impossible travel per user; severity stays medium and nothing is blocked."""
    narrow = with_watermark(payments).select(
        "user_id", "transaction_id", "event_ts", F.unix_millis("event_ts").alias("ms"),
        F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon"))
    return _pooled(_split(narrow, "user_id", hot, slice_ms, max_gap_ms), "user_id", pools).transformWithStateInPandas(
        processors.TravelState(min_km, max_gap_ms, ttl_ms, EARTH_RADIUS_KM, slice_ms),
        processors.TRAVEL_ALERT, "Append", "EventTime")


def state_of(spark, checkpoint: str) -> DataFrame:
    """What a detector keeps, read back from its checkpoint: one row per pool.

    ``kept`` is what the machine knows of each key and slice, ``held`` the columns of the rows that wait for the
    watermark.
    """
    cells = (
        spark.read.format("statestore").option("path", checkpoint).option("operatorId", 0)
        .option("stateVarName", "cell").load())
    return cells.select("key.*", "value.held", "value.kept", "value.timer", "partition_id")
