"""Profile records: plain or wrapped as a change, reduced to the current row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.functions.exprs import event_time
from tillwatch.operators.latest import content_order, current_rows
from tillwatch.schemas import change_of


def unwrap(raw: DataFrame, record: T.StructType, key: str) -> DataFrame:
    """JSON ``value`` to record columns plus ``op`` and ``change_ms``.

    Accepts both forms a topic can carry: the bare record, and ``{before, after, op}``. A delete
    keeps the key of the row that is gone. Values without a key have no row here: see :func:`unreadable`.
    """
    both = F.from_json("value", T.StructType(change_of(record).fields + record.fields))
    row = F.coalesce(
        F.col("p.after"), F.col("p.before"),
        F.struct(*[F.col(f"p.{f.name}").alias(f.name) for f in record.fields]))
    return (
        raw.select(both.alias("p"))
        .select(row.alias("r"), F.coalesce("p.op", F.lit("r")).alias("op"), F.col("p.ts_ms").alias("ts_ms"))
        .select("r.*", "op", F.coalesce("ts_ms", F.unix_millis(event_time(F.col("r.updated_at"))))
                .alias("change_ms"))
        .where(F.col(key).isNotNull())
    )


def unreadable(raw: DataFrame, record: T.StructType, key: str) -> DataFrame:
    """The records that :func:`unwrap` cannot read, as they came: its quarantine."""
    both = F.from_json("value", T.StructType(change_of(record).fields + record.fields))
    found = F.coalesce(F.col(f"_p.after.{key}"), F.col(f"_p.before.{key}"), F.col(f"_p.{key}"))
    return raw.withColumn("_p", both).where(found.isNull()).drop("_p")


def current(changes: DataFrame, key: str) -> DataFrame:
    """Newest record per key without deleted keys."""
    return current_rows(changes, [key], [F.desc("change_ms"), content_order(changes)]).drop("op", "change_ms")


def public_profile(profiles: DataFrame) -> DataFrame:
    """Only the seven contract fields leave; any internal column stays behind."""
    return profiles.select("user_id", "full_name", "kyc_status", "account_tier",
                           "risk_score_baseline", "home_country", "updated_at")
