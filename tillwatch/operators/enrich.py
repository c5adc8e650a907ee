"""Profile enrichment: current profile, or the profile as of event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwatch.operators.slices import HOUR, slice_of

PROFILE_COLUMNS = ["account_tier", "kyc_status", "risk_score_baseline", "home_country"]


def enrich(payments: DataFrame, profiles: DataFrame) -> DataFrame:
    """Left join with the current profiles. A missing profile never drops the row.

    No hint: Spark broadcasts the profiles when they are small, and splits skewed users when not.
    """
    side = profiles.select("user_id", *PROFILE_COLUMNS, F.lit(False).alias("_hit"))
    return (
        payments.join(side, "user_id", "left")
        .withColumn("profile_missing", F.col("_hit").isNull()).drop("_hit")
    )


def enrich_as_of(payments: DataFrame, changes: DataFrame, slice_ms: int = HOUR) -> DataFrame:
    """Enrich with the profile that was valid at event time, for repeatable replays.

    Changes and payments are merged per (user, slice) and the newest change is filled forward. The
    state at the start of a slice comes from the last change of every earlier slice, so neither a
    busy user nor a long history meets in one group, and no pair of rows is ever built.
    """
    profile = F.struct(*PROFILE_COLUMNS, (F.col("op") == "d").alias("gone"))
    versions = changes.select(
        "user_id", F.unix_millis("updated_at").alias("_ms"), profile.alias("_profile"),
    ).withColumn("_slice", slice_of(F.col("_ms"), slice_ms))
    facts = payments.withColumn("_ms", F.unix_millis("event_ts")).withColumn(
        "_slice", slice_of(F.col("_ms"), slice_ms))

    last_of_slice = versions.groupBy("user_id", "_slice").agg(
        F.max_by("_profile", F.struct("_ms", F.xxhash64("_profile"))).alias("_profile"))
    touched = facts.select("user_id", "_slice").distinct()
    before = (W.partitionBy("user_id").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1))
    opening = (
        touched.join(last_of_slice, ["user_id", "_slice"], "full")
        .withColumn("_profile", F.last("_profile", ignorenulls=True).over(before))
        .where("_profile IS NOT NULL")
        .select("user_id", "_slice", (F.col("_slice") * slice_ms).alias("_ms"),
                F.lit(0).alias("_kind"), "_profile"))
    body = F.struct(*payments.columns)
    # At equal times the opening state comes first, then changes, then payments.
    merged = (
        facts.select("user_id", "_slice", "_ms", F.lit(2).alias("_kind"), body.alias("_row"))
        .unionByName(versions.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
        .unionByName(opening, allowMissingColumns=True))
    # equal times are settled by content
    so_far = (W.partitionBy("user_id", "_slice").orderBy("_ms", "_kind", F.xxhash64("_profile"))
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    filled = (
        merged.withColumn("_p", F.last("_profile", ignorenulls=True).over(so_far))
        .where("_row IS NOT NULL"))
    present = F.coalesce(~F.col("_p.gone"), F.lit(False))
    return filled.select(
        "_row.*", *[F.when(present, F.col(f"_p.{c}")).alias(c) for c in PROFILE_COLUMNS],
        (~present).alias("profile_missing"))
