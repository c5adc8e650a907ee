"""Customer lifecycle: personal cadence, states, history and transitions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwatch.operators.latest import latest
from tillwatch.operators.slices import DAY, HOUR, slice_of
from tillwatch.sources.manifest import DatedTable


def gaps(activity: DataFrame, slice_ms: int = HOUR) -> DataFrame:
    """Time between neighbouring transactions of a user, with the day of the later one.

    Inside a time slice the gap is a ``lag``; between slices it is the first row of a slice minus
    the last row of the user's previous slice with rows. No window holds more than one slice of a
    user, or one row per slice.
    """
    rows = activity.select("user_id", "transaction_id", F.unix_millis("event_ts").alias("ms"))
    sliced = rows.withColumn("slice", slice_of(F.col("ms"), slice_ms))
    inside = W.partitionBy("user_id", "slice").orderBy("ms", "transaction_id")
    within = sliced.select("user_id", "ms", (F.col("ms") - F.lag("ms").over(inside)).alias("gap_ms"))
    by_slice = W.partitionBy("user_id").orderBy("slice")
    across = (
        sliced.groupBy("user_id", "slice").agg(F.min("ms").alias("ms"), F.max("ms").alias("hi"))
        .select("user_id", "ms", (F.col("ms") - F.lag("hi").over(by_slice)).alias("gap_ms")))
    return within.unionByName(across).where("gap_ms IS NOT NULL").select(
        "user_id", F.to_date(F.timestamp_millis("ms")).alias("dt"), "gap_ms")


def features(activity: DataFrame, as_of: list[str]) -> DataFrame:
    """Cadence and recency of every user at every ``as_of`` date.

    Days before the first date are summed up once and shared. The exact median holds one counter per
    distinct gap; gaps of one user add up to the observed time, so there are at most
    sqrt(2 x milliseconds observed) of them, however many rows the user has.
    """
    dates = sorted(as_of)
    all_dates = F.array(*[F.lit(d).cast("date") for d in dates])

    def seen_from(dt):
        return F.filter(all_dates, lambda d: d >= dt)

    days = activity.groupBy("user_id", F.to_date("event_ts").alias("dt")).agg(
        F.count("*").alias("n"), F.sum("amount_vnd").alias("gmv"))
    age = F.datediff("as_of", "dt")
    recency = (
        days.select("*", F.explode(seen_from(F.col("dt"))).alias("as_of"))
        .groupBy("as_of", "user_id").agg(
            F.min("dt").alias("first_date"), F.max("dt").alias("last_date"),
            F.coalesce(F.sum(F.when(age < 30, F.col("n"))), F.lit(0)).alias("txn_count_30d"),
            F.coalesce(F.sum(F.when(age < 90, F.col("n"))), F.lit(0)).alias("txn_count_90d"),
            F.coalesce(F.sum(F.when(age < 30, F.col("gmv"))), F.lit(0)).alias("gmv_30d")))
    floor_date = F.greatest("dt", F.lit(dates[0]).cast("date"))
    cadence = (
        gaps(activity).groupBy("user_id", "gap_ms", floor_date.alias("dt")).agg(F.count("*").alias("n"))
        .select("*", F.explode(seen_from(F.col("dt"))).alias("as_of"))
        .groupBy("as_of", "user_id")
        .agg((F.percentile("gap_ms", F.lit(0.5), F.col("n")) / DAY).alias("median_gap")))
    return (
        recency.join(cadence, ["as_of", "user_id"], "left")
        .withColumns({
            "days_since_first": F.datediff("as_of", "first_date"),
            "days_silent": F.datediff("as_of", "last_date")})
        .withColumn("silence_ratio", F.try_divide(
            F.col("days_silent").cast("double"), F.nullif(F.col("median_gap"), F.lit(0.0)))))


def population_p80(feature: DataFrame) -> DataFrame:
    """80th percentile of the 30-day transaction count over all users, per date."""
    return feature.groupBy("as_of").agg(F.percentile("txn_count_30d", F.lit(0.8)).alias("p80"))


def states(activity: DataFrame, suspended: DataFrame, as_of: list[str]) -> DataFrame:
    """State of every user at every date; the first matching rule of a fixed order wins."""
    feature = features(activity, as_of)
    flagged = suspended.select("user_id", F.lit(True).alias("_suspended"))
    state = (
        F.when(F.col("_suspended"), "HIGH_RISK_SUSPENDED")
        .when(F.col("days_since_first") <= 30, "NEW")
        .when(F.col("days_silent") > 90, "CHURNED")
        .when(F.col("days_silent") > 60, "DORMANT")
        .when((F.col("silence_ratio") > 2) & (F.col("txn_count_90d") >= 3), "AT_RISK")
        .when(F.col("txn_count_30d") >= F.col("p80"), "HIGHLY_ACTIVE")
        .otherwise("ACTIVE"))
    return (
        feature.join(population_p80(feature), "as_of")
        .join(flagged, "user_id", "left")
        .withColumn("state", state)
        .drop("_suspended", "p80"))


def history(state_rows: DataFrame) -> DataFrame:
    """Type-2 history: one row per stretch of unchanged state (one input row per user and date)."""
    by_date = W.partitionBy("user_id").orderBy("as_of")
    return (
        state_rows.withColumn("_before", F.lag("state").over(by_date))
        .where("_before IS NULL OR _before <> state")
        .withColumn("valid_to", F.lead("as_of").over(by_date))
        .select("user_id", "state", F.col("as_of").alias("valid_from"), "valid_to",
                F.col("valid_to").isNull().alias("is_current"), "median_gap", "days_silent",
                "silence_ratio", "txn_count_30d", "txn_count_90d", "gmv_30d"))


OPENED = ["median_gap", "days_silent", "silence_ratio", "txn_count_30d", "txn_count_90d", "gmv_30d"]


def merge_day(table: DatedTable, state_rows: DataFrame, day: date) -> int:
    """Bring the states of one day into the written history.

    The table holds openings: a row per user on each day its state became another one, and a row without
    state on the day a user left. A day therefore writes only users that changed, into the folder of that
    day; a repeated day replaces itself. When a stretch closes is told by the next opening of the user.
    """
    earlier = [r["dt"] for r in table.files().where(F.col("dt") < F.lit(day)).select("dt").distinct().collect()]
    last = latest(table.read(earlier), ["user_id"], [F.desc("dt")]).select("user_id", F.col("state").alias("_state"))
    today = state_rows.where(F.col("as_of") == F.lit(day)).select("user_id", "state", *OPENED)
    changed = today.join(last, "user_id", "full").where(~F.col("state").eqNullSafe(F.col("_state")))
    return table.replace(changed.drop("_state").withColumn("dt", F.lit(day)).select(*table.schema.names), [day])


def written_history(table: DatedTable) -> DataFrame:
    """The type-2 history that the openings tell, as :func:`history` would build it from all days."""
    by_date = W.partitionBy("user_id").orderBy("dt")
    return (
        table.read().withColumn("valid_to", F.lead("dt").over(by_date)).where("state IS NOT NULL")
        .select("user_id", "state", F.col("dt").alias("valid_from"), "valid_to",
                F.col("valid_to").isNull().alias("is_current"), *OPENED))


def moves(state_rows: DataFrame, before: str, after: str) -> DataFrame:
    """State of each user seen at two dates, with the 30-day volume at the earlier one, in one pass over the states."""

    def at(date: str, name: str):
        return F.max(F.when(F.col("as_of") == F.lit(date).cast("date"), F.col(name)))

    return (
        state_rows.where(F.col("as_of").isin(*[F.lit(d).cast("date") for d in (before, after)]))
        .groupBy("user_id").agg(
            at(before, "state").alias("state_from"), at(before, "gmv_30d").alias("gmv_30d_before"),
            at(after, "state").alias("state_to"))
        .where("state_from IS NOT NULL AND state_to IS NOT NULL"))


def transitions(state_rows: DataFrame, before: str, after: str) -> DataFrame:
    return (
        moves(state_rows, before, after).groupBy("state_from", "state_to")
        .agg(F.count("*").alias("customers"), F.sum("gmv_30d_before").alias("gmv_30d_before")))


def suspended_by_risk(alerts: DataFrame, outcome: DataFrame) -> DataFrame:
    """Users with a critical alert, or with a blocked transaction that was confirmed as fraud."""
    critical = alerts.where("severity = 'CRITICAL'").select("user_id")
    confirmed = outcome.where("decision = 'BLOCK' AND is_fraud_confirmed").select("user_id")
    return critical.unionByName(confirmed).distinct()
