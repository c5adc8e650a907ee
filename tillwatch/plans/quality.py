"""Data tests. Each returns the violating rows; an empty result passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwatch.functions.exprs import is_gmv, sum_if


def not_unique(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def is_null(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key column that has nulls."""
    counts = F.array(*[F.struct(F.lit(k).alias("column_name"), F.count_if(F.col(k).isNull()).alias("nulls"))
                       for k in keys])
    return df.agg(counts.alias("c")).select(F.inline("c")).where("nulls > 0")


def not_accepted(df: DataFrame, accepted: dict[str, tuple]) -> DataFrame:
    """Values outside the accepted lists, with their number of rows."""
    cells = F.array(*[
        F.when(~F.col(c).isin(*values), F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")))
        for c, values in accepted.items()])
    return (
        df.select(F.explode(F.array_compact(cells)).alias("v"))
        .groupBy("v.column_name", "v.value").agg(F.count("*").alias("rows")))


def unrelated(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Keys of the fact that the dimension does not have."""
    return (fact.groupBy(key).agg(F.count("*").alias("rows"))
            .join(dim.select(key), key, "left_anti"))


def violating(df: DataFrame, holds: Column) -> DataFrame:
    """Rows for which an invariant does not hold (null counts as holding)."""
    return df.where(~F.coalesce(holds, F.lit(True)))


def merchant_invariants(fact: DataFrame) -> DataFrame:
    """net <= gross, take rate in [0, 0.1], refund <= gross amount per merchant and day."""
    return violating(fact, (
        (F.col("net_revenue") <= F.col("gross_revenue")) & F.col("take_rate").between(0, 0.1)
        & (F.col("refund_amount") <= F.col("gmv"))))


def overspent(issued: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Users and days whose redeemed points exceed the points issued so far."""
    moves = (
        issued.groupBy("user_id", F.col("dt").alias("date_day")).agg(
            F.sum("points").alias("plus"), F.lit(0).cast("bigint").alias("minus"))
        .unionByName(
            redemptions.groupBy("user_id", F.to_date("event_ts").alias("date_day")).agg(
                F.lit(0).cast("bigint").alias("plus"), F.sum("points_spent").alias("minus")))
        .groupBy("user_id", "date_day").agg(F.sum("plus").alias("plus"), F.sum("minus").alias("minus")))
    # One row per user and day.
    so_far = W.partitionBy("user_id").orderBy("date_day").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        moves.withColumns({"issued_to_date": F.sum("plus").over(so_far),
                           "redeemed_to_date": F.sum("minus").over(so_far)})
        .where("redeemed_to_date > issued_to_date").drop("plus", "minus"))


def gmv_mismatch(merchant_fact: DataFrame, silver: DataFrame) -> DataFrame:
    """Days on which Gold and Silver volume differ."""
    gold = merchant_fact.groupBy(F.col("date_day").alias("dt")).agg(F.sum("gmv").alias("gold_gmv"))
    base = silver.groupBy("dt").agg(
        sum_if(is_gmv(F.col("status"), F.col("txn_type")), F.col("amount_vnd")).alias("silver_gmv"))
    return gold.join(base, "dt", "full").where(~F.col("gold_gmv").eqNullSafe(F.col("silver_gmv")))


def wrong_group(silver: DataFrame, expected: Column) -> DataFrame:
    """Users whose event carries another holdout group than their id gives."""
    return (silver.where(F.col("experiment_group") != expected)
            .groupBy("user_id").agg(F.count("*").alias("rows")))


def stale(bronze: DataFrame, as_of: str, max_silence: str = "15 minutes") -> DataFrame:
    """One row when nothing was ingested during the last ``max_silence`` before ``as_of``."""
    now = F.lit(as_of).cast("timestamp")
    return (
        bronze.agg(F.max("ingested_at").alias("last_ingested"))
        .where(F.col("last_ingested") < now - F.expr(f"interval {max_silence}")))
