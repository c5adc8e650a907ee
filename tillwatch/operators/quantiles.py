"""Exact interpolated percentiles by rank."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Value ranges that the distinct values are dealt to.
RANGES = 64


def exact_percentiles(
    df: DataFrame, by: list[str], value: Column, probabilities: dict[str, float],
) -> DataFrame:
    """One row per group with the named percentiles of ``value`` and the count ``n``, for many small groups.

    Equal values are counted before the shuffle. Ranks come from a running sum over the distinct
    values of a group in order, which sorts and spills; the built-in aggregate would hold them all
    in one hash map.
    """
    counted = df.select(*by, value.alias("_v")).where("_v IS NOT NULL").groupBy(*by, "_v").agg(
        F.count("*").alias("_c"))
    group = W.partitionBy(*by)
    upto = F.sum("_c").over(group.orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow))
    ranked = counted.withColumns({"_upto": upto, "_n": F.sum("_c").over(group)})

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto")), F.col("_v")))

    picks = []
    for name, p in probabilities.items():
        position = (F.col("_n") - 1) * F.lit(p)
        picks += [at_rank(F.floor(position)).alias(f"_lo_{name}"),
                  at_rank(F.ceil(position)).alias(f"_hi_{name}")]
    n = F.max("_n").alias("n")
    found = ranked.groupBy(*by).agg(n, *picks) if by else ranked.agg(n, *picks)

    def between(name: str, p: float) -> Column:
        position = (F.col("n") - 1) * F.lit(p)
        share = position - F.floor(position)
        return (F.col(f"_lo_{name}") * (1 - share) + F.col(f"_hi_{name}") * share).alias(name)

    return found.select(*by, "n", *[between(name, p) for name, p in probabilities.items()])


def selected_percentiles(
    df: DataFrame, by: list[str], value: Column, probabilities: dict[str, float], ranges: int = RANGES,
) -> DataFrame:
    """The same for groups of any size, up to all of the data.

    Selection by rank: equal values are counted first, the distinct ones fall into value ranges of about
    equal size, and the counts of the ranges (a few per group) tell in which of them the wanted ranks lie.
    Only those are sorted, each by itself, so a group that is all of the data is never in one task.
    """
    names = [f"_g{n}" for n in range(len(by))]
    counted = df.select(*(F.col(c).alias(g) for c, g in zip(by, names, strict=True)), value.alias("_v")).where(
        "_v IS NOT NULL").groupBy(*names, "_v").agg(F.count("*").alias("_c"))
    borders = counted.agg(F.percentile_approx("_v", [n / ranges for n in range(1, ranges)], 10_000)).scalar()
    ranged = counted.withColumn("_b", borders).withColumn(
        "_r", F.coalesce(F.size(F.filter("_b", lambda b: b < F.col("_v"))), F.lit(0))).drop("_b")
    group = W.partitionBy(*(names or [F.lit(0)]))
    sums = ranged.groupBy(*names, "_r").agg(F.sum("_c").alias("_in")).withColumns({
        "_before": F.sum("_in").over(group.orderBy("_r").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_in"),
        "_n": F.sum("_in").over(group)})

    def position(p: float) -> Column:
        return (F.col("_n") - 1) * F.lit(p)

    ranks = [f(position(p)) for p in probabilities.values() for f in (F.floor, F.ceil)]
    holds = reduce(Column.__or__, [(F.col("_before") <= r) & (r < F.col("_before") + F.col("_in")) for r in ranks])
    chosen = sums.where(holds).select(*(F.col(g).alias(f"{g}_") for g in names), F.col("_r").alias("_r_"), "_before", "_n")
    same = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(f"{g}_")) for g in names], F.col("_r") == F.col("_r_"))
    running = W.partitionBy(*names, "_r").orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = ranged.join(chosen, same).withColumn("_upto", F.col("_before") + F.sum("_c").over(running))

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto")), F.col("_v")))

    picks = [at_rank(f(position(p))).alias(f"_{side}_{name}")
             for name, p in probabilities.items() for side, f in (("lo", F.floor), ("hi", F.ceil))]
    found = ranked.groupBy(*names).agg(F.max("_n").alias("n"), *picks)

    def between(name: str, p: float) -> Column:
        at = (F.col("n") - 1) * F.lit(p)
        share = at - F.floor(at)
        return (F.col(f"_lo_{name}") * (1 - share) + F.col(f"_hi_{name}") * share).alias(name)

    return found.select(*(F.col(g).alias(c) for c, g in zip(by, names, strict=True)), "n",
                        *[between(name, p) for name, p in probabilities.items()])
