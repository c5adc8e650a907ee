"""Loyalty return: revenue per group, incremental lift, return, liability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwatch.functions.exprs import experiment_group, is_gmv, money, ratio, rounded_money, sum_if
from tillwatch.plans.assumptions import per_scenario

CELL = ["account_tier", "experiment_group"]
Z_95 = 1.959964


def group_of_user() -> Column:
    """The holdout is always recomputed; the field of the event can be wrong."""
    return experiment_group(F.col("user_id"))


def user_days(points: DataFrame) -> DataFrame:
    """Revenue and points per user and day: everything after this is far smaller than the facts."""
    gmv = is_gmv(F.col("status"), F.col("txn_type"))
    return points.groupBy(
        F.col("dt").alias("date_day"), "user_id",
        F.coalesce("account_tier", F.lit("UNKNOWN")).alias("account_tier"), "experiment_group",
    ).agg(
        sum_if(gmv, F.col("amount_vnd")).alias("gmv"), F.count_if(gmv).alias("txns"),
        F.sum("points").alias("points_issued"))


def redeemed_days(redemptions: DataFrame, profiles: DataFrame) -> DataFrame:
    return (
        redemptions.withColumn("date_day", F.to_date("event_ts"))
        .groupBy("date_day", "user_id").agg(F.sum("points_spent").alias("points_redeemed"))
        .join(profiles.select("user_id", "account_tier"), "user_id", "left")
        .withColumn("account_tier", F.coalesce("account_tier", F.lit("UNKNOWN")))
        .withColumn("experiment_group", group_of_user()))


def group_totals(users: DataFrame, by: list[str]) -> DataFrame:
    """Per group: active users, revenue, points and revenue per active user."""
    active = F.col("txns") > 0
    per_user = users.groupBy(*by, "experiment_group", "user_id").agg(
        F.sum("gmv").alias("gmv"), F.sum("txns").alias("txns"),
        F.sum("points_issued").alias("points_issued"))
    return (
        per_user.groupBy(*by, "experiment_group").agg(
            F.count_if(active).alias("active_users"), F.sum("gmv").alias("gmv"),
            F.sum("points_issued").alias("points_issued"))
        .withColumn("arpu", ratio(F.col("gmv"), F.col("active_users"))))


def sides() -> dict[str, Column]:
    """The figures of both groups as aggregates over the rows of one comparison."""
    return {
        f"{name}_{suffix}": F.max(F.when(F.col("experiment_group") == group, F.col(name)))
        for group, suffix in (("TREATMENT", "t"), ("CONTROL", "c"))
        for name in ("active_users", "gmv", "points_issued", "arpu")}


def compared(pairs: DataFrame) -> DataFrame:
    """Columns of the comparison, from the figures of both groups and the assumptions ``c``.

    The control points are scaled to the size of the treatment group; both point numbers are turned
    into money before they are subtracted.
    """
    scaled = F.col("points_issued_c") * ratio(F.col("active_users_t"), F.col("active_users_c"))
    return (
        pairs
        .withColumn("incremental_lift", ratio(F.col("arpu_t") - F.col("arpu_c"), F.col("arpu_c")))
        .withColumn("incremental_revenue",
                    (F.col("arpu_t") - F.col("arpu_c")) * F.col("active_users_t"))
        .withColumn("point_cost",
                    (F.col("points_issued_t") - scaled) * F.col("c.cost_per_point").cast("double"))
        .withColumn("program_roi", ratio(
            F.col("incremental_revenue") * F.col("c.gross_margin_rate").cast("double"),
            F.col("point_cost"))))


def lift(totals: DataFrame, by: list[str], costs: DataFrame) -> DataFrame:
    """Treatment against control: lift, incremental revenue, cost of the extra points, return."""
    pairs = totals.groupBy(*by).agg(*[v.alias(k) for k, v in sides().items()])
    return compared(per_scenario(pairs, costs)).drop("c")


def owing(rows: DataFrame) -> DataFrame:
    """What is still owed of ``points_issued`` and ``points_redeemed``, and its cost by the assumptions ``c``."""
    return (
        rows
        .withColumn("outstanding_points", F.col("points_issued") - F.col("points_redeemed"))
        .withColumn("liability_vnd",
                    rounded_money(money(F.col("outstanding_points")) * F.col("c.cost_per_point")))
        .withColumn("redemption_rate", ratio(F.col("points_redeemed"), F.col("points_issued")))
        .withColumn("breakage_rate", 1 - F.col("redemption_rate")))


def liability(users: DataFrame, redeemed: DataFrame, by: list[str], costs: DataFrame) -> DataFrame:
    """Points issued and redeemed, what is still owed and what it would cost."""
    issued = users.groupBy(*by).agg(F.sum("points_issued").alias("points_issued"))
    spent = redeemed.groupBy(*by).agg(F.sum("points_redeemed").alias("points_redeemed"))
    if by:
        both = issued.join(spent, by, "full")
    else:
        both = (issued.unionByName(spent, allowMissingColumns=True)
                .agg(F.max("points_issued").alias("points_issued"),
                     F.max("points_redeemed").alias("points_redeemed")))
    filled = both.fillna(0, ["points_issued", "points_redeemed"])
    return owing(per_scenario(filled, costs)).drop("c")


def fct_loyalty_analytics(users: DataFrame, redeemed: DataFrame, costs: DataFrame) -> DataFrame:
    """Grain: day x tier x group. Comparison columns stand on the treatment row of a day and tier.

    The users are aggregated once; both groups of a day and tier meet in a window of two rows.
    """
    day = ["date_day", "account_tier"]
    keys = [*day, "experiment_group"]
    spent = redeemed.groupBy(*keys).agg(F.sum("points_redeemed").alias("points_redeemed"))
    both = W.partitionBy(*day)
    rows = group_totals(users, day).join(spent, keys, "full").withColumns(
        {name: side.over(both) for name, side in sides().items()})
    filled = rows.fillna(0, ["active_users", "gmv", "points_issued", "points_redeemed"])
    to_date = (W.partitionBy(*CELL).orderBy("date_day")
               .rowsBetween(W.unboundedPreceding, W.currentRow))
    treated = F.col("experiment_group") == "TREATMENT"
    return compared(owing(per_scenario(filled, costs))).select(
        *keys, "active_users", "gmv", "points_issued", "arpu", "points_redeemed", "outstanding_points",
        "liability_vnd", "redemption_rate", "breakage_rate",
        *[F.when(treated, F.col(name)).alias(name)
          for name in ("incremental_lift", "incremental_revenue", "point_cost", "program_roi")],
        F.sum("outstanding_points").over(to_date).alias("outstanding_points_to_date"))


def holdout_balance(users: DataFrame, programme_start: str) -> DataFrame:
    """Are both groups alike before the programme: users, tier mix, revenue before the start.

    ``smd`` is the standardised mean difference of revenue per user, ``chi2`` the statistic of the
    tier mix against the group; both are repeated on every row.
    """
    before = F.when(F.col("date_day") < F.lit(programme_start).cast("date"), F.col("gmv"))
    per_user = users.groupBy("user_id", *CELL).agg(
        F.coalesce(F.sum(before), F.lit(0)).alias("pre_gmv"))
    moments = per_user.groupBy(*CELL).agg(
        F.count("*").alias("users"), F.sum("pre_gmv").alias("pre_gmv"),
        F.sum(F.col("pre_gmv").cast("decimal(38,0)") * F.col("pre_gmv").cast("decimal(19,0)"))
        .alias("_sq"))
    group, tier, everyone = (W.partitionBy("experiment_group"), W.partitionBy("account_tier"),
                             W.partitionBy())
    n_group = F.sum("users").over(group)
    # These windows run over tiers x groups: a dozen rows.
    shares = moments.withColumns({
        "group_users": n_group, "tier_users": F.sum("users").over(tier),
        "all_users": F.sum("users").over(everyone),
        "group_gmv": F.sum("pre_gmv").over(group), "group_sq": F.sum("_sq").over(group)})
    mean = F.col("group_gmv") / F.col("group_users")
    var = (F.col("group_sq").cast("double") - F.col("group_users") * mean * mean) / (F.col("group_users") - 1)
    stats = shares.withColumns({
        "tier_share": ratio(F.col("users"), F.col("group_users")),
        "pre_gmv_per_user": mean, "_var": F.when(F.col("group_users") > 1, var),
        "_expected": ratio(F.col("tier_users") * F.col("group_users"), F.col("all_users"))})

    def of(name: str, which: str) -> Column:
        return F.max(F.when(F.col("experiment_group") == which, F.col(name))).over(everyone)

    gap = F.col("users") - F.col("_expected")
    return stats.withColumns({
        "smd": (of("pre_gmv_per_user", "TREATMENT") - of("pre_gmv_per_user", "CONTROL"))
        / F.sqrt(F.nullif((of("_var", "TREATMENT") + of("_var", "CONTROL")) / 2, F.lit(0.0))),
        "chi2": F.sum(gap * gap / F.col("_expected")).over(everyone),
    }).select("account_tier", "experiment_group", "users", "tier_share", "pre_gmv",
              "pre_gmv_per_user", "smd", "chi2")


def roi_interval(users: DataFrame, costs: DataFrame) -> DataFrame:
    """Return with a 95 % interval from the sampling error of revenue per active user."""
    per_user = (
        users.groupBy("experiment_group", "user_id")
        .agg(F.sum("gmv").alias("gmv"), F.sum("txns").alias("txns"),
             F.sum("points_issued").alias("points"))
        .where("txns > 0"))

    def pick(group: str, agg) -> Column:
        return agg(F.when(F.col("experiment_group") == group, F.col("gmv").cast("double")))

    t, c = "TREATMENT", "CONTROL"
    sides = per_user.agg(
        pick(t, F.count).alias("n_t"), pick(c, F.count).alias("n_c"),
        pick(t, F.avg).alias("arpu_t"), pick(c, F.avg).alias("arpu_c"),
        pick(t, F.var_samp).alias("_var_t"), pick(c, F.var_samp).alias("_var_c"),
        sum_if(F.col("experiment_group") == t, F.col("points")).alias("_points_t"),
        sum_if(F.col("experiment_group") == c, F.col("points")).alias("_points_c"))
    diff = F.col("arpu_t") - F.col("arpu_c")
    se = F.sqrt(F.col("_var_t") / F.col("n_t") + F.col("_var_c") / F.nullif(F.col("n_c"), F.lit(0)))
    cost = ((F.col("_points_t") - F.col("_points_c") * ratio(F.col("n_t"), F.col("n_c")))
            * F.col("c.cost_per_point").cast("double"))

    def roi(value: Column) -> Column:
        return ratio(value * F.col("n_t") * F.col("c.gross_margin_rate").cast("double"), F.col("point_cost"))

    return (
        per_scenario(sides, costs)
        .withColumns({"diff": diff, "se": se, "point_cost": cost})
        .select("n_t", "n_c", "arpu_t", "arpu_c", "se", "point_cost",
                roi(F.col("diff")).alias("program_roi"),
                roi(F.col("diff") - Z_95 * F.col("se")).alias("roi_low"),
                roi(F.col("diff") + Z_95 * F.col("se")).alias("roi_high")))
