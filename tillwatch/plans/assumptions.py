"""Cost assumptions next to aggregated rows, one output row per scenario."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_scenario(aggregated: DataFrame, costs: DataFrame) -> DataFrame:
    """Repeat every (already aggregated) row for every scenario, assumptions in the struct ``c``.

    The sheet of scenarios becomes one value by a scalar subquery: all scenarios are computed in one pass
    over the facts, without a join, and their number has no limit.
    """
    sheet = costs.agg(F.collect_list(F.struct(*costs.columns))).scalar()
    return aggregated.withColumn("_sheet", sheet).withColumn("c", F.explode("_sheet")).drop("_sheet").withColumn(
        "scenario", F.col("c.scenario"))
