"""Business assumptions. Plans receive them as DataFrames; no assumption is written into a plan.

``load`` reads the five CSV files a finance team would own. ``default_seeds`` gives the same tables
as inline values, so that Spark knows their size and plans broadcast joins by itself.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "fx_rate": "date date, currency string, rate_to_vnd decimal(18,6)",
    "take_rate": "industry string, take_rate decimal(9,6)",
    "interchange_rate": "channel string, rate decimal(9,6)",
    "merchant_industry": "merchant_id string, industry string",
    "cost_assumptions": (
        "scenario string, cost_per_txn decimal(18,2), cost_per_point decimal(18,2), "
        "chargeback_penalty_fee decimal(18,2), prevention_efficacy decimal(9,6), "
        "gross_margin_rate decimal(9,6), vip_churn_risk decimal(9,6), "
        "vip_annual_value decimal(18,2), review_cost_per_case decimal(18,2), "
        "refund_fee_rate decimal(9,6), fixed_refund_cost decimal(18,2)"
    ),
}

# Fixed values of the default assumptions.
TAKE_RATE = [("F&B", "0.025"), ("Retail", "0.022"), ("Travel", "0.016")]
INTERCHANGE_RATE = [("POS", "0.008"), ("WEB", "0.018"), ("APP", "0.014")]
COST_COLUMNS = [
    "scenario", "cost_per_txn", "cost_per_point", "chargeback_penalty_fee", "prevention_efficacy",
    "gross_margin_rate", "vip_churn_risk", "vip_annual_value", "review_cost_per_case",
    "refund_fee_rate", "fixed_refund_cost",
]
COSTS = [
    ("base", "1500", "500", "500000", "0.7", "0.3", "0.15", "12000000", "25000", "0.01", "5000"),
]
WHAT_IF = COSTS + [
    ("cost_per_txn+20%",
     "1800", "500", "500000", "0.7", "0.3", "0.15", "12000000", "25000", "0.01", "5000"),
    ("efficacy-0.15",
     "1500", "500", "500000", "0.55", "0.3", "0.15", "12000000", "25000", "0.01", "5000"),
]
FX_FROM, FX_TO = "2023-12-01", "2024-03-31"
# Rates for the long history behind the lifecycle mart.
HISTORY_FROM, HISTORY_TO = "2023-09-01", "2024-07-31"
MERCHANT_NUMBERS = (1, 99)


@dataclass(frozen=True)
class Seeds:
    fx_rate: DataFrame
    take_rate: DataFrame
    interchange_rate: DataFrame
    merchant_industry: DataFrame
    cost_assumptions: DataFrame

    def with_costs(self, cost_assumptions: DataFrame) -> "Seeds":
        return replace(self, cost_assumptions=cost_assumptions)


def _inline(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    fields = [part.split(" ", 1) for part in SCHEMAS[name].replace(", ", "\n").splitlines()]
    body = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)
    names = ", ".join(n for n, _ in fields)
    casts = ", ".join(f"cast({n} as {t}) as {n}" for n, t in fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS seed({names})")


def costs(spark: SparkSession, rows: list[tuple] = COSTS) -> DataFrame:
    return _inline(spark, "cost_assumptions", rows)


def fx_rates(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Daily rates of a range of dates."""
    return spark.sql(
        f"""
        SELECT date, currency, cast(CASE currency WHEN 'USD' THEN 24000 + 10 * day(date)
               WHEN 'SGD' THEN 18000 + 7 * day(date) ELSE 1 END AS decimal(18,6)) AS rate_to_vnd
        FROM (SELECT explode(sequence(date'{first}', date'{last}')) AS date)
             LATERAL VIEW explode(array('VND', 'USD', 'SGD')) c AS currency
        """)


def default_seeds(spark: SparkSession) -> Seeds:
    lo, hi = MERCHANT_NUMBERS
    return Seeds(
        fx_rate=fx_rates(spark, FX_FROM, FX_TO),
        take_rate=_inline(spark, "take_rate", TAKE_RATE),
        interchange_rate=_inline(spark, "interchange_rate", INTERCHANGE_RATE),
        merchant_industry=spark.sql(
            f"""
            SELECT concat('M', lpad(cast(n AS string), 4, '0')) AS merchant_id,
                   CASE n % 3 WHEN 0 THEN 'Travel' WHEN 1 THEN 'F&B' ELSE 'Retail' END AS industry
            FROM (SELECT explode(sequence({lo}, {hi})) AS n)
            """),
        cost_assumptions=costs(spark),
    )


def save(seeds: Seeds, folder: str) -> None:
    """Write the seeds as CSV files with a header, one folder per seed."""
    for name in SCHEMAS:
        getattr(seeds, name).coalesce(1).write.mode("overwrite").option("header", True).csv(
            f"{folder}/{name}")


def load(spark: SparkSession, folder: str) -> Seeds:
    """Read the five CSV seeds with their fixed schemas."""
    return Seeds(**{
        name: spark.read.schema(schema).option("header", True).csv(f"{folder}/{name}")
        for name, schema in SCHEMAS.items()
    })
