"""Daily marts brought up to date when late records come: only the days they speak of are computed and written."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.sources.manifest import DatedTable


def touched_days(records: DataFrame, facts: DataFrame) -> list[date]:
    """Days of the transactions that the records name; at most as many as the calendar has."""
    named = facts.select("transaction_id", "dt").join(records.select("transaction_id"), "transaction_id", "left_semi")
    return sorted(r["dt"] for r in named.select("dt").distinct().collect())


def refresh_days(table: DatedTable, days: list[date], mart_of: Callable[[list[date]], DataFrame]) -> int:
    """The given days become what ``mart_of`` says of them. Other days are neither computed nor written.

    ``mart_of`` returns rows with a ``dt``; a day without rows becomes empty. Without days nothing is written.
    """
    return table.replace(mart_of(days), days) if days else table.commit()
