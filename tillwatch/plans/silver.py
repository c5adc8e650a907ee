"""Silver: one clean row per event. Dedup, conversion by transaction date, and removal of PII."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.exprs import device_hash, mask_ip
from tillwatch.operators.latest import dedup
from tillwatch.sources.manifest import DatedTable


def merge_late(on_time: DataFrame, late: DataFrame) -> DataFrame:
    """Late events rejoin the main set; columns only one side has become null on the other."""
    return on_time.unionByName(late, allowMissingColumns=True)


def to_vnd(payments: DataFrame, fx_rate: DataFrame) -> DataFrame:
    """Convert with the rate of the transaction date. A missing rate keeps the row, amount null."""
    rate = fx_rate.select(F.col("date").alias("dt"), "currency", "rate_to_vnd")
    return (
        payments.join(rate, ["dt", "currency"], "left")
        .withColumn("amount_vnd", F.round(
            F.col("amount").cast("decimal(19,0)") * F.col("rate_to_vnd")).cast("bigint"))
    )


def clean(payments: DataFrame, fx_rate: DataFrame) -> DataFrame:
    """Deduplicated and converted rows, still with raw identifiers: input of the detectors."""
    return to_vnd(dedup(payments), fx_rate)


def protect(rows: DataFrame, salt: str) -> DataFrame:
    """Hash the device and mask the address; raw identifiers leave the row."""
    return (
        rows.withColumns({
            "device_hash": device_hash(F.col("device_id"), salt),
            "ip_network": mask_ip(F.col("ip_address"))})
        .drop("device_id", "ip_address")
    )


def silver(payments: DataFrame, fx_rate: DataFrame, salt: str) -> DataFrame:
    return protect(clean(payments, fx_rate), salt)


def merge_late_into(table: DatedTable, late: DataFrame) -> int:
    """Bring late rows into a written Silver: only the days they belong to are read and written again.

    A late copy of a row that is there already replaces it if it arrived later, as in the first dedup.
    """
    days = [r["dt"] for r in late.select("dt").distinct().collect()]
    if not days:
        return table.commit()
    rows = table.read(days).unionByName(late.select(*table.schema.names))
    return table.replace(dedup(rows), days)
