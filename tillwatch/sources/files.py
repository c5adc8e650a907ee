"""Files of the lake: parsing, Bronze layout, compaction, scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.functions.exprs import event_time
from tillwatch.schemas import INJECTED_TRUTH

ROWS_PER_FILE = 5_000_000
FILE_BYTES = 128 * 1024 * 1024


def with_parsed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Parse ``value`` once. ``event_ts`` and ``ok`` tell whether the record is usable."""
    full = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return (
        raw.withColumn("e", parsed)
        .withColumn("event_ts", event_time(F.col("e.timestamp")))
        .withColumn("ok", F.col("e._corrupt").isNull() & F.col("event_ts").isNotNull()
                    & F.col("e.transaction_id").isNotNull()))


def parse_events(raw: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Parsed events, and the quarantine with the untouched text. No record stops the job."""
    parsed = with_parsed(raw, schema)
    keep = [c for c in raw.columns if c != "value"]
    good = parsed.where("ok").select(
        *keep, *[F.col(f"e.{f.name}").alias(f.name) for f in schema.fields], "event_ts", "value")
    return good, parsed.where("NOT ok").select(*keep, "value")


def write_bronze(payments: DataFrame, path: str) -> str:
    """Append to Parquet, one folder per event day.

    Rows go to ``dt`` through a rebalance, so Spark cuts a hot day into several writers and joins
    small days, instead of sending every day to exactly one task.
    """
    (payments.hint("rebalance", F.col("dt")).write.mode("append").partitionBy("dt")
     .option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path))
    return path


def lake_scan(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Read the lake; a date range prunes whole folders."""
    df = spark.read.parquet(path)
    if first:
        df = df.where(F.col("dt") >= F.lit(first).cast("date"))
    if last:
        df = df.where(F.col("dt") <= F.lit(last).cast("date"))
    return df


def ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """Injected attacks as JSON lines, one row per transaction, in the shape of fraud labels."""
    return (
        spark.read.schema(INJECTED_TRUTH).json(path)
        .select("fraud_type", F.explode("transaction_ids").alias("transaction_id"),
                F.lit(True).alias("is_fraud_confirmed"), F.lit("INJECTED").alias("label_source"),
                event_time(F.col("injected_at")).alias("resolved_at")))
