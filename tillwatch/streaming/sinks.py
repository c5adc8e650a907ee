"""Sinks of micro-batches. Every write is keyed by batch, so a repeated batch replaces itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

ROLL_INTERVAL = "60 seconds"


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a finite run, however long its input takes; its own error surfaces here."""
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return query


def start(writer, finite: bool, interval: str = ROLL_INTERVAL) -> StreamingQuery:
    """Start for good with a trigger interval, or run over what is there and stop."""
    if finite:
        return finish(writer.trigger(availableNow=True).start())
    return writer.trigger(processingTime=interval).start()


def write_batch(df: DataFrame, path: str, batch_id: int, by: list[str] | None = None) -> str:
    """Replace the folder of this batch."""
    target = f"{path}/batch_id={batch_id}"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(target)
    return target


def fan_out(df: DataFrame, path: str, batch_id: int) -> None:
    """Rows with ``route``, ``key`` and ``value`` to one folder per route, in one write."""
    write_batch(df.select("route", "key", "value"), path, batch_id, by=["route"])


def routed(df: DataFrame, route: str, key: str) -> DataFrame:
    """Rows as records of the output topic ``route``."""
    return df.select(F.lit(route).alias("route"), F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*df.columns)).alias("value"))


def read_routes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def serving_delta(rows: DataFrame) -> DataFrame:
    """What a micro-batch adds to the minute table."""
    gmv = (F.col("status") == "SUCCESS") & (F.col("txn_type") == "PAYMENT")
    return rows.groupBy(F.date_trunc("minute", "event_ts").alias("minute")).agg(
        F.coalesce(F.sum(F.when(gmv, F.col("amount_vnd"))), F.lit(0)).alias("gmv"),
        F.count("*").alias("txns"), F.count_if(F.col("status") == "SUCCESS").alias("succeeded"))


def serving_table(spark: SparkSession, path: str) -> DataFrame:
    """The minute table as its readers see it: all batch deltas added up."""
    return spark.read.parquet(path).groupBy("minute").agg(
        F.sum("gmv").alias("gmv"), F.sum("txns").alias("txns"), F.sum("succeeded").alias("succeeded"))


def jdbc_writer(url: str, table: str, properties: dict[str, str]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends batch deltas to a database table.

    Rows carry ``batch_id``; the view over the table counts each batch once, so a repeated batch
    does no harm.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        df.withColumn("batch_id", F.lit(batch_id)).write.jdbc(url, table, "append", properties)

    return write


def print_stream(stream: DataFrame) -> StreamingQuery:
    """Debug output."""
    return stream.writeStream.format("console").option("truncate", False).start()
