"""A stream of payments with the watermark of its source partitions.

Every micro-batch is marked with the batch operator, starting from the clock that the batch before has
left: one small row per partition. A repeated batch reads the same clock and replaces its own folders.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwatch.operators.idle import BOUND_MS, CLOCK, IDLE_MS, clock_after, with_partition_watermark
from tillwatch.schemas import PAYMENT_EVENT
from tillwatch.sources.files import with_parsed
from tillwatch.streaming import sinks


class PartitionClock:
    """Below ``out``: ``parsed`` records by batch and whether they are usable, ``rows`` by batch and lateness,
    ``quarantine``, and ``clock``, the state by batch."""

    def __init__(self, spark: SparkSession, out: str, bound_ms: int = BOUND_MS, idle_ms: int = IDLE_MS):
        self.spark, self.out, self.bound_ms, self.idle_ms = spark, out, bound_ms, idle_ms

    def _before(self, batch_id: int) -> DataFrame:
        """The clock of the batch before; the engine numbers batches without gaps."""
        try:
            return self.spark.read.schema(CLOCK).parquet(f"{self.out}/clock/batch_id={batch_id - 1}")
        except AnalysisException as missing:
            if batch_id or missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], CLOCK)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        # the clock takes several passes: text is parsed once, and each pass reads the columns it needs
        names = [f.name for f in PAYMENT_EVENT.fields if f.name != "timestamp"]
        parsed = with_parsed(batch, PAYMENT_EVENT).select(
            "key", F.when(~F.col("ok"), F.col("value")).alias("value"), F.col("partition").alias("src_partition"),
            "ingested_at", "event_ts", *[F.col(f"e.{n}").alias(n) for n in names], "ok")
        stored = self.spark.read.schema(parsed.schema).parquet(
            sinks.write_batch(parsed, f"{self.out}/parsed", batch_id, by=["ok"]))
        sinks.write_batch(stored.where("NOT ok").select("key", "value", F.col("src_partition").alias("partition"), "ingested_at"),
                          f"{self.out}/quarantine", batch_id)
        rows = stored.where("ok").select("src_partition", "ingested_at", "event_ts", *names)
        before = self._before(batch_id)
        marked = with_partition_watermark(rows, bound_ms=self.bound_ms, idle_ms=self.idle_ms, before=before)
        path = sinks.write_batch(marked, f"{self.out}/rows", batch_id, by=["late"])
        written = self.spark.read.schema(marked.schema).parquet(path)
        sinks.write_batch(clock_after(written, before=before).coalesce(1), f"{self.out}/clock", batch_id)

    def run(self, raw: DataFrame, checkpoint: str, finite: bool = False) -> StreamingQuery:
        writer = raw.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return sinks.start(writer, finite, "5 seconds")

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/rows").drop("batch_id").withColumn("late", F.col("late").cast("boolean"))
