"""The end of a finite input, and event time that moves without rows.

Operators in event time hold the last rows until the watermark passes them. A live stream goes on; a replay
ends. A closing record is a row without content beside the input: its event time moves the watermark, its
missing transaction id keeps it out of every result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.operators.slices import SECOND

DELAY_MS = 10 * SECOND


class Closable:
    """A streaming input with ``event_ts``, and a folder whose records move the watermark."""

    def __init__(self, spark: SparkSession, rows: DataFrame, folder: str):
        self.spark, self.folder, self.schema = spark, folder, rows.schema
        spark.createDataFrame([], rows.schema).write.parquet(folder)
        self.stream = rows.unionByName(spark.readStream.schema(rows.schema).parquet(folder))

    def advance(self, watermark_ms: int) -> None:
        """The watermark stands here when the next run of a query over ``stream`` ends."""
        at = F.timestamp_millis(F.lit(watermark_ms + DELAY_MS).cast("bigint"))
        record = [(at if f.name == "event_ts" else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema]
        self.spark.range(1).select(*record).write.mode("append").parquet(self.folder)
