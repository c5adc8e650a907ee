"""Topics of records that stay: fraud labels and redemptions.

Unlike a compacted topic nothing is removed: every readable record is kept with the micro-batch it came in, so
a plan can take all records, or only those that came after the batch it has seen last. What cannot be used (no
JSON, no key, no time, a delete) goes to the quarantine as it came. Both topics are read once a day, as the
marts are, so a day leaves one folder.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillwatch.functions.exprs import event_time
from tillwatch.streaming import sinks
from tillwatch.streaming.compacted import NONE, records_of


class RecordTopic:
    """Below ``out``: one folder per micro-batch and kind, ``record`` or ``quarantine``.

    ``time`` is the field that says when the record holds; it is read into the column ``at``.
    """

    def __init__(self, spark: SparkSession, out: str, record: T.StructType, key: str, time: str, at: str):
        self.spark, self.out, self.record, self.key, self.time, self.at = spark, out, record, key, time, at
        self.fields = [f.name for f in record.fields if f.name != time]

    def process(self, batch: DataFrame, batch_id: int) -> None:
        read = records_of(batch, self.record, self.key).withColumn("_at", event_time(F.col(self.time)))
        usable = F.col("ok") & F.col("_at").isNotNull() & (F.col("op") != "d")
        rows = read.select(
            *self.fields, F.col("_at").alias(self.at), "ingested_at", "raw_key", "raw_value",
            F.when(usable, "record").otherwise("quarantine").alias("kind"))
        sinks.write_batch(
            rows.withColumns({c: F.when(F.col("kind") == "quarantine", F.col(c)) for c in ("raw_key", "raw_value")}),
            self.out, batch_id, by=["kind"])

    def run(self, raw: DataFrame, checkpoint: str, finite: bool = True) -> StreamingQuery:
        writer = raw.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return sinks.start(writer, finite)

    def _rows(self, kind: str) -> DataFrame:
        schema = T.StructType([
            *[f for f in self.record.fields if f.name != self.time],
            T.StructField(self.at, T.TimestampType()), T.StructField("ingested_at", T.TimestampType()),
            T.StructField("raw_key", T.StringType()), T.StructField("raw_value", T.StringType()),
            T.StructField("batch_id", T.LongType()), T.StructField("kind", T.StringType())])
        try:
            rows = self.spark.read.schema(schema).parquet(self.out)
        except AnalysisException as missing:  # nothing has come yet
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], schema)
        return rows.where(F.col("kind") == kind).drop("kind")

    def records(self, after: int = NONE) -> DataFrame:
        """The readable records of the micro-batches after ``after``, repeats and revisions included."""
        return self._rows("record").where(F.col("batch_id") > after).drop("raw_key", "raw_value")

    def quarantine(self) -> DataFrame:
        return self._rows("quarantine").select(
            F.col("raw_key").alias("key"), F.col("raw_value").alias("value"), "ingested_at")

    def newest_batch(self) -> int:
        """The last micro-batch with readable records, or :data:`NONE`."""
        newest = self.records().agg(F.max("batch_id")).first()[0]
        return NONE if newest is None else newest
