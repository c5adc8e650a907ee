"""Topics as streams and as tables: one code path for a broker and for files.

A topic row has ``key``, ``value`` (JSON text), ``partition`` and ``ingested_at``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

ROW = "key string, value string, partition bigint, ingested_at timestamp"


@dataclass(frozen=True)
class Topic:
    """Where a topic lives: ``kafka`` with its options, or ``files`` with a folder."""

    name: str
    source: str = "files"
    path: str = ""
    options: dict[str, str] = field(default_factory=dict)


def _shape(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        F.col("partition").cast("bigint").alias("partition"), F.col("timestamp").alias("ingested_at"))


def read_stream(spark: SparkSession, topic: Topic, max_per_trigger: int | None = None) -> DataFrame:
    """The topic from its first record on, as a stream."""
    if topic.source == "kafka":
        reader: DataStreamReader = (
            spark.readStream.format("kafka").options(**topic.options)
            .option("subscribe", topic.name).option("startingOffsets", "earliest"))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return _shape(reader.load())
    reader = spark.readStream.schema(ROW).format("parquet")
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.load(topic.path)


def read_table(spark: SparkSession, topic: Topic) -> DataFrame:
    """Everything the topic holds now: the snapshot of a compacted topic."""
    if topic.source == "kafka":
        return _shape(spark.read.format("kafka").options(**topic.options)
                      .option("subscribe", topic.name).load())
    return spark.read.schema(ROW).parquet(topic.path)


def keyed(df: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """Rows as topic records: the key that decides the partition, and the JSON value."""
    cols = columns or df.columns
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*cols)).alias("value"))


def write_topic(records: DataFrame, topic: Topic) -> None:
    """Publish keyed records. The broker client partitions by key, buffers and retries."""
    if topic.source == "kafka":
        (records.select("key", "value").write.format("kafka").options(**topic.options)
         .option("topic", topic.name).save())
        return
    out = records
    if "partition" not in out.columns:
        out = out.withColumn("partition", F.pmod(F.xxhash64("key"), F.lit(6)).cast("bigint"))
    if "ingested_at" not in out.columns:
        out = out.withColumn("ingested_at", F.current_timestamp())
    out.select("key", "value", "partition", "ingested_at").write.mode("append").parquet(topic.path)
