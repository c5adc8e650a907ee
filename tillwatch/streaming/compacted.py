"""Compacted topics: the current record of every key, as it stood after any micro-batch.

Rules and profiles come as JSON, bare or wrapped as a change; a delete or an empty record removes its key.
A micro-batch is reduced to the newest record per key and written as a delta; every few batches the deltas
are merged into a base. A version names one base and the deltas after it, so a reader that notes the version
it used sees the same rows again after a restart, however far the topic has moved on.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillwatch.functions.exprs import event_time
from tillwatch.operators.latest import latest
from tillwatch.schemas import change_of
from tillwatch.streaming import sinks

VERSION = "base bigint, batch_id bigint"
NONE = -1


def records_of(raw: DataFrame, record: T.StructType, key: str) -> DataFrame:
    """Columns of ``record`` with ``op``, ``ingested_at`` and ``ok``; a record without value deletes its key."""
    both = F.from_json("value", T.StructType(change_of(record).fields + record.fields))
    row = F.coalesce(F.col("p.after"), F.col("p.before"), F.struct(*[F.col(f"p.{f.name}").alias(f.name) for f in record.fields]))
    gone = F.col("value").isNull()
    found = F.when(gone, F.col("key")).otherwise(F.col(f"r.{key}"))
    op = F.when(gone, "d").otherwise(F.coalesce("p.op", F.lit("r")))
    return (
        raw.withColumn("p", both).withColumn("r", row)
        .select(*[(found if f.name == key else F.col(f"r.{f.name}")).alias(f.name) for f in record.fields],
                op.alias("op"), "ingested_at", found.isNotNull().alias("ok"), F.col("key").alias("raw_key"),
                F.col("value").alias("raw_value")))


class CompactedTopic:
    """Below ``out``: ``delta`` and ``base`` tables by batch, ``versions``, and ``quarantine``.

    Of the records of a key the one that arrived last holds; equal arrivals go by ``order``, then content.
    """

    def __init__(self, spark: SparkSession, out: str, record: T.StructType, key: str,
                 order: tuple[str, ...] = (), compact_every: int = 20):
        self.spark, self.out, self.record, self.key = spark, out, record, key
        self.order, self.compact_every = order, compact_every
        self.schema = T.StructType([*record.fields, T.StructField("op", T.StringType()),
                                    T.StructField("ingested_at", T.TimestampType())])

    def _newest(self, rows: DataFrame) -> DataFrame:
        ranks = [F.desc(c) for c in ("ingested_at", *self.order)]
        return latest(rows, [self.key], [*ranks, F.to_json(F.struct(*rows.columns)).desc()])

    def _versions(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(VERSION).parquet(f"{self.out}/versions")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def version(self) -> int:
        """The newest complete version, or :data:`NONE`."""
        found = self._versions()
        newest = None if found is None else found.agg(F.max("batch_id")).first()[0]
        return NONE if newest is None else newest

    def _base(self, version: int) -> int:
        return NONE if version == NONE else self._versions().where(F.col("batch_id") == version).first()["base"]

    def _parts(self, base: int, version: int) -> DataFrame:
        """Rows of a base and of the deltas after it; several of a key."""
        paths = [f"{self.out}/base/batch_id={base}"] if base != NONE else []
        paths += [f"{self.out}/delta/batch_id={n}" for n in range(base + 1, version + 1)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def snapshot(self, version: int | None = None) -> DataFrame:
        """The current record per key of a version (the newest one if not given), without deleted keys."""
        at = self.version() if version is None else version
        return self._newest(self._parts(self._base(at), at)).where("op <> 'd'").drop("op", "ingested_at")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        read = records_of(batch, self.record, self.key)
        sinks.write_batch(read.where("NOT ok").select(F.col("raw_key").alias("key"), F.col("raw_value").alias("value"), "ingested_at"),
                          f"{self.out}/quarantine", batch_id)
        sinks.write_batch(self._newest(read.where("ok").select(*self.schema.names)), f"{self.out}/delta", batch_id)
        base = self._base(batch_id - 1)
        if batch_id - base >= self.compact_every:
            sinks.write_batch(self._newest(self._parts(base, batch_id)), f"{self.out}/base", batch_id)
            base = batch_id
        row = self.spark.createDataFrame([(base,)], "base bigint")
        sinks.write_batch(row.coalesce(1), f"{self.out}/versions", batch_id)  # last: the version is complete

    def quarantine(self) -> DataFrame:
        return self.spark.read.schema("key string, value string, ingested_at timestamp, batch_id bigint").parquet(
            f"{self.out}/quarantine").drop("batch_id")

    def run(self, raw: DataFrame, checkpoint: str, finite: bool = False) -> StreamingQuery:
        writer = raw.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return sinks.start(writer, finite, "5 seconds")


class RuleBook:
    """The rules of a topic for the decision stream: every batch of decisions notes the version it used."""

    def __init__(self, topic: CompactedTopic, out: str):
        self.topic, self.out = topic, out

    def at(self, version: int | None = None) -> DataFrame:
        rows = self.topic.snapshot(version).where("enabled")
        return rows.withColumns({"effective_from": event_time(F.col("effective_from")),
                                 "updated_at": event_time(F.col("updated_at"))})

    def __call__(self) -> DataFrame:
        return self.at()

    def of_batch(self, batch_id: int) -> DataFrame:
        """The rules of a batch of decisions; a repeated batch gets those of its first attempt."""
        spark, path = self.topic.spark, f"{self.out}/batch_id={batch_id}"
        try:
            version = spark.read.schema("version bigint").parquet(path).first()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            version = None
        if version is None:
            version = (self.topic.version(),)
            sinks.write_batch(spark.createDataFrame([version], "version bigint").coalesce(1), self.out, batch_id)
        return self.at(version[0])
