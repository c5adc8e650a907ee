"""Landing: the raw topic to Bronze, nothing lost, nothing changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwatch.schemas import PAYMENT_EVENT
from tillwatch.sources.files import ROWS_PER_FILE, with_parsed
from tillwatch.streaming.sinks import start


def bronze_rows(raw: DataFrame) -> DataFrame:
    """Raw text next to the parsed event; unusable records go to the ``quarantine`` folder."""
    return (
        with_parsed(raw, PAYMENT_EVENT)
        .select("key", "value", "partition", "ingested_at", "event_ts",
                *[F.col(f"e.{f.name}").alias(f.name) for f in PAYMENT_EVENT.fields],
                F.when(F.col("ok"), "event").otherwise("quarantine").alias("kind"),
                F.to_date(F.coalesce("event_ts", "ingested_at")).alias("dt")))


def land_bronze(
    raw: DataFrame, path: str, checkpoint: str, finite: bool = False, file_format: str = "parquet",
) -> StreamingQuery:
    """Append to Bronze, one folder per kind and event day; files appear when a batch commits.

    The writer tasks of a batch follow its input splits: there is no shuffle, so a hot key or day
    does not slow the landing. Small files are the business of the compaction.
    """
    writer = (
        bronze_rows(raw).writeStream.format(file_format).partitionBy("kind", "dt")
        .option("path", path).option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", ROWS_PER_FILE).outputMode("append"))
    return start(writer, finite)
