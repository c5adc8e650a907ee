"""A lake table whose files are named by a manifest.

Every write goes to a folder of its own and becomes visible when its manifest, one small Parquet file, is
renamed into place. Readers see the newest manifest, so a day can be rewritten or compacted while it is
read, and a job that dies leaves the table as it was. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.sources.files import FILE_BYTES, ROWS_PER_FILE

ENTRY = "dt date, file string, bytes bigint, rows bigint, commit bigint"


class DatedTable:
    """Rows with a ``dt``, kept below ``path`` in one folder per commit and day."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    # -- what there is ----------------------------------------------------------------------------

    def commit(self) -> int:
        """Number of the newest commit, 0 before the first one."""
        try:
            newest = self._manifests().agg(F.max("n")).first()[0]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            newest = None
        return newest or 0

    def _manifests(self) -> DataFrame:
        return self.spark.read.schema(f"{ENTRY}, n bigint").parquet(f"{self.path}/manifest")

    def files(self) -> DataFrame:
        """One row per file of the table: day, path, size, rows, and the commit that wrote it."""
        n = self.commit()
        if not n:
            return self.spark.createDataFrame([], ENTRY)
        return self._manifests().where(F.col("n") == n).drop("n")

    def read(self, days: Iterable | None = None) -> DataFrame:
        """The table, or some of its days. The paths of the files go through the driver, as in any scan."""
        files = self.files()
        if days is not None:
            files = files.where(F.col("dt").isin(list(days)))
        return self._read([r["file"] for r in files.select("file").collect()])

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.option("basePath", f"{self.path}/data").parquet(*paths)
        return rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema))

    # -- writing ----------------------------------------------------------------------------------

    def _store(self, rows: DataFrame) -> DataFrame:
        """Write rows with a ``bin`` to a folder of their own; its files as entries of a manifest."""
        name = uuid.uuid4().hex[:12]
        (rows.write.partitionBy("dt", "bin").option("maxRecordsPerFile", ROWS_PER_FILE)
         .parquet(f"{self.path}/data/part={name}"))
        written = self.spark.read.schema(T.StructType([*rows.schema])).option("basePath", f"{self.path}/data").parquet(
            f"{self.path}/data/part={name}")
        return written.groupBy(
            "dt", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(
            F.count("*").alias("rows"))

    def _publish(self, kept: DataFrame, added: DataFrame) -> int:
        n = self.commit() + 1
        entries = kept.unionByName(added.withColumn("commit", F.lit(n).cast("bigint")))
        entries.coalesce(1).write.parquet(f"{self.path}/manifest/n={n}")
        return n

    def append(self, rows: DataFrame) -> int:
        dealt = rows.hint("rebalance", F.col("dt")).withColumn("bin", F.lit(0))
        return self._publish(self.files(), self._store(dealt))

    def replace(self, rows: DataFrame, days: Iterable) -> int:
        """The given days become ``rows``; files of other days are neither read nor written."""
        others = self.files().where(~F.col("dt").isin(list(days)))
        return self._publish(others, self._store(rows.hint("rebalance", F.col("dt")).withColumn("bin", F.lit(0))))

    def compact(self, target: int = FILE_BYTES) -> int:
        """Pack the small files of every day into files of about ``target`` bytes; large ones stay.

        Files are taken by size into bins by their running total. A bin is one task and one file, so a hot
        day has many; a file that is alone in its bin is left as it is.
        """
        small = self.files().where(F.col("bytes") < target)
        in_order = W.partitionBy("dt").orderBy("bytes", "file")
        packed = small.withColumn("upto", F.sum("bytes").over(in_order)).withColumn(
            "bin", F.floor((F.col("upto") - F.col("bytes")) / target).cast("int"))
        packed = packed.withColumn("mates", F.count("*").over(W.partitionBy("dt", "bin"))).where("mates > 1")
        bins = packed.select("dt", "file", "bin").collect()  # file names, as the driver lists them for a scan
        if not bins:
            return self.commit()
        names = self.spark.createDataFrame([(r["file"], r["bin"]) for r in bins], "file string, bin int")
        paths = [r["file"] for r in bins]
        rows = self.spark.read.option("basePath", f"{self.path}/data").parquet(*paths).select(
            *(F.col(f.name).cast(f.dataType) for f in self.schema), F.col("_metadata.file_path").alias("file"))
        dealt = rows.join(F.broadcast(names), "file").drop("file").repartition(
            len({(r["dt"], r["bin"]) for r in bins}), "dt", "bin")
        added = self._store(dealt.select(*self.schema.names, "bin"))
        return self._publish(self.files().join(names.select("file"), "file", "left_anti").select(
            "dt", "file", "bytes", "rows", "commit"), added)
