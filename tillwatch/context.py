"""Inputs of one registered query and the plain form of its result."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.functions.exprs import is_gmv
from tillwatch.plans.silver import clean
from tillwatch.plans.warehouse import Warehouse
from tillwatch.session import scratch, size_shuffles
from tillwatch.sources.seeds import HISTORY_FROM, HISTORY_TO, Seeds, default_seeds, fx_rates
from tillwatch.testbed import SALT, Testbed


# Tables that queries share, and where this process has written them. The files of the data folder are part
# of the key: a folder that has been written anew is read anew.
SHARED, BY_DATE = {"facts", "history", "watermarked"}, {"facts"}
WRITTEN: dict[tuple, str] = {}


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.staged: dict[str, str] = {}
        self.tb = Testbed(spark, sf_dir)
        size_shuffles(spark, self.tb.events)

    @cached_property
    def seeds(self) -> Seeds:
        return default_seeds(self.spark)

    @cached_property
    def wh(self) -> Warehouse:
        tb = self.tb
        return Warehouse(tb.payments, tb.profile_changes, tb.rules, tb.labels, tb.redemptions,
                         self.seeds, SALT, self.stage)

    @cached_property
    def history(self) -> DataFrame:
        """Successful payments of the long history, through the same Silver steps."""
        rows = clean(self.tb.history, fx_rates(self.spark, HISTORY_FROM, HISTORY_TO))
        return self.stage(rows.where(is_gmv(F.col("status"), F.col("txn_type"))).select(
            "transaction_id", "user_id", "event_ts", "amount_vnd"), "history")

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write once to the shared folder and read back.

        Silver facts are the same for every query over a data folder: the first one that needs them writes
        them, by date, and the others of the application read that copy.
        """
        shared = self.shared_key(name)
        path = WRITTEN.get(shared) or self.scratch(name)
        self.staged[name] = path
        if shared not in WRITTEN:
            if name in BY_DATE:
                df.hint("rebalance", "dt").write.partitionBy("dt").parquet(path)
            else:
                df.write.parquet(path)
        if name in SHARED:
            WRITTEN[shared] = path
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def shared_key(self, name: str) -> tuple:
        return (self.spark.sparkContext.applicationId, *sorted(self.tb.events.inputFiles()), name)

    def once(self, name: str, make: Callable[[], str]) -> str:
        """The folder that a finished stream run has written; queries over the same data share it."""
        key = self.shared_key(name)
        if key not in WRITTEN:
            WRITTEN[key] = make()
        return WRITTEN[key]

    def stream_of(self, staged: DataFrame, name: str) -> DataFrame:
        """A staged table as a stream."""
        return self.spark.readStream.schema(staged.schema).parquet(self.staged[name])

    def scratch(self, name: str) -> str:
        return scratch(self.spark, name)


def plain(df: DataFrame) -> DataFrame:
    """Only text, bigint, boolean and rounded doubles, so any engine prints the same values."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = F.unix_millis(c)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.DoubleType, T.DecimalType)):
            # adding 0.0 turns a negative zero into zero
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
