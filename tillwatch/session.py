"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when a later operator then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows kept per key by row_number() = 1 are cut before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession, streaming: bool = False) -> SparkSession:
    """Apply the run-time settings every plan here relies on."""
    for key, value in {**RUNTIME_CONF, **(STATE_CONF if streaming else {})}.items():
        spark.conf.set(key, value)
    return spark


# Bytes of the narrow compressed input whose rows, made wide, fit one shuffle partition.
BYTES_PER_PARTITION = 4 << 20


def size_shuffles(spark: SparkSession, scan: DataFrame) -> None:
    """Start with enough shuffle partitions for the input; adaptive execution merges small ones."""
    splits = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(splits)
    spark.conf.set(splits, str(BYTES_PER_PARTITION))
    try:
        wanted = scan.select("*").rdd.getNumPartitions()
    finally:
        spark.conf.set(splits, before)
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(wanted, now)))


def local_session(
    cpus: int | str = "*", app: str = "tillwatch", conf: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and the bench; ``conf`` holds further start-up settings."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config(map=conf or {})
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@lru_cache(maxsize=1)
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="tillwatch-")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder of the cluster.

    The cluster names the folder in ``spark.checkpoint.dir``. Only a local session without that
    setting falls back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
