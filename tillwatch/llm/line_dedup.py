"""Lines that many documents share, dropped with the help of levelled sorted runs of line hashes.

A run is a table of line hashes, one row per hash, bucketed and sorted by it. Level 0 takes one run per
batch; when a level holds ``fanout`` runs they are merged into one run of the next level, so a hash is
rewritten once per level and a batch meets at most ``fanout - 1`` runs a level. A new batch is reduced to
one row per hash, merge-anti-joined with the runs (both sides lie in the same buckets in the same order,
so the runs are neither shuffled nor sorted again), and added as a run of its own: hashes that no run
holds name their owner, the largest document id of the batch, the others only add their counts.

``dedup_lines`` feeds batches of falling document ids. The first batch that holds a line therefore owns it.

Nothing meets in one task: hashes are counted before they are shuffled, and a hash with more than a
thousandth of all lines (there are fewer than a thousand of these) is joined by broadcast.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm.common import shuffle_partitions
from tillwatch.llm.url_filter import LOWER, UPPER
from tillwatch.session import scratch

WHITE = " \t\n\x0b\x0c\r"
HASH = ["h1", "h2"]
#: Stands for a missing document id, which is smaller than any other.
NO_ID = -(1 << 63)
#: Hashes with more than this share of all lines are joined by broadcast.
HEAVY = 1000


class LineRuns:
    """Levels of sorted runs with columns ``h1 h2 docs rows owner``."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = 3):
        self.spark, self.fanout = spark, max(2, fanout)
        self.buckets = buckets or shuffle_partitions(spark)
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}
        # one file per bucket is read in its order, so that merging needs no sort
        spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        self.paths[name] = scratch(self.spark, "line_run")
        (rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).format("parquet")
         .option("path", self.paths[name]).saveAsTable(name))
        return name

    def runs(self) -> list[DataFrame]:
        """All runs, the widest level first."""
        return [self.spark.table(name) for level in reversed(self.levels) for name in level]

    def anti_join(self, keys: DataFrame) -> DataFrame:
        """``keys`` with the owner left only where no run holds the hash."""
        known = []
        for n, run in enumerate(self.runs()):
            keys = keys.join(run.select(*HASH, F.lit(True).alias(f"held_{n}")), HASH, "left")
            known.append(F.col(f"held_{n}").isNotNull())
        fresh = ~reduce(Column.__or__, known, F.lit(False))
        return keys.select(*HASH, "docs", "rows", F.when(fresh, F.col("owner")).alias("owner"))

    def add(self, keys: DataFrame) -> None:
        """Add a batch of ``h1 h2 docs rows owner``, one row per hash, and compact full levels."""
        self._put(0, self._write(self.anti_join(keys.repartition(self.buckets, *HASH))))

    def _put(self, level: int, name: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._merge(full))

    def _merge(self, names: list[str]) -> str:
        """One run of several. The merged runs leave the catalog."""
        # read as plain files: a union of bucketed tables claims their buckets, but its tasks do not keep them
        rows = self.spark.read.parquet(*(self.paths[name] for name in names))
        merged = self._write(rows.groupBy(*HASH).agg(
            F.sum("docs").alias("docs"), F.sum("rows").alias("rows"), F.max("owner").alias("owner")))
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")
        return merged

    def compact(self) -> DataFrame:
        """Everything in one run, which stays as the top level."""
        names = [name for level in self.levels for name in level]
        self.levels = [[], [names[0] if len(names) == 1 else self._merge(names)]]
        return self.spark.table(self.levels[1][0])


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def hashed_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """``h1 h2 order mark pos`` of every line whose key is long enough; ``rows`` has order, mark, text."""
    lines = rows.select("order", "mark", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keys = lines.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    return keys.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "order", "mark", "pos")


def batch_keys(lines: DataFrame) -> DataFrame:
    """One row per hash: in how many documents, on how many lines, and the largest document id."""
    per_doc = lines.groupBy(*HASH, "order").agg(F.count("*").alias("rows"))
    return per_doc.groupBy(*HASH).agg(
        F.count("*").alias("docs"), F.sum("rows").alias("rows"), F.max("order").alias("owner"))


def without(lines: Column, dropped: Column) -> Column:
    """An array without the elements at the sorted places ``dropped``: the slices between them, joined."""
    starts = F.concat(F.array(F.lit(1)), F.transform(dropped, lambda p: p + 2))
    ends = F.concat(dropped, F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, ends, lambda s, e: F.slice(lines, s, e - s + 1)))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3,
    batches: int = 6, fanout: int = 3,
) -> DataFrame:
    """``docs`` with shared lines taken out of ``text_col``, and ``n_lines`` (before) and ``n_dropped``.

    A line is what lies between ``\\n``; its key has no white space at the ends and A-Z lower-cased. A key
    of at least ``min_chars`` code points that at least ``min_docs`` documents hold stays in the document
    with the largest id, wherever and however often it stands there, and goes from all others.

    Null or empty text is one empty line. A document is an id: rows that repeat an id are one document. A
    missing id is smaller than any other and one document too. Repeated rows stay repeated. Columns of
    ``docs`` named ``n_lines`` or ``n_dropped`` give way to the results. Empty tables give empty results.
    Keys and texts are compared by hash: keys by 128 bits, the texts of one id by 64.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(NO_ID)).alias("order"), F.xxhash64(text).alias("mark"),
        text.alias("text"), *(F.col(f"`{c}`").alias(f"own_{c}") for c in own if c != text_col))

    shares = [n / batches for n in range(1, batches)]
    borders = {int(b) for b in rows.approxQuantile("order", shares, 0.01)} if shares else set()
    batch = reduce(Column.__add__, [(F.col("order") < F.lit(b)).cast("int") for b in sorted(borders)], F.lit(0))
    hashed = hashed_lines(rows, min_chars).withColumn("batch", batch)
    path = scratch(spark, "lines")
    hashed.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(hashed.schema).parquet(path)

    runs = LineRuns(spark, fanout=fanout)
    for n in range(len(borders) + 1):
        runs.add(batch_keys(lines.where(F.col("batch") == n)))
    counted = runs.compact()
    shared = counted.where(F.col("docs") >= min_docs).select(*HASH, "rows", "owner")
    total = counted.agg(F.sum("rows")).first()[0] or 0
    heavy = F.broadcast(shared.where(F.col("rows") * HEAVY > total))
    light = shared.where(F.col("rows") * HEAVY <= total)
    goes = F.col("order") < F.col("owner")
    places = ["order", "mark", "pos"]
    drops = lines.join(heavy, HASH).where(goes).select(*places).union(
        lines.join(heavy.select(*HASH), HASH, "left_anti").join(light, HASH).where(goes).select(*places))
    dropped = drops.groupBy("order", "mark").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))

    marked = rows.join(dropped, ["order", "mark"], "left")
    parts = F.split("text", "\n")
    kept = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(
        F.array_join(without(parts, F.col("dropped")), "\n"))
    return marked.select(
        *(kept.alias(c) if c == text_col else F.col(f"`own_{c}`").alias(c) for c in own),
        F.size(parts).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"))
