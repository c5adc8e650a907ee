"""URL rules by a sort-merge range join.

A rule (host, path, verdict) fits its host and all subdomains when the path starts with the rule's path.
The host with its labels reversed and a closing dot (``com.example.``) is the canonical key: all keys a
rule's host covers form one interval, and the intervals of all rules nest or are disjoint. Rows and rules
are cut into cells of the key order, a rule is copied to the cells its interval meets, and each cell is
swept once in key order with a stack of the rules that are open at the present key.

A host may hold any share of the rows: cell borders are (key, row hash) pairs, so it spans many cells.
Borders come from a sample and only decide where a row is judged, never how.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.common import shuffle_partitions

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
AFTER_SCHEME = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, AFTER_SCHEME, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, AFTER_SCHEME, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def cell_borders(keys: DataFrame, cells: int, per_cell: int = 32) -> list[tuple[str, int]]:
    """At most ``cells - 1`` borders from a sample of about ``cells * per_cell`` (key, salt) pairs."""
    rows = keys.count()
    if not rows or cells < 2:
        return []
    share = min(1.0, cells * per_cell / rows)
    seen = sorted((r.key, r.salt) for r in keys.sample(share, seed=17).select("key", "salt").toLocalIterator())
    step = max(1, len(seen) // cells)
    return sorted(set(seen[step::step]))


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
) -> DataFrame:
    """One row per input row: the id, ``host``, ``path``, the winning ``rule`` and the ``verdict``.

    The longest rule (host and path together) wins; of equally long ones the one with the longer host; of
    a rule given with both verdicts, ``block``. Rows that no rule fits get ``default`` and a null rule.
    A null url, or one without ``://``, has an empty host and path. Empty tables give empty results;
    an empty rule table gives ``default`` everywhere; other columns of ``pages`` are not looked at, and
    repeated rows are judged one by one. Rules with a null host are ignored; a null path is empty.
    """
    spark = pages.sparkSession
    url = F.col(f"`{url_col}`")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), url_host(url).alias("host"), url_path(url).alias("path"))
    rows = rows.select(
        host_key(F.col("host")).alias("key"), F.xxhash64("id", "path").alias("salt"), F.lit(1).alias("kind"),
        "id", "host", "path", F.lit(None).cast("string").alias("verdict"))
    marks = rules.where("host is not null").select(
        host_key(F.translate("host", UPPER, LOWER)).alias("key"), F.lit(0).cast("bigint").alias("salt"),
        F.lit(0).alias("kind"), F.lit(None).cast(pages.schema[id_col].dataType).alias("id"),
        F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    cells = 4 * shuffle_partitions(spark)
    borders = cell_borders(rows, cells)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, salts, kinds = (batch.column(c).to_pylist() for c in ("key", "salt", "kind"))
            take, cell = [], []
            for i, (key, salt, kind) in enumerate(zip(keys, salts, kinds, strict=True)):
                if kind:
                    take.append(i)
                    cell.append(bisect_right(borders, (key, salt)))
                else:  # a rule goes to every cell its interval [key, key with "/" for the last ".") meets
                    over = range(bisect_right(borders, (key,)), bisect_left(borders, (key[:-1] + "/",)) + 1)
                    take.extend([i] * len(over))
                    cell.extend(over)
            out = batch.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), *out.columns], ["cell", *out.schema.names])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, int, dict[str, tuple[str, str]], list[int]]] = []
        at = None
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("cell", "key", "kind", "host", "path", "verdict")]
            take, rule, verdict = [], [], []
            for i, (cell, key, kind, host, path, says) in enumerate(zip(*cols, strict=True)):
                if cell != at:
                    stack, at = [], cell
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if not kind:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, len(host), {}, []))
                    _, _, by_path, lengths = stack[-1]
                    if path not in by_path or says == "block":
                        by_path[path] = (host + path, says)
                    if len(path) not in lengths:
                        lengths.append(len(path))
                        lengths.sort(reverse=True)
                    continue
                best, found = (-1, -1), (None, default)
                for _, size, by_path, lengths in stack:
                    for n in lengths:
                        if n <= len(path) and (hit := by_path.get(path[:n])):
                            if (size + n, size) > best:
                                best, found = (size + n, size), hit
                            break
                take.append(i)
                rule.append(found[0])
                verdict.append(found[1])
            out = batch.select(["id", "host", "path"]).take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                ["id", "host", "path", "rule", "verdict"])

    both = rows.unionByName(marks)
    celled = both.mapInArrow(place, T.StructType([T.StructField("cell", T.IntegerType()), *both.schema.fields]))
    swept = celled.repartition(cells, "cell").sortWithinPartitions("cell", "key", "kind").mapInArrow(
        sweep, T.StructType([
            T.StructField("id", pages.schema[id_col].dataType), T.StructField("host", T.StringType()),
            T.StructField("path", T.StringType()), T.StructField("rule", T.StringType()),
            T.StructField("verdict", T.StringType())]))
    return swept.withColumnRenamed("id", id_col)
