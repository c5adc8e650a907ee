"""Connected components of a link table, by alternating large and small stars.

Every step is a join of the links with one row per node, so a node with any number of links is a skewed
join side that adaptive execution splits; nothing is gathered per node or on the driver. Each round is
written to the shared folder, which ends its lineage. The number of rounds grows with the logarithm of
the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import stage_observed


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on its smallest neighbour or itself.

    ``links`` hold (a, b) with a > b. Large: the larger neighbours of every node. Small: the smaller ones
    and the node itself.
    """
    if large:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # larger neighbours of node x are the rows (a, x): a joins the smallest of x
        moved = links.join(least.select(F.col("a").alias("b"), "m"), "b").select("a", F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        joined = links.join(least, "a")
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _staged(links: DataFrame) -> tuple[DataFrame, dict]:
    """The written links with their count and combined hash, which are the same for the same set."""
    return stage_observed(links, "links", n=F.count(F.lit(1)), mark=F.bit_xor(F.xxhash64("a", "b")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable from each linked node, itself included.

    Links work both ways; repeated links and links of a node to itself do no harm, links with a null end
    are ignored. Nodes without links do not appear; an empty table gives no rows.
    """
    now, mark = _staged(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("a <> b").distinct())
    while mark["n"]:
        before = mark
        now, mark = _staged(_star(_star(now, large=True), large=False))
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
