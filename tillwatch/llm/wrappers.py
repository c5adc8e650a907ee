"""Main text of pages by wrappers inferred per host.

A page is a stream of block items. Repetitions side by side are folded into repeated groups, which turns
the page into a union-free regular expression; most pages of a host fold into few distinct expressions.
A host's expressions are aligned one after the other: equal items merge, items missing on one side become
optional, groups absorb their single occurrences, and words that differ make a text slot. The result is
the host's wrapper. It tells content slots from furniture: slots of the main element where pages have
one, unless they hold the same words on half of the host's pages or more, otherwise body slots that are
neither the same words on all their pages nor lists of links. Pages with equal content words count once.
Each page is then read through the wrapper and its content slots are joined in page order.

Only distinct expressions meet per host, in two steps (shares of a host, then the host), so a host with
any number of pages never gathers in one task.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.common import bound_batches, small_side, stage
from tillwatch.llm.html_tokens import Item, block_items
from tillwatch.llm.url_filter import url_host

LONGEST_GROUP = 12
SHARES = 16
SAME_WORDS_PAGES = 3
MAIN = ("A", "M")
#: Elements of the HTML standard that name what follows them.
LABELS = {"h1", "h2", "h3", "h4", "h5", "h6", "dt", "th", "caption", "summary"}
TIERS = (*MAIN, "B", "SC")  # regions of which the first with content is read


@dataclass
class Node:
    """An item or a repeated group of nodes. ``places`` are the page items a leaf stands for."""

    key: str
    body: list["Node"] = field(default_factory=list)
    places: list[int] = field(default_factory=list)
    optional: bool = False
    words: int | None = None  # hash of the words if all occurrences had the same
    pages: int = 0

    def leaves(self) -> Iterator["Node"]:
        if not self.body:
            yield self
        for n in self.body:
            yield from n.leaves()


def group_of(nodes: list[Node]) -> Node:
    return Node("(" + ",".join(n.key for n in nodes) + ")+", nodes)


def absorb(kept: list[Node], more: list[Node]) -> None:
    """Let the leaves of ``kept`` also stand for those of the equal nodes ``more``."""
    for a, b in zip(kept, more, strict=True):
        for x, y in zip(a.leaves(), b.leaves(), strict=True):
            x.places += y.places
            if x.words != y.words:
                x.words = None


def fold(nodes: list[Node]) -> list[Node]:
    """Fold equal neighbours into repeated groups, short ones first, until nothing changes."""

    def same(a: list[Node], b: list[Node]) -> bool:
        return all(x.key == y.key for x, y in zip(a, b, strict=True))

    changed = True
    while changed:
        changed = False
        for width in range(1, min(LONGEST_GROUP, len(nodes) - 1) + 1):
            out: list[Node] = []
            for node in nodes:
                out.append(node)
                while len(out) > width:
                    last, before = out[-1], out[-width - 1]
                    if len(before.body) == width and before.body[-1].key == last.key and same(before.body, out[-width:]):
                        absorb(before.body, out[-width:])
                        del out[-width:]
                    elif width == 1 and last.body and last.key == before.key:
                        absorb([before], [last])
                        del out[-1]
                    elif before.key == last.key and len(out) >= 2 * width and same(out[-2 * width:-width], out[-width:]):
                        first = out[-2 * width:-width]
                        absorb(first, out[-width:])
                        del out[-2 * width:]
                        out.append(group_of(first))
                    else:
                        break
                    changed = True
            nodes = out
    return nodes


def expression(items: list[Item]) -> list[Node]:
    return fold([
        Node(item.key, places=[i], words=None if item.text is None else xxhash.xxh3_64_intdigest(item.text) >> 1)
        for i, item in enumerate(items)])


def to_text(nodes: list[Node]) -> str:
    def plain(n: Node):
        return [n.key, n.optional, n.words, n.pages, [plain(x) for x in n.body]]

    return json.dumps([plain(n) for n in nodes])


def from_text(text: str) -> list[Node]:
    def node(x) -> Node:
        return Node(x[0], [node(y) for y in x[4]], [], x[1], x[2], x[3])

    return [node(x) for x in json.loads(text)]


def grouped_like(nodes: list[Node], other: list[Node]) -> list[Node]:
    """Turn single occurrences of the groups of ``other`` into groups."""
    bodies = {tuple(n.key for n in x.body) for x in other if x.body}
    for body in sorted(bodies, key=len, reverse=True):
        out: list[Node] = []
        for node in nodes:
            out.append(node)
            if tuple(n.key for n in out[-len(body):]) == body:
                out[-len(body):] = [group_of(out[-len(body):])]
        nodes = out
    return nodes


def merge(a: Node, b: Node) -> Node:
    body = [merge(x, y) for x, y in zip(a.body, b.body, strict=True)]
    return Node(a.key, body, [], a.optional or b.optional, a.words if a.words == b.words else None, a.pages + b.pages)


def align(wrapper: list[Node], page: list[Node]) -> list[Node]:
    """The wrapper that also covers ``page``."""
    wrapper, page = grouped_like(wrapper, page), grouped_like(page, wrapper)
    out: list[Node] = []
    matcher = SequenceMatcher(None, [n.key for n in wrapper], [n.key for n in page], autojunk=False)
    for how, a0, a1, b0, b1 in matcher.get_opcodes():
        if how == "equal":
            out += [merge(x, y) for x, y in zip(wrapper[a0:a1], page[b0:b1], strict=True)]
        else:
            for node in [*wrapper[a0:a1], *page[b0:b1]]:
                node.optional = True
                out.append(node)
    return fold_known(out)


def fold_known(nodes: list[Node]) -> list[Node]:
    """Neighbours with one key that alignment left apart become one group."""
    out: list[Node] = []
    for node in nodes:
        if out and out[-1].key == node.key and node.body:
            out[-1] = merge(out[-1], node)
        else:
            out.append(node)
    return out


def content_leaves(wrapper: list[Node], page: list[Node], host_pages: int) -> list[bool]:
    """For each leaf of a page's expression whether it is a content slot of the wrapper.

    A slot with the same words on all its pages is furniture. Inside the main element, where tags speak for
    content, at least half of the host's different pages must also have it, and a label (heading, term) that
    stands right before a content slot belongs to it however often it recurs. Text that only a class name
    marks as furniture counts where the page has no other.
    """
    leaves = [leaf for n in page for leaf in n.leaves()]
    same: dict[str, int] = {}
    for leaf in (x for n in wrapper for x in n.leaves()):
        if leaf.words is not None and leaf.pages >= SAME_WORDS_PAGES:
            name = leaf.key + str(leaf.words)
            same[name] = max(same.get(name, 0), leaf.pages)

    def content(leaf: Node, tier: str) -> bool:
        if leaf.key[0] != "#" or leaf.key[1] not in tier:
            return False
        pages = same.get(leaf.key + str(leaf.words), 0)
        return 2 * pages < max(host_pages, 1) if tier in MAIN else not pages and not leaf.key.endswith("|l")

    for tier in TIERS:
        found = [content(leaf, tier) for leaf in leaves]
        if any(found):
            break
    if tier in MAIN:
        slots = [n for n, leaf in enumerate(leaves) if leaf.key[0] == "#" and leaf.key[1] in tier]
        for n, following in zip(reversed(slots[:-1]), reversed(slots[1:])):
            found[n] = found[n] or (found[following] and leaves[n].key.split("|")[1] in LABELS)
    return found


def leaf_slots(nodes: list[Node], items: list[Item]) -> tuple[list[int], list[str]]:
    """The text runs of a page in order, and for each the number of its leaf in the page's expression."""
    owner = {i: n for n, leaf in enumerate(x for node in nodes for x in node.leaves()) for i in leaf.places}
    runs = [i for i, item in enumerate(items) if item.text is not None]
    return [owner[i] for i in runs], [items[i].text for i in runs]


def shape_of(nodes: list[Node]) -> str:
    return xxhash.xxh3_128_hexdigest("\n".join(n.key for n in nodes))


def content_hash(items: list[Item]) -> int:
    """One number for the words of a page that may be content: pages alike in them are one page."""
    for tier in TIERS:
        texts = [i.text for i in items if i.text is not None and i.key[1] in tier
                 and (tier in MAIN or not i.key.endswith("|l"))]
        if texts:
            break
    return xxhash.xxh3_64_intdigest("\n".join(texts)) - (1 << 63)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Id, url, ``text`` and ``n_chars`` (code points) of every page.

    Null or empty html gives an empty text, as does a page without content. A null url, or one without
    ``://``, belongs to the host with the empty name. Repeated rows are read one by one; an empty table
    gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("link"), url_host(F.col(f"`{url_col}`")).alias("host"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct expressions of a batch and the content hashes of their pages; words that differ are no words."""
        for batch in batches:
            seen: dict[tuple[str, str], list[Node]] = {}
            alike: dict[tuple[str, str], set[int]] = {}
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                items = block_items(html.as_py())
                nodes = expression(items)
                for leaf in (x for n in nodes for x in n.leaves()):
                    leaf.places = []
                key = (host, shape_of(nodes))
                seen[key] = [merge(x, y) for x, y in zip(seen[key], nodes, strict=True)] if key in seen else nodes
                alike.setdefault(key, set()).add(content_hash(items))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()),
                 pa.array([to_text(v) for v in seen.values()], pa.string()),
                 pa.array([sorted(alike[k]) for k in seen], pa.list_(pa.int64()))], ["host", "shape", "nodes", "alike"])

    def same_shape(group: pa.Table) -> pa.Table:
        texts = group.column("nodes").to_pylist()
        nodes = from_text(texts[0])
        for text in texts[1:]:
            nodes = [merge(x, y) for x, y in zip(nodes, from_text(text), strict=True)]
        return pa.table({"host": group.column("host")[:1], "shape": group.column("shape")[:1], "nodes": [to_text(nodes)]})

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each leaf stands for the different pages of its expression."""
        for batch in batches:
            texts = []
            for text, many in zip(batch.column("nodes"), batch.column("pages").to_pylist(), strict=True):
                nodes = from_text(text.as_py())
                for leaf in (x for n in nodes for x in n.leaves()):
                    leaf.pages = many
                texts.append(to_text(nodes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("shape"), pa.array(texts, pa.string())], ["host", "shape", "nodes"])

    def aligned(group: pa.Table) -> pa.Table:
        order = sorted(range(group.num_rows), key=lambda i: group.column("shape")[i].as_py())
        wrapper = from_text(group.column("nodes")[order[0]].as_py())
        for i in order[1:]:
            wrapper = align(wrapper, from_text(group.column("nodes")[i].as_py()))
        return pa.table({"host": group.column("host")[:1], "shape": group.column("shape")[:1], "nodes": [to_text(wrapper)]})

    kinds = "host string, shape string, nodes string"
    found = stage(rows.select("host", "html").mapInArrow(shapes, kinds + ", alike array<bigint>"), "expressions")
    # a page met under several expressions counts for one of them
    different = found.select("host", "shape", F.explode("alike").alias("page")).groupBy("host", "page").agg(
        F.min("shape").alias("shape")).groupBy("host", "shape").agg(F.count("*").alias("pages"))
    different = stage(different, "different")
    found = found.drop("alike")
    # a host's most common expression may come from any number of batches: merge in shares first
    for shares in (SHARES, 1):
        found = found.withColumn("part", F.pmod(F.xxhash64("nodes"), F.lit(shares))).groupBy("host", "shape", "part") \
            .applyInArrow(same_shape, kinds)
    found = found.join(different, ["host", "shape"], "left").select(
        "host", "shape", "nodes", F.coalesce("pages", F.lit(0)).alias("pages"))
    distinct = stage(found.mapInArrow(counted, kinds), "shapes")
    wrapper = distinct
    for shares in (SHARES, 1):
        wrapper = wrapper.withColumn("part", F.pmod(F.xxhash64("shape"), F.lit(shares))).groupBy("host", "part") \
            .applyInArrow(aligned, kinds)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = ["".join("01"[ok] for ok in content_leaves(from_text(w.as_py()), from_text(n.as_py()), many))
                    for w, n, many in zip(batch.column("wrapper"), batch.column("nodes"),
                                          batch.column("host_pages").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("shape"), pa.array(keep, pa.string())], ["host", "shape", "keep"])

    totals = different.groupBy("host").agg(F.sum("pages").alias("host_pages"))
    labels = stage(
        distinct.join(wrapper.select("host", F.col("nodes").alias("wrapper")).join(totals, "host"), "host").mapInArrow(
            label, "host string, shape string, keep string"), "slots")

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shape, texts, leaves = [], [], []
            for h in batch.column("html"):
                items = block_items(h.as_py())
                nodes = expression(items)
                shape.append(shape_of(nodes))
                at, text = leaf_slots(nodes, items)
                leaves.append(at)
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("link"), batch.column("host"), pa.array(shape, pa.string()),
                 pa.array(leaves, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.string()))],
                ["id", "link", "host", "shape", "leaf", "words"])

    read = rows.mapInArrow(slots, T.StructType([
        T.StructField("id", pages.schema[id_col].dataType), T.StructField("link", pages.schema[url_col].dataType),
        *T.StructType.fromDDL("host string, shape string, leaf array<int>, words array<string>").fields]))
    text = F.expr("array_join(filter(words, (w, i) -> substring(keep, leaf[i] + 1, 1) = '1'), ' ')")
    return read.join(small_side(labels, labels.count(), 20_000), ["host", "shape"]).select(
        F.col("id").alias(id_col), F.col("link").alias(url_col), text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("bigint"))
