"""How the sources of a language differ in the words they use.

Tokenizer: one ``bytes.translate`` over the UTF-8 bytes lowers A-Z and blanks every ASCII byte that is no
letter, ``bytes.split`` cuts the terms, a ``Counter`` per document gives their frequencies. A task adds
the counters of its documents up per (lang, source) and emits them sparse, a bounded number of entries at
a time; Spark sums them.

A term that a group does not use still has a smoothed probability there. With z the value of an unused
term, the distance of groups g and h over all V kept terms of a language is summed from what is used only:

    V |z_g - z_h|  +  used in g: (|p_g - z_h| - |z_g - z_h|)  +  used in h: (|p_h - z_g| - |z_g - z_h|)
    +  used in both: (|p_g - p_h| - |p_g - z_h| - |p_h - z_g| + |z_g - z_h|)

The two middle sums need only the histogram of a group's counts. The last one runs over the kept terms,
each with the groups that use it, in Arrow batches. No table of all terms by all groups is built.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwatch.llm.common import bound_batches, small_side, stage

#: ASCII letters lowered, other ASCII blanked, bytes of longer characters left alone.
TERM_BYTES = bytes(
    b | 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: Entries and tokens that a task holds before it emits them.
HELD, TOKENS = 600_000, 1 << 31
#: A document counts as this much beside its tokens, so that one number holds both.
ONE_DOC = 1 << 32
SCALE, PRIOR = 1_000_000_000, 5
COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to sparse counts of terms and of the documents that hold them."""
    held: dict[tuple[str, str], dict[bytes, int]] = {}
    entries = tokens = 0

    def emit() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in held.items():
            both = np.fromiter(counts.values(), np.int64, len(counts))
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(counts)), pa.repeat(source, len(counts)),
                 pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(both % ONE_DOC), pa.array(both // ONE_DOC)],
                names=["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("text").cast(pa.binary()), strict=True):
            found = Counter(terms(text.as_py()))
            counts = held.setdefault((lang, source), {})
            known, so_far = len(counts), counts.get
            for term, n in found.items():
                counts[term] = so_far(term, 0) + n + ONE_DOC
            entries += len(counts) - known
            tokens += found.total()
            if entries >= HELD or tokens >= TOKENS:
                yield from emit()
                entries = tokens = 0
    yield from emit()


def both_use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per kept term the groups that use it with p and z; per pair of groups the sum over terms both use.

    Pairs are formed by distance within a term's list, a whole batch at a time, and added up before they
    leave the batch.
    """
    for batch in batches:
        lists = batch.column("uses")
        flat = lists.flatten()
        per_term = np.diff(lists.offsets.to_numpy())
        of_term = np.repeat(np.arange(len(per_term)), per_term)
        names = flat.field("source").dictionary_encode()
        code, labels = names.indices.to_numpy(), names.dictionary.to_pylist()
        lang = batch.column("lang").dictionary_encode()
        lang_code, lang_labels = lang.indices.to_numpy()[of_term].astype(np.int64), lang.dictionary.to_pylist()
        p, z = flat.field("p").to_numpy(), flat.field("z").to_numpy()
        width, keys, sums = len(labels), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for step in range(1, int(per_term.max(initial=0))):
            at = np.flatnonzero(of_term[:-step] == of_term[step:])
            a, b = at, at + step
            x = np.abs(p[a] - p[b]) - np.abs(p[a] - z[b]) - np.abs(p[b] - z[a]) + np.abs(z[a] - z[b])
            key, place = np.unique((lang_code[a] * width + code[a]) * width + code[b], return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, place, x)
            keys.append(key)
            sums.append(total)
        first, second = np.divmod(np.concatenate(keys), max(width, 1))
        of_lang, first = np.divmod(first, max(width, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang_labels[k] for k in of_lang], pa.string()), pa.array([labels[k] for k in first], pa.string()),
             pa.array([labels[k] for k in second], pa.string()), pa.array(np.concatenate(sums), pa.int64())],
            names=["lang", "source", "item", "x"])


def smoothed(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * v)), exact at any size; null without terms."""
    wide = "decimal(28,0)"
    part = F.call_function("div", (n.cast("decimal(20,0)") + PRIOR) * F.lit(SCALE).cast("decimal(10,0)"),
                           (total.cast(wide) + v.cast("decimal(20,0)") * PRIOR))
    return F.when(v > 0, part + 1)


def divergence(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 30,
    top_terms: int = 50,
) -> DataFrame:
    """``lang source part item value rank``: distances between sources, and the terms each overuses.

    A term is a run of ASCII letters and characters beyond ASCII, A-Z lower-cased. A language keeps the
    terms that at least ``min_docs`` of its documents (rows) hold. Part ``pair`` has a row for every other
    source of the language with the summed difference over all kept terms (0 if there are none). Part
    ``term`` has the ``top_terms`` kept terms that the source uses and gives a higher p than its language
    does. Ranks go by value descending, then item in the order of its UTF-8 bytes.

    Null text, lang and source are empty strings. Repeated rows count as often as they stand there. A group
    without terms is a group; a language with one source has no pairs. Other columns are not read. Empty
    tables give empty results.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(
        *(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(a) for c, a in
          ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    # one shuffle serves both sums; a term sends a row per source and task, however common it is
    counted = rows.mapInArrow(count_terms, COUNTS).repartition("lang", "term")
    used = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = used.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"),
        F.collect_list(F.struct("source", "n")).alias("uses"))  # at most the sources of a language
    kept = stage(by_term.where(F.col("docs") >= min_docs).drop("docs"), "kept_terms")
    entries = kept.select("lang", "term", "lang_n", F.inline("uses"))

    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    zero = F.lit(0).cast("bigint")
    groups = stage(
        rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("total", "terms", "v", "lang_total")))
        .withColumn("z", smoothed(zero, F.col("total"), F.col("v"))), "groups")
    counts = groups.count()

    placed = entries.join(small_side(groups, counts), ["lang", "source"]).withColumn(
        "p", smoothed(F.col("n"), F.col("total"), F.col("v")))

    over = F.col("p") - smoothed(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term_part = (
        placed.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), over.alias("value"))
        .where("value > 0").withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms))

    uses = placed.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "z")).alias("uses"))
    both = uses.select("lang", "uses").mapInArrow(both_use, "lang string, source string, item string, x bigint")
    both = both.select("lang", "x", F.least("source", "item").alias("source"), F.greatest("source", "item").alias("item"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("z").alias("z2"))
    levels = placed.groupBy("lang", "source", "z", "p").agg(F.count("*").alias("k"))  # a group's counts repeat
    base = F.abs(F.col("z") - F.col("z2"))
    alone = levels.join(small_side(other, counts), "lang").where("source <> item").groupBy("lang", "source", "item").agg(
        F.sum(F.col("k") * (F.abs(F.col("p") - F.col("z2")) - base)).alias("x"))
    pairs = groups.join(small_side(other, counts), "lang").where("source < item").select(
        "lang", "source", "item", F.coalesce(F.col("v") * base, zero).alias("x"))
    sums = (
        pairs.unionByName(both)
        .unionByName(alone.select("lang", "x", F.least("source", "item").alias("source"),
                                  F.greatest("source", "item").alias("item")))
        .groupBy("lang", "source", "item").agg(F.sum("x").alias("value")))
    either = sums.select("lang", F.inline(F.array(
        F.struct("source", "item", "value"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"), "value"))))
    pair_part = either.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn(
        "rank", F.row_number().over(by_value))
    return pair_part.unionByName(term_part)
