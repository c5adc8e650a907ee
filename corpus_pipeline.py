"""The corpus pipeline: quality, toxicity, near duplicates, packing.

Each stage takes the rows its predecessor kept, decides on whole texts and returns the columns of
``documents`` (the last one the packed pieces). ``run`` writes every stage to the shared folder as Parquet
and reads it back, so a lost executor never costs more than the running stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwatch.llm.common import free_names, stage, table
from tillwatch.llm.quality import score_quality
from tillwatch.llm.queries import packed, quality_model, toxicity_model
from tillwatch.llm.shingle_join import near_documents
from tillwatch.llm.toxicity import score_toxicity


def judged(docs: DataFrame, score: Callable[..., DataFrame], keep: str) -> DataFrame:
    """Rows of ``docs`` for which ``keep`` holds on the columns that ``score`` adds, whatever ``docs`` calls its own."""
    own = docs.select(*(F.col(f"`{c}`").alias(f"own_{c}") for c in docs.columns))
    scored = score(own, id_col="own_doc_id", text_col="own_text", carry=tuple(own.columns))
    return scored.where(keep).select(*(F.col(f"`own_{c}`").alias(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose quality score reaches 0.3. Empty texts follow the bias of the model."""
    model = quality_model(spark, docs, sf_dir)
    return judged(docs, lambda rows, **names: score_quality(rows, model, **names), "predicted = 1")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the severity model finds clean; it is fitted on the documents that got here."""
    model = toxicity_model(spark, docs, sf_dir)
    return judged(docs, lambda rows, **names: score_toxicity(rows, model, **names), "not toxic")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each linked group, the one with the smallest id.

    Documents that link with nothing stay, repeated ids with different texts included; of rows that
    repeat both id and text one stays. A null id stays where its group has no other.
    """
    found = near_documents(docs)
    first = found.where("group is not null").groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("row"))
    empty = found.where("group is null").select(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    *keys, nth = free_names(docs.columns, "no_id", "id", "mark", "nth")
    keep = stage(first.select("row.*").union(empty).distinct().select(
        F.col("no_id").alias(keys[0]), F.coalesce("doc_id", F.lit(0)).alias(keys[1]), F.col("mark").alias(keys[2])), "keep")
    marked = docs.withColumns({
        keys[0]: F.col("doc_id").isNull(), keys[1]: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)),
        keys[2]: F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})
    order = Window.partitionBy(*keys).orderBy(F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)))
    rows = marked.join(keep, keys, "left_semi").withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1)
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document in as few sequences as best fit finds."""
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]

#: Classifiers and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
