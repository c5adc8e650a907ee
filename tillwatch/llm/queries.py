"""One registered query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm.bpe import document_digests
from tillwatch.llm.common import table
from tillwatch.llm.divergence import divergence
from tillwatch.llm.line_dedup import dedup_lines
from tillwatch.llm.near_vectors import near_vectors
from tillwatch.llm.packing import Limits, pack, token_pieces
from tillwatch.llm.quality import fit_quality, held_out, score_quality
from tillwatch.llm.shingle_join import near_documents
from tillwatch.llm.top_products import top_products
from tillwatch.llm.toxicity import fit_toxicity, score_toxicity
from tillwatch.llm.turn_repair import damaged, repair_report
from tillwatch.llm.url_filter import judge_urls
from tillwatch.llm.wrappers import main_text
from tillwatch.llm.warc import archive_folder, read_archives, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query("op1_url_filter")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


@query("op5_warc")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = archive_folder(spark)
    manifest = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(manifest, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


PACK = Limits(max_tokens=1024, max_docs=1024, max_cost=1024 * 1024)
END_ID = 2


@query("op6_bpe")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN)


def packed(docs: DataFrame) -> DataFrame:
    pieces = token_pieces(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN, PACK.max_tokens, END_ID)
    return pack(pieces, PACK).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op7_packing")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """Learns from the labels whose ids are not held out."""
    return fit_quality(docs, table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))))


@query("op2_quality")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, quality_model(spark, docs, sf_dir)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    return fit_toxicity(docs, table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))))


@query("op8_toxicity")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, toxicity_model(spark, docs, sf_dir))


@query("op4_near_vectors")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), 0.95)


@query("op9_top_products")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_products(vectors, vectors.where("vec_id % 20 = 0"), k=20, scale=64)


@query("op10_main_text")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


@query("op3_shingle_join")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(table(spark, sf_dir, "documents")).drop("mark", "group")


@query("op11_line_dedup")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, min_chars=20, min_docs=3).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op12_divergence")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"), min_docs=30, top_terms=50)


@query("op13_turn_repair")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(damaged(table(spark, sf_dir, "conversations")))


@query("pipeline")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)
