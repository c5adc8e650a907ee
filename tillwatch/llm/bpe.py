"""Byte-level BPE over overlapping chunks.

A text of at most ``chunk_chars`` is one piece. A longer one is cut into chunks that overlap; the chunks
are pre-tokenised in parallel, each from its own start. The pattern has no memory, so once two neighbours
share one pre-token boundary they agree from there on: the first shared boundary in the overlap is the
seam, and the pieces between seams are encoded in parallel. Seams follow a character that is no white
space, so that cutting there cannot change a look-ahead. Where no boundary is shared (a pre-token longer
than the overlap) the document is encoded whole by one task. Decoding concatenates raw bytes.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillwatch.llm.common import bound_batches, per_process, shuffle_partitions

CHUNK_CHARS = 65_536
OVERLAP_CHARS = 2_048
#: Engines may class rare code points differently. After these and before white space of ASCII none does.
PLAIN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
BLANK = frozenset(" \t\r\n")


def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    def load():
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    return per_process(f"bpe {ranks_path} {pattern}", load)


def safe_boundaries(pattern: str, text: str, at: int, low: int, high: int, ends: bool) -> list[int]:
    """Ends of pre-tokens of ``text`` (which starts at ``at``) in [low, high], where a cut changes nothing.

    The library encodes the pieces, another engine looks for their borders. Only borders that hold in both
    count: behind an ASCII letter or digit, before ASCII white space or the end.
    """
    found = []
    for match in regex.finditer(pattern, text):
        end = match.end()
        if low <= at + end <= high and text[end - 1] in PLAIN and (text[end] in BLANK if end < len(text) else ends):
            found.append(at + end)
    return found


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bound_batches(docs.sparkSession)
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def _piece_schema(docs: DataFrame, id_col: str) -> T.StructType:
    return T.StructType([
        T.StructField("row", T.LongType()), T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("piece", T.IntegerType()), T.StructField("ids", T.BinaryType())])


def _encode(ranks_path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for batch in batches:
            ids = [array("I", enc.encode_ordinary(t.as_py())).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), batch.column("piece"), pa.array(ids, pa.binary())],
                ["row", "id", "piece", "ids"])

    return run


def short_pieces(docs, ranks_path, pattern, id_col="doc_id", text_col="text", chunk_chars=CHUNK_CHARS) -> DataFrame:
    """The one piece of each document of at most ``chunk_chars``."""
    rows = _rows(docs, id_col, text_col).where(F.length("text") <= chunk_chars)
    return rows.withColumn("piece", F.lit(0)).mapInArrow(_encode(ranks_path, pattern), _piece_schema(docs, id_col))


def long_pieces(
    docs, ranks_path, pattern, id_col="doc_id", text_col="text", chunk_chars=CHUNK_CHARS, overlap=OVERLAP_CHARS,
) -> DataFrame:
    """The stitched pieces of each longer document."""
    spark = docs.sparkSession
    rows = _rows(docs, id_col, text_col).where(F.length("text") > chunk_chars)
    id_field = T.StructField("id", docs.schema[id_col].dataType)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, key, text in zip(batch.column("row"), batch.column("id"), batch.column("text"), strict=True):
                text = text.as_py()
                starts = range(0, len(text), chunk_chars)
                for k, at in enumerate(starts):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row.as_py()], pa.int64()), pa.array([key.as_py()], batch.column("id").type),
                        pa.array([k], pa.int32()), pa.array([len(starts)], pa.int32()), pa.array([at], pa.int64()),
                        pa.array([text[at:at + chunk_chars + overlap]], pa.string())],
                        ["row", "id", "chunk", "chunks", "at", "text"])

    chunks = rows.mapInArrow(split, T.StructType([
        T.StructField("row", T.LongType()), id_field, T.StructField("chunk", T.IntegerType()),
        T.StructField("chunks", T.IntegerType()), T.StructField("at", T.LongType()),
        T.StructField("text", T.StringType())])).repartition(shuffle_partitions(spark), "row", "chunk")

    def boundaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for chunk, many, at, text in zip(*(batch.column(c) for c in ("chunk", "chunks", "at", "text")), strict=True):
                chunk, many, at, text = chunk.as_py(), many.as_py(), at.as_py(), text.as_py()
                ends = len(text) < chunk_chars + overlap or chunk == many - 1
                left.append(safe_boundaries(pattern, text[:2 * overlap], at, at, at + overlap, False) if chunk else [])
                right.append([] if chunk == many - 1 else safe_boundaries(
                    pattern, text, at, at + chunk_chars, at + chunk_chars + overlap, ends))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("chunk"), batch.column("chunks"),
                 pa.array(left, pa.list_(pa.int64())), pa.array(right, pa.list_(pa.int64()))],
                ["row", "chunk", "chunks", "left", "right"])

    by_row = Window.partitionBy("row").orderBy("chunk")
    seams = chunks.mapInArrow(
        boundaries, "row bigint, chunk int, chunks int, left array<bigint>, right array<bigint>")
    seams = seams.withColumn("cut", F.array_min(F.array_intersect("right", F.lead("left").over(by_row))))
    seams = seams.select(
        "row", "chunk", F.coalesce(F.lag("cut").over(by_row), F.lit(0)).alias("begin"), "cut",
        F.max(F.col("cut").isNull() & (F.col("chunk") < F.col("chunks") - 1)).over(Window.partitionBy("row")).alias("apart"))
    pieces = chunks.join(seams.where("not apart"), ["row", "chunk"]).select(
        "row", "id", F.col("chunk").alias("piece"),
        F.expr("substring(text, cast(begin - at + 1 as int), cast(coalesce(cut, at + length(text)) - begin as int))").alias("text"))
    whole = rows.join(seams.where("apart and chunk = 0").select("row"), "row", "left_semi").select(
        "row", "id", F.lit(0).alias("piece"), "text")
    return pieces.unionByName(whole).mapInArrow(_encode(ranks_path, pattern), _piece_schema(docs, id_col))


def encode_documents(docs, ranks_path, pattern, id_col="doc_id", text_col="text", chunk_chars=CHUNK_CHARS,
                     overlap=OVERLAP_CHARS) -> DataFrame:
    """``row, id, piece, ids``: little-endian 32-bit ids per piece, in order of ``piece`` within a row.

    ``row`` numbers input rows, so repeated ids stay apart. Null text counts as empty and has one empty
    piece. An empty table gives no rows; other columns are ignored.
    """
    return short_pieces(docs, ranks_path, pattern, id_col, text_col, chunk_chars).unionByName(
        long_pieces(docs, ranks_path, pattern, id_col, text_col, chunk_chars, overlap))


def decode_pieces(pieces: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Adds the raw ``bytes`` of each piece; concatenated in order they are the document's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for batch in batches:
            raw = [enc.decode_bytes(array("I", x.as_py()).tolist()) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], [*batch.schema.names, "bytes"])

    return pieces.mapInArrow(run, T.StructType([*pieces.schema.fields, T.StructField("bytes", T.BinaryType())]))


def document_digests(docs, ranks_path, pattern, id_col="doc_id", text_col="text", chunk_chars=CHUNK_CHARS,
                     overlap=OVERLAP_CHARS) -> DataFrame:
    """Per document the number of ids and SHA-256 of its ids and of the decoded bytes.

    Pieces of a long document stream through one running hash in order; no task holds them together.
    """
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, now, kind = encoding(ranks_path, pattern), None, pa.null()
        names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]

        def batch_of(rows):
            cols = list(zip(*rows, strict=True)) or [[], [], [], []]
            kinds = [kind, pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        for batch in batches:
            done, kind = [], batch.column("id").type
            for row, key, ids in zip(batch.column("row").to_pylist(), batch.column("id").to_pylist(),
                                     batch.column("ids"), strict=True):
                ids = ids.as_py()
                if now is None or now[0] != row:
                    if now is not None:
                        done.append((now[1], now[2], now[3].hexdigest(), now[4].hexdigest()))
                    now = [row, key, 0, hashlib.sha256(), hashlib.sha256()]
                now[2] += len(ids) // 4
                now[3].update(ids)
                now[4].update(enc.decode_bytes(array("I", ids).tolist()))
            yield batch_of(done)
        if now is not None:
            yield batch_of([(now[1], now[2], now[3].hexdigest(), now[4].hexdigest())])

    short = short_pieces(docs, ranks_path, pattern, id_col, text_col, chunk_chars).mapInArrow(digest, schema)
    long = long_pieces(docs, ranks_path, pattern, id_col, text_col, chunk_chars, overlap)
    long = long.repartition(shuffle_partitions(docs.sparkSession), "row").sortWithinPartitions("row", "piece")
    return short.unionByName(long.mapInArrow(digest, schema))
