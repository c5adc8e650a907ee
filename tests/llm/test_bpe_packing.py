"""Encoding, decoding and packing against the libraries and brute force."""

import hashlib
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillwatch.llm import bpe, packing
from tillwatch.llm.queries import PACK, packed

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SAME = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id bigint, text string, id string"


def texts():
    prose = "It's the 3rd day;  we'll see\n\n\tnaïve façade  — 12345 ünïcode 漢字かな!! <|endoftext|>\r\n"
    return [None, "", " ", "a", "\n\n x", prose, prose * 40, " " * 700, "a" * 900, "ab " * 500 + "\n" * 300 + "x",
            "x" * 130 + " " + "y" * 200 + prose * 3, prose, " " * 9000 + "z", "😀" * 300]


@pytest.mark.parametrize("chunk, overlap", [(64, 32), (200, 64), (65_536, 2_048)])
def test_digests_equal_the_library(spark, chunk, overlap):
    rows = [(i, t, "clash") for i, t in enumerate(texts())] + [(5, texts()[5], "repeat")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = sorted(tuple(r) for r in bpe.document_digests(
        docs, RANKS, public_tokenizers.PATTERN, chunk_chars=chunk, overlap=overlap).collect())
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    want = []
    for i, t, _ in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_round_trip_and_very_long_white_space(spark):
    text = " " * 200_000 + "end" + "q" * 5000
    docs = spark.createDataFrame([(1, text, "")], DOCS)
    pieces = bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, chunk_chars=10_000, overlap=500)
    raw = bpe.decode_pieces(pieces, RANKS, public_tokenizers.PATTERN).orderBy("piece").collect()
    assert b"".join(r["bytes"] for r in raw).decode() == text


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert bpe.document_digests(none, RANKS, public_tokenizers.PATTERN).count() == 0
    assert packed(none).count() == 0


def test_tokenizer_gives_the_file_s_ids():
    exact = Tokenizer.from_file(JSON)
    ids = packing.tokenizer(JSON, SAME, public_tokenizers.PATTERN)
    for t in texts():
        assert ids(t or "") == exact.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>é", "<|endoftext|", "漢<|endoftext|>"])
def test_added_tokens_are_read_as_the_file_s_default_says(text):
    ids = packing.tokenizer(JSON, SAME, public_tokenizers.PATTERN)(text)
    assert ids == Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids
    assert (50256 in ids) == ("<|endoftext|>" in text)


def test_code_points_that_engines_class_differently(spark):
    """New scripts and marks between letters, short and cut into chunks; the library decides."""
    points = [*range(0x19160, 0x191C0), *range(0x1E030, 0x1E040), *range(0x11F00, 0x11F10), 0x0378, 0xFFFE, 0x2B820, 0x31350]
    short = [f"ab{chr(p)}cd !!{chr(p)} {chr(p)}x\n{chr(p)}" for p in points]
    long = ["".join(f"word{chr(p)}s !!{chr(p)}{chr(p)} " for p in points) * 3, "".join(map(chr, points)) * 20]
    rows = [(i, t, "") for i, t in enumerate(short + long)]
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in bpe.document_digests(
        spark.createDataFrame(rows, DOCS), RANKS, public_tokenizers.PATTERN, chunk_chars=300, overlap=100).collect()}
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    for i, t, _ in rows:
        ids = enc.encode_ordinary(t)
        assert got[i] == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())


def best_fit_one_by_one(lengths, limits):
    """Plain best fit over single pieces, longest first."""
    bins = []
    for n in sorted(lengths, reverse=True):
        need = (n, 1, n * n)
        caps = (limits.max_tokens, limits.max_docs, limits.max_cost)
        fits = [b for b in bins if all(x >= y for x, y in zip(b, need))]
        if fits:
            best = min(fits, key=lambda b: sum(w * ((x - y) / c) ** 2 for w, x, y, c in zip(limits.weights, b, need, caps)))
            for k in range(3):
                best[k] -= need[k]
        else:
            bins.append([c - y for c, y in zip(caps, need)])
    return len(bins)


@pytest.mark.parametrize("limits", [
    packing.Limits(100, 100, 10_000), packing.Limits(100, 5, 10_000), packing.Limits(100, 50, 3_000),
    packing.Limits(100, 5, 5_000, (1.0, 1.0, 1.0), "dot")])
def test_pack_keeps_every_limit_and_best_fit_counts(spark, limits):
    lengths = [(7 * i * i + 3 * i) % 50 + 1 for i in range(400)] + [50] * 200 + [1] * 30
    items = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)] + [(-1, None, ""), (-2, 0, "")],
                                  "key int, length int, note string").repartition(4)
    rows = packing.pack(packing.numbered(items), limits).collect()
    assert len(rows) == len(lengths) + 2
    assert all(r.sequence_id is None and r.offset is None for r in rows if r.key < 0)
    by_seq = defaultdict(list)
    for r in rows:
        if r.key >= 0:
            by_seq[r.sequence_id].append((r.offset, r.length))
    for places in by_seq.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= limits.max_tokens and len(places) <= limits.max_docs
        assert sum(n * n for _, n in places) <= limits.max_cost
    if limits.score == "norm":
        assert len(by_seq) == best_fit_one_by_one(lengths, limits)


def test_a_piece_beyond_the_limits_fails(spark):
    items = spark.createDataFrame([(1, 11)], "key int, length int")
    with pytest.raises(ValueError):
        packing.pack(packing.numbered(items), packing.Limits(10, 10, 100))


def test_packed_pieces_cover_their_documents(spark):
    docs = spark.createDataFrame(
        [(i, t, "") for i, t in enumerate(texts())] + [(50, "word " * 3000, ""), (50, "word " * 3000, "")], DOCS)
    exact = Tokenizer.from_file(JSON)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in packed(docs).collect():
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    for i, t in [*enumerate(texts()), (50, "word " * 3000)]:
        ids = [*exact.encode(t or "", add_special_tokens=False).ids, 2]
        pieces = sorted(set((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]))
        assert sum(n for _, _, n, _ in pieces) == len(ids)
        for _, start, n, crc in pieces:
            assert crc == zlib.crc32(struct.pack(f"<{n}I", *ids[start:start + n]))
        assert all(n == PACK.max_tokens for _, _, n, _ in pieces[1:])
    for places in by_seq.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= PACK.max_tokens
