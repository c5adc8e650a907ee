"""WARC archives: a writer with one gzip member per record and a splittable reader.

Reader: an archive is cut into byte ranges. The task of a range looks for gzip magic, takes a candidate
for a record only when its WARC header decodes, its length and checksum agree, and another record or the
end of the file follows; it owns the records that start inside its range and reads past the end of the
range to finish the last one.

Writer: each attempt of a task writes files of its own name. The manifest lists the files of the attempts
that Spark committed, and readers open only those, so a lost executor leaves nothing that is read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import bound_batches, stage
from tillwatch.session import scratch

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Most tasks of a read; more ranges share them.
MOST_TASKS = 100_000
READ_BYTES = 1 << 20

MANIFEST = "file string, bytes bigint, records bigint"
RECORDS = ("page_id bigint, url string, record_type string, record_id string, refers_to bigint, "
           "payload_bytes bigint, payload_digest string, payload binary")


def bare_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_revisits(pages: DataFrame, id_col: str, html_col: str, url_col: str, min_bytes: int = 0) -> DataFrame:
    """Each row with its payload and, if another row's equal payload stands for it, that row's id.

    Of equal payloads of at least ``min_bytes`` the one with the largest id is kept in full; rows that
    repeat that very id are kept in full as well, and a null id is never the largest.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html_col}`").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    kept = rows.groupBy("digest").agg(F.max("page_id").alias("first"))
    other = (F.octet_length("payload") >= min_bytes) & F.col("first").isNotNull() & (
        F.col("page_id").isNull() | (F.col("page_id") < F.col("first")))
    return rows.join(kept, "digest", "left").select(
        "page_id", "url", "payload", F.when(other, F.col("first")).alias("refers_to"))


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(f'{page_id} {digest}'.encode()).digest()[:16], version=5)}>"


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record as one gzip member; a revisit holds the HTTP header alone."""
    digest = bare_digest(payload)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}",
        "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(block)}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}",
                  f"WARC-Profile: {REVISIT_PROFILE}"]
    record = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    # a payload that is itself compressed may shine through; another strategy hides its magic
    for level, strategy in ((6, zlib.Z_DEFAULT_STRATEGY), (9, zlib.Z_HUFFMAN_ONLY), (1, zlib.Z_FIXED)):
        packer = zlib.compressobj(level, zlib.DEFLATED, 31, 8, strategy)
        packed = packer.compress(record) + packer.flush()
        if packed.find(MAGIC, 1) < 0:
            break
    return packed


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_bytes: int = 0, roll_bytes: int = 1 << 30, date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write one record per row below ``path`` (any file system Arrow opens) and return the manifest.

    Null payloads are empty, null urls leave their header out, blanks and control characters of a url are
    percent-encoded, other columns are ignored. An empty table writes no file and gives an empty manifest.
    """

    bound_batches(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = pafs.FileSystem.from_uri(path)
        where.create_dir(root, recursive=True)
        own = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        names, sizes, counts, sink = [], [], [], None
        for batch in batches:
            for row in batch.to_pylist():
                if sink is None or sizes[-1] >= roll_bytes:
                    if sink is not None:
                        sink.close()
                    names.append(f"{own}-{len(names):04d}.warc.gz")
                    sizes.append(0)
                    counts.append(0)
                    sink = where.open_output_stream(f"{root}/{names[-1]}", compression=None)
                data = member(row["page_id"], row["url"], row["payload"], row["refers_to"], date)
                sink.write(data)
                sizes[-1] += len(data)
                counts[-1] += 1
        if sink is not None:
            sink.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
            ["file", "bytes", "records"])

    return stage(with_revisits(pages, id_col, html_col, url_col, min_bytes).mapInArrow(write, MANIFEST), "manifest")


class Window:
    """Reads one file forward from any position, keeping only the bytes in use."""

    def __init__(self, file, size: int, start: int):
        self.file, self.size, self.base, self.data = file, size, start, bytearray()

    def fill(self, upto: int) -> None:
        have = self.base + len(self.data)
        if have < min(upto, self.size):
            more = self.file.read_at(min(max(upto - have, READ_BYTES), self.size - have), have)
            if not more:
                raise ValueError(f"the file ends at {have}, {self.size} bytes were written")
            self.data += more

    def drop(self, before: int) -> None:
        if before - self.base > 4 * READ_BYTES:
            del self.data[:before - self.base]
            self.base = before

    def find_magic(self, at: int, before: int) -> int:
        """Position of the next magic that starts in [at, before), or -1."""
        while at < before:
            self.fill(min(at + READ_BYTES, before) + len(MAGIC) - 1)
            hit = self.data.find(MAGIC, at - self.base)
            if 0 <= hit and hit + self.base < before:
                return hit + self.base
            if self.base + len(self.data) >= min(before + len(MAGIC) - 1, self.size):
                return -1
            at = max(at, self.base + len(self.data) - len(MAGIC) + 1)
        return -1


def parse_header(head: bytes) -> dict[str, str] | None:
    lines = head.split(b"\r\n")
    if not lines[0].startswith(VERSION):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return fields if fields.get("content-length", "").isdigit() else None


def decode_member(win: Window, at: int, whole: bool) -> tuple[dict[str, str], bytes, int] | None:
    """Header, block and end of the record at ``at``; None if there is none. Not ``whole``: header only."""
    unpack, out, pos, head, fields, need, seen = zlib.decompressobj(31), bytearray(), at, -1, {}, 0, 0
    while not unpack.eof:
        win.fill(pos + READ_BYTES // 16)
        chunk = bytes(win.data[pos - win.base:pos - win.base + READ_BYTES // 16])
        if not chunk:
            return None
        try:
            out += unpack.decompress(chunk)
        except zlib.error:
            return None
        pos += len(chunk)
        if head < 0:
            if not bytes(out[:len(VERSION)]) == VERSION[:len(out)]:
                return None
            head = out.find(b"\r\n\r\n", max(0, seen - 3))
            seen = len(out)
            if head >= 0:
                if (found := parse_header(bytes(out[:head]))) is None:
                    return None
                fields, need = found, head + 8 + int(found["content-length"])
                if not whole:
                    return fields, b"", pos
        if head >= 0 and len(out) > need:
            return None
    if head < 0 or len(out) != need or out[-4:] != b"\r\n\r\n":
        return None
    return fields, bytes(out[head + 4:-4]), pos - len(unpack.unused_data)


def records_in(file, size: int, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records that start in [start, end). They follow each other: one that cannot be read is an error, no gap."""
    win, at, expected = Window(file, size, start), start, 0 if start == 0 and size else None
    while (at := win.find_magic(at, min(end, size))) >= 0:
        found = decode_member(win, at, whole=True)
        if found:
            after = found[2]
            win.fill(after + len(MAGIC))
            follows = after >= size or (
                win.data[after - win.base:][:len(MAGIC)] == MAGIC and decode_member(win, after, whole=False))
            if follows:
                if expected not in (None, at):
                    break
                yield found[0], found[1]
                at = expected = after
                win.drop(at)
                continue
        at += 1
    if expected is not None and expected < min(end, size) and at != expected:
        raise ValueError(f"no record can be read at byte {expected}")


def read_archives(
    manifest: DataFrame, path: str, split_bytes: int = 64 << 20, with_payload: bool = True,
) -> DataFrame:
    """All records of the files of a manifest, read in ranges of ``split_bytes``; see ``RECORDS``.

    ``payload_bytes`` and ``payload_digest`` describe the full payload, of revisits too. A payload whose
    digest disagrees with its header fails the job. An empty manifest gives no rows.
    """
    ranges = manifest.select(
        "file", "bytes", F.explode(F.expr(f"sequence(0L, greatest(bytes - 1, 0L), {int(split_bytes)}L)")).alias("start"))
    many = manifest.agg(F.sum(F.expr(f"greatest(bytes - 1, 0L) div {int(split_bytes)}L + 1"))).first()[0] or 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = pafs.FileSystem.from_uri(path)
        names = ["page_id", "url", "record_type", "record_id", "refers_to", "payload_bytes", "payload_digest", "payload"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for name, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with where.open_input_file(f"{root}/{name}") as file:
                    rows, held = [], 0
                    for head, block in records_in(file, size, start, start + split_bytes):
                        said = head.get("warc-payload-digest", "").removeprefix("sha1:")
                        payload = block.partition(b"\r\n\r\n")[2] if head["warc-type"] == "response" else b""
                        if head["warc-type"] == "response" and bare_digest(payload) != said:
                            raise ValueError(f"{name}: the payload of {head['warc-record-id']} does not fit its digest")
                        page, other = head.get("x-page-id"), head.get("x-refers-to-page-id")
                        rows.append((
                            page and int(page), head.get("warc-target-uri"), head["warc-type"], head["warc-record-id"],
                            other and int(other), int(head.get("x-payload-length", len(payload))), said,
                            payload if with_payload else None))
                        held += len(payload)
                        if held > 16 * READ_BYTES or len(rows) >= 10_000:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    # a task per range: the rows that name the ranges are few bytes, whatever they stand for
    return ranges.repartition(min(many, MOST_TASKS)).mapInArrow(scan, RECORDS)


def archive_folder(spark) -> str:
    return scratch(spark, "warc")
