"""Seekable Zstandard WARC bundles (operator 1).

``write`` turns pages into WARC records and packs them into independent Zstandard frames of
about ``FRAME_BYTES``; a footer in the seekable format (a skippable frame with the compressed
and the full size of each frame) makes any frame reachable alone. It returns the record
index: the archive, frame and frame-relative offset of each record. ``read`` goes by the
footers: frames are dealt to tasks, which fetch and decompress only their byte ranges.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with the smallest id
is a response, the others are revisits without payload that refer to it. Only digests and ids meet to
find that; a hot payload is one row per task before the shuffle. The html itself is shuffled once,
by id and digest, so that copies of a hot page spread.

An archive's name holds the task's attempt, so a repeated or speculative task writes another file;
the index names the files that count.

Defined cases: NULL html is an empty payload; rows of one id and payload are alike (all
response, or all revisit); a NULL id is never the smallest and always a response; line ends in urls are
percent-encoded; an empty table makes no archive; columns other than id, url and html are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repweave.llm.common import batch, bounded_batches, materialise, open_fs, shared_path

FRAME_BYTES = 1 << 20
ARCHIVE_BYTES = 1 << 30
MIN_REVISIT = 100
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the seekable format: a skippable frame's and the footer's magic numbers
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = "page_id long, archive string, frame int, frame_at long, frame_bytes long, record_at long, record_bytes long"
INDEX_ARROW = pa.schema([("page_id", pa.int64()), ("archive", pa.string()), ("frame", pa.int32()),
                         ("frame_at", pa.int64()), ("frame_bytes", pa.int64()), ("record_at", pa.int64()),
                         ("record_bytes", pa.int64())])
RECORDS = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
           "archive string, frame int, record_at long")
RECORDS_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                           ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                           ("archive", pa.string()), ("frame", pa.int32()), ("record_at", pa.int64())])

_URN = "urn:page:"


def _urn(page_id: int | None) -> str:
    return f"<{_URN}{'none' if page_id is None else page_id}>"


def _page_id(urn: str) -> int | None:
    name = urn.strip("<>").removeprefix(_URN)
    return None if name == "none" else int(name)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}",
            f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha256:{digest}", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: quote(m.group()), url)}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, bytes, header, block) of each record of a frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        header = dict(x.split(": ", 1) for x in lines[1:])
        size = int(header["Content-Length"])
        stop = end + 4 + size + 4
        yield at, stop - at, header, data[end + 4:end + 4 + size]
        at = stop


class _Archive:
    """Writes one seekable bundle, frame by frame."""

    def __init__(self, path: str):
        self.path = path
        self.files, name = open_fs(path)
        self.files.create_dir(os.path.dirname(name), recursive=True)
        self.out = self.files.open_output_stream(name, compression=None)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.table: list[tuple[int, int]] = []
        self.at = 0

    def frame(self, data: bytes) -> tuple[int, int, int]:
        """Write a frame: its number, offset and compressed size."""
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.table.append((len(packed), len(data)))
        self.at += len(packed)
        return len(self.table) - 1, self.at - len(packed), len(packed)

    def close(self) -> None:
        body = b"".join(struct.pack("<II", *x) for x in self.table) + struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()


def seek_table(path: str) -> list[tuple[int, int, int]]:
    """(offset, compressed, full size) of each frame, from an archive's footer."""
    files, name = open_fs(path)
    with files.open_input_file(name) as f:
        size = f.size()
        f.seek(size - 9)
        n, _, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        f.seek(size - 9 - 8 * n)
        sizes = struct.iter_unpack("<II", f.read(8 * n))
        out, at = [], 0
        for packed, full in sizes:
            out.append((at, packed, full))
            at += packed
        return out


def read_frame(path: str, at: int, size: int) -> bytes:
    files, name = open_fs(path)
    with files.open_input_file(name) as f:
        f.seek(at)
        return zstandard.ZstdDecompressor().decompress(f.read(size))


def read_record(path: str, frame: int, record_at: int) -> tuple[dict[str, str], bytes]:
    """One record by its place in the index: (header, payload)."""
    at, size, _ = seek_table(path)[frame]
    _, _, header, block = next(parse(read_frame(path, at, size)[record_at:]))
    return header, block.split(b"\r\n\r\n", 1)[1]


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", frame_bytes: int = FRAME_BYTES, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write the archives below ``folder`` (a new shared one by default); the record index."""
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = folder or shared_path(spark, "warc")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    narrow = rows.where(F.octet_length("html") >= min_revisit).select("id", "digest")
    first = narrow.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    revisits = materialise(narrow.join(first.select("digest", "first"), "digest").where("id > first")
                           .select("id", "digest", "first").distinct(), "revisits")
    typed = rows.join(revisits, ["id", "digest"], "left").select("id", "url", "html", "digest", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        archive, held, size, made = None, [], 0, 0

        def flush() -> pa.RecordBatch:
            frame, at, packed = archive.frame(b"".join(r for _, r in held))
            out, offset = [], 0
            for i, r in held:
                out.append((i, archive.path, frame, at, packed, offset, len(r)))
                offset += len(r)
            return batch(INDEX_ARROW, [list(c) for c in zip(*out, strict=True)])

        for rb in batches:
            for i, url, html, digest, to in zip(*(c.to_pylist() for c in rb.columns), strict=True):
                if archive is None:
                    archive = _Archive(f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{made}.warc.zst")
                    made += 1
                r = record(i, url, html.encode(), digest, to)
                if held and size + len(r) > frame_bytes:
                    yield flush()
                    held, size = [], 0
                    if archive.at > ARCHIVE_BYTES:
                        archive.close()
                        archive = _Archive(f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{made}.warc.zst")
                        made += 1
                held.append((i, r))
                size += len(r)
        if archive is not None:
            if held:
                yield flush()
            archive.close()

    return materialise(typed.mapInArrow(run, INDEX), "warc-index")


#: Compressed bytes that one task reads back.
READ_BYTES = 128 << 20


def read(archives: DataFrame, archive_col: str = "archive") -> DataFrame:
    """All records of the archives named in a frame. Payloads of responses are digested and
    held against their header; a revisit's size and digest are those of its response."""
    listed = archives.select(F.col(archive_col).alias("archive")).distinct()
    frames_arrow = pa.schema([("archive", pa.string()), ("frame", pa.int32()), ("at", pa.int64()), ("size", pa.int64())])

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for path in rb.column(0).to_pylist():
                table = seek_table(path)
                yield batch(frames_arrow, [[path] * len(table), list(range(len(table))), [t[0] for t in table],
                                           [t[1] for t in table]])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for path, frame, at, size in zip(*(c.to_pylist() for c in rb.columns), strict=True):
                out = []
                for offset, _, header, block in parse(read_frame(path, at, size)):
                    digest = header["WARC-Payload-Digest"].removeprefix("sha256:")
                    kind, payload = header["WARC-Type"], block.split(b"\r\n\r\n", 1)[1]
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{path}: the payload in frame {frame} at {offset} is not what its digest says")
                    out.append((_page_id(header["WARC-Record-ID"]), header.get("WARC-Target-URI"), kind,
                                len(payload) if kind == "response" else None, digest,
                                _page_id(header["WARC-Refers-To"]) if kind == "revisit" else None, path, frame, offset))
                yield batch(RECORDS_ARROW, [list(c) for c in zip(*out, strict=True)])

    table = materialise(listed.mapInArrow(frames, "archive string, frame int, at long, size long"), "warc-frames")
    size = table.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    # a stated number of tasks: adaptive execution would merge the tiny rows that name large frames
    tasks = max(1, min(size["n"], table.sparkSession.sparkContext.defaultParallelism), -(-(size["bytes"] or 0) // READ_BYTES))
    dealt = table.repartition(tasks, "archive", "frame")
    found = materialise(dealt.mapInArrow(records, RECORDS), "warc-records")
    sizes = (found.where("record_type = 'response' and page_id is not null").groupBy("page_id", "payload_digest")
             .agg(F.max("payload_bytes").alias("size"))
             .select(F.col("page_id").alias("refers_to"), "payload_digest", "size"))
    return found.join(sizes, ["refers_to", "payload_digest"], "left").withColumn(
        "payload_bytes", F.coalesce("payload_bytes", "size")).drop("size")
