"""WARC archives in seekable Zstandard bundles.

A task writes the records of its partition into bundles of bounded size in the shared folder. A
bundle is a row of independent Zstandard frames, each holding a group of records, and ends in a seek
table: a skippable frame with the compressed and the plain size of every frame. An index table maps
each record's identifier to its bundle, its frame, and its offset inside the frame, so one record is
read by decompressing one frame. Any Zstandard reader can decompress a whole bundle.

Pages with equal payloads are written in full once: the page with the largest id is a `response`,
the others are `revisit` records that name it. The payload's digest and length stand in the headers
of both. Bundles are named by task attempt, and the index names the bundles of the attempts that
count: what a lost executor leaves behind is never read.

Defined results: a null page is an empty payload; a null url leaves out the target; a null page_id
is written as an empty identifier, never a response if another page has its payload, and its revisit
names that page. Repeated rows are written once each; all rows with a group's largest id are
responses. No rows in, no bundle and no rows out. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path, stage
from .common import join_hot, utf8

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 32 << 20
SUFFIX = ".warc.zst"
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the seekable format: a skippable frame, and the footer that closes it.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1

_ENTRY = "page_id long, bundle string, frame long, offset long, length long"
_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _identifier(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(identifier: str) -> int | None:
    number = identifier.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One record; a revisit has the answer's header without the payload."""
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = answer if revisit else answer + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_identifier(page_id)}",
        f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        if _PLAIN_URL.fullmatch(url):
            lines.append(f"WARC-Target-URI: {url}")
        else:
            lines += [f"WARC-Target-URI: {quote(url)}", f"{_ESCAPED}: yes"]
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_identifier(refers_to)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


#: An address of visible ASCII is written as it is; any other is escaped, and marked so that it is read back.
_PLAIN_URL = re.compile(r"[\x21-\x7e]*")
_ESCAPED = "X-Target-URI-Escaped"


def _target(head: dict[str, str]) -> str | None:
    url = head.get("WARC-Target-URI")
    return unquote(url) if url is not None and _ESCAPED in head else url


def records_of(plain: bytes) -> Iterator[tuple]:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload) of each record."""
    at = 0
    while at < len(plain):
        until = plain.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in plain[at:until].decode().split("\r\n")[1:])
        start = until + 4
        block = plain[start : start + int(head["Content-Length"])]
        answer, _, payload = block.partition(b"\r\n\r\n")
        size = int(answer.rpartition(b"Content-Length: ")[2])
        revisit = head["WARC-Type"] == "revisit"
        yield (
            _page_id(head["WARC-Record-ID"]), size, head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"],
            _page_id(head["WARC-Refers-To"]) if revisit else None,
            _target(head), None if revisit else payload,
        )
        at = start + len(block) + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The closing frame for frames of (compressed, plain) sizes."""
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frames_of(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of each frame, from the seek table at the end."""
    count, flags, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE or flags & 0x80:
        raise ValueError("no seek table, or one with checksums")
    table = bundle[-9 - 8 * count : -9]
    out, at = [], 0
    for packed, plain in struct.iter_unpack("<II", table):
        out.append((at, packed, plain))
        at += packed
    return out


class _Bundle:
    """Gathers records into frames, and frames into one file."""

    def __init__(self, name: str, frame_bytes: int):
        self.name, self.frame_bytes = name, frame_bytes
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.plain = bytearray()
        self.entries: list[tuple] = []
        self.written = 0

    def add(self, page_id: int | None, data: bytes) -> None:
        if self.plain and len(self.plain) + len(data) > self.frame_bytes:
            self.close_frame()
        self.entries.append((page_id, self.name, len(self.sizes), len(self.plain), len(data)))
        self.plain += data

    def close_frame(self) -> None:
        if self.plain:
            packed = zstandard.ZstdCompressor(level=3).compress(bytes(self.plain))
            self.frames.append(packed)
            self.sizes.append((len(packed), len(self.plain)))
            self.written += len(packed)
            self.plain.clear()

    def save(self, fs: pafs.FileSystem, folder: str) -> None:
        self.close_frame()
        with fs.open_output_stream(f"{folder}/{self.name}", compression=None) as out:
            for frame in self.frames:
                out.write(frame)
            out.write(seek_table(self.sizes))


def write_bundles(
    pages: DataFrame, folder: str, min_revisit: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> DataFrame:
    """Write all rows of `pages` to bundles below `folder`; gives the index, staged.

    Payloads of fewer than `min_revisit` bytes are always written in full.
    """
    payload = utf8("html")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    keyed = rows.withColumn("digest", F.sha2("payload", 256))
    narrow = keyed.filter(F.octet_length("payload") >= min_revisit).select("page_id", "digest")
    groups = stage(narrow.groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n")), "payloads")
    shared = groups.filter("n > 1 AND response IS NOT NULL").select(F.col("digest").alias("_digest"), "response")
    # Only pages with copies look up their response; their rows are narrow, the payloads stay where they are.
    twins = narrow.join(shared, F.col("digest") == F.col("_digest"), "left_semi")
    answers = join_hot(stage(twins, "twins"), shared.withColumnRenamed("_digest", "digest"), "digest", "page_id")
    answers = answers.filter(~F.col("page_id").eqNullSafe(F.col("response"))).select(
        F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), F.col("response").alias("refers_to")
    )
    answers = answers.distinct()
    told = keyed.join(
        answers, keyed["digest"].eqNullSafe(F.col("_digest")) & keyed["page_id"].eqNullSafe(F.col("_page")), "left"
    ).select("page_id", "url", "payload", "refers_to")
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _file_system(uri)
        fs.create_dir(path, recursive=True)
        task = TaskContext.get()
        made = 0

        def fresh() -> _Bundle:
            return _Bundle(f"part-{task.partitionId():06d}-{made:05d}-{task.taskAttemptId()}{SUFFIX}", frame_bytes)

        def index(entries: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*entries) if entries else [[]] * 5
            return pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["page_id", "bundle", "frame", "offset", "length"]
            )

        bundle = fresh()
        for batch in batches:
            for page_id, url, data, refers_to in zip(*(batch.column(k).to_pylist() for k in range(4))):
                bundle.add(page_id, record(page_id, url, data, refers_to, refers_to is not None))
                if bundle.written + len(bundle.plain) >= bundle_bytes:
                    bundle.save(fs, path)
                    yield index(bundle.entries)
                    made += 1
                    bundle = fresh()
        if bundle.entries:
            bundle.save(fs, path)
            yield index(bundle.entries)

    return stage(told.mapInArrow(run, _ENTRY), "warc-index")


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def _read(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """The bundles that the index names; like a file listing, the names pass through the driver."""
    names = [row.bundle for row in index.select("bundle").distinct().toLocalIterator()]
    return spark.read.format("binaryFile").load([f"{folder}/{name}" for name in names])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def read_bundles(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """All records of the bundles below `folder` that are in the index, frame by frame; a response's payload is checked against its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                for at, packed, plain in frames_of(data):
                    rows = list(records_of(unpack.decompress(data[at : at + packed], max_output_size=plain)))
                    for row in rows:
                        if row[6] is not None and sha1_base32(row[6]) != row[2]:
                            raise ValueError(f"the payload of page {row[0]} does not match its digest")
                    yield _batch(rows)

    return _read(spark, folder, index).select("content").mapInArrow(run, _RECORD)


def read_pages(spark: SparkSession, folder: str, index: DataFrame, page_ids: DataFrame) -> DataFrame:
    """The records of `page_ids` (column page_id) by way of the index: only frames that hold one are decompressed."""
    wanted = index.join(page_ids.select("page_id").distinct(), "page_id", "left_semi")
    places = wanted.groupBy("bundle").agg(F.collect_list(F.struct("frame", "offset", "length")).alias("places"))
    bundles = _read(spark, folder, wanted).withColumn("bundle", F.element_at(F.split("path", "/"), -1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for content, places in zip(batch.column(0), batch.column(1)):
                data, rows = content.as_py(), []
                frames, opened = frames_of(data), (-1, b"")
                for place in sorted(places.as_py(), key=lambda p: (p["frame"], p["offset"])):
                    if opened[0] != place["frame"]:
                        at, packed, plain = frames[place["frame"]]
                        opened = (place["frame"], unpack.decompress(data[at : at + packed], max_output_size=plain))
                    rows += records_of(opened[1][place["offset"] : place["offset"] + place["length"]])
                yield _batch(rows)

    return bundles.join(places, "bundle").select("content", "places").mapInArrow(run, _RECORD)


def round_trip(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """Write all pages to a new folder of bundles and read them back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    index = write_bundles(pages, folder, min_revisit)
    if index.isEmpty():
        return spark.createDataFrame([], _RECORD)
    return read_bundles(spark, folder, index)
