"""Exact duplicates by Grace hash partitioning and open-addressing tables.

1. Each map task folds equal records of a bounded block together, so a text that fills a third of
   the input leaves a task as one record per block, however many copies there are.
2. The folded records are partitioned by hash into spill files: Spark's shuffle files. The task of
   a partition puts its records into an open-addressing table that compares complete contents.
3. A table takes `table_bytes` of contents. Records it has no room for are written out again and
   partitioned anew by other bits of the hash, until no record is left over. A content is either
   in a table or left over with all its records, so every pass decides whole groups.

Results of a pass are narrow (digest, row to keep, size); the left-over records and the results lie
in the shared folder, so a lost executor repeats one pass's tasks only.

Defined results: null counts as empty, and all empty or blank texts are equal; a null doc_id is the
largest id, so it stays only if no other row is as long; repeated rows with one doc_id count in
group_size, and all of them are kept if that doc_id is; empty input gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import stage
from .common import boxed, frugal, join_hot, release, utf8

BLANKS = b" \t\n\x0b\x0c\r"
TABLE_BYTES = 96 << 20
BLOCK_BYTES = 16 << 20
_NO_ID = (1 << 63) - 1


class ContentTable:
    """Open addressing with linear probing over complete byte strings."""

    def __init__(self, limit: int, slots: int = 1024):
        self.limit = limit
        self.bytes = 0
        self.slots = np.full(slots, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def find(self, h: int, content: bytes) -> int:
        """The number of a content; -1 if it is new and there is no room."""
        mask = len(self.slots) - 1
        at = h & mask
        while (number := int(self.slots[at])) >= 0:
            if self.hashes[number] == h and self.contents[number] == content:
                return number
            at = (at + 1) & mask
        if self.contents and self.bytes + len(content) > self.limit:
            return -1
        number = len(self.contents)
        self.slots[at] = number
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + 64
        if 3 * len(self.contents) > 2 * len(self.slots):
            self._grow()
        return number

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for number, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = number


def sha256(content: bytes) -> bytes:
    return hashlib.sha256(content).digest()


def _place(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little") & _NO_ID


_RECORD = pa.schema(
    [("digest", pa.binary()), ("content", pa.binary()), ("chars", pa.int64()), ("keep", pa.int64()), ("size", pa.int64())]
)
_SPARK_RECORD = "digest binary, content binary, chars long, keep long, size long"


class _Groups:
    """Contents of a table with the best row and the number of rows of each."""

    def __init__(self, limit: int):
        self.table = ContentTable(limit)
        self.digests: list[bytes] = []
        self.best: list[tuple[int, int]] = []  # code points negated, doc_id
        self.sizes: list[int] = []

    def add(self, digest: bytes, content: bytes, chars: int, keep: int, size: int) -> bool:
        number = self.table.find(_place(digest), content)
        if number < 0:
            return False
        if number == len(self.sizes):
            self.digests.append(digest)
            self.best.append((-chars, keep))
            self.sizes.append(size)
        else:
            self.best[number] = min(self.best[number], (-chars, keep))
            self.sizes[number] += size
        return True

    def columns(self) -> list[pa.Array]:
        return [
            pa.array(self.digests, pa.binary()), pa.array(self.table.contents, pa.binary()),
            pa.array([-c for c, _ in self.best], pa.int64()), pa.array([k for _, k in self.best], pa.int64()),
            pa.array(self.sizes, pa.int64()),
        ]


def _normal(texts: pa.Array) -> Iterator[bytes]:
    return (t.as_py().translate(None, BLANKS) for t in texts)


@F.arrow_udf(T.BinaryType())
def _digest(texts: pa.Array) -> pa.Array:
    found = pa.array([sha256(c) for c in _normal(texts)], pa.binary())
    release()
    return found


def _fold(digest_of: Callable[[bytes], bytes], block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _Groups(block_bytes)
        for batch in batches:
            chars, ids = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for content, n, doc in zip(_normal(batch.column(0)), chars, ids):
                digest = digest_of(content)
                if not groups.add(digest, content, n, doc, 1):
                    yield pa.record_batch(groups.columns(), schema=_RECORD)
                    groups = _Groups(block_bytes)
                    groups.add(digest, content, n, doc, 1)
        if groups.sizes:
            yield pa.record_batch(groups.columns(), schema=_RECORD)

    return run


def _tables(table_bytes: int):
    """Decided groups have no content; left-over records still have theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _Groups(table_bytes)
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(5)))
            left = [row for row in rows if not groups.add(*row)]
            if left:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*left), _RECORD)], schema=_RECORD)
        digest, content, *rest = groups.columns()
        for at in range(0, len(digest), 10_000):
            part = [a.slice(at, 10_000) for a in (digest, pa.nulls(len(digest), pa.binary()), *rest)]
            yield pa.record_batch(part, schema=_RECORD)

    return run


def groups(
    docs: DataFrame, table_bytes: int = TABLE_BYTES, block_bytes: int = BLOCK_BYTES, partitions: int | None = None
) -> DataFrame:
    """(digest, chars, keep, size) of each distinct content; keep is doc_id, or the largest long for null."""
    spark = docs.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    records = docs.select(
        utf8("text").alias("text"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"),
    ).mapInArrow(frugal(_fold(sha256, block_bytes), 0), _SPARK_RECORD)
    decided, level = None, 0
    while True:
        dealt = records.repartition(parts, F.xxhash64(F.lit(level), "digest"))
        done = stage(dealt.mapInArrow(frugal(_tables(table_bytes), 1), _SPARK_RECORD), f"grace-{level}")
        found = done.filter("content IS NULL").drop("content")
        decided = found if decided is None else decided.union(found)
        records = done.filter("content IS NOT NULL")
        if records.isEmpty():
            return decided
        level += 1


def exact_duplicates(
    docs: DataFrame, table_bytes: int = TABLE_BYTES, block_bytes: int = BLOCK_BYTES, partitions: int | None = None
) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, digest (SHA-256 of the normalised text).

    Without `partitions` there are as many as let half a table take a partition, so that skewed
    partitions only are partitioned again, and the session's number at least.
    """

    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    members = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest(utf8("text")).alias("digest"), size.alias("bytes"))
    members = stage(members, "digests")
    if partitions is None:
        total = members.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
        partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * total // table_bytes)
    decided = groups(docs, table_bytes, block_bytes, partitions)
    joined = join_hot(members, decided, "digest", "doc_id")
    keep = F.nullif("keep", F.lit(_NO_ID))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.col("size").alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "digest",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay. Rows without doc_id cannot be told apart and all stay."""
    gone = exact_duplicates(docs).filter("NOT kept AND doc_id IS NOT NULL").select("doc_id", "digest").distinct()
    rows = boxed(docs, doc_id=F.col("doc_id").cast("long"), digest=_digest(utf8("text")))
    return rows.join(gone, ["doc_id", "digest"], "left_anti").select("_row.*")
