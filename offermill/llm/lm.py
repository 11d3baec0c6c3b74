"""Cross-entropy difference of two n-gram models over one vocabulary.

A target model learns from the target documents, a background model from all documents. Both count
the same words and word pairs: every distinct word and pair of the corpus has a counter of its own, named by
64 bits of hash, so what is counted grows with the input and no two share one at any size. Both smooth
alike: a word's probability is a fixed mix of its share after the word before it, its share of all words, and an
even share (one of EVEN). Shares do not depend on the size of a corpus, so the models match although the
background is larger. The score of a document is its mean loss per word under the target model less that under
the background model: the lower, the more it is like the target.

How it runs. Documents are dealt into blocks of some `block_bytes` of text. A block counts its distinct words and
pairs, sorted, and sends them to parts of the key space, cut so that each holds the counters of some `part_bytes`
of text. A part sums over all blocks and answers every block in the order in which it asked, with counts only. The block
then scores its documents. So a counter meets one row of each block, never one of each occurrence, and
no table is sent to all executors or to the driver.

Defined results: null, empty and wordless texts have n_words 0 and score 0; repeated rows count as often
as they occur, in any blocks; a null doc_id counts for the background and is scored; target ids without a document
teach nothing; without any target word the target model is even, and every score says so; empty input
gives no rows; extra columns are ignored. One text and one block fit a task. `docs` should be a written table:
its rows are dealt by their place in the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from .common import utf8
from .decontam import words_of

MIX = (0.6, 0.35, 0.05)  # after the word before, of all words, even
EVEN = 1 << 18
BLOCK_BYTES = 12 << 20
PART_BYTES = 12 << 20
#: Target ids up to this number are sent to all tasks (8 bytes each); more are dealt like the documents.
MARKS = 1_000_000
_CACHE = 300_000
_BEGIN = np.uint64(1)  # stands before the first word
_ODD = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    """64-bit hashes of words, kept while they are few."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One 64-bit key of two; 0 is left free for the number of all words."""
    x = (first + _ODD) * _OTHER
    x ^= x >> np.uint64(29)
    x = (x + second) * _ODD
    x ^= x >> np.uint64(32)
    return np.maximum(x * _OTHER, np.uint64(1))


@dataclass
class Block:
    """Words and pairs of some texts. `keys` are sorted; `place[i]` is where counter i stands in them.

    Counters are, in this order, all words, each word, each word as the one before, each pair.
    """

    doc: np.ndarray  # the text of every word
    before: np.ndarray
    word: np.ndarray
    pair: np.ndarray
    words: int
    keys: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes], known: _Hashes) -> Block:
        hashed, lengths = [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            words = words_of(text)
            if len(known) > _CACHE:
                known.clear()
            lengths[k] = len(words)
            found = np.empty(len(words) + 1, np.uint64)
            found[0] = _BEGIN
            found[1:] = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            hashed.append(found)
        begins = np.cumsum(lengths + 1) - lengths - 1
        distinct, at = np.unique(np.concatenate(hashed), return_inverse=True)
        word = np.delete(at, begins)
        before = np.delete(at, begins + lengths)
        pairs, pair = np.unique(_mixed(distinct[before], distinct[word]), return_inverse=True)
        none = np.zeros(1, np.uint64)
        keys = np.concatenate([none, _mixed(distinct, none), _mixed(none, distinct), pairs])
        order = np.argsort(keys, kind="stable")
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        return cls(np.repeat(np.arange(len(texts)), lengths), before, word, pair, len(distinct), keys[order], place)

    def counts(self, weight: np.ndarray) -> np.ndarray:
        """How often each key occurs, every occurrence with the weight of its text."""
        each = weight[self.doc]
        n = self.words
        found = [[each.sum()], *(np.bincount(at, each, size) for at, size in (
            (self.word, n), (self.before, n), (self.pair, len(self.keys) - 2 * n - 1)))]
        out = np.empty(len(self.keys))
        out[self.place] = np.concatenate(found)
        return out

    def losses(self, counts: np.ndarray) -> np.ndarray:
        """Loss of each word, in nats, under a model with these counts for `keys`."""
        found, n = counts[self.place].astype(np.float64), self.words
        words, befores, pairs = found[1 : n + 1], found[n + 1 : 2 * n + 1], found[2 * n + 1 :]
        after = pairs[self.pair] / np.maximum(befores[self.before], 1.0)
        return -np.log(MIX[0] * after + MIX[1] * words[self.word] / max(found[0], 1.0) + MIX[2] / EVEN)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers with few high bytes, byte by byte of all of them, compressed."""
    return zstandard.compress(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes(), 1)


def _unpacked(packed: list[bytes]) -> list[np.ndarray]:
    rows = [np.frombuffer(zstandard.decompress(p), np.uint8).reshape(8, -1) for p in packed]
    return [np.ascontiguousarray(r.T).view(np.uint64).ravel() for r in rows]


def _texts(table: pa.Table) -> list[bytes]:
    return table.column("text").to_pylist()


def _dealt(docs: DataFrame, targets: DataFrame, blocks: int) -> DataFrame:
    """(block, doc_id, text, is_target). Repeated rows fall into any blocks: the place of a row is part of the deal."""
    marks = targets.select(F.col("doc_id").alias("_target")).filter("_target IS NOT NULL").distinct()
    marks = F.broadcast(marks) if marks.count() <= MARKS else marks.hint("shuffle_hash")
    # Dealt before the join: a scan gives rows the same places each time, a shuffle does not.
    block = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(blocks)).alias("block")
    rows = docs.select(block, "doc_id", utf8("text").alias("text")).join(marks, F.col("doc_id") == F.col("_target"), "left")
    return rows.select("block", "doc_id", "text", F.col("_target").isNotNull().alias("is_target"))


def _asked(dealt: DataFrame, parts: int) -> DataFrame:
    """(part, block, keys, target, background): what each block counts, one row for each part it has keys of.

    Keys are sent as the steps from one to the next.
    """

    def run(table: pa.Table) -> pa.Table:
        block = Block.of(_texts(table), _Hashes())
        is_target = np.array(table.column("is_target").to_pylist(), np.float64)
        target, background = (block.counts(w).astype(np.uint64) for w in (is_target, np.ones(len(is_target))))
        part = (block.keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        used, first = np.unique(part, return_index=True)
        ends = np.append(first[1:], len(part))
        keys = [_packed(np.diff(block.keys[i:j], prepend=np.uint64(0))) for i, j in zip(first, ends)]
        columns = [keys, *([_packed(a[i:j]) for i, j in zip(first, ends)] for a in (target, background))]
        number = table.column("block")[0].as_py()
        return pa.table(
            [pa.array(used.astype(np.int64)), pa.array([number] * len(used), pa.int64()), *(pa.array(c, pa.binary()) for c in columns)],
            names=["part", "block", "keys", "target", "background"],
        )

    return dealt.groupBy("block").applyInArrow(run, "part long, block long, keys binary, target binary, background binary")


def _answered(asked: DataFrame) -> DataFrame:
    """(block, part, target, background): counts over all blocks, in the order of the keys asked for."""

    def run(table: pa.Table) -> pa.Table:
        asked = [np.cumsum(steps, dtype=np.uint64) for steps in _unpacked(table.column("keys").to_pylist())]
        ends = np.cumsum([len(a) for a in asked])
        keys, at = np.unique(np.concatenate(asked), return_inverse=True)
        columns = []
        for name in ("target", "background"):
            given = np.concatenate(_unpacked(table.column(name).to_pylist()))
            sums = np.bincount(at, given, len(keys)).astype(np.uint64)[at]
            columns.append(pa.array([_packed(sums[e - len(a) : e]) for a, e in zip(asked, ends)], pa.binary()))
        return pa.table([table.column("block"), table.column("part"), *columns], names=["block", "part", "target", "background"])

    return asked.groupBy("part").applyInArrow(run, "block long, part long, target binary, background binary")


def score(docs: DataFrame, targets: DataFrame, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_words, target_loss, background_loss (means per word), score (their difference).

    The sizes set how the work is cut, not the result.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    dealt = _dealt(docs, targets, 1 + size // block_bytes)
    answered = _answered(_asked(dealt, 1 + size // part_bytes))
    kind = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("target_loss", T.DoubleType()), T.StructField("background_loss", T.DoubleType()),
    ])

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block.of(_texts(table), _Hashes())
        answers = answers.sort_by("part")
        n = np.bincount(block.doc, minlength=len(table))
        means = []
        for name in ("target", "background"):
            counts = np.concatenate(_unpacked(answers.column(name).to_pylist()))
            means.append(np.bincount(block.doc, block.losses(counts), len(table)) / np.maximum(n, 1))
        return pa.table([table.column("doc_id"), pa.array(n), *map(pa.array, means)], names=kind.names)

    scored = dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(run, kind)
    return scored.withColumn("score", F.col("target_loss") - F.col("background_loss"))
