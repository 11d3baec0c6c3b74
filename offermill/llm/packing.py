"""Packing of tokenised documents into fixed windows by minimum bin slack.

Each task packs the documents of its own partition: nothing is shuffled, and no task sees more than
its share. A document of more than a window first gives whole windows; what remains of each document
is gathered into blocks of bounded size. There every window starts with the longest remainder, and a
subset-sum over a bitset of reachable lengths, with counts traced back through its layers, picks the
remainders that come closest to the free space. The same choice is repeated while the counts last.

If no choice fills the window, one more remainder is cut to fill it. Only the end of a partition
lacks material: its rest is cut into sequences whose lengths are powers of two, which need no padding.

Defined results: null and empty texts are documents of the one closing id; repeated rows and null
doc_ids are packed like others; empty input gives no pieces; extra columns are ignored. sequence_id
holds the partition in its upper bits, so it is unique over all partitions.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import frugal
from .tokens import TextTokenizer, text_parts

CAPACITY = 4096
END_ID = 2
BLOCK_TOKENS = 4_000_000
_YIELD_TOKENS = 1_000_000

#: A piece: document (row of the block), first id, ids.
Piece = tuple[int, int, np.ndarray]


def closest_lengths(counts: dict[int, int], space: int) -> Counter:
    """The multiset of lengths, at most counts[length] of each, whose sum comes closest to `space` from below."""
    full = (1 << (space + 1)) - 1
    reachable, layers = 1, []
    for length in sorted((n for n, c in counts.items() if c and n <= space), reverse=True):
        left, share = min(counts[length], space // length), 1
        while left and not reachable >> space:
            share = min(share, left)
            layers.append((reachable, length, share))
            reachable |= (reachable << (length * share)) & full
            left -= share
            share *= 2
        if reachable >> space:
            break
    total, chosen = reachable.bit_length() - 1, Counter()
    for before, length, share in reversed(layers):
        if not before >> total & 1:
            chosen[length] += share
            total -= length * share
    return chosen


def pack_block(pieces: list[Piece], capacity: int, last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Filled sequences, and the pieces left for the next block; with `last` nothing is left."""
    pool: defaultdict[int, list[Piece]] = defaultdict(list)
    for piece in pieces:
        pool[len(piece[2])].append(piece)
    counts = {n: len(p) for n, p in pool.items()}
    rest = sum(n * c for n, c in counts.items())
    keep = 0 if last else rest // 4
    sequences: list[list[Piece]] = []

    def take(length: int) -> Piece:
        counts[length] -= 1
        if not counts[length]:
            del counts[length]
        return pool[length].pop()

    while counts and rest > keep:
        longest = max(counts)
        others = counts | {longest: counts[longest] - 1}
        chosen = closest_lengths(others, capacity - longest)
        chosen[longest] += 1
        size = sum(n * k for n, k in chosen.items())
        repeats = min(counts[n] // k for n, k in chosen.items()) if size == capacity else 1
        for _ in range(repeats):
            sequences.append([take(n) for n, k in chosen.items() for _ in range(k)])
        rest -= size * repeats
        if size < capacity and counts:  # every other remainder is longer than the gap
            doc, start, ids = take(max(counts))
            gap = capacity - size
            sequences[-1].append((doc, start, ids[:gap]))
            pool[len(ids) - gap].append((doc, start + gap, ids[gap:]))
            counts[len(ids) - gap] = counts.get(len(ids) - gap, 0) + 1
            rest -= gap
        elif size < capacity:
            sequences[-1:] = _powers_of_two(sequences[-1])
    return sequences, [p for n, c in counts.items() for p in pool[n][:c]]


def _powers_of_two(sequence: list[Piece]) -> list[list[Piece]]:
    """The same ids as sequences whose lengths are the powers of two in their number."""
    total = sum(len(ids) for _, _, ids in sequence)
    sizes = [1 << b for b in reversed(range(total.bit_length())) if total >> b & 1]
    out: list[list[Piece]] = [[]]
    free = sizes.pop(0)
    for doc, start, ids in sequence:
        while len(ids):
            if not free:
                out.append([])
                free = sizes.pop(0)
            out[-1].append((doc, start, ids[:free]))
            used = min(free, len(ids))
            start, ids, free = start + used, ids[used:], free - used
    return out


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    tokenizer = TextTokenizer.of(path)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tokenizer.table()
        number = TaskContext.get().partitionId() << 33
        names: list = []  # doc_id and number of ids of the documents of the block
        waiting: list[Piece] = []
        ready: list[list[Piece]] = []
        held = made = 0

        def rows(sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal number
            columns: list[list] = [[], [], [], [], [], [], []]
            for sequence in sequences:
                offset = 0
                for doc, start, ids in sequence:
                    values = (names[doc][0], start, len(ids), ids.tobytes(), names[doc][1], number, offset)
                    for column, value in zip(columns, values):
                        column.append(value)
                    offset += len(ids)
                number += 1
            types = [doc_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        doc_type = pa.int64()
        for batch in batches:
            doc_type = batch.column(0).type
            doc_ids = iter(batch.column(0).to_pylist())
            for part in text_parts(t.as_py() for t in batch.column(1)):
                for ids in tokenizer.ids(part, table):
                    ids = np.append(ids, end_id).astype("<u4")
                    names.append((next(doc_ids), len(ids)))
                    whole = len(ids) - len(ids) % capacity
                    ready += [[(len(names) - 1, at, ids[at : at + capacity])] for at in range(0, whole, capacity)]
                    made += whole
                    if whole < len(ids):
                        waiting.append((len(names) - 1, whole, ids[whole:].copy()))
                        held += len(ids) - whole
                if held >= block_tokens:
                    filled, waiting = pack_block(waiting, capacity, last=False)
                    ready += filled
                    made += held - (held := sum(len(p[2]) for p in waiting))
                if made >= _YIELD_TOKENS:
                    for at in range(0, len(ready), 256):
                        yield rows(ready[at : at + 256])
                    kept = sorted({doc for doc, _, _ in waiting})
                    place = {doc: k for k, doc in enumerate(kept)}
                    names = [names[doc] for doc in kept]
                    waiting = [(place[doc], start, ids) for doc, start, ids in waiting]
                    ready, made = [], 0
        ready += pack_block(waiting, capacity, last=True)[0]
        for at in range(0, len(ready), 256):
            yield rows(ready[at : at + 256])

    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(frugal(run), schema)
