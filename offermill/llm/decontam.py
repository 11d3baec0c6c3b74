"""Benchmark decontamination by a hash set of test n-grams.

Test items are cut into windows of `n` words. The windows of one block of items make a sorted array
of hashes, which goes to the executors with the closure. A training text is scanned as an array of
word numbers; window hashes are looked up first, then the words are compared, so a hash collision
never counts. What is sent is bounded: a block holds `block_words` item words at most, and a larger
benchmark is scanned in several blocks, whose hits are merged.

Hits come as spans of words and of characters per document and can be removed as spans or as documents.

Defined results: null and wordless texts have no words and no hits; null, empty and repeated items
count as given (a repeated window names every item that has it; null item ids are left out of the
list of ids, their hits count); an empty benchmark hits nothing; extra columns are ignored by `scan`
and kept by `remove_documents` and `remove_spans`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import boxed

N = 10
BLOCK_WORDS = 200_000

#: Bytes of words: letters (as lower case), digits, and everything beyond ASCII.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def words_of(text: bytes) -> list[bytes]:
    # Split at the blank alone: no other white space is left, and bytes beyond ASCII are parts of words.
    return [w for w in text.translate(_WORD_BYTES).split(b" ") if w]


def _roll(numbers: np.ndarray, width: int) -> np.ndarray:
    """A hash of each stretch of `width` numbers."""
    n = len(numbers) - width + 1
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * _BASE + numbers[k : k + n]
    return out ^ (out >> np.uint64(29))


@dataclass
class WindowSet:
    """The windows of a block of items: by width, sorted hashes, their words, and the items that have them."""

    vocabulary: dict[bytes, int]
    widths: dict[int, tuple[np.ndarray, np.ndarray, list[list], np.ndarray]]

    @staticmethod
    def of(items: list[tuple], n: int) -> WindowSet:
        vocabulary: dict[bytes, int] = {}
        found: dict[int, dict[tuple, set]] = {}
        for item, text in items:
            numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
            width = min(n, len(numbers))
            if width:
                for at in range(len(numbers) - width + 1):
                    found.setdefault(width, {}).setdefault(tuple(numbers[at : at + width]), set()).add(item)
        widths = {}
        for width, windows in found.items():
            rows = np.array(list(windows), np.uint64)
            hashes = np.array([_roll(row, width)[0] for row in rows], np.uint64)
            order = np.argsort(hashes, kind="stable")
            owners = [sorted((i for i in windows[tuple(map(int, rows[k]))] if i is not None), key=str) for k in order]
            bits = np.zeros(1 << 20, bool)
            bits[hashes & np.uint64((1 << 20) - 1)] = True
            widths[width] = (hashes[order], rows[order], owners, bits)
        return WindowSet(vocabulary, widths)

    def scan(self, texts: list[bytes]) -> tuple[list[int], list[np.ndarray], list[set]]:
        """Of each text: its number of words, the numbers of its hit words, the items with occurring windows."""
        counts, parts = [], []
        get = self.vocabulary.get
        for text in texts:
            words = words_of(text)
            counts.append(len(words))
            parts.append(np.fromiter((get(w, 0) for w in words), np.uint64, len(words)))
        numbers = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        ends = np.cumsum(counts)
        cover = np.zeros(len(numbers) + 1, np.int32)
        items: list[set] = [set() for _ in texts]
        for width, (hashes, rows, owners, bits) in self.widths.items():
            if len(numbers) < width:
                continue
            rolled = _roll(numbers, width)
            at = np.flatnonzero(bits[rolled & np.uint64((1 << 20) - 1)])
            doc = np.searchsorted(ends, at, side="right")
            inside = at + width <= ends[doc]
            at, doc = at[inside], doc[inside]
            first, last = (np.searchsorted(hashes, rolled[at], side=s) for s in ("left", "right"))
            for start, d, lo, hi in zip(at, doc, first, last):  # windows that share a hash with an item's
                for k in range(lo, hi):
                    if (rows[k] == numbers[start : start + width]).all():
                        items[d].update(owners[k])
                        cover[start] += 1
                        cover[start + width] -= 1
        hit = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        cuts = np.searchsorted(hit, ends)
        begins = ends - counts
        hits = [hit[a:b] - begin for a, b, begin in zip([0, *cuts[:-1]], cuts, begins)]
        return counts, hits, items


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple]]:
    """Items in blocks of bounded size; they come to the driver one partition at a time."""
    block, size = [], 0
    rows = benchmark.select("item_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("t"))
    for item, text in rows.toLocalIterator():
        n = len(words_of(bytes(text)))
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((item, bytes(text)))
        size += n
    yield block


def _spans(hit: np.ndarray) -> list[dict]:
    """Stretches of neighbouring words: first and one past the last."""
    if not len(hit):
        return []
    cut = np.flatnonzero(np.diff(hit) > 1)
    return [{"start": int(a), "end": int(b) + 1} for a, b in zip(hit[[0, *(cut + 1)]], hit[[*cut, len(hit) - 1]])]


def scan(docs: DataFrame, benchmark: DataFrame, n: int = N, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit, spans (of hit words), items (ids as strings, sorted)."""
    marked = docs.select("doc_id", _marked(docs, benchmark, n, block_words).alias("f"))
    length = F.aggregate("f.spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"])
    return marked.select("doc_id", "f.n_words", length.alias("n_hit"), "f.spans", "f.items")


def _marked(docs: DataFrame, benchmark: DataFrame, n: int, block_words: int) -> Column:
    text = F.encode(F.coalesce(docs["text"], F.lit("")), "UTF-8")
    out = None
    for items in _blocks(benchmark, block_words):
        out = _finder(WindowSet.of(items, n), out is not None)(text, *([] if out is None else [out]))
    return out


def _finder(windows: WindowSet, merge: bool):
    """An Arrow UDF over texts, and the findings of earlier blocks if `merge`."""
    kind = T.StructType([
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ])
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    arrow = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.string()))])

    def found(texts: pa.Array, earlier: pa.Array | None = None) -> pa.Array:
        counts, hits, items = windows.scan(texts.to_pylist())
        before = earlier.to_pylist() if earlier is not None else [None] * len(counts)
        rows = []
        for count, hit, item, old in zip(counts, hits, items, before):
            names = set(map(str, item))
            if old:
                hit = np.unique(np.concatenate([hit, *(np.arange(s["start"], s["end"]) for s in old["spans"])]))
                names.update(old["items"])
            rows.append({"n_words": count, "spans": _spans(hit), "items": sorted(names)})
        return pa.array(rows, arrow)

    if merge:
        def two(texts: pa.Array, earlier: pa.Array) -> pa.Array:
            return found(texts, earlier)

        return F.arrow_udf(two, kind)

    def one(texts: pa.Array) -> pa.Array:
        return found(texts)

    return F.arrow_udf(one, kind)


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = N, least_hits: int = 1) -> DataFrame:
    """The rows of `docs` with fewer than `least_hits` hit words."""
    hits = F.aggregate("found.spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"])
    return boxed(docs, found=_marked(docs, benchmark, n, BLOCK_WORDS)).filter(hits < least_hits).select("_row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """`docs` without their hit words; what stands between two words of a span goes too, the rest stays."""

    @F.arrow_udf(T.StringType())
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array([_cut(t, f["spans"]) for t, f in zip(texts.to_pylist(), found.to_pylist())], pa.string())

    rows = boxed(docs, found=_marked(docs, benchmark, n, BLOCK_WORDS))
    text = F.when(F.size("found.spans") > 0, cut(F.col("_row.text"), F.col("found"))).otherwise(F.col("_row.text"))
    return rows.select(*(text.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns))


def _cut(text: str | None, spans: list[dict]) -> str | None:
    if not spans:
        return text
    raw = text.encode()
    is_word = np.frombuffer(raw.translate(_WORD_BYTES), np.uint8) != 32
    edges = np.diff(is_word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    out, at = [], 0
    for span in spans:
        out.append(raw[at : starts[span["start"]]])
        at = int(ends[span["end"] - 1])
    return b"".join([*out, raw[at:]]).decode()
