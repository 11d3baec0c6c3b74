"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time evaluation.

Every task indexes its documents in blocks of bounded size: the postings of the terms that items ask for. For
each item, the short lists of a block are summed term by term into accumulators. From then on the accumulators
are one iterator among the long lists, with a bound of its own, and all of them are walked document by document
in windows:

* a window whose bounds cannot reach the item's worst held score is skipped;
* in a window, the lists of the least bounds that together cannot reach it yield no candidates; they are only
  looked up for candidates of the others, as long as bounds leave a chance.

A task carries the held documents from block to block, and hands on at most `top` of each item. Those are ranked
by a shuffle on the item.

The score is the sum, over the terms of an item with repeats, of w * ((10^9 * tf) div (1000 * tf + 12 * m)), with
w = floor(1000 * ln((2N + 2) / (2df + 1))) and m = 75 + (25 * n * N) div L. N, L and the df of all asked terms are
counted over all documents first. Items are read in blocks of a bounded number of bytes; each is searched alone.

Defined results: null, empty and term-less texts are no documents of N and are never found; items without terms
find nothing; repeated items are searched each, repeated documents are ranked each; of equal scores the smaller
doc_id comes first, a null doc_id last; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import utf8

TOP = 20
ITEM_BYTES = 4 << 20  # items searched at once
BLOCK_BYTES = 16 << 20  # documents indexed at once
BLOCK_DOCS = 16_384
WINDOW = 256
SHORT = 64  # lists of up to this many documents in a block are summed beforehand

_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Letters and digits, only A-Z lower-cased, and everything beyond ASCII."""
    return text.translate(_TERM_BYTES).split()


@dataclass
class Items:
    """A bounded block of items: the numbers of their terms, each with its repeats."""

    vocabulary: dict[bytes, int]
    asked: list[list[tuple[int, int]]]

    @staticmethod
    def of(texts: list[str | None]) -> Items:
        vocabulary: dict[bytes, int] = {}
        asked = []
        for text in texts:
            counts = Counter(terms_of((text or "").encode()))
            asked.append([(vocabulary.setdefault(t, len(vocabulary)), n) for t, n in counts.items()])
        return Items(vocabulary, asked)

    def found(self, terms: list[bytes]) -> list[int]:
        get = self.vocabulary.get
        return [k for k in map(get, terms) if k is not None]


@dataclass
class Corpus:
    """Counts over all documents."""

    documents: int
    terms: int
    weight: np.ndarray  # of each asked term

    def length(self, n: int) -> int:
        return 75 + 25 * n * self.documents // self.terms


def corpus_counts(docs: DataFrame, items: Items) -> Corpus:
    """One aggregation: a row per asked term and one for the totals comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        df = np.zeros(len(items.vocabulary), np.int64)
        for batch in batches:
            for text in batch.column(0):
                words = terms_of(text.as_py())
                documents += bool(words)
                terms += len(words)
                df[list(set(items.found(words)))] += 1
        used = np.flatnonzero(df)
        term = pa.array([-1, *used.tolist()], pa.int32())
        yield pa.record_batch(
            [term, pa.array([documents, *df[used].tolist()], pa.int64()), pa.array([terms] + [0] * len(used), pa.int64())],
            names=["term", "n", "terms"],
        )

    rows = docs.select(utf8("text")).mapInArrow(run, "term int, n long, terms long")
    summed = {r.term: r for r in rows.groupBy("term").agg(F.sum("n").alias("n"), F.sum("terms").alias("terms")).collect()}
    total = summed.pop(-1, None)
    if total is None or not total.n:
        return Corpus(0, 1, np.zeros(len(items.vocabulary), np.int64))
    df = np.zeros(len(items.vocabulary), np.int64)
    for term, row in summed.items():
        df[term] = row.n
    weight = [math.floor(1000 * math.log((2 * total.n + 2) / (2 * int(n) + 1))) for n in df]
    return Corpus(total.n, total.terms, np.array(weight, np.int64))


class Index:
    """The postings of a block of documents. Documents have places 0, 1, ..."""

    def __init__(self, found: list[list[int]], lengths: list[int], corpus: Corpus):
        self.size = len(found)
        sizes = np.fromiter(map(len, found), np.int64, self.size)
        terms = np.fromiter((k for ks in found for k in ks), np.int64, int(sizes.sum()))
        pairs, tf = np.unique(terms * self.size + np.repeat(np.arange(self.size), sizes), return_counts=True)
        term, self.docs = np.divmod(pairs, self.size)
        m = np.array([corpus.length(n) for n in lengths], np.int64)
        tf = tf.astype(np.int64)
        self.scores = corpus.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[self.docs]))
        listed, first = np.unique(term, return_index=True)
        ends = np.append(first[1:], len(term))
        self.lists = {int(k): (a, b) for k, a, b in zip(listed, first.tolist(), ends.tolist())}
        self.windows = -(-self.size // WINDOW)
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def borders(self, docs: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where windows begin in a list, and the best score in each."""
        at = np.searchsorted(docs, np.arange(self.windows + 1) * WINDOW)
        best = np.zeros(self.windows, np.int64)
        full = np.flatnonzero(at[1:] > at[:-1])
        if len(full):
            best[full] = np.maximum.reduceat(scores, at[full])
        return at, best

    def search(self, asked: list[tuple[int, int]], top: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the block with a score of `least` or more, and all ties of the last place."""
        short, walked = [], []  # walked: documents, scores, repeats, window borders, window bounds
        for term, repeats in asked:
            a, b = self.lists.get(term, (0, 0))
            if b - a > SHORT:
                if term not in self.known:
                    self.known[term] = self.borders(self.docs[a:b], self.scores[a:b])
                at, best = self.known[term]
                walked.append((self.docs[a:b], self.scores[a:b], repeats, at, best * repeats))
            elif b > a:
                short.append((self.docs[a:b], self.scores[a:b] * repeats))
        if short:  # accumulators of the short lists: from here on one list
            docs, place = np.unique(np.concatenate([d for d, _ in short]), return_inverse=True)
            sums = np.zeros(len(docs), np.int64)
            np.add.at(sums, place, np.concatenate([s for _, s in short]))
            walked.append((docs, sums, 1, *self.borders(docs, sums)))
        if not walked:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        bounds = np.array([w[4] for w in walked])
        reach = bounds.sum(axis=0)
        held_docs, held = [], []
        kept = 0
        for window in np.flatnonzero(reach >= least):
            if reach[window] < least:
                continue
            docs, scores = self._window(walked, bounds[:, window], int(window), least)
            if not len(docs):
                continue
            held_docs.append(docs)
            held.append(scores)
            kept += len(docs)
            if kept >= top:
                all_docs, all_scores = np.concatenate(held_docs), np.concatenate(held)
                least = max(least, int(np.partition(all_scores, kept - top)[kept - top]))
                stay = all_scores >= least
                held_docs, held, kept = [all_docs[stay]], [all_scores[stay]], int(stay.sum())
        if not held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(held_docs), np.concatenate(held)

    def _window(self, walked: list[tuple], bound: np.ndarray, window: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(bound, kind="stable")
        below = np.cumsum(bound[order])  # what lists up to this one can add
        first = int(np.searchsorted(below, least))  # lists before it cannot reach `least` together
        base = window * WINDOW
        sums = np.zeros(WINDOW, np.int64)
        is_found = np.zeros(WINDOW, bool)
        for k in order[first:]:
            docs, scores, repeats, at, _ = walked[k]
            a, b = at[window], at[window + 1]
            place = docs[a:b] - base
            sums[place] += scores[a:b] * repeats
            is_found[place] = True
        place = np.flatnonzero(is_found)
        for rank in range(first - 1, -1, -1):
            place = place[sums[place] + below[rank] >= least]
            if not len(place):
                break
            docs, scores, repeats, at, _ = walked[order[rank]]
            a, b = at[window], at[window + 1]
            if b > a:
                spot = np.minimum(a + np.searchsorted(docs[a:b], place + base), b - 1)
                same = docs[spot] == place + base
                sums[place[same]] += scores[spot[same]] * repeats
        place = place[sums[place] >= least]
        return place + base, sums[place]


def _blocks(batches: Iterator[pa.RecordBatch], items: Items) -> Iterator[tuple[pa.Array, list[list[int]], list[int]]]:
    """Ids, asked terms and numbers of terms of documents, in blocks."""
    ids, found, lengths, size = [], [], [], 0
    for batch in batches:
        column = batch.column(0)
        begin = 0
        for k, text in enumerate(batch.column(1)):
            words = terms_of(text.as_py())
            found.append(items.found(words))
            lengths.append(len(words))
            size += len(words) * 8
            if size >= BLOCK_BYTES or len(found) >= BLOCK_DOCS:
                yield pa.concat_arrays([*ids, column.slice(begin, k + 1 - begin)]), found, lengths
                ids, found, lengths, size, begin = [], [], [], 0, k + 1
        ids.append(column.slice(begin))
    if found:
        yield pa.concat_arrays(ids), found, lengths


def _best(docs: DataFrame, items: Items, corpus: Corpus, top: int) -> DataFrame:
    """The best rows of each task: number of the item, doc_id, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple]] = [[] for _ in items.asked]
        kind = None
        for ids, found, lengths in _blocks(batches, items):
            kind = ids.type
            index = Index(found, lengths, corpus)
            # Places by doc_id, null last: ties are cut as they are ranked.
            by_id = np.empty(len(ids), np.int64)
            by_id[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
            for number, asked in enumerate(items.asked):
                best = held[number]
                places, scores = index.search(asked, top, best[-1][0] if len(best) == top else 1)
                if len(places):
                    first = np.lexsort([by_id[places], -scores])[:top]
                    best += zip(scores[first].tolist(), ids.take(pa.array(places[first])).to_pylist())
                    best.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
                    del best[top:]
        if kind is not None:
            rows = [(number, doc, score) for number, best in enumerate(held) for score, doc in best]
            number, doc, score = zip(*rows) if rows else ((), (), ())
            yield pa.record_batch(
                [pa.array(number, pa.int32()), pa.array(doc, kind), pa.array(score, pa.int64())], names=["number", "doc_id", "score"]
            )

    kind = T.StructType([T.StructField("number", T.IntegerType()), docs.schema["doc_id"], T.StructField("score", T.LongType())])
    return docs.select("doc_id", utf8("text").alias("text")).mapInArrow(run, kind)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    narrow = items.select("item_id", "text")
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // item_bytes)
    kind = T.StructType([items.schema["item_id"], T.StructField("number", T.IntegerType())])
    found = []
    for part in range(max(1, parts)):
        # A block of items is dealt by hash; it goes to the driver and, as terms, to the tasks.
        block = narrow if parts <= 1 else narrow.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        rows = block.collect()
        asked = Items.of([r.text for r in rows])
        best = _best(docs, asked, corpus_counts(docs, asked), top)
        place = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(r.item_id, k) for k, r in enumerate(rows)], kind)
        found.append(ranked.join(F.broadcast(names), "number").select("item_id", "rank", "doc_id", "score"))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out
