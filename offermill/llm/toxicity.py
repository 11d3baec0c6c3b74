"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text and their beginnings and endings, hashed into 2^BITS places. The
machine scores the terms present in a text by a weight each, and by a product of short vectors for
each pair: a pair may be toxic when neither part is.

Learning takes `max_rows` labelled rows at most, one for each of the documents with the smallest hash of
doc_id: terms are found in parallel, one task fits the bounded sample. Kept are terms that differ between the
classes by `least_z` standard errors alone, and terms of pairs that do so together: of the SCREENED terms
that vary most between rows every pair is tried, and the PAIRS best whose odds ratio differs between the
classes by PAIR_Z standard errors count. Other terms are left out, so unknown words never add up to a
verdict. The model has `max_terms` terms at most, with those of pairs, and goes to the executors with the
closure. Scoring is one pass over whole texts.

Defined results: null and empty texts get the score of a text without known terms; rows without a
doc_id are scored and counted as held out; of several rows of one labelled document the one whose terms
have the smallest hash teaches; labels that are null, or whose document is missing, teach
nothing; of several labels of one document the largest counts; without labels of both classes every
score is the share of label 1, one half if there are none. Extra columns are kept by `keep_clean`.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import boxed, frugal, release, utf8
from .decontam import words_of

BITS = 20
MAX_ROWS = 20_000
MAX_TERMS = 16_384
LEAST_Z = 3.5
LEAST_ROWS = 4
SCREENED = 1024
PAIRS = 64
PAIR_Z = 6.0  # half a million pairs are tried
FACTORS = 8
EPOCHS = 40
THRESHOLD = 0.7
_MASK = (1 << BITS) - 1
_CACHE = 200_000
_SCREEN_ROWS = 2_000


def word_terms(word: bytes) -> list[int]:
    """Places of a word, of its first four to six bytes and of its last four."""
    parts = [b"=" + word]
    parts += [b"^" + word[:n] for n in (4, 5, 6) if len(word) >= n]
    if len(word) >= 4:
        parts.append(b"$" + word[-4:])
    return [zlib.crc32(p) & _MASK for p in parts]


@dataclass
class Machine:
    """score = sigmoid(bias + sum of weights + sum over pairs of vector products); terms ascend."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """rows: of each text, places into `terms`, each once."""
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        places = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
        doc = np.repeat(np.arange(len(rows)), counts)
        linear = np.bincount(doc, self.weights[places], len(rows))
        pairs = np.zeros(len(rows))
        for k in range(self.vectors.shape[1]):
            v = self.vectors[places, k]
            pairs += np.bincount(doc, v, len(rows)) ** 2 - np.bincount(doc, v * v, len(rows))
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + pairs / 2, -30, 30)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that never teach: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def _place_columns(texts: Iterable[bytes], known: bytes | None, cache: dict) -> list[np.ndarray]:
    """Of each text the distinct places, ascending; with `known`, only those marked there."""
    rows = []
    for text in texts:
        found: set[int] = set()
        for word in set(words_of(text)):
            terms = cache.get(word)
            if terms is None:
                terms = tuple(t for t in word_terms(word) if known is None or known[t])
                if len(cache) >= _CACHE:
                    cache.clear()
                cache[word] = terms
            if terms:
                found.update(terms)
        rows.append(np.sort(np.fromiter(found, np.int64, len(found))))
    return rows


def _sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """terms and label of the rows to learn from."""
    chosen = (
        labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic"))
        .filter(~held_out("_id") & F.col("_toxic").isNotNull())
        .groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
        .orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    )

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            rows = _place_columns((t.as_py() for t in batch.column(1)), None, cache)
            found = pa.array([r.astype(np.int32) for r in rows], pa.list_(pa.int32()))
            yield pa.record_batch([batch.column(0), found, batch.column(2)], names=["id", "terms", "label"])

    rows = docs.select("doc_id", utf8("text").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    rows = rows.select(F.col("_id").cast("string").alias("id"), "text", (F.col("_toxic") > 0).cast("int").alias("label"))
    listed = rows.mapInArrow(frugal(terms, 1), "id string, terms array<int>, label int")
    # A task sends one row of an id, however often it is repeated.
    first = F.min(F.struct(F.xxhash64("terms").alias("hash"), "terms", "label"))
    return listed.groupBy("id").agg(first.alias("row")).select("row.terms", "row.label")


def _choose(rows: list[np.ndarray], labels: np.ndarray, least_z: float, max_terms: int) -> np.ndarray:
    """The terms whose share of rows differs between the classes, alone or in pairs, ascending."""
    counts = np.zeros((2, _MASK + 1), np.int64)
    for c in (0, 1):
        own = np.flatnonzero(labels == c)
        for at in range(0, len(own), _SCREEN_ROWS):
            counts[c] += np.bincount(np.concatenate([rows[i] for i in own[at : at + _SCREEN_ROWS]]), minlength=_MASK + 1)
    totals = [(labels == c).sum() for c in (0, 1)]
    odds = [np.log((n + 0.5) / (t - n + 0.5)) for n, t in zip(counts, totals)]
    z = np.abs(odds[1] - odds[0]) / np.sqrt(1 / (counts[0] + 0.5) + 1 / (counts[1] + 0.5))
    z[counts[0] + counts[1] < LEAST_ROWS] = 0
    best = np.argsort(-z, kind="stable")[:max_terms]
    paired = _paired(rows, labels, counts[0] + counts[1])[:max_terms]
    alone = best[z[best] >= least_z]
    return np.union1d(paired, alone[~np.isin(alone, paired)][: max_terms - len(paired)])


def _paired(rows: list[np.ndarray], labels: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The terms of the pairs whose odds ratio differs between the classes, best pairs first."""
    varied = np.minimum(counts, len(rows) - counts)
    tried = np.argsort(-varied, kind="stable")[:SCREENED]
    tried = tried[varied[tried] >= LEAST_ROWS]
    place = np.full(_MASK + 1, -1, np.int64)
    place[tried] = np.arange(len(tried))
    ratio, variance = np.zeros((2, len(tried), len(tried)))
    for c in (0, 1):
        own = [p[p >= 0] for p in (place[rows[i]] for i in np.flatnonzero(labels == c))]
        both = np.zeros((len(tried), len(tried)))
        for at in range(0, len(own), _SCREEN_ROWS):
            block = np.zeros((min(_SCREEN_ROWS, len(own) - at), len(tried)), np.float32)
            for k, r in enumerate(own[at : at + _SCREEN_ROWS]):
                block[k, r] = 1
            both += block.T @ block
        alone = np.diag(both)
        first, second = alone[:, None] - both, alone[None, :] - both
        cells = [both + 0.5, len(own) - both - first - second + 0.5, first + 0.5, second + 0.5]
        ratio += (2 * c - 1) * (np.log(cells[0] * cells[1]) - np.log(cells[2] * cells[3]))
        variance += sum(1 / n for n in cells)
    z = np.triu(np.abs(ratio) / np.sqrt(variance), 1).ravel()
    best = np.argsort(-z, kind="stable")[:PAIRS]
    places = np.stack(np.unravel_index(best[z[best] >= PAIR_Z], variance.shape), axis=1).ravel()
    return tried[list(dict.fromkeys(places.tolist()))]


def learn(rows: list[np.ndarray], labels: np.ndarray, least_z: float = LEAST_Z, max_terms: int = MAX_TERMS) -> Machine:
    """AdaGrad over small batches, in an order fixed by a seed; weights shrink towards zero."""
    share = labels.mean() if len(labels) else 0.5
    if share in (0, 1) or not len(labels):
        return Machine(float(np.log((share + 1e-6) / (1 - share + 1e-6))), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    terms = _choose(rows, labels, least_z, max_terms)
    place = np.full(_MASK + 1, -1, np.int64)
    place[terms] = np.arange(len(terms))
    rows = [p[p >= 0] for p in (place[r] for r in rows)]
    rng = np.random.default_rng(7)
    model = Machine(float(np.log(share / (1 - share))), terms, np.zeros(len(terms)), rng.normal(0, 0.02, (len(terms), FACTORS)))
    past_w, past_v, past_b = np.full(len(terms), 1e-6), np.full((len(terms), FACTORS), 1e-6), 1e-6
    size = 256
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), size):
            picked = order[at : at + size]
            batch = [rows[i] for i in picked]
            error = model.scores(batch) - labels[picked]
            doc = np.repeat(np.arange(len(batch)), [len(r) for r in batch])
            places = np.concatenate(batch)
            sums = np.zeros((len(batch), FACTORS))
            np.add.at(sums, doc, model.vectors[places])
            used, back = np.unique(places, return_inverse=True)
            by_w = np.bincount(back, error[doc], len(used)) / size + 1e-5 * model.weights[used]
            by_v = np.zeros((len(used), FACTORS))
            np.add.at(by_v, back, error[doc, None] * (sums[doc] - model.vectors[places]))
            by_v = by_v / size + 1e-4 * model.vectors[used]
            past_b += (step := error.sum() / size) ** 2
            past_w[used] += by_w**2
            past_v[used] += by_v**2
            model.bias -= 0.2 * step / past_b**0.5
            model.weights[used] -= 0.2 * by_w / np.sqrt(past_w[used])
            model.vectors[used] -= 0.02 * by_v / np.sqrt(past_v[used])
    return model


def _ordered(rows: list[np.ndarray], marks: list[int]) -> list[int]:
    """Places of the rows by label, then bytes; whole rows are copied only where the first terms agree."""

    def first(i: int) -> tuple[int, bytes]:
        return marks[i], rows[i][:16].tobytes()

    order = sorted(range(len(rows)), key=first)
    return [i for _, same in groupby(order, first) for i in sorted(same, key=lambda i: rows[i].tobytes())]


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Machine:
    """Learn on at most `max_rows` labelled rows outside the held-out third."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[np.ndarray] = []
        marks: list[int] = []
        for batch in batches:
            rows += [r.values.to_numpy() for r in batch.column(0)]
            marks += batch.column(1).to_pylist()
        order = _ordered(rows, marks)  # any order of arrival learns the same
        model = learn([rows[i] for i in order], np.array([marks[i] for i in order], np.int64))
        at = range(len(model.terms))
        yield pa.record_batch(
            [
                pa.array([-1, *model.terms.tolist()], pa.int64()), pa.array([model.bias, *model.weights.tolist()], pa.float64()),
                pa.array([[], *(model.vectors[i].tolist() for i in at)], pa.list_(pa.float64())),
            ],
            names=["term", "weight", "vector"],
        )

    found = _sample(docs, labels, max_rows).repartition(1).mapInArrow(frugal(run), "term long, weight double, vector array<double>")
    got = sorted(found.collect())
    vectors = np.array([r.vector for r in got[1:]]).reshape(-1, FACTORS)
    return Machine(got[0].weight, np.array([r.term for r in got[1:]], np.int64), np.array([r.weight for r in got[1:]]), vectors)


def score_column(model: Machine, column: str = "text") -> Column:
    """The score of each whole text, 0 to 1."""
    known = np.zeros(_MASK + 1, np.uint8)
    known[model.terms] = 1
    marks = zlib.compress(known.tobytes())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache: dict = {}
        table = zlib.decompress(marks)
        for texts in batches:
            rows = _place_columns((t.as_py() for t in texts), table, cache)
            found = pa.array(model.scores([np.searchsorted(model.terms, r) for r in rows]), pa.float64())
            del texts
            release()
            yield found

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, T.DoubleType())(utf8(column))


def scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `docs`."""
    model = fit(docs, labels, max_rows)
    scored = docs.select("doc_id", held_out().alias("held_out"), score_column(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` with a score below `threshold`."""
    model = fit(docs, labels)
    return boxed(docs, score=score_column(model)).filter(F.col("score") < threshold).select("_row.*")
