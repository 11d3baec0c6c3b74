"""Encoding into the pieces of a sentencepiece BPE model, and decoding.

A model of this type joins, of all neighbours whose joined spelling is a piece, the pair of the best
score, the leftmost first, until none is left. A row of pieces is the encoding of a text exactly when each
two neighbours of it are the encoding of their own joined spelling: as long as no join crosses a border,
those inside any two neighbours come in the same order as they would alone. So every beginning of a text
has one such row at most, and the encoding is found from left to right:

* one pass of an Aho-Corasick automaton over all pieces gives the longest piece at each position, and links
  lead from a piece to its next shorter beginning that is a piece;
* the longest piece that stands behind the one before it is taken; whether two pieces stand side by side is
  tried by joining their letters anew, and remembered;
* where none stands, the position has failed for good: a bit is set, and the piece before is taken back and
  shortened.

Letters that are no piece stand alone and become their bytes. Where no piece of the model has a blank behind
another letter, texts are cut before the blanks that follow a letter; equal cuts of a chunk of texts are encoded once, and different ones are walked side by side.

Defined results: null and empty texts have no ids and decode to the empty text; a blank mark (U+2581) in a
text decodes to a blank, as in the library; repeated rows are encoded each; extra columns are kept.
"""

from __future__ import annotations

import codecs
import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

BLANK = "▁"
MAX_PAIRS = 300_000  # remembered pairs; they are dropped when full, which changes no result
CHUNK = 6 << 20  # bytes of text, or ids times four, that are worked on at once; a text is never cut for it
MATCHES = 1 << 18  # matches of the automaton that are held at once
_MIX = 0x9E3779B97F4A7C1

codecs.register_error("one-by-one", lambda e: ("�", e.start + 1))


class Pieces:
    """A model, compiled for a worker process."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spelling: list[str] = []
        self.written: list[bytes] = []  # what a piece decodes to
        self.score: dict[str, float] = {}
        self.bytes = np.full(256, model.unk_id(), np.int32)
        self.automaton = ahocorasick.Automaton()
        known: dict[str, int] = {}
        for k in range(len(model)):
            piece = model.id_to_piece(k)
            self.spelling.append(piece)
            if model.is_unused(k):
                raise ValueError("models with unused pieces are not supported")
            if model.is_byte(k):
                self.bytes[int(piece[3:5], 16)] = k
                self.written.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(k):
                self.written.append(b"")
            elif model.is_unknown(k):
                self.written.append(" ⁇ ".encode())
            else:
                self.written.append(piece.replace(BLANK, " ").encode())
                self.score[piece] = model.get_score(k)
                known[piece] = k
                self.automaton.add_word(piece, k)
        self.automaton.make_automaton()
        self.none = len(self.spelling)  # stands for a letter that is no piece
        self.spelling.append("")
        self.length = np.array([*map(len, self.spelling[:-1]), 1], np.int64)
        self.shorter = np.full(self.none + 1, -1, np.int32)
        for piece, k in known.items():
            self.shorter[k] = next((known[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in known), -1)
        letters = set("".join(known))
        self.between = next(c for c in map(chr, range(0x10FFFF, 0, -1)) if c not in letters)
        inside = any(BLANK in piece.lstrip(BLANK) for piece in known)
        self.cut = re.compile(".+" if inside else f"{BLANK}*[^{BLANK}]+|{BLANK}+", re.DOTALL)
        self.pairs: dict[int, bool] = {}
        self.slots = np.full(1 << 20, -1, np.int64)  # the pairs used of late, by hash
        self.stands = np.zeros(1 << 20, bool)

    def joined(self, text: str) -> list[str]:
        """The pieces of a short text by joining its letters, best score first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _stand(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether pieces stay whole behind the ones before them (-1: at the begin, or behind a letter that is no piece)."""
        key = (before.astype(np.int64) + 1) << 24 | piece
        slot = (key * _MIX >> 40) & (len(self.slots) - 1)
        missing, out = np.flatnonzero(self.slots[slot] != key), self.stands[slot]
        if len(missing):
            keys, place = np.unique(key[missing], return_inverse=True)
            found = []
            for k in keys.tolist():
                stands = self.pairs.get(k)
                if stands is None:
                    both = [self.spelling[p] for p in ((k >> 24) - 1, k & 0xFFFFFF) if p >= 0]
                    if len(self.pairs) >= MAX_PAIRS:
                        self.pairs.clear()
                    stands = self.pairs[k] = k & 0xFFFFFF == self.none or self.joined("".join(both)) == both
                found.append(stands)
            out[missing] = np.array(found)[place]
            self.slots[slot[missing]], self.stands[slot[missing]] = key[missing], out[missing]
        return out

    def encode_cuts(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all cuts in a row, and how many each has. The cuts are walked side by side."""
        joined = self.between.join(cuts) + self.between
        lengths = np.fromiter(map(len, cuts), np.int64, len(cuts))
        starts = np.cumsum(lengths + 1) - lengths - 1
        stops = starts + lengths
        longest = np.full(len(joined) + 1, self.none, np.int32)
        matches = itertools.chain.from_iterable(self.automaton.iter(joined))
        while len(found := np.fromiter(itertools.islice(matches, 2 * MATCHES), np.int64).reshape(-1, 2)):
            longest[found[:, 0] + 1 - self.length[found[:, 1]]] = found[:, 1]  # later ends overwrite earlier ones: longer pieces
        failed = np.zeros(len(joined) + 1, bool)  # one mark per position
        ended = np.full(len(joined) + 1, -1, np.int32)  # the piece that ends before a position; none before a begin
        lane = np.flatnonzero(lengths)
        at, stop = starts[lane], stops[lane]
        before, guess = np.full(len(lane), -1, np.int32), longest[at]
        while len(at):
            back = np.flatnonzero(guess < 0)
            if len(back):  # nothing stands here: take the piece before back and shorten it
                failed[at[back]] = True
                last = ended[at[back]]
                at[back] -= self.length[last]
                guess[back] = self.shorter[last]
                before[back] = ended[at[back]]
                before[before == self.none] = -1
            tried = np.flatnonzero(guess >= 0)
            end = at[tried] + self.length[guess[tried]]
            good = ~failed[end]
            good[good] = self._stand(before[tried[good]], guess[tried[good]])
            guess[tried[~good]] = self.shorter[guess[tried[~good]]]
            taken, end = tried[good], end[good]
            ended[end] = before[taken] = guess[taken]
            before[before == self.none] = -1
            at[taken], guess[taken] = end, longest[end]
            if (at == stop).any():
                more = at < stop
                at, stop, before, guess = at[more], stop[more], before[more], guess[more]
        # From the ends back to the begins.
        marks = np.zeros(len(joined) + 1, bool)
        lane, at = np.flatnonzero(lengths), stops[lengths > 0]
        while len(at):
            marks[at] = True
            at = at - self.length[ended[at]]
            more = at > starts[lane]
            lane, at = lane[more], at[more]
        ends = np.flatnonzero(marks)
        ids = ended[ends]
        owner = np.searchsorted(stops, ends)
        unknown = np.flatnonzero(ids == self.none)
        if len(unknown):
            spelled = [joined[k - 1].encode() for k in ends[unknown].tolist()]
            times = np.ones(len(ids), np.int64)
            times[unknown] = [len(x) for x in spelled]
            ids, owner = np.repeat(ids, times), np.repeat(owner, times)
            ids[ids == self.none] = self.bytes[np.frombuffer(b"".join(spelled), np.uint8)]
        return ids, np.bincount(owner, minlength=len(cuts))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Equal cuts of the texts are encoded once."""
        number: dict[str, int] = {}
        rows = []
        for text in texts:
            cuts = self.cut.findall(BLANK + text.replace(" ", BLANK)) if text else []
            rows.append(np.array([number.setdefault(c, len(number)) for c in cuts], np.int64))
        ids, sizes = self.encode_cuts(list(number))
        first = np.cumsum(sizes) - sizes
        out = []
        for row in rows:
            own = sizes[row]
            begin = np.cumsum(own) - own
            out.append(ids[np.repeat(first[row] - begin, own) + np.arange(own.sum())])
        return out

    def decode(self, ids) -> str:
        """The text of ids. The blank that encoding puts before a text is taken off again; bytes that are no
        text become replacement marks."""
        written = self.written
        text = b"".join([written[k] for k in ids]).decode("utf-8", "one-by-one")
        first = next((k for k in ids if written[k]), None)
        return text[1:] if first is not None and self.spelling[first].startswith(BLANK) else text


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The model of a worker process; what one task compiled serves the next."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def _in_chunks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of rows of about `most` in sum; a row is never cut."""
    at, total = 0, 0
    for k, n in enumerate(sizes.tolist()):
        if total and total + n > most:
            yield at, k
            at, total = k, 0
        total += n
    yield at, len(sizes)


def _mapped(
    df: DataFrame, column: Column, added: dict[str, T.DataType], each: Callable[[pa.Array], tuple[list, ...]], keep: list[str] | None
) -> DataFrame:
    """Columns of `df` with the columns `added`, which `each` gives for chunks of bounded size."""
    kept = [c for c in (df.columns if keep is None else keep) if c not in added]
    rows = df.select(F.struct(F.lit(True).alias("_"), *(df[c] for c in kept)).alias("_row"), column.alias("_value"))
    arrow = [{"string": pa.string(), "array<int>": pa.list_(pa.int32())}[kind.simpleString()] for kind in added.values()]
    names = ["_row", *added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1)
            sizes = pc.multiply(pc.list_value_length(values), 4) if pa.types.is_list(values.type) else pc.binary_length(values)
            for a, b in _in_chunks(sizes.to_numpy(zero_copy_only=False), CHUNK):
                found = map(pa.array, each(values.slice(a, b - a)), arrow)
                yield pa.record_batch([batch.column(0).slice(a, b - a), *found], names=names)

    schema = T.StructType([rows.schema["_row"], *(T.StructField(name, kind) for name, kind in added.items())])
    mapped = rows.mapInArrow(run, schema)
    return mapped.select(*(F.col("_row").getField(c).alias(c) for c in kept), *added)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (default: all) with the ids of each whole text in a column `ids`."""

    def each(values: pa.Array) -> tuple[list]:
        return (pieces(path).encode(values.to_pylist()),)

    return _mapped(docs, F.coalesce(F.col(text), F.lit("")), {ids: T.ArrayType(T.IntegerType())}, each, keep)


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `encoded` (default: all) with the text of its ids in a column `text`; null ids have none."""

    def each(values: pa.Array) -> tuple[list]:
        model = pieces(path)
        return ([model.decode(v.values.to_numpy(zero_copy_only=False).tolist()) for v in values],)

    return _mapped(encoded, F.coalesce(F.col(ids), F.array().cast("array<int>")), {text: T.StringType()}, each, keep)


def encode_decode(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", keep: list[str] | None = None
) -> DataFrame:
    """`encode` and `decode` of its ids in one pass, so that a task needs one worker and one model, not two."""

    def each(values: pa.Array) -> tuple[list, list]:
        model = pieces(path)
        found = model.encode(values.to_pylist())
        return found, [model.decode(k.tolist()) for k in found]

    added = {ids: T.ArrayType(T.IntegerType()), decoded: T.StringType()}
    return _mapped(docs, F.coalesce(F.col(text), F.lit("")), added, each, keep)
