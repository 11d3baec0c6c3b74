"""Phrase collocation mining by multikey three-way quicksort of suffix pointers.

Every word of a piece of text begins a suffix of at most `most_words` words. A first pass counts words, and looks for
leading words and pairs that come so often that their suffixes would crowd one partition. Suffixes are then routed by
their first word, those of crowded words by the first two, of crowded pairs by the first three, so that all suffixes
that share enough leading words meet in one partition. On the way equal suffixes of a block of documents are folded
to one with a number.

In a partition the suffix pointers are sorted by multikey quicksort to the maximum depth: a group is parted by one
word into less, equal and greater; equal ones go on with the next word. The sizes of the equal parts are the counts of
phrases. Parts below the least count are abandoned, since no phrase in them can reach it. All groups of a partition
are parted at once by array operations.

What comes out are all phrases of the least count or more, few enough to be joined with the counts of their parts.

Defined results: null and empty texts have no words; a null language is `und`; repeated rows count each; words end at
blanks and tabs, pieces at punctuation and line ends, and no phrase crosses those; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.numbering import number_rows
from ..session import stage
from .common import join_hot, utf8

LEAST = 10
WORDS = 3
TOP = 2000
BLOCK_BYTES = 8 << 20  # of text folded at once
PART_BYTES = 24 << 20  # of text per partition of the sort
CROWDED = 1_000  # a leading word or pair with more than one in so many of all words is routed deeper
_HEAVY = 2_000  # pairs with more than one in so many words of a block are named by the block

#: Ends of pieces become full stops, tabs blanks, A-Z small letters.
_BYTES = bytes(46 if chr(c) in ".,;:!?\n\v\f\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


class Words:
    """The words of a block of texts of one language as numbers from 1 on, in a row; 0 stands between pieces."""

    def __init__(self, texts: list[bytes]):
        vocabulary: dict[bytes, int] = {b".": 0}
        number = vocabulary.setdefault
        ids: list[np.ndarray] = []
        for text in texts:
            words = text.translate(_BYTES).replace(b".", b" . ").split(b" ")
            ids.append(np.array([number(w, len(vocabulary)) for w in words if w] + [0], np.int32))
        self.row = np.concatenate([*ids, np.zeros(WORDS, np.int32)])
        self.words = list(vocabulary)
        self.n = len(self.words)

    def suffixes(self) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
        """The distinct suffixes, as words at each depth, and how often they come."""
        at = np.flatnonzero(self.row)
        second = self.row[at + 1]
        # A vocabulary of a block is far below 2^21, so three words fit one number.
        both = self.row[at].astype(np.int64) * self.n + second
        found, counts = np.unique(both * self.n + np.where(second > 0, self.row[at + 2], 0), return_counts=True)
        both, third = np.divmod(found, self.n)
        first, second = np.divmod(both, self.n)
        return tuple(c.astype(np.int32) for c in (first, second, third)), counts

    def leading(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How often each word comes; pairs that are frequent here, as first * n + second; how often those come."""
        counts = np.bincount(self.row, minlength=self.n)
        counts[0] = 0
        total = int(counts.sum())
        often = counts * _HEAVY > total
        at = np.flatnonzero(often[self.row[:-1]] & often[self.row[1:]])
        pairs, number = np.unique(self.row[at].astype(np.int64) * self.n + self.row[at + 1], return_counts=True)
        heavy = number * _HEAVY > total
        return counts, pairs[heavy], number[heavy]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """Blocks of the texts of a language, from columns lang and text."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}

    def block(lang: str) -> tuple[str, Words]:
        del sizes[lang]
        return lang, Words(held.pop(lang))

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            held.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text)
            if sizes[lang] >= BLOCK_BYTES:
                yield block(lang)
            elif sum(sizes.values()) >= 4 * BLOCK_BYTES:
                yield block(max(sizes, key=sizes.get))
    for lang in list(held):
        yield block(lang)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), utf8("text").alias("text"))


def leading_counts(docs: DataFrame) -> DataFrame:
    """(lang, first, second, n): all words with their counts (second null), and pairs that are frequent in a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in _blocks(batches):
            counts, pairs, weight = block.leading()
            used = np.flatnonzero(counts)
            a, b = np.divmod(pairs, block.n)
            columns = [
                pa.array([lang] * (len(used) + len(a)), pa.string()),
                pa.array([block.words[k] for k in used] + [block.words[k] for k in a], pa.binary()),
                pa.array([None] * len(used) + [block.words[k] for k in b], pa.binary()),
                pa.array([*counts[used].tolist(), *weight.tolist()], pa.int64()),
            ]
            yield pa.record_batch(columns, names=["lang", "first", "second", "n"])

    counted = _rows(docs).mapInArrow(run, "lang string, first binary, second binary, n long")
    return counted.groupBy("lang", "first", "second").agg(F.sum("n").alias("n"))


def _hash(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def _crowded(leading: DataFrame) -> tuple[set, set, dict[str, int]]:
    """Crowded words, crowded pairs, and the number of words of each language. There are less than CROWDED of either,
    whatever the input."""
    totals = {r.lang: r.n for r in leading.filter("second IS NULL").groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    limit = max(1, sum(totals.values()) // CROWDED)
    often = leading.filter(F.col("n") > limit).select("lang", "first", "second").collect()
    words = {(r.lang, bytes(r.first)) for r in often if r.second is None}
    return words, {(r.lang, bytes(r.first), bytes(r.second)) for r in often if r.second is not None}, totals


def routed(docs: DataFrame, words: set, pairs: set, parts: int) -> DataFrame:
    """(part, lang, vocabulary, first, second, third, n): per block and partition, suffixes as numbers of listed words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in _blocks(batches):
            columns, counts = block.suffixes()
            first, second, third = columns
            h = _hash([lang.encode() + b"\0" + w for w in block.words])
            deep = np.array([(lang, w) in words for w in block.words])[first]
            route = h[first]
            route = np.where(deep, route * np.uint64(0x9E3779B97F4A7C15) + h[second], route)
            place = {w: k for k, w in enumerate(block.words)}
            crowded = [np.int64(place[a]) * block.n + place[b] for x, a, b in pairs if x == lang and a in place and b in place]
            if crowded:
                deeper = np.isin(first.astype(np.int64) * block.n + second, crowded)
                route = np.where(deeper, route * np.uint64(0x9E3779B97F4A7C15) + h[third], route)
            part = (route ^ (route >> np.uint64(31))) % np.uint64(parts)
            order = np.argsort(part, kind="stable")  # suffixes of a part stay in their order
            cuts = np.flatnonzero(np.diff(part[order], prepend=parts + 1))
            for a, b in zip(cuts, [*cuts[1:], len(order)]):
                own = order[a:b]
                used, numbers = np.unique(np.concatenate([c[own] for c in columns]), return_inverse=True)
                lists = [pa.array([x], pa.list_(pa.int32())) for x in (*numbers.astype(np.int32).reshape(3, -1), counts[own].astype(np.int32))]
                spelled = pa.array([[block.words[k] for k in used]], pa.list_(pa.binary()))
                yield pa.record_batch(
                    [pa.array([int(part[own[0]])], pa.int32()), pa.array([lang], pa.string()), spelled, *lists],
                    names=["part", "lang", "vocabulary", "first", "second", "third", "n"],
                )

    kind = "part int, lang string, vocabulary array<binary>, first array<int>, second array<int>, third array<int>, n array<int>"
    return _rows(docs).mapInArrow(run, kind)


def equal_parts(columns: list[np.ndarray], weight: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of pointers into `columns`, the words at each depth; 0 ends a suffix.

    Gives (depth, pointers, sizes): of each equal part of at least `least`, its depth counted from 1, one of its
    pointers, and its size. A group is parted by the word of a pointer in its middle.
    """
    deep = np.stack(columns)
    pointers = np.arange(len(weight))
    sizes = np.array([len(weight)])
    depth = np.zeros(1, np.int64)
    while len(pointers):
        starts = np.cumsum(sizes) - sizes
        group = np.repeat(np.arange(len(sizes)), sizes)
        word = deep[depth[group], pointers]
        # The median of three pointers of a group.
        three = np.stack([word[starts], word[starts + sizes // 2], word[starts + sizes - 1]])
        pivot = three.sum(axis=0) - three.max(axis=0) - three.min(axis=0)
        side = np.sign(word - pivot[group]) + 1
        key = group * 3 + side
        totals = np.bincount(key, weight[pointers], 3 * len(sizes)).astype(np.int64)
        numbers = np.bincount(key, minlength=3 * len(sizes))
        kept = totals >= least
        kept[1::3] &= pivot > 0
        equal = np.flatnonzero(kept[1::3])
        if len(equal):
            one = np.zeros(len(sizes), np.int64)
            same = side == 1
            one[group[same]] = pointers[same]
            for level in np.unique(depth[equal]):
                own = equal[depth[equal] == level]
                yield int(level) + 1, one[own], totals[1::3][own]
        # What goes on: less and greater parts at their depth, equal ones a word deeper.
        following = np.repeat(depth, 3)
        following[1::3] += 1
        kept &= following < len(columns)
        stays = kept[key]
        pointers, key = pointers[stays], key[stays]
        sizes, depth = numbers[kept], following[kept]
        pointers = pointers[np.argsort(key.astype(np.int32), kind="stable")]


def _phrases_of(batches: Iterator[pa.RecordBatch], pairs: set, least: int) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[dict, list[list[np.ndarray]]]] = {}  # one vocabulary for the suffixes of all blocks
    for batch in batches:
        for k, lang in enumerate(batch.column(1).to_pylist()):
            known, lists = held.setdefault(lang, ({b".": 0}, [[], [], [], []]))
            spelled = batch.column(2)[k].values.to_pylist()
            numbers = np.fromiter((known.setdefault(w, len(known)) for w in spelled), np.int32, len(spelled))
            for j in range(WORDS):
                lists[j].append(numbers[batch.column(3 + j)[k].values.to_numpy(zero_copy_only=False)])
            lists[WORDS].append(batch.column(3 + WORDS)[k].values.to_numpy(zero_copy_only=False).copy())
    while held:
        lang, (known, lists) = held.popitem()
        *columns, weight = map(np.concatenate, lists)
        del lists
        words = list(known)
        split = {(known[a], known[b]) for x, a, b in pairs if x == lang and a in known and b in known}
        for depth, pointers, sizes in equal_parts(columns, weight, least):
            if depth == 1:
                continue  # counted by the first pass
            spelled = [[words[i] for i in columns[d][pointers].tolist()] if d < depth else [None] * len(pointers) for d in range(WORDS)]
            if depth == 2 and split:
                whole = [(int(columns[0][p]), int(columns[1][p])) not in split for p in pointers]
                pick = np.flatnonzero(whole)
                spelled, sizes = [[x[i] for i in pick] for x in spelled], sizes[pick]
            yield _counted(lang, spelled, sizes)
        for a, b in split:  # pairs dealt over partitions: each gives its share
            share = weight[(columns[0] == a) & (columns[1] == b)].sum()
            if share:
                yield _counted(lang, [[words[a]], [words[b]], [None]], np.array([share]))


def _counted(lang: str, spelled: list[list], sizes: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([lang] * len(sizes), pa.string()), *(pa.array(x, pa.binary()) for x in spelled), pa.array(sizes, pa.int64())]
    return pa.record_batch(columns, names=["lang", "w1", "w2", "w3", "n"])


def frequent(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Words (lang, w1, n) and phrases (lang, w1, w2, w3 or null, n) of at least `least`; words in all per language."""
    spark = docs.sparkSession
    leading = stage(leading_counts(docs), "phrase-words")
    words, pairs, totals = _crowded(leading)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    dealt = routed(docs, words, pairs, parts).repartitionById(parts, "part")
    counted = dealt.mapInArrow(lambda batches: _phrases_of(batches, pairs, least), "lang string, w1 binary, w2 binary, w3 binary, n long")
    counted = stage(counted.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "phrase-counts")
    return leading.filter(F.col("second").isNull() & (F.col("n") >= least)).select("lang", F.col("first").alias("w1"), "n"), counted, totals


def _key(*columns: str) -> Column:
    """One key of a language and words."""
    return F.concat_ws("\0", "lang", *(F.hex(c) for c in columns))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two and three words of each language.

    With a = f(phrase), and l and r the counts of the parts of a cut, the score of a cut is floor(10^6 * a * a / (l * r));
    the cut of the lowest score counts, of equal ones the first. A phrase inside a longer one that comes at least
    half as often is dropped.
    """
    words, counted, totals = frequent(docs, least)
    spark = docs.sparkSession
    ones = words.select(_key("w1").alias("key"), F.col("n").alias("f"))
    twos = counted.filter("w3 IS NULL")
    threes = counted.filter("w3 IS NOT NULL")

    def with_count(rows: DataFrame, table: DataFrame, columns: list[str], name: str) -> DataFrame:
        keyed = stage(rows.withColumn("key", _key(*columns)), "phrase-keys")
        return join_hot(keyed, table.withColumnRenamed("f", name), "key", "id").drop("key")

    named = F.xxhash64("lang", "w1", "w2", "w3").alias("id")
    pairs = twos.select("*", named)
    pairs = with_count(with_count(pairs, ones, ["w1"], "l1"), ones, ["w2"], "r1")
    two_counts = twos.select(_key("w1", "w2").alias("key"), F.col("n").alias("f"))
    triples = threes.select("*", named)
    for columns, name, table in ((["w1"], "l1", ones), (["w2", "w3"], "r1", two_counts), (["w1", "w2"], "l2", two_counts), (["w3"], "r2", ones)):
        triples = with_count(triples, table, columns, name)
    longest = threes.select(_key("w1", "w2").alias("key"), "n").union(threes.select(_key("w2", "w3").alias("key"), "n"))
    longest = longest.groupBy("key").agg(F.max("n").alias("longer"))
    alone = pairs.withColumn("key", _key("w1", "w2")).join(longest, "key", "left").filter("longer IS NULL OR 100 * longer < 50 * n")

    def score(left: str, right: str) -> Column:
        """In decimals: products of counts may pass 64 bits."""
        n, l, r = (f"CAST({c} AS DECIMAL(15,0))" for c in ("n", left, right))
        return F.expr(f"CAST(1000000 AS DECIMAL(7,0)) * {n} * {n} DIV ({l} * {r})")

    both = alone.select("lang", "w1", "w2", "w3", "n", F.col("l1").alias("l"), F.col("r1").alias("r"), score("l1", "r1").alias("score"))
    cut = F.when(score("l1", "r1") <= score("l2", "r2"), F.struct(F.col("l1").alias("l"), F.col("r1").alias("r"), score("l1", "r1").alias("score")))
    cut = cut.otherwise(F.struct(F.col("l2").alias("l"), F.col("r2").alias("r"), score("l2", "r2").alias("score")))
    both = both.union(triples.withColumn("cut", cut).select("lang", "w1", "w2", "w3", "n", "cut.l", "cut.r", "cut.score"))
    phrase = F.concat_ws(" ", *(F.decode(c, "UTF-8") for c in ("w1", "w2", "w3")))
    both = both.select("lang", phrase.alias("phrase"), F.col("n").alias("a"), "l", "r", "score")
    # A language may hold a third of all rows or more: places come from a range shuffle, not from a window.
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    best = number_rows(stage(both, "phrase-scores"), ["lang"], order, "rank").filter(F.col("rank") <= top)
    sizes = F.broadcast(spark.createDataFrame(list(totals.items()), "lang string, n long"))
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
