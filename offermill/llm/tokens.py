"""Token counts and ids of whole texts by compiled tokenizers (see `bpe`).

Defined results: null counts as empty and has no tokens; repeated rows come back once each; a text
of any length is handled whole, in memory that grows with that text alone; special strings inside
texts count as their one token, as the library has it by default; empty input gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import functools
import json
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import bpe

LIMIT = 1024
_PART_CHARS = 2_000_000
_BEYOND = regex.compile("[^\0-\u024f]")


@functools.lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@dataclass
class TextTokenizer:
    """What tasks need of a tokenizer file; the file itself is read by its path in each worker."""

    path: str
    classes: bytes
    specials: dict[str, int]
    lower: bool
    join_space: bool

    @staticmethod
    def of(path: str) -> TextTokenizer:
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        steps = [n["type"] for n in (form["normalizer"] or {"normalizers": []})["normalizers"]]
        if steps not in ([], ["NFC", "Replace", "Lowercase"]) or form["model"]["type"] != "BPE":
            raise ValueError(f"no machine is made for the tokenizer {path}")
        specials = {t["content"]: t["id"] for t in form["added_tokens"]}
        return TextTokenizer(path, bpe.class_table(path), specials, bool(steps), form["pre_tokenizer"]["type"] == "ByteLevel")

    def table(self) -> np.ndarray:
        return np.frombuffer(zlib.decompress(self.classes), np.uint8)

    def _parts(self, texts: list[str]) -> tuple[list[str], np.ndarray, list[tuple[int, int]]]:
        """Texts cut at special strings and normalised, the text of each part, and (part, id) of each
        special string, which follows that part."""
        parts, owner, found = [], [], []
        pattern = regex.compile("|".join(map(regex.escape, self.specials)))
        for k, text in enumerate(texts):
            at = 0
            if any(s in text for s in self.specials):
                for m in pattern.finditer(text):
                    found.append((len(parts), self.specials[m[0]]))
                    parts.append(text[at : m.start()])
                    owner.append(k)
                    at = m.end()
            parts.append(text[at:])
            owner.append(k)
        if self.lower:
            parts = [self._normal(p) for p in parts]
        return parts, np.array(owner, np.int64), found

    def _normal(self, text: str) -> str:
        """Composed and in lower case. Beyond Latin letters the library's own tables decide."""
        if text.isascii():
            return text.lower()
        if _BEYOND.search(text):
            return _library(self.path).normalizer.normalize_str(text)
        return unicodedata.normalize("NFC", text).lower()

    def counts(self, texts: list[str], table: np.ndarray) -> np.ndarray:
        parts, owner, found = self._parts(texts)
        words = bpe.split_words(parts, table, self.join_space)
        numbers, _, _ = bpe.merger(self.path).walk(words.data, words.begins, words.ends)
        total = np.bincount(owner[words.text], numbers, len(texts)).astype(np.int64)
        for part, _ in found:
            total[owner[part]] += 1
        return total

    def ids(self, texts: list[str], table: np.ndarray) -> list[np.ndarray]:
        parts, owner, found = self._parts(texts)
        words = bpe.split_words(parts, table, self.join_space)
        tokens, numbers = bpe.merger(self.path).tokens(words.data, words.begins, words.ends)
        behind = np.cumsum(np.bincount(words.text, numbers, len(parts)).astype(np.int64))
        if found:
            at = [behind[part] for part, _ in found]
            tokens = np.insert(tokens, at, [i for _, i in found])
            behind += np.cumsum(np.bincount([part for part, _ in found], minlength=len(parts)))
        last_part = np.searchsorted(owner, np.arange(len(texts)), side="right") - 1
        return np.split(tokens, behind[last_part][:-1])


def text_parts(texts: Iterable[str], most: int = _PART_CHARS) -> Iterator[list[str]]:
    """Lists of texts with `most` characters at most, or with one longer text."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > most:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def count_column(path: str, column: str = "text") -> Column:
    """The number of tokens of each whole text."""
    tokenizer = TextTokenizer.of(path)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = tokenizer.table()
        for texts in batches:
            found = [tokenizer.counts(part, table) for part in text_parts(texts.to_pylist())]
            yield pa.array(np.concatenate([*found, np.zeros(0, np.int64)]), pa.int64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, T.LongType())(F.coalesce(F.col(column), F.lit("")))


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    counted = docs.select("doc_id", size.alias("n_bytes"), count_column(path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
