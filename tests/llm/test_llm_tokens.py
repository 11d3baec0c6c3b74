"""Compiled tokenizers against the library, and the pieces of packed sequences."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from offermill.llm import bpe, packing, tokens

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")
ALPHABET = "abc'strevmld  \n\t .,!?0129éÉñß漢字́ ​İΣς𝔘😀"


@pytest.fixture(scope="module", params=NAMES)
def pair(request):
    path = public_tokenizers.path(request.param)
    mine = tokens.TextTokenizer.of(path)
    return Tokenizer.from_file(path), mine, mine.table()


def _same(pair, texts):
    library, mine, table = pair
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in mine.ids(texts, table)] == want
    assert mine.counts(texts, table).tolist() == list(map(len, want))


def test_chosen_texts(pair):
    _same(pair, [
        "", " ", "'", "'r", " 's", "''s", "a  ", "\n\n a", "  \n", "'re've'll'l'd't'm", "don't DON'T we'RE", "x'" * 40, "a" * 3000,
        "12345 67", "it's<|endoftext|> 's<|endoftext|><|startoftext|>x", "<|endoftext|>", "<|endoftext", "\0a\0", "é ́",
    ])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=60), min_size=1, max_size=5))
def test_texts_of_a_small_alphabet(pair, texts):
    _same(pair, texts)


def test_random_code_points_and_long_runs(pair):
    rng = random.Random(3)
    kinds = [(1, 0x2FFF), (0x3000, 0xD7FF), (0xE000, 0x10FFFF), (97, 122)]
    texts = ["".join(chr(rng.randint(*rng.choice(kinds))) for _ in range(40)) for _ in range(400)]
    texts += [" " * 3000 + "a", "'s" * 2000, "a'" * 2000, "1" * 1500 + "\n" * 1500 + "x"]  # over many chunks
    _same(pair, texts)


def test_every_entry_state_of_a_chunk(monkeypatch):
    monkeypatch.setattr(bpe, "LANE", 5)
    rng = random.Random(9)
    whole = np.array([rng.randrange(bpe.SYMBOLS) for _ in range(4000)] + [bpe.END], np.uint8)
    small = bpe.word_begins(whole, True)
    monkeypatch.setattr(bpe, "LANE", 8192)
    assert (small == bpe.word_begins(whole, True)).all()


def test_counts_of_odd_rows(make_docs, odd_rows):
    path = public_tokenizers.path(NAMES[0])
    library = Tokenizer.from_file(path)
    got = tokens.token_counts(make_docs(odd_rows), path, limit=5).collect()
    want = []
    for d, t in odd_rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 5))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert tokens.token_counts(make_docs([]), path).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=12), st.integers(1, 60))
def test_closest_lengths(lengths, space):
    counts = {n: lengths.count(n) for n in lengths}
    chosen = packing.closest_lengths(counts, space)
    sums = {0}
    for n in lengths:
        sums |= {s + n for s in sums if s + n <= space}
    assert sum(n * k for n, k in chosen.items()) == max(sums)
    assert all(k <= counts[n] for n, k in chosen.items())


@pytest.mark.parametrize("block_tokens", [50, 1_000_000])
def test_pieces_hold_every_id_once(make_docs, odd_rows, block_tokens):
    path = public_tokenizers.path(NAMES[1])
    library = Tokenizer.from_file(path)
    rows = [(k, t) for k, (_, t) in enumerate(odd_rows)] + [(100 + k, "some more words " * (k % 7)) for k in range(200)]
    pieces = packing.pack(make_docs(rows), path, capacity=64, block_tokens=block_tokens).collect()
    ids = {d: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for d, t in rows}
    spans, sequences = {}, {}
    for p in pieces:
        assert bytes(p.ids) == ids[p.doc_id][p.start : p.start + p.length].tobytes() and p.doc_tokens == len(ids[p.doc_id])
        spans.setdefault(p.doc_id, []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for d, whole in ids.items():
        at = 0
        for start, length in sorted(spans[d]):
            assert start == at and length > 0
            at += length
        assert at == len(whole)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 64 or at & (at - 1) == 0  # no padding
    assert packing.pack(make_docs([]), path).count() == 0


def test_null_ids_are_packed(make_docs):
    path = public_tokenizers.path(NAMES[1])
    got = packing.pack(make_docs([(None, None), (None, "a")]), path).collect()
    assert sorted(p.length for p in got if p.doc_id is None)[-1] == 2 or len(got) >= 2
    assert sum(p.length for p in got) == 3
    assert zlib.crc32(bytes(got[0].ids))
