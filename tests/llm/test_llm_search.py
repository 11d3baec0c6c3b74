"""Phrases, pieces and ranked search against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from offermill.llm import phrases, pieces, ranked
from offermill.llm.queries import op12_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


# Phrases


def _plain_phrases(rows, least, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", _lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in (1, 2, 3):
                counts.setdefault(lang, Counter()).update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            if len(p) == 2 and any(p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in found.items() if len(q) == 3):
                continue
            score, cut = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def _phrase_rows(seed, odd_rows):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(12)] + ["Éa", "X", "x", "\x1c", "漢"]
    rows = [("en", t) for _, t in odd_rows]
    for _ in range(120):
        text = " ".join(rng.choice(words[: rng.randrange(2, len(words))]) for _ in range(rng.randrange(40)))
        text = "".join(rng.choice([", ", "\t", "\n", " . ", "  "]) if c == " " and rng.random() < 0.15 else c for c in text)
        rows.append((rng.choice(["en", "de", None, "und", ""]), text))
    return rows + [("en", "hot pair " + " ".join(f"hot pair z{k % 90}" for k in range(2000)))]


@pytest.mark.parametrize("crowded,block,part", [(1000, 1 << 20, 1 << 20), (4, 300, 2_000), (100, 5_000, 500)])
def test_phrases(spark, odd_rows, monkeypatch, crowded, block, part):
    monkeypatch.setattr(phrases, "CROWDED", crowded)
    monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
    monkeypatch.setattr(phrases, "PART_BYTES", part)
    rows = _phrase_rows(7, odd_rows)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    docs = docs.withColumns({c: F.lit(1) for c in ("w1", "n", "key", "part", "first", "doc_id")})
    got = sorted(tuple(r) for r in phrases.collocations(docs, top=60).collect())
    assert got == _plain_phrases(rows, 10, 60)


def test_equal_parts_are_all_prefixes():
    rng = np.random.default_rng(3)
    for size, words in ((1, 2), (400, 3), (3000, 9), (3000, 300)):
        columns = [rng.integers(1, words + 1, size), *rng.integers(0, words + 1, (2, size))]
        columns[2][columns[1] == 0] = 0
        weight = rng.integers(1, 4, size)
        want = Counter()
        for *row, n in zip(*columns, weight):
            for d in (1, 2, 3):
                if row[d - 1]:
                    want[tuple(row[:d])] += n
        got = {}
        for depth, pointers, sizes in phrases.equal_parts(columns, weight, 6):
            for p, n in zip(pointers, sizes):
                got[tuple(int(c[p]) for c in columns[:depth])] = n
        assert got == {k: n for k, n in want.items() if n >= 6}


def test_phrases_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None), ("en", " . ")], "lang string, text string")).count() == 0


# Pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def _strange(seed, number):
    rng = random.Random(seed)
    parts = ["a", "e", "the", "ing", " ", "  ", "\n", "\t", "é", "漢", "ゼ", "00", "▁", "\0", "😀", "<0x41>", "</s>", "--", "́"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(number)]


def test_encoding_and_decoding_like_the_library(library, monkeypatch):
    monkeypatch.setattr(pieces, "MAX_PAIRS", 200)
    model = pieces.Pieces(MODEL)
    model.slots, model.stands = model.slots[:64], model.stands[:64]
    texts = _strange(1, 3000) + [" " * n for n in range(70)] + ["b" + " " * n + "the" for n in range(40)] + ["thethe" * 900, "漢字仮名" * 700]
    for text, found in zip(texts, model.encode(texts)):
        ids = library.encode(text)
        assert found.tolist() == ids
        assert model.decode(ids) == library.decode(ids)
    rng = random.Random(2)
    for _ in range(500):
        ids = [rng.randrange(rng.choice([259, 32_000])) for _ in range(rng.randrange(9))]
        assert model.decode(ids) == library.decode(ids)


def test_pieces_of_tables(make_docs, odd_rows, library):
    rows = odd_rows + list(enumerate(_strange(3, 60), 100))
    docs = make_docs(rows).withColumn("ids", F.lit("x")).withColumn("_value", F.lit("x"))
    encoded = pieces.encode(docs, MODEL)
    assert set(encoded.columns) == set(docs.columns)
    decoded = pieces.decode(encoded, MODEL)
    got = sorted(((r.doc_id, list(r.ids), r.decoded) for r in decoded.collect()), key=str)
    want = sorted(((d, library.encode(t or ""), library.decode(library.encode(t or ""))) for d, t in rows), key=str)
    assert got == want
    assert pieces.decode(pieces.encode(make_docs([]), MODEL, keep=["doc_id"]), MODEL).count() == 0


def test_one_pass_codes_both_ways(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    coded = pieces.encode_decode(docs, MODEL, keep=["doc_id"])
    two = pieces.decode(pieces.encode(docs, MODEL, keep=["doc_id"]), MODEL)
    assert sorted(map(str, coded.collect())) == sorted(map(str, two.collect()))
    assert pieces.encode_decode(make_docs([]), MODEL).count() == 0


def test_pieces_query_needs_one_worker_per_task(spark):
    plan = op12_pieces(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


# Ranked search


def _plain_ranks(rows, items, top):
    terms = [re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", _lowered(t)) for _, t in rows]
    n_docs, n_terms = sum(map(bool, terms)), sum(map(len, terms))
    df = Counter(t for ts in terms for t in set(ts))
    out = []
    for item, text in items:
        asked = Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", _lowered(text)))
        found = []
        for (doc, _), ts in zip(rows, terms):
            tf, score = Counter(ts), 0
            for t in asked.keys() & tf.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 25 + 25 * len(ts) * n_docs // n_terms
                score += asked[t] * w * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("short,window,block,item_bytes", [(64, 256, 16_384, 1 << 20), (3, 7, 40, 60), (0, 16, 100, 1 << 20)])
def test_ranks(spark, make_docs, odd_rows, monkeypatch, short, window, block, item_bytes):
    monkeypatch.setattr(ranked, "SHORT", short)
    monkeypatch.setattr(ranked, "WINDOW", window)
    monkeypatch.setattr(ranked, "BLOCK_DOCS", block)
    rng = random.Random(5)
    words = [f"t{k}" for k in range(60)] + ["Éa", "漢字"]
    weights = [1 / (k + 1) for k in range(len(words))]
    rows = odd_rows + [(k, " ".join(rng.choices(words, weights, k=rng.randrange(1, 60)))) for k in range(100, 400)]
    rows += [(1000 + k % 30, "t0 T1,t2 copy") for k in range(90)]
    items = [(1, "t0 t1 t2 t2"), (2, "t50 t51 Éa; 漢字"), (3, None), (4, ""), (5, "absent"), (None, "hello world"), (7, "t3 t9 t20 t40 copy COPY"), (8, "t0")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    got = ranked.search(make_docs(rows).repartition(4), bench, item_bytes=item_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == _plain_ranks(rows, items, 20)


def test_ranks_of_nothing(spark, make_docs):
    bench = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert ranked.search(make_docs([]), bench).count() == 0
    assert ranked.search(make_docs([(1, None), (2, " ")]), bench).count() == 0
    assert ranked.search(make_docs([(1, "word")]), bench.filter("false")).count() == 0
