"""Decontamination, personal data, licences, toxicity and language models against plain versions."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from offermill.llm import decontam, licenses, lm, pii, queries, toxicity

PASSAGE = "the quick brown fox jumps over one lazy dog and then sleeps for very long"


def _words(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def _contaminated(rows, items, n):
    out = []
    for d, t in rows:
        words, hit, found = _words(t), set(), set()
        for item, text in items:
            test = _words(text)
            width = min(n, len(test))
            windows = {tuple(test[k : k + width]) for k in range(len(test) - width + 1)} if width else set()
            for k in range(len(words) - width + 1):
                if width and tuple(words[k : k + width]) in windows:
                    hit.update(range(k, k + width))
                    if item is not None:
                        found.add(str(item))
        out.append((d, len(words), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_words", [10, 100_000])
def test_decontamination(spark, make_docs, odd_rows, block_words):
    items = [(1, PASSAGE), (2, "short item"), (2, "short item"), (3, None), (4, ""), (None, "É漢 x"), (10, PASSAGE.upper()), (11, "word1 word2 word3")]
    rows = odd_rows + [
        (20, f"Before, {PASSAGE.replace(' ', '; ')}! after"), (21, PASSAGE.rsplit(" ", 6)[0]), (22, "A short item and a SHORT-ITEM."),
        (23, "é漢 x É漢 x"), (24, " ".join(PASSAGE.split()[:9])), (25, f"{PASSAGE} {PASSAGE}"),
    ]
    docs = make_docs(rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.scan(docs, bench, block_words=block_words).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=str) == _contaminated(rows, items, 10)
    kept = decontam.remove_documents(docs, bench)
    assert kept.columns == docs.columns
    hits = {d for d, _, n, _ in _contaminated(rows, items, 10) if n}
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - hits
    cut = {r.doc_id: r.text for r in decontam.remove_spans(docs, bench).collect()}
    assert cut[20] == "Before, ! after" and cut[22] == "A  and a ." and cut[24] == rows[-2][1]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.remove_documents(docs, none).count() == len(rows)
    assert decontam.scan(make_docs([]), bench).count() == 0


PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def _valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(n - 9 if n > 9 else n for n in twice) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def _spans(text):
    found = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(PLAIN) for m in re.finditer(p, text or "") if _valid(kind, m[0])]
    return sorted(found)


def test_fixed_patterns(make_docs, odd_rows):
    hard = [
        "a@b.c_d@e.f", "a@b.c@d.e x@y", "@x.y a@.b a.b@c.d.", "1.2.3.4.5.6.7.8 001.2.3.0255 1.2.3.256 1.2.3.99999999999999999999",
        "4111-1111-1111-1111 4111 1111 1111 1112 4111  1111", "41111111111111110000000 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "+1 2 3 4 5 6 7 8 9 0 - +12-+1234567890",
        "😀 a@b.cd é +49 (0)30 123456-78 😀10.1.1.1", "9" * 5000, "a." * 5000 + "@b" + ".c" * 5000, "+1" + " " * 3000, "1 " * 4000,
    ]
    rows = odd_rows + [(100 + k, t) for k, t in enumerate(hard)]
    got = pii.find(make_docs(rows)).collect()
    assert sorted(((r.doc_id, [tuple(s) for s in r.base]) for r in got), key=str) == sorted(((d, _spans(t)) for d, t in rows), key=str)
    assert pii.find(make_docs([])).count() == 0


def test_contexts_find_unseen_identifiers(make_docs):
    seeds = [(k, f"please call: +1 (222) 333-44{k:02d} today") for k in range(10)]
    others = [(50 + k, f"the number 12345{k:04d} is an order, the end") for k in range(10)]
    unseen = [(90, "or call: 222-333-9999 now"), (91, "the 222-333-9999 thing")]
    got = {r.doc_id: r for r in pii.find(make_docs(seeds + others + unseen)).collect()}
    assert [tuple(s) for s in got[90].added] == [(9, 3, 21)]
    assert all(not r.added for d, r in got.items() if d != 90)


def test_licences(make_docs, odd_rows):
    lines = [line for family in licenses.FAMILIES for line in licenses.TEMPLATES[family]]
    prose = [(200 + k, "some plain words about rivers and the hills of a country in rain") for k in range(40)]
    licensed = [(300 + k, f"first line\n{line}\nlast line") for k, line in enumerate(lines)]
    docs = make_docs(odd_rows + prose + licensed)
    found = licenses.scan(docs)
    rows = {r.doc_id: r for r in licenses.per_document(docs, found).collect()}
    wanted = [family for family in licenses.FAMILIES for _ in licenses.TEMPLATES[family]]
    right = [rows[300 + k].families == family for k, family in enumerate(wanted)]
    assert sum(right) >= len(right) - 1
    assert all(not rows[d].families and not rows[d].n_unknown for d, _ in prose + odd_rows)
    assert licenses.per_document(docs, found).count() == docs.count()


def test_toxicity_learns_words_and_pairs():
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(1500):  # terms 1 and 2 are toxic together only, term 3 always
        has = rng.random(3) < (0.5, 0.5, 0.1)
        rows.append(np.array(sorted([k + 1 for k in range(3) if has[k]] + list(10 + rng.choice(40, 5, replace=False)))))
        labels.append(int((has[0] and has[1]) or has[2]))
    rows, labels = np.array(rows, object), np.array(labels)
    model = toxicity.learn(list(rows[:1200]), labels[:1200], least_z=0)

    def right(model):
        scores = model.scores([np.searchsorted(model.terms, r[np.isin(r, model.terms)].astype(int)) for r in rows[1200:]])
        return ((scores > 0.5) == labels[1200:]).mean()

    assert right(model) > 0.97
    model.vectors[:] = 0  # weights alone miss the pair
    assert right(model) < 0.9
    assert toxicity.learn([], np.array([])).scores([np.zeros(0, np.int64)])[0] == pytest.approx(0.5, abs=1e-3)


def test_toxicity_learns_pairs_of_terms_that_say_nothing_alone():
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for _ in range(3000):  # exactly one of terms 1 and 2
        has = rng.random(2) < 0.5
        rows.append(np.array(sorted([k + 1 for k in range(2) if has[k]] + list(10 + rng.choice(2000, 30, replace=False)))))
        labels.append(int(has[0] != has[1]))
    labels = np.array(labels)
    model = toxicity.learn(rows[:2400], labels[:2400])
    assert {1, 2} <= set(model.terms.tolist()) and len(model.terms) < 20
    scores = model.scores([np.searchsorted(model.terms, r[np.isin(r, model.terms)]) for r in rows[2400:]])
    found = scores >= toxicity.THRESHOLD
    assert found[labels[2400:] == 1].mean() > 0.95 and found[labels[2400:] == 0].mean() < 0.05
    few = toxicity.learn(rows[:2400], labels[:2400], max_terms=1)
    assert len(few.terms) == 1


def test_toxicity_takes_one_row_of_a_document(spark, make_docs):
    rows = [(7, "you idiot"), (7, "a kind note"), (7, "you idiot"), (8, "again"), (None, "lost")] * 20
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 0), (None, 1)], "doc_id long, toxic int")
    got = toxicity._sample(make_docs(rows), labels, 10).collect()
    assert sorted(r.label for r in got) == [0, 1]


def test_toxicity_of_odd_rows(spark, make_docs, odd_rows):
    rows = odd_rows + [(1000 + k, f"you idiot of number {k}" if k % 2 else f"a kind note of number {k}") for k in range(300)]
    docs = make_docs(rows)
    labels = spark.createDataFrame([(1000 + k, k % 2) for k in range(300)] + [(5, None), (99999, 1)], "doc_id long, toxic int")
    got = toxicity.scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id and r.doc_id >= 1000)
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 150
    assert toxicity.scores(make_docs([]), labels).count() == 0
    assert all(r.score == pytest.approx(0.5, abs=1e-3) for r in toxicity.scores(docs, labels.limit(0)).collect())


def _language_scores(rows, targets):
    """Plain version: exact words and pairs of whole texts."""
    pairs, words, befores = ([Counter(), Counter()] for _ in range(3))
    for d, t in rows:
        found = _words(t)
        for model in (0, 1) if d is not None and d in targets else (1,):
            words[model].update(found)
            befores[model].update([None, *found][: len(found)])
            pairs[model].update(zip([None, *found], found))
    totals = [max(1, sum(w.values())) for w in words]
    out = []
    for d, t in rows:
        found, loss = _words(t), [0.0, 0.0]
        for before, word in zip([None, *found], found):
            for k in (0, 1):
                after = pairs[k][before, word] / max(1, befores[k][before])
                loss[k] -= math.log(0.6 * after + 0.35 * words[k][word] / totals[k] + 0.05 / 2**18) / len(found)
        out.append((str(d), len(found), loss[0], loss[1], loss[0] - loss[1]))
    return sorted(out)


def _same_scores(got, want):
    got = sorted((str(r.doc_id), r.n_words, r.target_loss, r.background_loss, r.score) for r in got)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2:] for g in got], [w[2:] for w in want], rtol=0, atol=1e-9)


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 100, "part_bytes": 5000}, {"part_bytes": 3}])
def test_language_models(spark, make_docs, odd_rows, sizes):
    docs = make_docs(odd_rows)
    # Repeated, absent and null ids teach once or nothing.
    targets = spark.createDataFrame([(4,), (4,), (9,), (12345,), (None,)], "doc_id long")
    _same_scores(lm.score(docs, targets, **sizes).collect(), _language_scores(odd_rows, {4, 9}))


def test_language_models_without_rows(spark, make_docs, odd_rows):
    targets = spark.createDataFrame([], "doc_id long")
    assert lm.score(make_docs([]), targets).count() == 0
    _same_scores(lm.score(make_docs(odd_rows), targets).collect(), _language_scores(odd_rows, set()))


def test_language_models_of_dealt_marks(spark, make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(lm, "MARKS", 0)
    targets = spark.createDataFrame([(4,), (9,)], "doc_id long")
    _same_scores(lm.score(make_docs(odd_rows), targets).collect(), _language_scores(odd_rows, {4, 9}))


def test_registered_scores_against_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").filter("quality = 1").collect()
    want = _language_scores([tuple(r) for r in docs], {r.doc_id for r in labels})
    _same_scores(queries.op10_lm_score(spark, "/root/testdata/sf0.001").collect(), want)


def test_digest_of_listed_spans(spark):
    row = spark.range(1).select(F.array(F.struct(F.lit(3).alias("start"), F.lit(1).alias("kind"), F.lit(9).alias("end"))).alias("s"))
    text = row.select(pii.listed(F.col("s"))).first()[0]
    assert text == "ip:3:9" and len(hashlib.sha256(text.encode()).hexdigest()) == 64
