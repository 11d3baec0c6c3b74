"""Registered queries without a statement, and the pipeline's stages, against plain versions on a given table."""

import base64
import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from offermill.llm import licenses, toxicity
from offermill.llm.common import read_table
from offermill.session import stage

from test_llm_dedup import _exact, _fingerprint, _groups
from test_llm_near import _least
from test_llm_scans import PLAIN, _contaminated, _spans

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()


def _run(spark, name):
    return entry.queries()[name](spark, SMALL).collect()


def _kept_ids(rows):
    """Smallest id reachable of each row."""
    fps = {d: _fingerprint(t) for d, t in rows}
    roots = _groups(set(fps.values()))
    least = {}
    for d, fp in fps.items():
        least[roots[fp]] = min(least.get(roots[fp], d), d)
    return {d: (f"{fp:016x}", least[roots[fp]]) for d, fp in fps.items()}


def test_op1(spark, rows):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in _run(spark, "op1_simhash")}
    assert got == _kept_ids(rows)


def _check_pieces(pieces, rows):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for d, t in rows}
    spans, sequences = {}, {}
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes())
        assert p.doc_tokens == len(ids[p.doc_id])
        spans.setdefault(p.doc_id, []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert set(spans) == set(ids)
    for parts, size in [(spans[d], len(ids[d])) for d in ids] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == size if size is not None else at == 4096 or at & (at - 1) == 0


def test_op2(spark, rows):
    _check_pieces(_run(spark, "op2_packing"), rows)


def test_op3(spark, rows):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for d, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want[d] = (len((t or "").encode()), n, n > 1024)
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in _run(spark, "op3_token_counts")} == want


def test_op4(spark, rows):
    got = _run(spark, "op4_toxicity")
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_op4_on_held_out_rows(spark):
    table = "/root/testdata/sf0.1"
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{table}/labels.parquet'").fetchall())
    got = toxicity.scores(read_table(spark, table, "documents"), read_table(spark, table, "labels")).collect()
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    found = sum(p and y for p, y in held)
    assert found / sum(y for _, y in held) > 0.75 and found / sum(p for p, _ in held) > 0.95


def test_op6(spark, rows):
    family = {line: name for name, lines in licenses.TEMPLATES.items() for line in lines}
    want = {d: ",".join(sorted({family[x] for x in (t or "").split("\n") if x in family})) for d, t in rows}
    got = {r.doc_id: r.families for r in _run(spark, "op6_licenses")}
    assert set(got) == set(want) and all(set(want[d].split(",")) - {""} <= set(got[d].split(",")) for d in want)
    assert sum(got[d] != want[d] for d in want) <= len(want) // 100


def test_op7(spark):
    pages = duckdb.sql(f"SELECT page_id, html FROM '{SMALL}/pages.parquet'").fetchall()
    last = {}
    for page, html in pages:
        last[html or ""] = max(page, last.get(html or "", page))
    want = {}
    for page, html in pages:
        payload, answer = (html or "").encode(), last[html or ""]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        again = page != answer
        want[page] = (len(payload), digest, "revisit" if again else "response", answer if again else None)
    assert {r[0]: tuple(r)[1:] for r in _run(spark, "op7_warc")} == want


def test_op8(spark, rows):
    want = {}
    for d, t in rows:
        spans = _spans(t)
        listed = ",".join(f"{PLAIN[k][0]}:{a}:{b}" for a, k, b in spans)
        want[d] = (*(sum(s[1] == k for s in spans) for k in range(4)), hashlib.sha256(listed.encode()).hexdigest())
    got = _run(spark, "op8_pii")
    assert {r.doc_id: tuple(r)[1:6] for r in got} == want
    for r in got:
        spans = [s.split(":") for s in filter(None, r.spans.split(","))]
        assert len(spans) >= sum(tuple(r)[1:5])


def test_op10(spark, rows):
    got = _run(spark, "op10_lm_score")
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in rows)
    assert all(abs(r.score - (r.target_loss - r.background_loss)) < 1e-9 for r in got)


def test_op12(spark, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {}
    for d, t in rows:
        ids = library.encode(t or "")
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids)))
        want[d] = (len(ids), *digests)
    assert {r[0]: tuple(r)[1:] for r in _run(spark, "op12_pieces")} == want


def test_pipeline_stage_by_stage(spark, rows):
    docs, before = read_table(spark, SMALL, "documents"), dict(rows)
    columns = docs.columns
    benchmark = duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    for name, step in corpus_pipeline.STAGES:
        given = docs
        docs = stage(step(spark, docs, SMALL), name)
        if name == "packing":
            _check_pieces(docs.collect(), list(before.items()))
            break
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        listed = list(before.items())
        if name == "toxicity":
            scored = toxicity.scores(given, read_table(spark, SMALL, "labels")).collect()
            want = {r.doc_id for r in scored if not r.predicted}
        elif name == "exact_dedup":
            want = {d for d, keep, *_ in _exact(listed) if d == keep}
        elif name == "simhash_dedup":
            want = {d for (d, _), least in zip(listed, _least(listed)) if d == least}
        else:
            want = {d for d, _, hits, _ in _contaminated(listed, benchmark, 10) if not hits}
        assert after == {d: before[d] for d in want}
        before = after
