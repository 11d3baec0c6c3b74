"""What workers hold, and keep between tasks."""

import random

import numpy as np
import pyarrow as pa
import pytest

from offermill.llm import common, exact, toxicity


def _batch(texts):
    return pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.binary())], names=["doc_id", "text"])


@pytest.mark.parametrize("most", [1, 10, 1000])
def test_pieces_are_small_and_whole(most):
    texts = [b"x" * random.Random(k).randrange(30) for k in range(100)] + [b"", None, b"y" * 500]
    batch = _batch(texts)
    for part in (batch, batch.slice(7, 90)):
        got = list(common.pieces(part, 1, most))
        assert pa.Table.from_batches(got).to_pylist() == part.to_pylist()
        assert all(len(p) == 1 or sum(len(t or b"") for t in p.column(1).to_pylist()) <= most for p in got)
    assert list(common.pieces(batch.slice(0, 0), 1, most)) == []


def test_tasks_get_small_pieces_and_give_memory_back(monkeypatch):
    freed, sizes = [], []
    monkeypatch.setattr(common, "release", lambda: freed.append(1))

    def run(batches):
        for batch in batches:
            sizes.append(batch.column(1).nbytes)
            yield batch

    batches = [_batch([b"z" * 1000] * 5000)] * 2
    assert sum(len(b) for b in common.frugal(run, 1)(iter(batches))) == 10_000
    assert max(sizes) < 2 * common.PIECE_BYTES and len(freed) == 3


def test_digests_are_made_text_by_text():
    texts = pa.array([b"a b", b" c\n"], pa.binary())
    found = exact._normal(texts)
    assert not isinstance(found, list)
    assert list(found) == [b"ab", b"c"]


def test_rows_are_ordered_by_whole_content():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(4, rng.integers(0, 4), False)).astype(np.int32) for _ in range(300)]
    rows += [np.concatenate([np.arange(20), [k % 5 + 20]]).astype(np.int32) for k in range(40)]  # alike in their first terms
    marks = rng.integers(0, 2, len(rows)).tolist()
    assert toxicity._ordered(rows, marks) == sorted(range(len(rows)), key=lambda i: (marks[i], rows[i].tobytes()))
