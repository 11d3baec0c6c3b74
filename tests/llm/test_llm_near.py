"""Near duplicates by exact similarity, against all pairs."""

import random
from fractions import Fraction
from pathlib import Path

import pytest

import corpus_pipeline
from offermill.llm import common, near, simhash
from offermill.session import scratch_path


def _sets(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def _least(rows):
    """Smallest id of the group of each row, by comparing all."""
    sets = [_sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) >= Fraction(4, 5) * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[find(k)] = min(least.get(find(k), d), d)
    return [least.get(find(k)) for k in range(len(rows))]


def _families(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(6):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(8, 150))]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 12)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(500)}"
            if rng.random() < 0.3:
                words = words[: rng.randrange(len(words) // 2, len(words))]
            rows.append((len(rows) + 100, " ".join(words) + rng.choice(["", " all rights reserved by the owner of this text"])))
            if rng.random() < 0.2:
                base = words
    return rows


@pytest.mark.parametrize("floor", [2, 1000])
def test_groups_are_those_of_all_pairs(make_docs, odd_rows, monkeypatch, floor):
    monkeypatch.setattr(near, "HOT_BUCKET", floor)
    rows = odd_rows + _families(3)
    got = near.near_duplicates(make_docs(rows)).collect()
    want = sorted(((d, least) for (d, _), least in zip(rows, _least(rows))), key=str)
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == want


@pytest.mark.parametrize("rounds", [0, 3])
def test_a_large_bucket_of_variants(make_docs, monkeypatch, rounds):
    monkeypatch.setattr(near, "ROUNDS", rounds)
    rng = random.Random(11)
    base, rows = [f"b{k}" for k in range(120)], []
    for k in range(220):
        words = list(base)
        for _ in range(rng.randrange(1, 5)):
            words[rng.randrange(120)] = f"x{rng.randrange(10_000)}"
        rows.append((k, " ".join(words)))
    numbers, staged = {}, near.stage

    def counted(df, label):
        out = staged(df, label)
        if label == "near-likely":
            numbers.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(near, "stage", counted)
    got = near.near_duplicates(make_docs(rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((d, least) for (d, _), least in zip(rows, _least(rows)))
    if rounds == 3:  # by far not all 24,090 pairs
        assert sum(numbers["near-likely"]) < 12_000, numbers


def test_large_tables_go_when_they_are_read(spark, make_docs):
    folder = Path(scratch_path(spark, "near")).parent
    before = set(folder.glob("near-*"))
    rows = _families(5)
    got = {r.doc_id: r.component_id for r in near.near_duplicates(make_docs(rows), fingerprints=True).collect()}
    assert len(set(got.values())) < len(got) == len(rows)
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.glob("near-*")) - before}
    assert left & {f"near-{n}" for n in ("entries", "nodes", "routed", "entered", "members", "met", "labelled", "texts", "sets")} == set()
    assert "near-marked" in left


def test_the_stage_removes_near_copies_of_distant_fingerprints(spark, make_docs):
    words = [f"w{k}" for k in range(231)]
    changed = list(words)
    for k in (40, 120, 200):
        changed[k] = "other"
    docs = make_docs([(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(words[:150])), (None, " ".join(words))])
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None"]
    assert corpus_pipeline.drop_near_copies(spark, make_docs([]), "").count() == 0


def test_the_stage_drops_what_fingerprints_link_and_sets_do_not(spark, make_docs):
    # Of texts with many copies of one stretch, fingerprints agree; the sets of their stretches share little.
    core = "alpha beta gamma " * 400
    rows = [(1, core + " ".join(f"a{k}" for k in range(40))), (2, core + " ".join(f"b{k}" for k in range(40)))]
    assert len({r.component_id for r in simhash.near_duplicates(make_docs(rows)).collect()}) == 1
    assert [r.doc_id for r in near.keep_one(make_docs(rows)).orderBy("doc_id").collect()] == [1, 2]
    assert [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, make_docs(rows), "").collect()] == [1]


def test_the_sample_keeps_its_share_of_many_texts(make_docs, monkeypatch):
    # A passage of 60 in 400 texts: with a sample of fixed size, ever longer buckets would pass as rare.
    monkeypatch.setattr(near, "SAMPLE", 10)
    passage = " ".join(f"p{k}" for k in range(12))
    rows = [(k, " ".join(f"u{k}x{n}" for n in range(30)) + (" " + passage if k < 60 else "")) for k in range(400)]
    assert set(near.shingles(passage.encode())) <= set(near.common_shingles(make_docs(rows)))


def test_late_places_exclude_pairs(spark):
    rows = spark.createDataFrame([(100, 12, 100, 12), (100, 13, 100, 1), (100, 1, 100, 13), (100, 21, 80, 1)], "size int, place int, size_b int, place_b int")
    assert [r[0] for r in rows.select(near._places_fit(Fraction(4, 5))).collect()] == [True, False, False, True]


def test_rounds_of_components_go_and_so_do_their_shuffles(spark):
    folder = Path(scratch_path(spark, "links")).parent
    before = set(folder.glob("*"))
    path = spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long")
    assert {tuple(r) for r in common.components(path).collect()} == {(k, 0) for k in range(41)}
    assert [p.name.rsplit("-", 1)[0] for p in set(folder.glob("*")) - before] == ["small-star"]


@pytest.mark.parametrize("own, within", [("10485760", 1 << 20), ("300k", 300 << 10), ("-1", -1)])
def test_tables_of_numbers_are_broadcast_up_to_a_small_size(spark, make_docs, monkeypatch, own, within):
    name, seen = "spark.sql.autoBroadcastJoinThreshold", []
    grouped = near._grouped
    monkeypatch.setattr(near, "_grouped", lambda *args: seen.append(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()) or grouped(*args))
    before = spark.conf.get(name)
    spark.conf.set(name, own)
    try:
        rows = near.near_duplicates(make_docs([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "h i j k l m n")])).count()
        assert rows == 3 and seen == [within]
        assert spark.conf.get(name) == own
    finally:
        spark.conf.set(name, before)
