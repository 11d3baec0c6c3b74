"""SimHash groups, exact groups, and what the filtering forms keep."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from offermill.llm import common, exact, simhash
from offermill.session import stage


def _fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _signed(value):
    return value - (1 << 64) if value >> 63 else value


def _groups(points):
    """Smallest id reachable in steps of two bits, by fingerprint."""
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    listed = list(points)
    for i, a in enumerate(listed):
        for b in listed[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {p: find(p) for p in listed}


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=200))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode(errors="ignore")) == _signed(_fingerprint(text.encode(errors="ignore").decode()))


def test_near_duplicates_of_odd_rows(make_docs, odd_rows):
    got = sorted((tuple(r) for r in simhash.near_duplicates(make_docs(odd_rows)).collect()), key=str)
    fps = {t: _fingerprint(t) for _, t in odd_rows}
    roots = _groups(set(fps.values()))
    least, same = {}, defaultdict(int)
    for d, t in odd_rows:
        same[fps[t]] += 1
        if d is not None:
            least[roots[fps[t]]] = min(least.get(roots[fps[t]], d), d)
    want = [(d, _signed(fps[t]), least[roots[fps[t]]], same[fps[t]]) for d, t in odd_rows]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("bucket_limit", [1, 4, 1000])
def test_links_join_the_same_groups_at_every_bucket_limit(spark, bucket_limit):
    rng = random.Random(5)
    points = set()
    for _ in range(12):  # families that share a half, with long chains
        base = rng.getrandbits(64)
        for _ in range(25):
            base ^= 1 << rng.randrange(64) if rng.random() < 0.7 else 1 << rng.randrange(6)
            points.add(base)
            points.add(base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    df = spark.createDataFrame([(_signed(p),) for p in points], "fp long")
    links = [tuple(r) for r in simhash.links(df, bucket_limit).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in links)
    found = {r.node: r.component for r in common.components(simhash.links(df, bucket_limit)).collect()}
    want = _groups(points)
    by_root, by_mine = defaultdict(set), defaultdict(set)
    for p in points:
        by_root[want[p]].add(p)
        by_mine[found.get(_signed(p), _signed(p))].add(p)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_mine.values()))


def test_hot_keys_do_not_change_a_join(spark):
    left = spark.createDataFrame([(k % 3 and k, k) for k in range(300)] + [(None, 7)], "key long, n long")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 300, 2)], "key long, v string")
    for how in ("inner", "left"):
        want = sorted(map(str, left.join(right, "key", how).collect()))
        assert sorted(map(str, common.join_hot(left, right, "key", "n", how, floor=20, ways=4).collect())) == want


def _exact(rows):
    plain = {d: (t or "").translate({c: None for c in (32, *range(9, 14))}) for d, t in enumerate(t for _, t in rows)}
    groups = defaultdict(list)
    for k, (d, t) in enumerate(rows):
        groups[plain[k]].append((-len(t or ""), d is None, d or 0))
    out = []
    for k, (d, _) in enumerate(rows):
        _, none, best = min(groups[plain[k]])
        keep = None if none else best
        out.append((d, keep, len(groups[plain[k]]), d == keep, hashlib.sha256(plain[k].encode()).digest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [1, 60, 1 << 20])
def test_exact_duplicates_at_every_table_size(make_docs, odd_rows, limit):
    got = exact.exact_duplicates(make_docs(odd_rows), table_bytes=limit, block_bytes=limit, partitions=3)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _exact(odd_rows)


def test_tables_compare_contents():
    table = exact.ContentTable(1 << 20, slots=4)
    numbers = [table.find(7, str(k % 50).encode()) for k in range(200)]  # one hash for all
    assert numbers == [k % 50 for k in range(200)]
    full = exact.ContentTable(10)
    assert [full.find(1, b"x" * 20), full.find(2, b"y"), full.find(1, b"x" * 20)] == [0, -1, 0]


def test_kept_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = exact.keep_one(docs)
    assert kept.columns == docs.columns
    # Of the blank texts the longest stays.
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, [3, 4, 4, None, 6, 7, 8, 9, 6]))
    assert {r.digest for r in kept.collect()} == {"x"}
    near = simhash.keep_one(docs)
    assert near.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in near.collect()))) == sorted(map(str, [1, 4, 4, None, 6, 7, 8, 9, 6]))


def test_empty_tables(make_docs):
    docs = make_docs([])
    assert simhash.near_duplicates(docs).count() == 0
    assert exact.exact_duplicates(docs).count() == 0
    assert exact.keep_one(docs).count() == simhash.keep_one(docs).count() == 0


@pytest.mark.parametrize("bucket_limit", [1, 200])
def test_entries_of_fingerprints_are_never_broadcast(spark, bucket_limit):
    points = stage(spark.range(2000).select(F.xxhash64(F.col("id") % 1000).alias("fp")).distinct(), "points")
    found = simhash.links(points, bucket_limit)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [key" in plan
    assert not re.search(r"BroadcastHashJoin \[key#\w+\], \[key#\w+\], Inner", plan)
    found.count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"BroadcastHashJoin \[key#\w+\], \[key#\w+\], Inner", plan)
