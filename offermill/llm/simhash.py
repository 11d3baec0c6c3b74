"""Near duplicates by SimHash fingerprints and deletion-variant signatures.

A fingerprint has 64 bits. Two that differ in at most two bits differ in at most one bit of
one of their 32-bit halves. Each half is therefore indexed with one bit left out at a time;
fingerprints with equal entries meet in an equality join and are verified on all 64 bits.

The join has two sides, so that no pair meets twice and equal halves meet but once: rows whose
left-out bit is 0 meet rows whose left-out bit is 1, and an entry for the whole half brings
equal halves together. Buckets above `bucket_limit` fingerprints are not paired. Their members
get finer entries, with the remaining differing bits left out as well: rows that share such an
entry are linked without a check, so a bucket of any size costs a fixed number of rows per member.

Defined results: null, empty and blank texts have fingerprint zero; repeated rows come back once
each; a null doc_id keeps its row and takes part through its fingerprint, its component is the
smallest non-null doc_id reachable, else null. No rows in, no rows out. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import stage
from .common import boxed, components, join_hot, utf8

SEED = 42
BITS = 64
HALF = 32
SHINGLE = 3
BUCKET_LIMIT = 200
_BLOCK = 1 << 16


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of one text; bytes.split() parts at blanks and \\t to \\r."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[k:] for k in range(width)))))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(shingles), _BLOCK):
        part = shingles[at : at + _BLOCK]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in part), np.uint64, len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(shingles), bitorder="little").view(np.int64)[0])


def fingerprint_column(width: int = SHINGLE):
    @F.arrow_udf(T.LongType())
    def fps(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py(), width) for t in texts], pa.int64())

    return fps


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id and fp (signed 64 bits) of every row."""

    return docs.select("doc_id", fingerprint_column(width)(utf8("text")).alias("fp"))


def _half(which: int) -> Column:
    return F.shiftrightunsigned("fp", HALF * which).bitwiseAND(F.lit((1 << HALF) - 1))


def _entry(which: int, bit: int, half: Column) -> Column:
    """Half and left-out bit in the upper part, the half's value in the lower. Bit 32: none left out."""
    return F.lit((which * (HALF + 1) + bit) << HALF).bitwiseOR(half)


def _index(points: DataFrame) -> DataFrame:
    """(key, side, fp): 33 entries for each half of each fingerprint."""
    entries = []
    for which in (0, 1):
        half = _half(which)
        for bit in range(HALF):
            is_one = F.shiftrightunsigned("fp", HALF * which + bit).bitwiseAND(F.lit(1))
            without = half.bitwiseAND(F.lit(((1 << HALF) - 1) ^ (1 << bit)))
            entries.append(F.struct(_entry(which, bit, without).alias("key"), is_one.cast("byte").alias("side")))
        entries.append(F.struct(_entry(which, HALF, half).alias("key"), F.lit(2).cast("byte").alias("side")))
    return points.select("fp", F.explode(F.array(*entries)).alias("e")).select("e.key", "e.side", "fp")


def _pairs(index: DataFrame) -> DataFrame:
    """Verified links of fingerprints that share an entry.

    Both sides are sorted, never broadcast: Spark takes the 66 entries of a fingerprint for one row, and would send them
    through the driver while the fingerprints themselves are a small table.
    """
    zero = index.filter("side <> 1").select("key", F.col("side").alias("s"), F.col("fp").alias("a"))
    one = index.filter("side <> 0").select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2
    met = zero.join(one.hint("merge"), "key").filter(near & ((F.col("s") == 0) | (F.col("a") < F.col("b"))))
    return met.select("a", "b")


def _fine_links(crowded: DataFrame) -> DataFrame:
    """Links inside large buckets: (key, fp) rows, linked to the smallest of each finer entry.

    Members of a bucket agree on a half, but for one bit at most. With the half equal, the other
    half differs in two bits at most: it is entered with each pair of bits left out. With one bit
    left out, the other half differs in one at most: it is entered with each bit left out. Rows
    sharing a finer entry thus differ in two bits at most, and every such pair shares one.
    """
    place = F.shiftrightunsigned("key", HALF)
    which = F.floor(place / (HALF + 1))
    whole = F.pmod(place, F.lit(HALF + 1)) == HALF
    ones = [1 << i for i in range(HALF)]
    twos = [(1 << i) | (1 << j) for i in range(HALF) for j in range(i)]
    masks = F.when(whole, F.array(*map(F.lit, twos))).otherwise(F.array(*(F.lit(m) for m in ones)))
    other = F.when(which == 0, _half(1)).otherwise(_half(0))
    entered = crowded.select("key", "fp", other.alias("o"), F.explode(masks).alias("mask")).select(
        "key", "mask", F.col("o").bitwiseAND(F.bitwise_not("mask")).alias("rest"), "fp"
    )
    # Equal entries differ in the left-out bits only, so such a group has eight members at most.
    least = entered.groupBy("key", "mask", "rest").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    return least.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b")


def links(points: DataFrame, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints connected by steps of two bits or fewer.

    `points` has one row per distinct fingerprint `fp`.
    """
    index = _index(points)
    crowded = index.groupBy("key").count().filter(F.col("count") > bucket_limit).select("key")
    crowded = stage(crowded, "crowded")
    if crowded.isEmpty():
        return _pairs(index)
    members = index.join(crowded, "key", "left_semi")
    return _pairs(index.join(crowded, "key", "left_anti")).union(_fine_links(members.select("key", "fp")))


def near_duplicates(docs: DataFrame, width: int = SHINGLE, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row per row of `docs`: doc_id, fp, component_id, n_same (rows with the same fingerprint)."""
    marked = stage(fingerprints(docs, width), "fingerprints")
    points = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n_same")), "points")
    found = stage(components(links(points.select("fp"), bucket_limit)), "fp-components").withColumnRenamed("node", "fp")
    grouped = points.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stage(grouped.join(smallest, "component").select("fp", "component_id", "n_same"), "named")
    return join_hot(marked, named, "fp", "doc_id").select("doc_id", "fp", "component_id", "n_same")


def keep_one(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of its group; rows without any doc_id stay.

    Of repeated rows with one doc_id, all stay or go together: they are one document.
    """
    gone = near_duplicates(docs, width).filter(F.col("doc_id") != F.col("component_id")).select("doc_id", "fp").distinct()
    rows = boxed(docs, doc_id=F.col("doc_id"), fp=fingerprint_column(width)(utf8("text")))
    return rows.join(gone, ["doc_id", "fp"], "left_anti").select("_row.*")
