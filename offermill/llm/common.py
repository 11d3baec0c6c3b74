"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import dropping_shuffles, stage, unstage

#: A key is hot from this many rows on; at most MAX_HOT keys are ever sent to the driver.
HOT_ROWS = 20_000
MAX_HOT = 1000
PIECE_BYTES = 1 << 20  # of text that a task turns into Python objects at once


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str) -> Column:
    """The bytes of a text; null counts as empty."""
    return F.encode(F.coalesce(F.col(column), F.lit("")), "UTF-8")


def pieces(batch: pa.RecordBatch, texts: int, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of `batch` with `most` bytes at most in its column `texts`, or with one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_numpy(), dtype=np.int64)
    begin = 0
    while begin < len(batch):
        past = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, past + most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def release() -> None:
    """Give back what Arrow has freed. Workers live on between tasks, and each would keep its largest batches."""
    pa.default_memory_pool().release_unused()


def frugal(run: Callable, texts: int | None = None) -> Callable:
    """`run`, for mapInArrow, on small pieces of each batch by its column `texts`; freed memory is given back in between."""

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from (batch,) if texts is None else pieces(batch, texts)
                del batch
                release()

        yield from run(cut())
        release()

    return sliced


def boxed(df: DataFrame, **columns: Column) -> DataFrame:
    """The rows of `df` as one column `_row`, and further columns: no name can clash. `_row.*` unpacks them."""
    return df.select(F.struct(*(df[c] for c in df.columns)).alias("_row"), *(c.alias(n) for n, c in columns.items()))


def hot_values(df: DataFrame, key: str, floor: int = HOT_ROWS) -> list:
    """The most frequent keys with more than `floor` rows, MAX_HOT at most.

    A key that is left out has less than one in MAX_HOT of all rows, so it fits a task
    whenever the other tasks' shares do.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") > floor)
    return [row[0] for row in counts.orderBy(F.desc("count")).limit(MAX_HOT).select(key).collect()]


def join_hot(
    left: DataFrame, right: DataFrame, key: str, spread: str, how: str = "inner", floor: int = HOT_ROWS, ways: int = 64,
    hot: list | None = None,
) -> DataFrame:
    """Join many `left` rows with `right` rows on `key`; rows of hot keys are dealt over `ways` tasks.

    `left` is read once more for the counts, unless `hot` names the hot keys: keep it staged or narrow. Only
    rows of hot keys get salts, and only their `right` rows are copied, once for each salt.
    """
    hot = hot_values(left, key, floor) if hot is None else hot
    if not hot:
        return left.join(right, key, how)
    schema = left.select(F.col(key).alias("_hot")).schema
    marks = F.broadcast(left.sparkSession.createDataFrame([(v,) for v in hot], schema))
    is_hot = F.col("_hot").isNotNull()
    salted = left.join(marks, F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(spread), F.lit(ways)).cast("int")).otherwise(0)
    )
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0)))
    copied = right.join(marks, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(salts))
    return salted.drop("_hot").join(copied.drop("_hot"), [key, "_salt"], how).drop("_salt")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); a component is named by its smallest node.

    Star contraction: each round hangs the larger neighbours of a node onto its smallest
    neighbour, then the smaller ones. Rounds grow with the logarithm of the longest path. Every
    round is written to the shared folder, so a lost executor costs no recomputation of earlier ones;
    it goes when the next one is written.
    """
    with dropping_shuffles(edges.sparkSession):
        return _contracted(edges)


def _contracted(edges: DataFrame) -> DataFrame:
    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    ordered = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    current = stage(ordered, "links")
    while True:
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            current.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        lows = smallest(both).withColumn("m", F.least("u", "m"))
        large = (
            join_hot(both, lows, "u", "v").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        )
        large = stage(large, "large-star")
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        lows = smallest(down)
        joined = join_hot(down, lows, "u", "v")
        small = joined.filter("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b")).union(
            lows.select(F.col("m").alias("a"), F.col("u").alias("b"))
        )
        following = stage(small.distinct(), "small-star")
        unstage(large)
        settled = _same(current, following)
        unstage(current)
        if settled:
            break
        current = following
    leaves = following.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = following.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return leaves.union(roots)


def _same(one: DataFrame, other: DataFrame) -> bool:
    def digest(df: DataFrame) -> tuple:
        h = F.xxhash64("a", "b")
        return tuple(df.agg(F.count("*"), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())

    return digest(one) == digest(other)
