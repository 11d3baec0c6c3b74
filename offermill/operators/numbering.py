"""Exact row numbers without putting a group into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

_BLOCK_BITS = 33  # width of the row part of monotonically_increasing_id


def number_rows(df: DataFrame, within: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Add `name`: 1..n inside each `within` group, in `order`.

    A window would send a whole group to one task, and one run may hold a third
    of all rows. Instead the rows are range-partitioned on (group, order), so
    that every partition is one stretch of the final order. Each row keeps its
    place in its stretch, and a table with one row per group and stretch gives
    the number of rows before it. `order` should end in a unique column.

    Stretch borders are sampled, so the placed rows are written once before they
    are counted. Drop unneeded columns before calling.
    """
    keys = [F.col(c) for c in within]
    placed = (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = stage(placed, "placed").withColumn("_block", F.shiftright("_place", _BLOCK_BITS))

    before = Window.partitionBy(*within).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*within, "_block").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    offsets = sizes.select(
        *within,
        "_block",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    # Written so that its real size decides how it is joined.
    offsets = stage(offsets, "offsets")
    # A group may be null; an equality would drop its rows.
    offsets = offsets.select("_block", "_shift", *(F.col(c).alias(f"_of_{c}") for c in within))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in within]
    numbered = placed.join(
        offsets.withColumnRenamed("_block", "_in"), reduce(Column.__and__, same, F.col("_block") == F.col("_in"))
    ).drop("_in", *(f"_of_{c}" for c in within))
    return numbered.withColumn(name, (F.col("_place") + F.col("_shift")).cast("long")).drop(
        "_place", "_block", "_shift"
    )
