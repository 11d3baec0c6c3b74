"""Splitting the hot keys of a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def split_hot_keys(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread_by: Column,
    ways: int = 64, floor: int = 20_000, max_hot: int = 1000,
) -> tuple[DataFrame, DataFrame]:
    """Add a `_salt` column to both sides, for a join on key and salt.

    A key is hot when it has more than `floor` left rows and more than one in
    `max_hot` of all left rows, so there are at most `max_hot` hot keys: small
    enough to broadcast. Hot keys get `ways` salts on the left, and their right
    rows are copied once per salt; all other rows keep salt 0. `left` is read
    for the counts first, so it should be a staged or narrow table. `floor` decides
    when copying pays; the result is the same at any value.
    """
    counts = left.filter(F.col(left_key).isNotNull()).groupBy(F.col(left_key).alias("_hot")).count()
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    limit = max(floor, total // max_hot)
    hot = counts.filter(F.col("count") > limit).select("_hot")
    hot_values = [row[0] for row in hot.collect()]
    if not hot_values:
        return left.withColumn("_salt", F.lit(0)), right.withColumn("_salt", F.lit(0))

    hot = F.broadcast(left.sparkSession.createDataFrame([(v,) for v in hot_values], hot.schema))
    is_hot = F.col("_hot").isNotNull()
    salted_left = (
        left.join(hot, F.col(left_key) == F.col("_hot"), "left")
        .withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(spread_by), ways).cast("int")).otherwise(0))
        .drop("_hot")
    )
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0)))
    salted_right = (
        right.join(hot, F.col(right_key) == F.col("_hot"), "left")
        .withColumn("_salt", F.explode(salts))
        .drop("_hot")
    )
    return salted_left, salted_right


def join_split(
    left: DataFrame, right: DataFrame, key: str, spread_by: Column, how: str = "inner", **limits: int
) -> DataFrame:
    """Join on `key`, the rows of hot left keys dealt over several tasks; `right` has few rows per key."""
    right_key = f"_right_{key}"
    salted, copied = split_hot_keys(left, right.withColumnRenamed(key, right_key), key, right_key, spread_by, **limits)
    copied = copied.withColumnRenamed("_salt", "_right_salt")
    met = (F.col(key) == F.col(right_key)) & (F.col("_salt") == F.col("_right_salt"))
    return salted.join(copied, met, how).drop("_salt", "_right_salt", right_key)


def join_counted(
    left: DataFrame, right: DataFrame, keys: tuple[str, ...], counts: DataFrame, spread_by: Column,
    how: str = "left", ways: int = 64, floor: int = 20_000, max_hot: int = 1000,
) -> DataFrame:
    """Join on `keys`, the rows of hot keys dealt over several tasks.

    `counts` is a staged table of the keys that matter with their left rows `_rows`, so `left` is not read for
    them; what is hot, and how it is dealt, is as in `split_hot_keys`.
    """
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    hot = counts.filter(F.col("_rows") > max(floor, total // max_hot)).select(*keys, F.lit(True).alias("_hot"))
    rows = hot.collect()
    if not rows:
        return left.join(right, list(keys), how)
    marks = F.broadcast(left.sparkSession.createDataFrame(rows, hot.schema))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(ways)).cast("int")).otherwise(0)
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0)))
    dealt = left.join(marks, list(keys), "left").withColumn("_salt", salt).drop("_hot")
    copied = right.join(marks, list(keys), "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return dealt.join(copied, [*keys, "_salt"], how).drop("_salt")
