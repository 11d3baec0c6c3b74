"""Keyed changes of a watchlist table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .numbering import number_rows
from .skew import join_split


class ChangeRefused(ValueError):
    """A change that would break the table; nothing was written."""


def upsert_entries(target: DataFrame, updates: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """Replace every row of an updated key where it stands; append new keys at the end.

    Updates apply in the order of their own `pos`: the last one of a key wins, and
    a new key takes its place from its first. Both are map-side aggregates, so a
    key updated very often is one row before the join. `target` is joined once.
    """
    content = [c for c in target.columns if c not in (key, pos)]
    latest = updates.groupBy(key).agg(
        F.max_by(F.struct(*content), pos).alias("_new"), F.min(pos).alias("_asked")
    )
    # Rows of a target key may be many: those of hot keys are dealt over several tasks.
    replaced = join_split(target, latest.select(key, "_new"), key, F.col(pos), "left").select(
        key, pos, *[F.when(F.col("_new").isNull(), F.col(c)).otherwise(F.col(f"_new.{c}")).alias(c) for c in content]
    )
    known = target.select(key).distinct()
    added = latest.join(known, key, "left_anti").select(key, "_asked", "_new.*")
    numbered = number_rows(added, [], [F.col("_asked"), F.col(key)], "_n").drop("_asked")
    last = target.agg(F.coalesce(F.max(pos), F.lit(-1))).first()[0]
    appended = numbered.withColumn(pos, (F.col("_n") + F.lit(last)).cast(target.schema[pos].dataType)).drop("_n")
    return replaced.unionByName(appended)


def _refuse(keys: DataFrame, what: str) -> None:
    """Stop with the number of keys and the first of them, if there are any."""
    first = keys.limit(20).collect()
    if first:
        named = ", ".join(repr(r[0]) for r in first)
        raise ChangeRefused(f"{what} {named}" + (f" and more, {keys.count()} in all" if len(first) == 20 else ""))


def remove_entries(
    target: DataFrame, keys: DataFrame, key: str, protected: DataFrame | None = None
) -> DataFrame:
    """The table without the given keys.

    Refused when a key is not there, or is still named in `protected` (a table
    with the same key column).
    """
    wanted = keys.select(key).distinct()
    _refuse(wanted.join(target.select(key).distinct(), key, "left_anti"), "no entry with key")
    if protected is not None:
        _refuse(wanted.join(protected.select(key).distinct(), key, "left_semi"), "still listed elsewhere:")
    return join_split(target, wanted, key, F.xxhash64(*target.columns), "left_anti")
