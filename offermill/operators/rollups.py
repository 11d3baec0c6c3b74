"""Roll-ups per run. Each is one aggregation with map-side partial sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.policy import DEFAULT, Policy, holds
from ..functions.text import has_text
from .gates import admitted_offers, eligible_ranked


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def _per_run(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts for every run; a run without rows counts zero."""
    names = [c for c in counts.columns if c != "run_id"]
    joined = runs.select("run_id").join(counts, "run_id", "left")
    return joined.fillna(0, subset=names)


def report_summary(gated: DataFrame, runs: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Counts and summary sentence of each run after all gates.

    `excluded` holds what the report had excluded before; what the gates excluded
    is counted from `gated`.
    """
    stays = ~F.col("removed")
    ranked = stays & eligible_ranked()
    tier, kind = F.col("benchmark.tier"), F.col("access_kind")
    counts = gated.groupBy("run_id").agg(
        _count(ranked).alias("ranked"),
        *[_count(ranked & (tier == t)).alias(f"tier_{t.lower()}") for t in fv.TIERS],
        _count(ranked & (kind == "FREE")).alias("free"),
        _count(ranked & (kind == "ULTRA_LOW")).alias("ultra_low"),
        _count(stays & (F.col("section") == "caution_offers")).alias("caution"),
        _count(F.col("gate").isNotNull()).alias("excluded"),
    )
    summary = _per_run(runs, counts)
    if excluded is not None:
        earlier = excluded.groupBy("run_id").agg(F.count("*").alias("_earlier"))
        summary = summary.join(earlier, "run_id", "left").withColumn(
            "excluded", F.col("excluded") + F.coalesce("_earlier", F.lit(0))
        ).drop("_earlier")
    numbers = ["ranked", "tier_s", "tier_a", "tier_b", "free", "ultra_low", "caution", "excluded"]
    return summary.withColumn("summary", F.format_string(fv.SUMMARY_TEXT, *map(F.col, numbers)))


def snapshot(offers: DataFrame, runs: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Counts of what each run shows, over admitted offers."""
    price, kind = F.col("effective_price_per_million"), F.col("access_kind")
    both_zero = holds((price["input"] == 0) & (price["output"] == 0))
    counts = admitted_offers(offers, policy).groupBy("run_id").agg(
        F.count("*").alias("total"),
        _count(F.col("benchmark.tier") == "S").alias("s_count"),
        _count(F.col("benchmark.tier") == "A").alias("a_count"),
        _count((kind == "FREE") | (~has_text(kind) & both_zero)).alias("free_count"),
        _count(has_text(F.col("end_at")) | has_text(F.col("discount_end_at"))).alias("limited_count"),
    )
    return _per_run(runs, counts)


def run_stats(gated: DataFrame, runs: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Ranked, excluded in all, fixed and excluded by this check, per run."""
    counts = gated.groupBy("run_id").agg(
        _count(~F.col("removed") & eligible_ranked()).alias("ranked"),
        _count(F.col("gate").isNotNull()).alias("excluded_this_run"),
        F.sum(F.size("fixes").cast("long")).alias("auto_fixed"),
    )
    stats = _per_run(runs, counts).withColumn("excluded", F.col("excluded_this_run"))
    if excluded is None:
        return stats
    earlier = excluded.groupBy("run_id").agg(F.count("*").alias("_earlier"))
    return (
        stats.join(earlier, "run_id", "left")
        .withColumn("excluded", F.col("excluded") + F.coalesce("_earlier", F.lit(0)))
        .drop("_earlier")
    )


def section_counts(
    rows: DataFrame, runs: DataFrame, sections: Sequence[str] = fv.OFFER_SECTIONS, column: str = "section"
) -> DataFrame:
    """Rows per run and section of a fixed list, in its order, with zeros.

    Counted into one row per run and unfolded after it, so that runs and sections
    without rows need no cross product.
    """
    counted = rows.groupBy("run_id").agg(
        *[_count(F.col(column) == name).alias(f"_{i}") for i, name in enumerate(sections)]
    )
    wide = _per_run(runs, counted)
    unfolded = F.array(
        *[
            F.struct(F.lit(i).alias("section_no"), F.lit(name).alias(column), F.col(f"_{i}").alias("rows"))
            for i, name in enumerate(sections)
        ]
    )
    return wide.select("run_id", F.inline(unfolded))
