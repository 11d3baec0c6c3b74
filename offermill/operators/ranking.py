"""Ranking, slots and places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed_values as fv
from ..functions.dates import parse_instant
from ..functions.policy import DEFAULT, Policy
from .gates import admitted_offers, is_admitted
from .numbering import number_rows

_KEYS = ("_tier", "_access", "_release", "_version", "_score", "_priced")


def _with_keys(offers: DataFrame) -> DataFrame:
    """Sort keys of the ranking.

    Scores of different benchmark versions are never compared. A rule that falls
    back to dates between versions is no total order, so versions form blocks,
    newest first and missing last, and scores count inside a block only. Dotted
    numbers compare part by part, so 2.10 is newer than 2.9; other texts follow.
    """
    version = F.when(F.col("benchmark.version") != "", F.col("benchmark.version"))
    tier = F.array_position(F.array(*map(F.lit, fv.TIERS)), F.col("benchmark.tier")).cast("int")
    score = F.col("benchmark.score") + F.lit(0.0)  # -0.0 ranks with 0.0
    return offers.withColumns(
        {
            "_tier": tier,
            "_access": F.when(F.col("access_kind") == "FREE", 0).otherwise(1),
            "_release": F.when(
                version.rlike(r"^[0-9]{1,18}(\.[0-9]{1,18})*$"), F.split(version, r"\.").cast("array<bigint>")
            ),
            "_version": version,
            "_score": F.when(version.isNotNull(), score),
            "_priced": parse_instant(F.col("price_verified_at")),
        }
    )


def _by_name() -> Column:
    return F.collate(F.coalesce("name", F.lit("")), "UNICODE")


def _order() -> list[Column]:
    return [
        F.col("_tier").asc(),
        F.col("_access").asc(),
        F.col("_release").desc_nulls_last(),
        F.col("_version").desc_nulls_last(),
        F.col("_score").desc_nulls_last(),
        F.col("_priced").desc_nulls_last(),
        _by_name().asc(),
        F.col("offer_id").asc(),
    ]


def ranked_offers(offers: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Admitted offers with their `position`, 1..n in each run."""
    keyed = _with_keys(admitted_offers(offers, policy))
    return number_rows(keyed, ["run_id"], _order(), "position").drop(*_KEYS)


def top_offer(offers: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """The first offer of each run; map tasks send one candidate per run only."""
    first = Window.partitionBy("run_id").orderBy(*_order())
    keyed = _with_keys(admitted_offers(offers, policy)).withColumn("_rank", F.row_number().over(first))
    return keyed.filter("_rank = 1").drop("_rank", *_KEYS)


def _slotted(offers: DataFrame, policy: Policy) -> DataFrame:
    """Rows of the page with slot and sort keys, from one scan."""
    ranked = F.col("section") == "ranked_offers"
    kind = F.col("access_kind")
    shown = offers.filter(is_admitted(policy) | F.col("section").isin(*fv.OFFER_SECTIONS[1:]))
    keyed = _with_keys(shown)
    # Rank keys order ranked rows only; the others keep their place in the report.
    keyed = keyed.withColumns({key: F.when(ranked, F.col(key)) for key in _KEYS})
    return keyed.withColumns(
        {
            "_source": F.when(ranked, 0).when(F.col("section") == "caution_offers", 2).otherwise(1),
            "_listed": F.when(~ranked, F.col("pos")),
            "_name": F.when(ranked, _by_name()),
            "slot": F.when(F.col("section") == "discount_offers", "slot-discount")
            .when(ranked, F.when(kind == "FREE", "slot-free").otherwise("slot-ultra"))
            .when(kind == "ULTRA_LOW", "slot-ultra")
            .otherwise("slot-free"),
        }
    )


def offer_slots(offers: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """All offers of the page in their `slot`, with `slot_position` 1..n in each.

    Ranked offers come first, by rank; conditional, then caution offers follow as
    they stand in the report, eligible or not. Discounts have a slot of their own.
    One range shuffle numbers all slots of all runs.
    """
    order = [F.col("_source").asc(), *_order()[:6], F.col("_listed"), F.col("_name"), F.col("offer_id")]
    numbered = number_rows(_slotted(offers, policy), ["run_id", "slot"], order, "slot_position")
    return numbered.drop("_source", "_listed", "_name", *_KEYS)


def slot_positions(slots: DataFrame) -> DataFrame:
    """The two-digit place shown on each card."""
    text = F.col("slot_position").cast("string")
    return slots.withColumn("shown_position", F.when(F.col("slot_position") < 10, F.concat(F.lit("0"), text)).otherwise(text))
