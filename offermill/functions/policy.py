"""Policy columns: price pairs, benchmark scores, discounts, evidence.

Everything here is a plain Column expression, so it fuses into the stage of
whatever query uses it. Spark orders NaN above all numbers and treats -0.0 as
equal to 0.0, so each predicate guards for both. Expressions are kept short: a
generated method over 8000 bytes is never compiled to machine code.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, functions as F

from .. import fixed_values as fv


@dataclass(frozen=True)
class Policy:
    """Thresholds of the catalogue; the defaults are the published ones."""

    benchmarks: tuple[str, ...] = fv.RANKING_BENCHMARKS
    min_score: float = fv.RANKING_MIN_SCORE
    frontier_score: float = fv.FRONTIER_MIN_SCORE
    max_input: float = fv.ULTRA_LOW_MAX_INPUT
    max_output: float = fv.ULTRA_LOW_MAX_OUTPUT
    max_suspicion: float = fv.SUSPICION_RANKING_MAX
    small_model_b: float = fv.SMALL_MODEL_LIMIT_B


DEFAULT = Policy()
_INFINITY = float("inf")


def holds(predicate: Column) -> Column:
    """Three-valued logic to two: unknown counts as false."""
    return F.coalesce(predicate, F.lit(False))


def is_finite(c: Column) -> Column:
    # NaN is above infinity in Spark's order, so one comparison rules out both.
    return holds(F.abs(c) < _INFINITY)


def is_positive_zero(c: Column) -> Column:
    return holds((c == 0) & (c.cast("string") == "0.0"))


def _has_plus_sign(c: Column) -> Column:
    """Above minus zero. Its text tells it from zero; positive prices make none."""
    return (c > 0) | (c.cast("string") == "0.0")


def _known_price(c: Column) -> Column:
    return (c >= 0) & (c < _INFINITY)


def access_kind(input_price: Column, output_price: Column, policy: Policy = DEFAULT) -> Column:
    """FREE, ULTRA_LOW or null from the effective prices per million tokens.

    NaN and infinity fail the upper limits; minus zero and less fail the sign.
    """
    cheap = (
        (input_price <= policy.max_input)
        & (output_price <= policy.max_output)
        & _has_plus_sign(input_price)
        & _has_plus_sign(output_price)
    )
    both_zero = (input_price == 0) & (output_price == 0)
    return F.when(cheap, F.when(both_zero, "FREE").otherwise("ULTRA_LOW"))


def is_price_eligible(input_price: Column, output_price: Column, policy: Policy = DEFAULT) -> Column:
    return access_kind(input_price, output_price, policy).isNotNull()


def access_kind_matches(
    kind: Column, input_price: Column, output_price: Column, policy: Policy = DEFAULT
) -> Column:
    """The claimed kind is the derived one; a null claim matches a null result."""
    return kind.eqNullSafe(access_kind(input_price, output_price, policy))


def is_ranking_benchmark(key: Column, policy: Policy = DEFAULT) -> Column:
    return holds(key.isin(*policy.benchmarks))


def _score_at_least(key: Column, score: Column, limit: float, policy: Policy) -> Column:
    return holds(key.isin(*policy.benchmarks) & (score >= limit) & (score < _INFINITY))


def qualifies_ranking(key: Column, score: Column, policy: Policy = DEFAULT) -> Column:
    return _score_at_least(key, score, policy.min_score, policy)


def qualifies_frontier(key: Column, score: Column, policy: Policy = DEFAULT) -> Column:
    return _score_at_least(key, score, policy.frontier_score, policy)


def is_discount(
    normal_input: Column, normal_output: Column, effective_input: Column, effective_output: Column
) -> Column:
    """All four prices known, and the normal one higher in at least one direction."""
    prices = (normal_input, normal_output, effective_input, effective_output)
    lower = (normal_input > effective_input) | (normal_output > effective_output)
    return holds(all_known(*prices) & lower)


def all_known(*prices: Column) -> Column:
    """Every price is finite and not negative; may be null when one is missing."""
    return reduce(Column.__and__, map(_known_price, prices))


def discount_rate(normal: Column, effective: Column) -> Column:
    """Percent off with one decimal, halves up; null without a positive normal price."""
    scaled = (normal - effective) / normal * 1000 + 0.5
    # Beyond 2^53 a double is whole already and floor's bigint would overflow.
    whole = F.when(F.abs(scaled) < 9.0e15, F.floor(scaled).cast("double")).otherwise(scaled)
    return F.when(is_finite(normal) & is_finite(effective) & holds(normal > 0), whole / 10)


def discount_rates(
    normal_input: Column, normal_output: Column, effective_input: Column, effective_output: Column
) -> Column:
    return F.struct(
        discount_rate(normal_input, effective_input).alias("input"),
        discount_rate(normal_output, effective_output).alias("output"),
    )


def _whole(c: Column) -> Column:
    number = c.cast("double")
    return F.when(is_finite(number) & (number == F.floor(number)), number)


def operational_confidence(
    provider_key: Column,
    access_kind: Column,
    verified: Column,
    stale_mild: Column,
    provider_count: Column,
    uptime_percent: Column,
    free_endpoint_status: Column,
    api_calls_30d: Column,
) -> Column:
    """HIGH, MEDIUM, LOW or NONE from the evidence a provider of this sort leaves."""
    fresh, carried = holds(verified), holds(stale_mild)
    count, calls = _whole(provider_count), _whole(api_calls_30d)
    serving = holds(count > 0)
    has_uptime = is_finite(uptime_percent)
    paid_out = holds(access_kind.isin(*fv.RANKED_KINDS))
    claims_cheap = holds((access_kind != "") & (access_kind != "DISCOUNTED"))

    endpoint_page = (
        F.when(free_endpoint_status == "deprecated", "NONE")
        .when(free_endpoint_status == "available", F.when(holds(calls > 0), "HIGH").otherwise("MEDIUM"))
        .otherwise("LOW")
    )
    router = (
        F.when(holds(count == 0) & claims_cheap, "NONE")
        .when(serving & has_uptime, "HIGH")
        .when(serving | has_uptime | fresh | carried, "MEDIUM")
        .otherwise("LOW")
    )
    official = F.when(fresh, "HIGH").when(carried, "MEDIUM").otherwise("LOW")
    return (
        F.when(holds(provider_key == "nvidia") & paid_out, endpoint_page)
        .when(holds(provider_key == "openrouter"), router)
        .otherwise(official)
    )
