"""Fixes and exclusion gates: one ordered projection.

The first gate an offer fails removes it, so the order of the list below is part
of the result. No gate looks at other rows, except the citation gate, whose
verdict is joined on beforehand.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions import policy as P
from ..functions.policy import DEFAULT, Policy, holds
from ..functions.text import (
    citation_supports, has_text, is_http_url, json_text, number_text,
)
from ..session import stage
from ..sources.registry import Registry
from .matching import with_capability
from .skew import join_counted, split_hot_keys

SENT_VERDICTS = 100_000  # verdicts that Spark may broadcast: their texts take many times their files
STEPS = (
    "schema", "allowance", "classification", "endpoint", "citation", "free-claim", "size",
    "no-terminal-bench", "access-kind", "access-prices", "gate3", "suspicion", "nim", "discount",
)


@dataclass(frozen=True)
class OfferContract:
    """What each offer of a checked section must look like.

    The published report schema is an input of the engine, like the registry:
    `required` names fields that must be there, `required_if_eligible` those only
    an offer marked for ranking needs, `allowed` the values a field may take. By
    default there are no rules.
    """

    required: tuple[str, ...] = ()
    required_if_eligible: tuple[str, ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    sections: tuple[str, ...] = ("ranked_offers", "conditional_credits", "caution_offers")


def _or_question_mark(c: Column) -> Column:
    return F.when(has_text(c), c).otherwise("?")


def eligible_ranked() -> Column:
    return (F.col("section") == "ranked_offers") & F.col("ranking_eligible").eqNullSafe(True)


# ---------------------------------------------------------------- schema gate


def schema_errors(contract: OfferContract) -> Column:
    """Messages of all broken constraints of a row, sorted; empty when it is sound."""
    path = F.concat(F.lit("/"), F.col("section"), F.lit("/"), F.col("pos").cast("string"))
    eligible = F.col("ranking_eligible").eqNullSafe(True)
    errors = [
        F.when(
            F.col(name).isNull(), F.concat(path, F.lit(f": must have required property '{name}'"))
        )
        for name in contract.required
    ]
    errors += [
        F.when(
            eligible & F.col(name).isNull(), F.concat(path, F.lit(f": must have required property '{name}'"))
        )
        for name in contract.required_if_eligible
    ]
    errors += [
        F.when(
            ~F.col(name).isin(*values),
            F.concat(path, F.lit(f"/{name}: must be equal to one of the allowed values")),
        )
        for name, values in contract.allowed.items()
    ]
    if not errors:
        return F.array().cast("array<string>")
    checked = F.col("section").isin(*contract.sections)
    return F.when(checked, F.array_sort(F.array_compact(F.array(*errors)))).otherwise(
        F.array().cast("array<string>")
    )


def is_broken(contract: OfferContract) -> Column:
    """Whether any constraint is broken: the same rules without their messages."""
    eligible = F.col("ranking_eligible").eqNullSafe(True)
    rules = [F.col(name).isNull() for name in contract.required]
    rules += [eligible & F.col(name).isNull() for name in contract.required_if_eligible]
    rules += [holds(~F.col(name).isin(*values)) for name, values in contract.allowed.items()]
    return F.col("section").isin(*contract.sections) & reduce(Column.__or__, rules, F.lit(False))


def schema_reason(contract: OfferContract) -> Column:
    return F.concat(F.lit("[schema] "), F.array_join(schema_errors(contract), "; "))


def schema_violations(offers: DataFrame, contract: OfferContract = OfferContract()) -> DataFrame:
    """One row per offer that breaks the contract, its messages joined."""
    return (
        offers.filter(is_broken(contract))
        .withColumn("_errors", schema_errors(contract))
        .select(
            "run_id", "section", "offer_id",
            _or_question_mark(F.col("name")).alias("name"),
            F.size("_errors").cast("long").alias("errors"),
            F.array_join("_errors", "; ").alias("detail"),
        )
    )


# ---------------------------------------------------------------------- fixes


def _allowance_is_bad() -> Column:
    return ~holds(F.col("free_allowance_rank").isin(*fv.ALLOWANCE_RANKS))


def _class_is_bad(policy: Policy) -> Column:
    price = F.col("effective_price_per_million")
    kind = P.access_kind(price["input"], price["output"], policy)
    return (
        F.col("section").isin("ranked_offers", "conditional_credits", "caution_offers")
        & holds(F.col("classification").isin(*fv.FREE_CLASSES))
        & holds(kind == "ULTRA_LOW")
    )


def fix_allowance(offers: DataFrame) -> DataFrame:
    """Unknown allowance ranks of eligible ranked offers become NORMAL; `fixed` tells which."""
    bad = eligible_ranked() & _allowance_is_bad()
    return offers.withColumns(
        {
            "fixed": bad,
            "free_allowance_rank": F.when(bad, "NORMAL").otherwise(F.col("free_allowance_rank")),
        }
    )


def fix_classification(offers: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Free classes of offers with a cheap but paid price become E_DISCOUNT."""
    bad = _class_is_bad(policy)
    return offers.withColumns(
        {
            "fixed": bad,
            "prior_classification": F.col("classification"),
            "classification": F.when(bad, "E_DISCOUNT").otherwise(F.col("classification")),
        }
    )


# ---------------------------------------------------------------------- gates
#
# Each gate is a condition and a text. Conditions are what every offer goes
# through, so they are short; texts are made for failures only.


@dataclass(frozen=True)
class Gate:
    fails: Column
    reason: Column


def _not(passes: Column) -> Column:
    """Fails unless the test is known to pass."""
    return ~holds(passes)


def _endpoint() -> Gate:
    """Needs `provider_idx`, `by_url` and `cap`."""
    url, source = F.col("base_url"), F.col("endpoint_source")
    official = [F.col(f"cap.{name}") for name in ("label", "base_url", "docs_url")]
    return Gate(
        _not((url != "") & is_http_url(source) & F.col("by_url")),
        F.when(~has_text(url), fv.REASON_NO_BASE_URL)
        .when(~is_http_url(source), fv.REASON_NO_SOURCE)
        .when(
            F.col("provider_idx").isNull(),
            F.format_string(fv.REASON_UNKNOWN_PROVIDER, F.coalesce("provider", F.lit("null"))),
        )
        .otherwise(F.format_string(fv.REASON_CONTRADICTS, url, *official)),
    )


def _citation() -> Gate:
    """Needs `cited`."""
    return Gate(
        ~F.col("cited"),
        F.format_string(
            fv.REASON_CITATION, F.col("endpoint_source"), F.coalesce("base_url", F.lit("null"))
        ),
    )


def _free_claim() -> Gate:
    text = F.concat_ws(
        " ", F.coalesce("free_limits", F.lit("")), F.coalesce("rate_limits", F.lit(""))
    )
    # Word edges are those of ASCII words: Japanese letters next to a phrase do
    # not hide it, as they would with Java's \b.
    before, after = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
    phrases = [p if p.endswith("]") else p + after for p in fv.PAID_PHRASES]
    return Gate(text.rlike(f"(?i){before}({'|'.join(phrases)})"), F.lit(fv.REASON_PAID))


def _size(policy: Policy) -> Gate:
    total, tier = F.col("total_parameters_b"), F.col("benchmark.tier")
    return Gate(
        (total < policy.small_model_b) & _not(tier.isin(*fv.COMPETITIVE_TIERS)),
        F.format_string(fv.REASON_SIZE, number_text(total), F.coalesce(tier, F.lit("null"))),
    )


def _benchmark(policy: Policy) -> Gate:
    ok = P.qualifies_ranking(F.col("benchmark_key"), F.col("benchmark.score"), policy)
    return Gate(~ok, F.lit(fv.REASON_BENCHMARK))


def _access_kind() -> Gate:
    kind = F.col("access_kind")
    return Gate(
        _not(kind.isin(*fv.RANKED_KINDS)), F.format_string(fv.REASON_ACCESS_KIND, json_text(kind))
    )


def _access_prices(policy: Policy) -> Gate:
    price, kind = F.col("effective_price_per_million"), F.col("access_kind")
    matches = P.access_kind_matches(kind, price["input"], price["output"], policy)

    def side(name):
        # Only finite numbers exist in JSON; anything else is written as null.
        text = F.when(P.is_finite(price[name]), number_text(price[name])).otherwise("null")
        return F.concat(F.lit(f'"{name}":'), text)

    shown = F.when(price.isNull(), "null").otherwise(
        F.concat(F.lit("{"), side("input"), F.lit(","), side("output"), F.lit("}"))
    )
    return Gate(
        price.isNull() | ~matches, F.format_string(fv.REASON_ACCESS_PRICES, shown, json_text(kind))
    )


def _confidence() -> Gate:
    c = F.col("operational_confidence")
    return Gate(
        _not(c.isin("HIGH", "MEDIUM")),
        F.when(c == "NONE", fv.REASON_CONFIDENCE_NONE)
        .when(c == "LOW", fv.REASON_CONFIDENCE_LOW)
        .otherwise(F.format_string(fv.REASON_CONFIDENCE_INVALID, json_text(c))),
    )


def _suspicion(policy: Policy) -> Gate:
    score = F.col("suspicion_score")
    # NaN is above infinity and does not count as high.
    return Gate(
        (score > policy.max_suspicion) & (score <= float("inf")),
        F.format_string(fv.REASON_SUSPICION, number_text(score)),
    )


def _deprecated() -> Gate:
    return Gate(F.col("free_endpoint_status") == "deprecated", F.lit(fv.REASON_DEPRECATED))


def _discount() -> Gate:
    normal, effective = F.col("normal_price_per_million"), F.col("effective_price_per_million")
    sides = (normal["input"], normal["output"], effective["input"], effective["output"])
    complete = (
        (F.col("access_kind") == "DISCOUNTED") & F.col("discount_rates").isNotNull() & P.all_known(*sides)
    )
    lower = (sides[0] > sides[2]) | (sides[1] > sides[3])
    return Gate(
        _not(complete & lower),
        F.when(_not(complete), fv.REASON_DISCOUNT_INCOMPLETE).otherwise(fv.REASON_DISCOUNT_NOT_LOWER),
    )


def _single(offers: DataFrame, gate: Gate, scope: Column | None = None) -> DataFrame:
    """Add `gate_reason`, null where the gate passes or does not apply."""
    scope = eligible_ranked() if scope is None else scope
    return offers.withColumn("gate_reason", F.when(scope & gate.fails, gate.reason))


def gate_endpoint(offers: DataFrame, registry: Registry) -> DataFrame:
    return _single(with_capability(offers, registry), _endpoint()).drop("cap")


def gate_free_claim(offers: DataFrame) -> DataFrame:
    return _single(offers, _free_claim())


def gate_size(offers: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    return _single(offers, _size(policy))


def gate_benchmark(offers: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    return _single(offers, _benchmark(policy))


def gate_access_kind(offers: DataFrame) -> DataFrame:
    return _single(offers, _access_kind())


def gate_access_prices(offers: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    return _single(offers, _access_prices(policy))


def gate_confidence(offers: DataFrame) -> DataFrame:
    return _single(offers, _confidence())


def gate_suspicion(offers: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    return _single(offers, _suspicion(policy))


def gate_deprecated(offers: DataFrame) -> DataFrame:
    return _single(offers, _deprecated())


def gate_discount(offers: DataFrame) -> DataFrame:
    return _single(offers, _discount(), F.col("section") == "discount_offers")


# -------------------------------------------------------------- citation gate


def offers_per_source(offers: DataFrame) -> DataFrame:
    """How many eligible ranked offers cite each URL."""
    cited = offers.filter(eligible_ranked() & is_http_url(F.col("endpoint_source")))
    return cited.groupBy("endpoint_source").agg(F.count("*").alias("offers"))


def join_citations(offers: DataFrame, pages: DataFrame) -> DataFrame:
    """Add `cited`: whether the cited page names the endpoint; null when there is no page.

    Offers that share (URL, endpoint) are judged once: the pairs are made
    distinct in the map tasks, staged, and only they meet the page texts. A page
    cited with very many endpoints is split over several tasks. The verdicts go
    back by an equi-join, which deals the rows of a pair with very many offers over
    several tasks; rows outside the gate get scattered keys that match nothing, so
    they do not gather in one task as nulls would.
    """
    scope = eligible_ranked() & is_http_url(F.col("endpoint_source"))
    url, base = F.col("endpoint_source"), F.coalesce("base_url", F.lit(""))
    counted = offers.filter(scope).groupBy(url.alias("_url"), base.alias("_base")).agg(F.count("*").alias("_rows"))
    pairs = stage(counted, "citations")
    texts = pages.select(F.col("url").alias("_page"), "html")
    left, right = split_hot_keys(pairs, texts, "_url", "_page", F.col("_base"))
    joined = left.join(
        right.withColumnRenamed("_salt", "_page_salt"),
        (F.col("_url") == F.col("_page")) & (F.col("_salt") == F.col("_page_salt")),
    )
    # Staged, so that page texts are read once, however often and in how many parts the offers are.
    verdicts = stage(
        joined.select("_url", "_base", citation_supports(F.col("html"), F.col("_base")).alias("cited")), "verdicts"
    )
    if verdicts.count() > SENT_VERDICTS:
        verdicts = verdicts.hint("merge")
    keyed = offers.withColumns(
        {
            "_url": F.when(scope, url).otherwise(F.concat(F.lit("#"), F.pmod("offer_id", F.lit(65536)).cast("string"))),
            "_base": base,
        }
    )
    return join_counted(keyed, verdicts, ("_url", "_base"), pairs, F.col("offer_id")).drop("_url", "_base")


def gate_citation(offers: DataFrame, pages: DataFrame) -> DataFrame:
    return _single(join_citations(offers, pages), _citation())


# ------------------------------------------------------------------ waterfall


def apply_gates(
    offers: DataFrame,
    registry: Registry,
    pages: DataFrame | None = None,
    contract: OfferContract = OfferContract(),
    policy: Policy = DEFAULT,
) -> DataFrame:
    """Run all fixes and gates over all runs at once.

    Adds `gate`, `reason`, `failed_gates` (all failures, the deciding one first),
    `fixes`, and `removed` (taken out of its section). Offers broken by schema
    stay in their section, no longer eligible. Without `pages` the citation gate
    is off and the whole waterfall is one projection over the scan.
    """
    df = with_capability(offers, registry)
    if pages is not None:
        df = join_citations(df, pages)

    gates = {
        "endpoint": _endpoint(),
        "citation": _citation(),
        "free-claim": _free_claim(),
        "size": _size(policy),
        "no-terminal-bench": _benchmark(policy),
        "access-kind": _access_kind(),
        "access-prices": _access_prices(policy),
        "gate3": _confidence(),
        "suspicion": _suspicion(policy),
        "nim": _deprecated(),
    }
    if pages is None:
        del gates["citation"]
    discount = _discount()
    broken = is_broken(contract)
    in_ranking = eligible_ranked()
    in_discounts = F.col("section") == "discount_offers"

    first = F.when(broken, "schema").when(
        ~in_ranking, F.when(in_discounts & discount.fails, "discount")
    )
    for code, gate in gates.items():
        first = first.when(gate.fails, code)
    # `gate` is settled before any text is made, in a projection of its own.
    df = df.withColumns(
        {
            "gate": first,
            "_allowance_fixed": in_ranking & ~broken & _allowance_is_bad(),
            "_class_fixed": _class_is_bad(policy),
        }
    )

    gate = F.col("gate")
    reason = F.when(gate == "schema", schema_reason(contract)).when(gate == "discount", discount.reason)
    for code, one in gates.items():
        reason = reason.when(gate == code, one.reason)
    failed = F.array_compact(
        F.array(
            F.when(gate == "schema", "schema"),
            *[F.when(in_ranking & (gate != "schema") & one.fails, code) for code, one in gates.items()],
            F.when(gate == "discount", "discount"),
        )
    )

    def fix(condition: Column, gate: str, detail: Column) -> Column:
        return F.when(
            condition,
            F.struct(F.lit(STEPS.index(gate) + 1).alias("step"), F.lit(gate).alias("gate"), detail.alias("detail")),
        )

    fixes = F.array_compact(
        F.array(
            fix(F.col("_allowance_fixed"), "allowance", F.lit(fv.DETAIL_ALLOWANCE)),
            fix(
                F.col("_class_fixed"),
                "classification",
                F.format_string(fv.DETAIL_CLASSIFICATION, F.col("classification")),
            ),
        )
    )
    failed_any = gate.isNotNull()
    # Texts, lists and flags are projections of their own as well: each stays
    # small enough to be compiled, and is dropped where nobody asks for it.
    df = df.withColumn("reason", reason)
    df = df.withColumn(
        "failed_gates", F.when(failed_any, failed).otherwise(F.array().cast("array<string>"))
    )
    return df.withColumns(
        {
            "fixes": fixes,
            "removed": failed_any & (gate != "schema"),
            "free_allowance_rank": F.when(F.col("_allowance_fixed"), "NORMAL").otherwise(F.col("free_allowance_rank")),
            "classification": F.when(F.col("_class_fixed"), "E_DISCOUNT").otherwise(F.col("classification")),
            "ranking_eligible": F.when(failed_any, F.lit(False)).otherwise(F.col("ranking_eligible")),
            "exclusion_reason": F.coalesce("reason", "exclusion_reason"),
        }
    ).drop("_allowance_fixed", "_class_fixed", "cap")


def checked_offers(gated: DataFrame) -> DataFrame:
    """The offers that stay in their section."""
    return gated.filter(~F.col("removed"))


def excluded_offers(gated: DataFrame) -> DataFrame:
    """Name and reason of what this run excluded."""
    return gated.filter(F.col("gate").isNotNull()).select(
        "run_id", "section", "pos", "offer_id",
        _or_question_mark(F.col("name")).alias("name"), "gate", "reason",
    )


def fix_log(gated: DataFrame) -> DataFrame:
    """All actions as rows, in one pass; `step`, section and place give their order."""
    exclusion = F.when(
        F.col("gate").isNotNull(),
        F.struct(
            F.array_position(F.array(*map(F.lit, STEPS)), F.col("gate")).cast("int").alias("step"),
            F.lit("exclude").alias("action"),
            F.col("gate").alias("gate"),
            F.col("reason").alias("detail"),
        ),
    )
    fixes = F.transform(
        "fixes",
        lambda f: F.struct(
            f["step"].alias("step"), F.lit("auto-fix").alias("action"), f["gate"].alias("gate"),
            f["detail"].alias("detail"),
        ),
    )
    actions = F.array_compact(F.concat(fixes, F.array(exclusion)))
    rows = gated.select("run_id", "section", "pos", "offer_id", "name", F.explode(actions).alias("a"))
    return rows.select(
        "run_id",
        F.col("a.step").alias("step"),
        "section", "pos", "offer_id",
        F.when(F.col("a.action") == "exclude", _or_question_mark(F.col("name")))
        .otherwise(F.col("name"))
        .alias("offer"),
        F.col("a.action").alias("action"),
        F.col("a.gate").alias("gate"),
        F.col("a.detail").alias("detail"),
    )


def gate_counts(gated: DataFrame) -> DataFrame:
    """Excluded offers per run and gate."""
    failed = gated.filter(F.col("gate").isNotNull())
    return failed.groupBy("run_id", "gate").agg(F.count("*").alias("offers"))


def contradiction_violations(contradictions: DataFrame) -> DataFrame:
    """Contradictions with fewer than two values; any row aborts the run."""
    n = F.coalesce(F.size("values"), F.lit(0))
    n = F.when(F.col("values").isNull(), 0).otherwise(n)
    bad = contradictions.withColumn("n_values", n.cast("long")).filter("n_values < 2")
    return bad.withColumn(
        "message",
        F.format_string(
            "contradictions entry for %s has %d value(s); a contradiction needs at least two",
            F.coalesce("offer_name", F.lit("null")),
            F.col("n_values"),
        ),
    )


def is_admitted(policy: Policy = DEFAULT) -> Column:
    price = F.col("effective_price_per_million")
    return (
        eligible_ranked()
        & P.qualifies_ranking(F.col("benchmark_key"), F.col("benchmark.score"), policy)
        & holds(F.col("benchmark.tier").isin(*fv.TIERS))
        & holds(F.col("access_kind").isin(*fv.RANKED_KINDS))
        & P.access_kind_matches(F.col("access_kind"), price["input"], price["output"], policy)
    )


def admitted_offers(offers: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """The offers that may be ranked."""
    return offers.filter(is_admitted(policy))
