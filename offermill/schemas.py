"""Column types of the engine's tables."""

from pyspark.sql import types as T


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _D, _B, _L = T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType()
PRICE = _struct(input=_D, output=_D)

# The fields of one offer as they stand in a report. Dates stay ISO text, as in
# the report: whether text is a date is itself part of the checks.
OFFER_FIELDS = _struct(
    name=_S, model_name=_S, provider=_S, provider_key=_S, model_id=_S, canonical_model_id=_S,
    base_url=_S, endpoint_source=_S, price_source=_S, delivery_type=_S, information_confidence=_S,
    access_kind=_S, classification=_S, ranking_eligible=_B,
    effective_price_per_million=PRICE, normal_price_per_million=PRICE, discount_rates=PRICE,
    benchmark_key=_S,
    benchmark=_struct(score=_D, benchmark_name=_S, version=_S, tier=_S),
    benchmarks=T.ArrayType(_struct(name=_S, version=_S, score=_D)),
    sources=T.ArrayType(_S), registration_conditions=T.ArrayType(_S),
    suspicion_score=_D, suspicion_reasons=T.ArrayType(_S),
    total_parameters_b=_D, context_tokens=_D,
    operational_confidence=_S, free_allowance_rank=_S, free_endpoint_status=_S,
    free_limits=_S, rate_limits=_S, training_use=_S, data_policy=_S, data_policy_source=_S,
    caution_reason=_S, exclusion_reason=_S, recent_activity=_S,
    tool_calling=_B, end_timezone_known=_B,
    last_verified=_S, price_verified_at=_S, end_at=_S, discount_end_at=_S,
    window=_struct(start=_S, end=_S),
    verified=_B, stale_mild=_B, provider_count=_L, api_calls_30d=_L, uptime_percent=_D,
)

# Where an offer stands: run, section, place in the section, and an id that is
# unique within the run and rises with the place.
OFFER_PLACE = _struct(run_id=_S, section=_S, pos=_L, offer_id=_L)
OFFERS = T.StructType(OFFER_PLACE.fields + OFFER_FIELDS.fields)

CONTRADICTION = _struct(offer_name=_S, fact=_S, adopted_value=_S, values=T.ArrayType(_S))
UPDATE = _struct(
    key=_S, label=_S, source_url=_S, facts=_struct(date=_S, title=_S, excerpt=_S, url=_S)
)
REGISTRY_ENTRY = _struct(
    key=_S, label=_S, match=T.ArrayType(_S), base_url=_S, base_url_pattern=_S, openai=_B,
    agents=T.ArrayType(_S), docs_url=_S, openai_base_url=_S, anthropic_base_url=_S,
    openrouter=_B, model_page_template=_S,
)
