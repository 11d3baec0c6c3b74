"""The data of offer cards, discount cards and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions import text as X
from ..functions.dates import format_date
from ..functions.policy import holds, is_finite
from ..functions.prices import discount_value, price_text, shown_price, shows_free
from ..functions.text import has_text, number_text, text_or_null


def price_display(offers: DataFrame) -> DataFrame:
    """Add `price_text` and `price_is_free`."""
    price = shown_price(F.col("effective_price_per_million"), F.col("normal_price_per_million"))
    return offers.withColumns(
        {
            "price_text": price_text(F.col("access_kind"), price),
            "price_is_free": shows_free(F.col("access_kind"), price),
        }
    )


def display_codes(offers: DataFrame) -> DataFrame:
    """Add badge texts and style codes; a missing badge is null."""
    confidence = F.coalesce(text_or_null(F.col("operational_confidence")), F.lit(fv.TEXT_DASH))
    return offers.withColumns(
        {
            "class_badge": X.class_badge(F.col("classification")),
            "class_style": X.class_badge_style(F.col("classification")),
            "access_badge": X.access_badge(F.col("access_kind")),
            "tier_style": F.when(F.col("benchmark").isNotNull(), X.tier_style(F.col("benchmark.tier"))),
            "confidence_text": confidence,
            "confidence_style": X.confidence_style(F.col("operational_confidence")),
            "training_style": X.training_style(F.col("training_use")),
        }
    )


def discount_cards(offers: DataFrame, tz: Column | str | None = None) -> DataFrame:
    """Rows of the discount section with their price, rate and period texts."""
    normal, effective = F.col("normal_price_per_million"), F.col("effective_price_per_million")
    rates, window = F.col("discount_rates"), F.col("window")

    def pair(price: Column) -> Column:
        return F.concat(discount_value(price["input"]), F.lit(" / "), discount_value(price["output"]))

    def rate(word: str, c: Column) -> Column:
        return F.when(c.isNotNull(), F.concat(F.lit(word + " "), number_text(c), F.lit("%")))

    rate_text = F.concat_ws(" / ", rate("入力", rates["input"]), rate("出力", rates["output"]))
    until = F.when(has_text(window["end"]), format_date(window["end"], tz)).otherwise(fv.TEXT_OPEN_END)
    period = (
        F.when(
            has_text(window["start"]), F.concat(format_date(window["start"], tz), F.lit(" 〜 "), until)
        )
        .when(
            has_text(F.col("discount_end_at")),
            F.concat(format_date(F.col("discount_end_at"), tz), F.lit(" まで")),
        )
        .otherwise(fv.TEXT_NO_WINDOW)
    )
    no_normal = normal["input"].isNull() & normal["output"].isNull()
    return offers.filter(F.col("section") == "discount_offers").select(
        "run_id", "pos", "offer_id", "name", "provider", "model_id", "base_url",
        F.when(no_normal, fv.TEXT_NOT_OBTAINED).otherwise(pair(normal)).alias("normal_text"),
        pair(effective).alias("effective_text"),
        F.when(rate_text == "", fv.TEXT_DASH).otherwise(rate_text).alias("rate_text"),
        period.alias("period_text"),
    )


def benchmark_details(offers: DataFrame) -> DataFrame:
    """One row per listed benchmark, with the length of the list."""
    rows = offers.select(
        "run_id", "offer_id", F.size("benchmarks").cast("long").alias("benchmark_count"),
        F.posexplode("benchmarks").alias("benchmark_no", "b"),
    )
    version = F.col("b.version")
    label = F.concat(
        F.coalesce("b.name", F.lit("")),
        F.when(has_text(version), F.concat(F.lit(" ("), version, F.lit(")"))).otherwise(""),
    )
    return rows.select(
        "run_id", "offer_id", "benchmark_count", "benchmark_no",
        label.alias("label"),
        F.concat(F.coalesce(number_text(F.col("b.score")), F.lit("")), F.lit("%")).alias("value"),
    )


def joined_lists(offers: DataFrame) -> DataFrame:
    """Add conditions and suspicion reasons as one text each; empty lists give null."""

    def joined(name: str) -> Column:
        return F.when(holds(F.size(name) > 0), F.array_join(name, " / ", ""))

    return offers.withColumns(
        {
            "conditions_text": joined("registration_conditions"),
            "suspicion_text": joined("suspicion_reasons"),
        }
    )


def card_attributes(offers: DataFrame, tz: Column | str | None = None) -> DataFrame:
    """The optional attributes of each card as (label, value) rows in fixed order.

    `link` is the page that a value stands on; only the data policy has one.
    """

    def c(name: str) -> Column:
        return F.col(name)

    def when_text(name: str, value: Column | None = None) -> Column:
        return F.when(has_text(c(name)), c(name) if value is None else value)

    def date(name: str) -> Column:
        return format_date(c(name), tz)

    lists = {
        name: F.when(holds(F.size(name) > 0), F.array_join(name, " / ", ""))
        for name in ("suspicion_reasons", "registration_conditions")
    }
    tokens, score = c("context_tokens"), c("suspicion_score")
    zone_note = F.when(c("end_timezone_known").eqNullSafe(True), "").otherwise(" (タイムゾーン不明)")
    reasons = F.coalesce(F.concat(F.lit(" ・ "), lists["suspicion_reasons"]), F.lit(""))
    attributes = [
        ("Context", F.when(is_finite(tokens) & (tokens != 0),
                           F.concat(F.call_function("format_number", tokens, F.lit("#,##0.###")), F.lit(" tokens")))),
        ("Tool calling", F.when(c("tool_calling"), "対応").when(~c("tool_calling"), "非対応")),
        ("Base URL", when_text("base_url")),
        ("Model ID", when_text("model_id")),
        ("価格確認日", when_text("price_verified_at", date("price_verified_at"))),
        ("割引期限", when_text("discount_end_at",
                           F.concat(F.lit("⏳ "), date("discount_end_at"), F.lit("まで")))),
        ("リミット", when_text("free_limits")),
        ("期限", when_text("end_at", F.concat(F.lit("⏳ "), date("end_at"), F.lit("まで"), zone_note))),
        ("レート", when_text("rate_limits")),
        ("データ利用", when_text("training_use")),
        ("データポリシー", when_text("data_policy")),
        ("怪し度", F.when(is_finite(score) & (score > 0),
                       F.concat(number_text(score), F.lit("/5"), reasons))),
        ("条件", lists["registration_conditions"]),
        ("注意", X.stale_note(c("caution_reason"), c("exclusion_reason"))),
    ]
    links = {"データポリシー": when_text("data_policy_source")}
    no_link = F.lit(None).cast("string")
    cells = [
        F.when(
            value.isNotNull(),
            F.struct(
                F.lit(i).alias("attribute_no"), F.lit(label).alias("label"), value.alias("value"),
                links.get(label, no_link).alias("link"),
            ),
        )
        for i, (label, value) in enumerate(attributes, 1)
    ]
    return offers.select("run_id", "section", "offer_id", F.inline(F.array_compact(F.array(*cells))))


def updates_list(updates: DataFrame) -> DataFrame:
    """Headline, date, title, excerpt and links of each update."""
    facts = F.col("facts")
    return updates.select(
        "run_id", "section", "pos",
        F.coalesce(text_or_null(F.col("label")), F.col("key")).alias("headline"),
        *[text_or_null(facts[name]).alias(name) for name in ("date", "title", "excerpt", "url")],
        text_or_null(F.col("source_url")).alias("source_url"),
    )


def contradiction_notes(contradictions: DataFrame) -> DataFrame:
    """What is disputed and which value was adopted."""
    return contradictions.select(
        "run_id", "pos",
        F.coalesce("offer_name", F.lit("")).alias("offer_name"),
        F.coalesce("fact", F.lit("")).alias("fact"),
        F.coalesce("adopted_value", F.lit(fv.TEXT_UNDECIDED)).alias("adopted_value"),
    )
