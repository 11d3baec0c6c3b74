"""Price texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as fv


def _any_size(c: Column) -> Column:
    """Twelve digits of any double, spelled out from its exponent."""
    scientific = F.format_string("%.11e", F.abs(c))
    digits = F.concat(F.substring(scientific, 1, 1), F.substring(scientific, 3, 11))
    power = F.regexp_extract(scientific, r"e([+-]\d+)\z", 1).cast("int")
    number = F.when(power >= 11, F.concat(digits, F.repeat(F.lit("0"), power - 11))).otherwise(
        F.rtrim(F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits), F.lit("0"))
    )
    return F.concat(F.when(c < 0, "-").otherwise(""), number)


def format_price(c: Column) -> Column:
    """`$` and at most twelve significant digits, without grouping or exponent."""
    size = F.abs(c)
    # Within this range a decimal holds all twelve digits; nearly every price does.
    usual = F.format_string("%.11e", c).cast("decimal(38,22)").cast("string")
    number = (
        F.when((size >= 1.0e-10) & (size < 1.0e15), F.regexp_replace(usual, r"\.?0+\z", ""))
        .when(F.isnan(c), "NaN")
        .when(size == float("inf"), F.when(c < 0, "-∞").otherwise("∞"))
        .otherwise(_any_size(c))
    )
    return (
        F.when(c.isNull(), fv.TEXT_DASH).when(c == 0, "$0").otherwise(F.concat(F.lit("$"), number))
    )


def discount_value(c: Column) -> Column:
    return F.when(c.isNull(), fv.TEXT_NOT_OBTAINED).otherwise(format_price(c))


def shown_price(effective: Column, normal: Column) -> Column:
    return F.coalesce(effective, normal)


def shows_free(kind: Column, price: Column) -> Column:
    zero = (price["input"] == 0) & (price["output"] == 0)
    return F.coalesce(kind == "FREE", F.lit(False)) | F.coalesce(zero, F.lit(False))


def price_text(kind: Column, price: Column) -> Column:
    pair = F.concat(format_price(price["input"]), F.lit(" / "), format_price(price["output"]))
    return F.when(shows_free(kind, price), "$0").otherwise(pair)
