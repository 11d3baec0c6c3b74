"""Text columns: field tests, citation test, number text, display codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as fv
from .policy import holds

# White space as browsers see it, wider than Java's \s.
SPACE = r"\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def has_text(c: Column) -> Column:
    """Neither missing nor empty."""
    return F.coalesce(c, F.lit("")) != ""


def text_or_null(c: Column) -> Column:
    return F.when(c != "", c)


def is_http_url(c: Column) -> Column:
    return holds(c.startswith("https://") | c.startswith("http://"))


def is_non_blank(c: Column) -> Column:
    return holds(c.rlike(f"[^{SPACE}]"))


def is_identifier(c: Column) -> Column:
    return holds(c.rlike(r"^[a-z][a-z0-9_]*\z"))


def is_bare_name(c: Column) -> Column:
    """A name without slash or white space."""
    return is_non_blank(c) & ~holds(c.rlike(f"[/{SPACE}]"))


def url_host(url: Column) -> Column:
    """Host with its port, as a browser gives it: lower case, default port dropped."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\]*)", 1)
    host = F.lower(F.regexp_replace(authority, r"^.*@", ""))
    return (
        F.when(scheme == "https", F.regexp_replace(host, r":443\z", ""))
        .when(scheme == "http", F.regexp_replace(host, r":80\z", ""))
        .otherwise(host)
    )


def citation_supports(html: Column, base_url: Column) -> Column:
    """The page names the URL, the URL without scheme and last slash, or its host."""
    bare = F.regexp_replace(F.regexp_replace(base_url, "^https?://", ""), r"/\z", "")
    host = url_host(base_url)
    return has_text(base_url) & holds(
        html.contains(base_url) | html.contains(bare) | ((host != "") & html.contains(host))
    )


def number_text(c: Column) -> Column:
    """A double as JSON writes it: 7, 0.05, 1e-7."""
    text, size = c.cast("string"), F.abs(c)
    # Digits come from the shortest text, not from the binary value.
    scale = F.when(size < 1, text.cast("decimal(38,23)").cast("string")).otherwise(
        text.cast("decimal(38,16)").cast("string")
    )
    plain = F.regexp_replace(scale, r"\.?0+\z", "")
    exponent = F.regexp_replace(F.regexp_replace(text, r"(\.0)?E", "e"), r"e(\d)", "e+$1")
    return (
        F.when(c == 0, "0")
        .when(~text.contains("E"), F.regexp_replace(text, r"\.0\z", ""))
        .when((size >= 1.0e-6) & (size < 1.0e21), plain)
        .otherwise(exponent)
    )


def json_text(c: Column) -> Column:
    """A text value as JSON: quoted, or null."""
    quoted = F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]\z", "")
    return F.when(c.isNull(), "null").otherwise(quoted)


def stale_note(caution_reason: Column, exclusion_reason: Column) -> Column:
    stale = F.when(
        exclusion_reason.startswith("[stale]"),
        F.regexp_replace(exclusion_reason, rf"^\[stale\][{SPACE}]*", ""),
    )
    return F.coalesce(text_or_null(caution_reason), stale)


def _lookup(c: Column, pairs) -> Column:
    chain = F.when(c == pairs[0][0], pairs[0][1])
    for code, text in pairs[1:]:
        chain = chain.when(c == code, text)
    return chain


def class_badge(classification: Column) -> Column:
    return _lookup(classification, [(code, label) for code, label, _ in fv.CLASS_BADGES])


def class_badge_style(classification: Column) -> Column:
    return _lookup(classification, [(code, style) for code, _, style in fv.CLASS_BADGES])


def access_badge(kind: Column) -> Column:
    return _lookup(kind, [(code, label) for code, label, _ in fv.ACCESS_BADGES])


def tier_style(tier: Column) -> Column:
    return F.when(tier == "S", "tier-s").when(tier == "A", "tier-a").otherwise("tier-b")


def confidence_style(confidence: Column) -> Column:
    return (
        F.when(confidence == "HIGH", "conf-high").when(confidence == "MEDIUM", "conf-med").otherwise("conf-low")
    )


def training_style(training_use: Column) -> Column:
    return F.when(
        text_or_null(training_use).isNotNull(),
        F.when(training_use.rlike("(?i)なし|no"), "train-no").otherwise("train-yes"),
    )
