"""Offers against the provider registry, and what follows from the match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from .. import fixed_values as fv, schemas
from ..functions.text import has_text, text_or_null
from ..sources.registry import INDEXED, Registry, entries
from . import registry_join
from .skew import join_split

CHAIN_ROWS = 200

_WAYS = T.StructType(
    [
        T.StructField("_way", T.IntegerType()),
        T.StructField("provider_idx", T.IntegerType()),
        T.StructField("by_url", T.BooleanType()),
        T.StructField("cap", schemas.REGISTRY_ENTRY),
    ]
)


def _java_pattern(pattern: str) -> str:
    """`$` ends the text here, never before a last line break as in Java."""
    if pattern.endswith("$") and not pattern.endswith("\\$"):
        return pattern[:-1] + r"\z"
    return pattern


def _compiles(df: DataFrame, patterns: Sequence[str]) -> bool:
    probe = df.sparkSession.range(1).select(*[F.lit("").rlike(p) for p in patterns])
    try:
        probe.collect()  # folded by the optimizer, no task is started
    except PySparkException:
        return False
    return True


def _valid_patterns(df: DataFrame, rows: Sequence[tuple[int, str | None]]) -> set[int]:
    """`idx` of the entries whose pattern compiles; the others match no URL."""
    patterns = {idx: _java_pattern(pattern) for idx, pattern in rows if pattern}
    if not patterns or _compiles(df, list(patterns.values())):
        return set(patterns)
    return {idx for idx, pattern in patterns.items() if _compiles(df, [pattern])}


def _first(branches: Sequence[tuple[Column, int]]) -> Column:
    """The value of the first condition that holds, null for none."""
    code = F.when(F.lit(False), F.lit(0))
    for condition, value in branches:
        code = code.when(condition, value)
    return code


def _by_url(rows: Sequence[tuple[int, str | None]], valid: set[int], url: Column) -> list[tuple[Column, int]]:
    """Each pattern is a literal in the plan, compiled once; none at all fits every URL."""
    return [
        (url.isNotNull() if pattern is None else url.rlike(_java_pattern(pattern)), idx)
        for idx, pattern in rows
        if pattern is None or idx in valid
    ]


def _code(by_url: Column, by_text: Column) -> Column:
    """One code of both ways: idx for the URL, -1 - idx for the texts. Texts count only when no pattern fits."""
    return F.coalesce(by_url, -1 - by_text)


def _joined_matches(offers: DataFrame, registry: DataFrame) -> DataFrame:
    url, texts = F.col("_url"), F.col("_texts")

    def loose(patterns, matchers):
        valid = _valid_patterns(offers, [p for p in patterns if p[1] is not None])
        return _first(_by_url(patterns, valid, url)), _first([(texts.contains(m), idx) for idx, m in matchers])

    return registry_join.with_matches(offers, registry, loose, _code)


def with_capability(offers: DataFrame, registry: Registry, chain_rows: int = CHAIN_ROWS) -> DataFrame:
    """Add `provider_idx`, `by_url` and the matched entry as `cap`, null for none.

    Up to `chain_rows` entries the match is a projection: URLs are tried against each pattern in
    registry order, then matchers are searched in URL, provider and name. Its entry comes from a table
    with two rows per entry, one for each way to match, which is broadcast. The join also keeps later
    filters from being pushed into the chain of patterns, which would evaluate it again. A larger registry
    is matched by joins, with the same rows at any `chain_rows`; a stream of offers cannot be.
    """
    columns = offers.columns
    texts = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("base_url", "provider", "name")])
    prepared = offers.withColumns({"_url": text_or_null(F.col("base_url")), "_texts": F.lower(texts)})
    rows = entries(registry, chain_rows)
    if rows is None:
        if offers.isStreaming:
            raise ValueError(f"a stream is matched against {chain_rows} registry entries at most")
        table = registry if isinstance(registry, DataFrame) else offers.sparkSession.createDataFrame(registry, INDEXED)
        cap = F.struct(*[f.name for f in schemas.REGISTRY_ENTRY]).alias("cap")
        ways = table.select(F.col("idx").alias("provider_idx"), cap)
        matched = _joined_matches(prepared, table)
        by_url = F.col("_match") >= 0
        matched = matched.withColumns({"by_url": by_url, "provider_idx": F.when(by_url, F.col("_match")).otherwise(-1 - F.col("_match"))})
        return join_split(matched, ways, "provider_idx", registry_join.spread(matched), "left").select(*columns, "provider_idx", "by_url", "cap")
    patterns = [(r.idx, r.base_url_pattern) for r in rows]
    by_url = _by_url(patterns, _valid_patterns(offers, patterns), F.col("_url"))
    by_text = [(F.col("_texts").contains(m.lower()), -1 - r.idx) for r in rows for m in r.match or ()]
    ways = [(r.idx, r.idx, True, tuple(r)[1:]) for r in rows]
    ways += [(-1 - r.idx, r.idx, False, tuple(r)[1:]) for r in rows]
    table = offers.sparkSession.createDataFrame(ways, _WAYS)
    return (
        prepared.withColumn("_match", _first(by_url + by_text))
        .join(F.broadcast(table), F.col("_match") == F.col("_way"), "left")
        .drop("_url", "_texts", "_match", "_way")
    )


def provider_match(offers: DataFrame, registry: Registry, chain_rows: int = CHAIN_ROWS) -> DataFrame:
    """Add `provider_idx` and `by_url`: the first registry entry that matches."""
    return with_capability(offers, registry, chain_rows).drop("cap")


def client_urls(with_cap: DataFrame) -> DataFrame:
    """Add the URLs for OpenAI-style and Anthropic-style clients."""
    known = F.col("cap").isNotNull()
    return with_cap.withColumns(
        {
            "openai_url": F.when(
                known, F.coalesce(text_or_null(F.col("cap.openai_base_url")), F.col("base_url"))
            ),
            "anthropic_url": F.when(known, text_or_null(F.col("cap.anthropic_base_url"))),
        }
    )


def offer_link(with_cap: DataFrame) -> DataFrame:
    """Add `href` and `link_label`: the model's page, else the first source."""
    template, model = F.col("cap.model_page_template"), text_or_null(F.col("model_id"))
    mark = "{model_id}"
    at = F.locate(mark, template)
    # Only the first placeholder is filled.
    filled = F.when(at > 0, F.overlay(template, model, at, F.lit(len(mark)))).otherwise(template)
    page = F.when(has_text(template) & model.isNotNull(), filled)
    href = F.coalesce(page, text_or_null(F.get("sources", F.lit(0))))
    return with_cap.withColumns(
        {
            "href": href,
            "link_label": F.when(page.isNotNull(), fv.TEXT_MODEL_PAGE).when(
                href.isNotNull(), fv.TEXT_OFFICIAL_SITE
            ),
        }
    )


def connection_matrix(with_cap: DataFrame) -> DataFrame:
    """One row per offer and client: status, mode and endpoint of the connection.

    Four literal clients are exploded per row; there is no join.
    """
    clients = F.array(
        *[
            F.struct(F.lit(i).alias("n"), F.lit(c).alias("client"), F.lit(label).alias("client_label"))
            for i, (c, label) in enumerate(fv.CLIENTS)
        ]
    )
    rows = client_urls(with_cap).withColumn("_c", F.explode(clients))
    cap, client = F.col("cap"), F.col("_c.client")
    builtin = F.coalesce(cap["openrouter"], F.lit(False))
    openai = F.coalesce(cap["openai"], F.lit(False))
    configured = F.coalesce(F.array_contains(cap["agents"], client), F.lit(False))
    mode = (
        F.when(client == "pi", F.when(builtin, "built-in").otherwise("custom"))
        .when(
            client == "claude_code",
            F.when(F.col("anthropic_url").isNotNull(), "direct").when(openai, "proxy").otherwise("cloud"),
        )
        .when(
            client == "opencode",
            F.when(builtin, "built-in").when(openai, "custom").otherwise("native"),
        )
        .otherwise("custom")
    )
    endpoint = (
        F.when(client == "pi", F.when(~builtin, F.col("base_url")))
        .when(
            client == "claude_code",
            F.when(F.col("anthropic_url").isNotNull(), F.col("anthropic_url")).when(openai, F.col("base_url")),
        )
        .when(client == "opencode", F.when(~builtin & openai, F.col("base_url")))
        .otherwise(F.col("openai_url"))
    )
    status = (
        F.when(cap.isNull(), "provider_unknown").when(~configured, "client_unverified").otherwise("configured")
    )
    return rows.select(
        "run_id", "section", "offer_id",
        F.col("_c.n").alias("client_no"), client.alias("client"), F.col("_c.client_label").alias("client_label"),
        F.col("cap.key").alias("provider_key"),
        status.alias("status"),
        F.when(status == "configured", mode).alias("mode"),
        F.when(status == "configured", endpoint).alias("endpoint"),
    )
