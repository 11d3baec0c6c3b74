"""Watchlist document: one JSON file to one table per domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

DOMAINS = (
    "frontier_vendors", "vendors", "provider_monitors", "community", "coding_products", "credit_programs",
)
_LISTS = ("subreddits", "queries", "repos", "orgs", "keywords")
_TOP = ("version", "windows", *DOMAINS)

# Values that may be of any type are kept as text, so that the constraint check
# sees them instead of the reader.
ENTRY_TYPES = {
    "vendors": "key string, label string, tier double, channels map<string,string>",
    "provider_monitors": "provider_key string, watch map<string,string>",
    "community": "kind string, subreddits string, queries string, repos string, orgs string, keywords string",
    "coding_products": "key string, label string, pricing_url string, changelog_url string",
    "credit_programs": (
        "key string, label string, url string, max_credit string, currency string, eligibility string,"
        " deadline string, usable_services string, prepaid_conditions string, terms_text string"
    ),
}


def json_list(c: Column) -> Column:
    """Array of raw items, null when the text is no JSON array."""
    return F.when(F.ltrim(c).startswith("["), F.from_json(c, "array<string>"))


def _is_object(column: str) -> Column:
    return F.ltrim(column).startswith("{")


def _checked(name: str, kind: T.DataType) -> Column:
    """A field of `row`. A text field of another JSON type becomes blank text, which no rule takes
    for a text; a list that is written as null stays the text `null`, which is no list."""
    value = F.col(f"row.{name}")
    if kind != T.StringType():
        return value.alias(name)
    found = F.schema_of_variant(F.try_variant_get(F.try_parse_json("raw"), f"$.{name}", "variant"))
    if name in _LISTS:
        return F.when(found == "VOID", "null").otherwise(value).alias(name)
    return F.when(~found.isin("STRING", "VOID"), "").otherwise(value).alias(name)


def read_raw_watchlist(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Domain tables of a watchlist document, not yet checked."""
    schema = ", ".join(f"{name} string" for name in _TOP)
    doc = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    tables = {
        "meta": doc.select(
            F.from_json(F.concat(F.lit('{"v":'), F.coalesce("version", F.lit("null")), F.lit("}")), "v double")["v"]
            .alias("version"),
            F.from_json(F.when(_is_object("windows"), F.col("windows")), "hot_days double, warm_days double, catchup_days double").alias("windows"),
            F.array_compact(
                F.array(*[F.when(json_list(F.col(name)).isNull(), name) for name in DOMAINS])
            ).alias("not_arrays"),
        )
    }
    for name in DOMAINS:
        items = doc.select(F.posexplode(json_list(F.col(name))).alias("pos", "raw"))
        if name == "frontier_vendors":
            tables[name] = items.select("pos", F.col("raw").alias("key"))
        else:
            is_object = _is_object("raw")
            row = F.from_json(F.when(is_object, F.col("raw")), ENTRY_TYPES[name])
            entries = items.select("pos", is_object.alias("is_object"), "raw", row.alias("row"))
            fields = [_checked(field.name, field.dataType) for field in entries.schema["row"].dataType]
            tables[name] = entries.select("pos", "is_object", *fields)
    return tables
