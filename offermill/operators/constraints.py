"""Watchlist constraints: every broken rule as a row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.policy import holds
from ..functions.text import is_bare_name, is_http_url, is_identifier, is_non_blank
from ..sources.watchlist import json_list
from .skew import join_split


def duplicate_keys(rows: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """All rows of a key but the first by `pos`, which must be unique.

    The first place of each key is a map-side minimum, so a key with very many
    rows is one small row before it is joined back; its rows are then dealt over
    several tasks.
    """
    firsts = (
        rows.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(pos).alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    return join_split(rows, firsts, key, F.col(pos)).filter(F.col(pos) > F.col("_first")).drop("_first")


def orphan_keys(rows: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose key has no parent row; null keys are orphans too.

    Orphaned keys are found on distinct keys; only these meet the rows again, and
    a key with very many rows is dealt over several tasks.
    """
    known = parents.select(F.col(parent_key).alias(key)).distinct()
    orphaned = rows.select(key).distinct().join(known, key, "left_anti").filter(F.col(key).isNotNull())
    found = join_split(rows, orphaned, key, F.xxhash64(*rows.columns), "left_semi")
    return found.unionByName(rows.filter(F.col(key).isNull()))


def _when(broken: Column, rule: str, message: Column) -> Column:
    return F.when(holds(broken), F.struct(F.lit(rule).alias("rule"), message.alias("message")))


def _rows(table: DataFrame, domain: str, rules: Column) -> DataFrame:
    broken = table.select(F.col("pos").cast("long").alias("at"), F.explode(rules).alias("v"))
    return broken.select(F.lit(domain).alias("domain"), F.col("at").alias("pos"), "v.*")


def _label(domain: str) -> Column:
    return F.concat(F.lit(f"{domain}["), F.col("pos").cast("string"), F.lit("]"))


def _channel_rules(label: Column) -> Column:
    channels = F.col("channels")
    allowed = F.array(*map(F.lit, fv.CHANNEL_KEYS))
    unknown = F.transform(
        F.filter(F.map_keys(channels), lambda k: ~F.array_contains(allowed, k)),
        lambda k: F.struct(
            F.lit("channel_key").alias("rule"),
            F.concat(
                label, F.lit('.channels has unknown key "'), k,
                F.lit(f'" (allowed: {", ".join(fv.CHANNEL_KEYS)})'),
            ).alias("message"),
        ),
    )
    fixed = [
        _when(
            channels[key].isNotNull() & ~is_http_url(channels[key]),
            "channel_url",
            F.concat(label, F.lit(f".channels.{key} must be null or an http(s) url")),
        )
        for key in fv.CHANNEL_URL_KEYS
    ]
    orgs = channels["github_orgs"]
    names = json_list(orgs)
    fixed.append(
        _when(
            channels["hf_org"].isNotNull() & ~is_bare_name(channels["hf_org"]),
            "hf_org",
            F.concat(label, F.lit(".channels.hf_org must be null or a bare hugging face org name")),
        )
    )
    fixed.append(
        _when(
            orgs.isNotNull() & (names.isNull() | F.exists(names, lambda n: ~is_bare_name(n))),
            "github_orgs",
            F.concat(label, F.lit(".channels.github_orgs must be null or an array of bare github org names")),
        )
    )
    return F.concat(F.coalesce(unknown, F.array()), F.array_compact(F.array(*fixed)))


def _vendor_rows(vendors: DataFrame) -> DataFrame:
    label = _label("vendors")
    own = F.array_compact(
        F.array(
            _when(~is_identifier(F.col("key")), "key", F.concat(label, F.lit(".key must be a lowercase identifier"))),
            _when(
                ~is_non_blank(F.col("label")), "label", F.concat(label, F.lit(".label must be a non empty string"))
            ),
            _when(
                ~holds(F.col("tier").isin(*map(float, fv.VENDOR_TIERS))),
                "tier",
                F.concat(label, F.lit(f".tier must be one of {', '.join(map(str, fv.VENDOR_TIERS))}")),
            ),
            _when(
                F.col("channels").isNull(), "channels", F.concat(label, F.lit(".channels must be an object"))
            ),
        )
    )
    return _objects(vendors, "vendors", F.concat(own, F.coalesce(_channel_rules(label), F.array())))


def _objects(table: DataFrame, domain: str, rules: Column) -> DataFrame:
    """Violations of the entries; an entry that is no object has just that one."""
    not_object = F.array(
        F.struct(
            F.lit("object").alias("rule"), F.concat(_label(domain), F.lit(" must be an object")).alias("message")
        )
    )
    if "is_object" in table.columns:
        rules = F.when(~F.col("is_object"), not_object).otherwise(rules)
    return _rows(table, domain, rules)


def _duplicates(table: DataFrame, domain: str, key: str) -> DataFrame:
    """Duplicates among well-formed keys."""
    again = duplicate_keys(table.filter(is_identifier(F.col(key))), key)
    message = F.concat(_label(domain), F.lit(f'.{key} "'), F.col(key), F.lit('" is duplicated'))
    return _rows(
        again, domain, F.array(F.struct(F.lit("duplicate").alias("rule"), message.alias("message")))
    )


def _monitor_rows(monitors: DataFrame) -> DataFrame:
    label = _label("provider_monitors")
    watch = F.col("watch")
    bad_urls = F.transform(
        F.filter(F.map_entries(watch), lambda e: ~is_http_url(e["value"])),
        lambda e: F.struct(
            F.lit("watch_url").alias("rule"),
            F.concat(label, F.lit(".watch."), e["key"], F.lit(" must be an http(s) url")).alias("message"),
        ),
    )
    own = F.array_compact(
        F.array(
            _when(
                ~is_identifier(F.col("provider_key")),
                "provider_key",
                F.concat(label, F.lit(".provider_key must be a lowercase identifier")),
            ),
            _when(
                watch.isNull() | (F.size(watch) == 0),
                "watch",
                F.concat(label, F.lit(".watch must be a non empty object of url keys")),
            ),
        )
    )
    return _objects(monitors, "provider_monitors", F.concat(own, F.coalesce(bad_urls, F.array())))


def _community_rows(community: DataFrame) -> DataFrame:
    label, kind = _label("community"), F.col("kind")

    def empty(name: str) -> Column:
        return ~holds(F.size(json_list(F.col(name))) > 0)

    def no_list(name: str) -> Column:
        return json_list(F.col(name)).isNull()

    rules = [
        _when(
            ~holds(kind.isin(*fv.COMMUNITY_KINDS)),
            "kind",
            F.concat(label, F.lit(f".kind must be one of {', '.join(fv.COMMUNITY_KINDS)}")),
        ),
        _when(
            (kind == "reddit") & empty("subreddits"),
            "subreddits",
            F.concat(label, F.lit(".subreddits must be a non empty array")),
        ),
        _when(
            (kind == "hn") & empty("queries"), "queries", F.concat(label, F.lit(".queries must be a non empty array"))
        ),
        _when(
            (kind == "github") & (no_list("repos") | no_list("orgs")),
            "repos",
            F.concat(label, F.lit(" requires repos[] and orgs[] arrays")),
        ),
        _when(
            F.col("keywords").isNotNull() & no_list("keywords"),
            "keywords",
            F.concat(label, F.lit(".keywords must be an array")),
        ),
    ]
    return _objects(community, "community", F.array_compact(F.array(*rules)))


def _listed_rows(table: DataFrame, domain: str) -> DataFrame:
    label = _label(domain)
    rules = [
        _when(~is_identifier(F.col("key")), "key", F.concat(label, F.lit(".key must be a lowercase identifier"))),
        _when(~is_non_blank(F.col("label")), "label", F.concat(label, F.lit(".label must be a non empty string"))),
    ]
    if domain == "coding_products":
        changelog = F.col("changelog_url")
        rules += [
            _when(
                ~is_http_url(F.col("pricing_url")),
                "pricing_url",
                F.concat(label, F.lit(".pricing_url must be an http(s) url")),
            ),
            _when(
                changelog.isNotNull() & ~is_http_url(changelog),
                "changelog_url",
                F.concat(label, F.lit(".changelog_url must be null or an http(s) url")),
            ),
        ]
    else:
        rules.append(
            _when(~is_http_url(F.col("url")), "url", F.concat(label, F.lit(".url must be an http(s) url")))
        )
        rules += [
            _when(
                F.col(name).isNotNull() & ~is_non_blank(F.col(name)),
                name,
                F.concat(label, F.lit(f".{name} must be null or a non empty string")),
            )
            for name in fv.PROGRAM_KEYS
        ]
    return _objects(table, domain, F.array_compact(F.array(*rules)))


def _frontier_rows(frontier: DataFrame, vendors: DataFrame) -> list[DataFrame]:
    """One message when any key is malformed, and one per key without a vendor."""
    bad = frontier.agg(F.count_if(~is_identifier(F.col("key"))).alias("n")).filter("n > 0")
    malformed = bad.select(
        F.lit("frontier_vendors").alias("domain"),
        F.lit(None).cast("long").alias("pos"),
        F.lit("key").alias("rule"),
        F.lit("frontier_vendors must be an array of lowercase identifier keys").alias("message"),
    )
    sound = vendors.filter(is_identifier(F.col("key")))
    orphans = orphan_keys(frontier, sound, "key", "key")
    message = F.concat(
        F.lit('frontier_vendors key "'), F.coalesce("key", F.lit("null")), F.lit('" has no matching vendors entry')
    )
    return [
        malformed,
        _rows(
            orphans,
            "frontier_vendors",
            F.array(F.struct(F.lit("orphan").alias("rule"), message.alias("message"))),
        ),
    ]


def _meta_rows(meta: DataFrame, vendors: DataFrame | None) -> list[DataFrame]:
    windows = F.col("windows")
    rules = [
        _when(
            ~F.col("version").eqNullSafe(F.lit(float(fv.WATCHLIST_VERSION))),
            "version",
            F.concat(
                F.lit(f"watchlist version must be {fv.WATCHLIST_VERSION}, found "),
                F.coalesce(F.col("version").cast("string"), F.lit("none")),
            ),
        ),
        _when(windows.isNull(), "windows", F.lit("windows must be an object")),
    ]
    for key in fv.WINDOW_KEYS:
        days = windows[key]
        sound = holds((days == F.floor(days)) & (days >= 1) & (days <= 365))
        rules.append(
            _when(
                windows.isNotNull() & ~sound, "windows", F.lit(f"windows.{key} must be an integer from 1 to 365")
            )
        )
    arrays = F.transform(
        "not_arrays",
        lambda d: F.struct(F.lit("array").alias("rule"), F.concat(d, F.lit(" must be an array")).alias("message")),
    )
    table = meta.withColumn("pos", F.lit(None).cast("long"))
    out = [_rows(table, "watchlist", F.concat(F.array_compact(F.array(*rules)), F.coalesce(arrays, F.array())))]
    if vendors is not None:
        none = vendors.agg(F.count("*").alias("n")).filter("n = 0")
        out.append(
            none.select(
                F.lit("vendors").alias("domain"),
                F.lit(None).cast("long").alias("pos"),
                F.lit("non_empty").alias("rule"),
                F.lit("vendors must be a non empty array").alias("message"),
            )
        )
    return out


def watchlist_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Every violation in the given domain tables: (domain, pos, rule, message)."""
    found: list[DataFrame] = []
    vendors = tables.get("vendors")
    if "meta" in tables:
        found += _meta_rows(tables["meta"], vendors)
    if vendors is not None:
        found += [_vendor_rows(vendors), _duplicates(vendors, "vendors", "key")]
        if "frontier_vendors" in tables:
            found += _frontier_rows(tables["frontier_vendors"], vendors)
    if "provider_monitors" in tables:
        monitors = tables["provider_monitors"]
        found += [_monitor_rows(monitors), _duplicates(monitors, "provider_monitors", "provider_key")]
    if "community" in tables:
        found.append(_community_rows(tables["community"]))
    for domain in ("coding_products", "credit_programs"):
        if domain in tables:
            found.append(_listed_rows(tables[domain], domain))
    return reduce(DataFrame.unionByName, found)
