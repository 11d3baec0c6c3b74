"""Watchlist: load, change and write, each behind the full constraint check."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as fv
from ..functions.text import is_identifier
from ..operators.changes import ChangeRefused, remove_entries, upsert_entries
from ..operators.constraints import watchlist_violations
from ..sources.watchlist import DOMAINS, read_raw_watchlist
from .publish import live_table, promote

KEYS = {
    "vendors": "key",
    "provider_monitors": "provider_key",
    "community": "kind",
    "coding_products": "key",
    "credit_programs": "key",
}

Tables = dict[str, DataFrame]


class WatchlistInvalid(ValueError):
    """The message lists every violation."""


def check(tables: Tables, what: str = "invalid watchlist") -> None:
    # The list comes whole to the driver: it is an error text about a document
    # that people write by hand.
    absent = [f"{name} must be an array" for name in DOMAINS if name not in tables]
    if "meta" not in tables:
        absent.append("version and windows must be there")
    found = watchlist_violations(tables).orderBy("domain", "pos", "rule") if tables else None
    messages = absent + ([r.message for r in found.collect()] if found is not None else [])
    if messages:
        raise WatchlistInvalid("\n  ".join([f"{what}:", *messages]))


def read_watchlist(spark: SparkSession, path: str) -> Tables:
    """Domain tables of a watchlist document that keeps all constraints."""
    tables = read_raw_watchlist(spark, path)
    check(tables, f"invalid watchlist at {path}")
    return tables


def _domain_key(domain: str) -> str:
    if domain not in KEYS:
        raise ChangeRefused(f"domain must be one of {', '.join(fv.EDITABLE_DOMAINS)}")
    return KEYS[domain]


def add_entries(tables: Tables, domain: str, entries: DataFrame) -> Tables:
    """The tables with `entries` added to, or replaced in, one domain."""
    key = _domain_key(domain)
    if entries.filter(~is_identifier(F.col(key))).limit(1).count():
        raise ChangeRefused("entry requires a lowercase identifier key")
    changed = {**tables, domain: upsert_entries(tables[domain], entries, key)}
    check(changed, "watchlist invalid after add")
    return changed


def drop_entries(tables: Tables, domain: str, keys: DataFrame) -> Tables:
    """The tables without the given keys of one domain."""
    key = _domain_key(domain)
    protected = tables.get("frontier_vendors") if domain == "vendors" else None
    changed = {**tables, domain: remove_entries(tables[domain], keys, key, protected)}
    check(changed, "watchlist invalid after remove")
    return changed


def write_watchlist(tables: Tables, path: str) -> None:
    """Check, write all tables to a version of their own, then switch; a bad document leaves the old one."""
    check(tables, "refusing to write invalid watchlist")
    spark = next(iter(tables.values())).sparkSession
    staging = f"{path.rstrip('/')}/versions/{uuid.uuid4().hex}"
    for name, table in tables.items():
        table.write.parquet(f"{staging}/{name}")
    promote(spark, staging, path.rstrip("/"), list(tables))


def read_written_watchlist(spark: SparkSession, path: str, names) -> Tables:
    return {name: live_table(spark, path.rstrip("/"), name) for name in names}
