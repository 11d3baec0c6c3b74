"""The whole check of a batch of reports: scan, gates, publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.policy import DEFAULT, Policy
from ..operators.gates import OfferContract, apply_gates
from ..sources.registry import Registry
from ..sources.reports import Reports, read_reports
from .publish import publish_report


def validate_reports(
    spark: SparkSession,
    path: str,
    root: str,
    registry: Registry,
    pages: DataFrame | None = None,
    contract: OfferContract = OfferContract(),
    policy: Policy = DEFAULT,
    one_per_line: bool = False,
) -> Reports:
    """Check all reports below `path` and publish the result below `root`."""
    reports = read_reports(spark, path, one_per_line)
    gated = apply_gates(reports.offers, registry, pages, contract, policy)
    publish_report(
        gated, reports.runs, root, reports.contradictions, reports.missing_sections, reports.excluded
    )
    return reports
