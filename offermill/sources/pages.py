"""Citation pages: one body per URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def citation_pages(pages: DataFrame, order: str = "page_id", max_chars: int | None = None) -> DataFrame:
    """The earliest body of each URL, whole unless a fetch limit is asked for.

    The earliest copy is found without the bodies, which no task of the scan thus has to sort; a URL with
    very many copies stays cheap. Of rows with the same place, one stays.
    """
    body = F.col("html") if max_chars is None else F.substring("html", 1, max_chars)
    earliest = pages.groupBy(F.col("url").alias("_url")).agg(F.min(F.struct(order)).alias("_least"))
    is_earliest = F.col("url").eqNullSafe(F.col("_url")) & F.col(order).eqNullSafe(F.col("_least")[order])
    first = Window.partitionBy("url").orderBy(order)
    kept = pages.select("url", order, "html").join(earliest, is_earliest, "left_semi")
    ranked = kept.withColumn("_copy", F.row_number().over(first))
    return ranked.filter("_copy = 1").select("url", order, body.alias("html"))
