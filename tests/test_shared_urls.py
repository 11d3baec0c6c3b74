"""Pages that share a URL, and joins whose left keys were counted before."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import oracle
from offermill import session
from offermill.operators.skew import join_counted

SMALL = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def shared_urls(tmp_path_factory):
    """The small tables, every three pages under one URL."""
    folder = tmp_path_factory.mktemp("shared-urls")
    for file in SMALL.glob("*.parquet"):
        if file.name != "pages.parquet":
            (folder / file.name).symlink_to(file)
    pages = f"'{SMALL}/pages.parquet'"
    duckdb.execute(
        f"COPY (SELECT p.* REPLACE (q.url AS url) FROM {pages} p JOIN {pages} q ON q.page_id = p.page_id - p.page_id % 3)"
        f" TO '{folder}/pages.parquet'"
    )
    return str(folder)


@pytest.mark.parametrize("name", ["citation_pages", "gate_citation", "excluded_offers", "failed_gates"])
def test_pages_that_share_a_url(spark, shared_urls, name):
    query, sql = entry.queries()[name], entry.oracle_sql()[name]
    _, rows, difference = oracle.compare(spark, oracle.connect(shared_urls), query, sql, shared_urls)
    assert rows and difference is None


@pytest.mark.parametrize("floor", [1, 100_000])
def test_counted_join_is_a_left_join(spark, floor):
    left = spark.range(2_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("a"), (F.col("id") % 2).alias("b"))
    right = spark.range(7).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"), F.lit("x").alias("found"))
    counts = left.groupBy("a", "b").agg(F.count("*").alias("_rows"))
    got = join_counted(left, right, ("a", "b"), counts, F.col("id"), floor=floor, max_hot=1_000)
    want = left.join(right, ["a", "b"], "left")
    assert sorted(map(str, got.select("id", "a", "b", "found").collect())) == sorted(map(str, want.select("id", "a", "b", "found").collect()))


def test_staging_drops_its_shuffle_files_and_keeps_the_setting(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    shuffles = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    held = shuffles.shuffleStatuses().size()
    rows = spark.range(1_000).repartition(5, "id")
    assert session.stage(rows, "cleanup").count() == 1_000
    assert spark.conf.get(key) == before
    assert shuffles.shuffleStatuses().size() <= held + 1  # that of the count
