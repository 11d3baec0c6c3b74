import json
import random

import pytest
from pyspark.sql import Window, functions as F

from offermill.operators import numbering, ranking
from offermill.operators.numbering import number_rows
from offermill.operators.skew import join_split
from offermill.sources.reports import POS_BITS, read_reports
from offermill.suite import fixtures as fx

from reports import offer, report, write

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_numbers_equal_a_window(spark, partitions):
    """A group with most of the rows, tiny groups, and order keys full of ties."""
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.7 else f"g{rng.randrange(40)}", rng.randrange(5), i) for i in range(5000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x int, id int").repartition(partitions)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = numbering.number_rows(df, ["g"], [F.col("x").desc(), F.col("id").asc()], "n")
        want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("x"), "id")).cast("long"))
        assert sorted(map(tuple, got.select("g", "id", "n").collect())) == sorted(
            map(tuple, want.select("g", "id", "n").collect())
        )
        everything = numbering.number_rows(df, [], [F.col("x"), F.col("id")], "n")
        assert sorted(r["n"] for r in everything.collect()) == list(range(1, 5001))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, x int")
    assert numbering.number_rows(df, ["g"], [F.col("x")], "n").count() == 0


def _offers(spark, rows):
    """rows: (name, version, score, day, kind)."""
    base = fx.offers(spark, SMALL).limit(1).drop("name", "benchmark", "price_verified_at", "access_kind", "offer_id")
    table = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "offer_id long, name string, version string, score double, day string, access_kind string",
    )
    low = F.col("access_kind") == "ULTRA_LOW"
    price = F.when(low, 0.1).otherwise(0.0)
    joined = table.join(base, F.lit(True)).withColumns(
        {
            "run_id": F.lit("r"), "section": F.lit("ranked_offers"), "ranking_eligible": F.lit(True),
            "benchmark_key": F.lit("terminal_bench_2_1"), "price_verified_at": F.col("day"),
            "benchmark": F.struct("score", F.lit("b").alias("benchmark_name"), "version", F.lit("A").alias("tier")),
            "effective_price_per_million": F.struct(price.alias("input"), price.alias("output")),
        }
    )
    return joined.drop("version", "score", "day")


def test_order_of_the_ranking(spark):
    rows = [
        ("cheap", "2.1", 99.0, "2026-01-09", "ULTRA_LOW"), ("old version", "2.0", 95.0, "2026-01-09", "FREE"),
        ("b later", "2.1", 70.0, "2026-01-03", "FREE"), ("a later", "2.1", 70.0, "2026-01-03", "FREE"),
        ("newer", "2.1", 70.0, "2026-01-04", "FREE"), ("no date", "2.1", 70.0, "soon", "FREE"),
        ("best", "2.1", 80.0, None, "FREE"), ("no version", None, 98.0, "2026-01-09", "FREE"),
        ("no version, later", "", 60.0, "2026-01-10", "FREE"), ("ア", "2.1", 70.0, "2026-01-03", "FREE"),
        ("B later", "2.1", 70.0, "2026-01-03", "FREE"),
    ]
    ranked = ranking.ranked_offers(_offers(spark, rows)).orderBy("position").collect()
    assert [r["name"] for r in ranked] == [
        "best", "newer", "a later", "b later", "B later", "ア", "no date", "old version", "no version, later",
        "no version", "cheap",
    ]
    assert [r["position"] for r in ranked] == list(range(1, len(rows) + 1))


def test_slots_keep_report_order_and_count_from_one(spark):
    slots = ranking.offer_slots(fx.offers(spark, SMALL))
    per_slot = slots.groupBy("run_id", "slot").agg(F.count("*").alias("n"), F.max("slot_position").alias("last"))
    assert per_slot.filter("n != last").count() == 0
    tail = slots.filter("slot = 'slot-free' and section = 'caution_offers'")
    head = slots.filter("slot = 'slot-free' and section != 'caution_offers'")
    first = tail.groupBy("run_id").agg(F.min("slot_position").alias("a"))
    last = head.groupBy("run_id").agg(F.max("slot_position").alias("b"))
    assert first.join(last, "run_id").filter("a < b").count() == 0


def test_no_group_is_sorted_in_one_task(spark):
    """The rank comes from a range shuffle; a window over offers may not appear."""
    plan = ranking.ranked_offers(fx.offers(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    top = ranking.top_offer(fx.offers(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in top


def test_a_null_group_is_numbered(spark):
    rows = spark.createDataFrame([("a", 2), (None, 5), (None, 4), ("a", 1)], "g string, v long")
    got = number_rows(rows, ["g"], [F.col("v")], "n").collect()
    assert sorted((str(r.g), r.v, r.n) for r in got) == [("None", 4, 1), ("None", 5, 2), ("a", 1, 1), ("a", 2, 2)]


def test_newer_versions_by_number(spark, tmp_path):
    versions = ["2.9", "2.10", "beta", None, "2.9.1", "10"]
    ranked = [offer(str(v), benchmark={"score": 70, "tier": "S", "version": v}) for v in versions]
    offers = read_reports(spark, write(tmp_path / "in", "r1", report(ranked))).offers
    keyed = ranking._with_keys(offers).orderBy(*ranking._order()).select("name")
    assert [r["name"] for r in keyed.collect()] == ["10", "2.10", "2.9.1", "2.9", "beta", "None"]


def test_ids_of_high_parts_differ(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    parts = [0, 1, 268_435_456, 3_000_000_000]
    docs = [
        {**report([offer(f"{p}-{k}") for k in range(3)], conditional_credits=[offer(f"c{p}")]), "run_id": "r", "part": p}
        for p in parts
    ]
    (folder / "p.json").write_text("\n".join(map(json.dumps, docs)))
    rows = read_reports(spark, str(folder), one_per_line=True).offers.select("offer_id", "pos").collect()
    assert len({r.offer_id for r in rows}) == len(rows) == 16 and min(r.offer_id for r in rows) >= 0
    assert {part_of_number(r.pos) for r in rows} == set(parts)
    (folder / "p.json").write_text(json.dumps({**docs[0], "part": 1 << 36}))
    with pytest.raises(Exception, match="out of range"):
        read_reports(spark, str(folder), one_per_line=True).offers.collect()


def part_of_number(pos):
    return pos >> POS_BITS


def test_hot_keys_are_dealt_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(4000).select(
            F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), F.col("id").alias("pos")
        )
        marks = rows.select("key").distinct().withColumn("m", F.lit(1)).hint("merge")
        joined = join_split(rows, marks, "key", F.col("pos"), floor=500)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 4000 and max(r["count"] for r in sizes) < 1200
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
