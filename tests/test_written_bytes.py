"""What queries write and move on the way."""

from pathlib import Path

from pyspark.sql import functions as F

import __spark_entry__ as entry
from offermill.operators import gates
from offermill.plans import publish
from offermill.session import scratch_path
from offermill.sources.registry import default_entries
from offermill.suite import fixtures as fx

SMALL = "/root/testdata/sf0.001"


def test_scanned_reports_are_written_compressed(spark):
    folder = Path(scratch_path(spark, "reports")).parent
    before = set(folder.glob("reports-*"))
    rows = entry.queries()["report_scan"](spark, SMALL).count()
    (written,) = set(folder.glob("reports-*")) - before
    sizes = [p.stat().st_size for p in written.glob("part-*")]
    assert rows == fx.table(spark, SMALL, "orders").count()
    assert 0 < sum(sizes) < 400 * rows  # about 1,250 bytes a document otherwise


def test_exclusions_and_log_are_written_as_read(spark, tmp_path, monkeypatch):
    frame, dealt = type(spark.range(1)), []
    hint = frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, name, *keys: dealt.append(self.columns) or hint(self, name, *keys))
    gated = gates.apply_gates(fx.offers(spark, SMALL), default_entries())
    publish.publish_report(gated, fx.runs(spark, SMALL), str(tmp_path / "live"))
    assert len(dealt) == 2 and "failed_gates" in dealt[0] and "summary" in dealt[1]
    log = publish.live_runs(spark, str(tmp_path / "live"), "fix_log", gates.fix_log(gated).schema)
    assert log.exceptAll(gates.fix_log(gated)).count() == 0 and log.count() == gates.fix_log(gated).count()



def _names(spark, folder):
    return {r[0] for r in spark.read.parquet(f"{folder}/offers").select("_metadata.file_path").distinct().collect()}


def test_many_offers_are_published_in_parts(spark, tmp_path, monkeypatch):
    gated = gates.apply_gates(fx.offers(spark, SMALL), default_entries())
    gated = gated.withColumn("run_id", F.when(F.col("offer_id") % 3 > 0, F.col("run_id")).when(F.col("offer_id") % 2 > 0, F.concat(F.lit("r"), (F.col("offer_id") % 40).cast("string"))))
    runs = gated.select("run_id").distinct().filter("run_id IS NOT NULL")
    rows, dealt = gated.count(), []
    evened = publish._evened
    monkeypatch.setattr(publish, "SLICE_ROWS", 300)
    monkeypatch.setattr(publish, "SAMPLED", 4)
    monkeypatch.setattr(publish, "_evened", lambda df: dealt.append(df.count() if "failed_gates" in df.columns else 0) or evened(df))
    publish.publish_report(gated, runs, str(tmp_path / "live"))
    assert len(dealt) > 4 and sum(dealt) == rows and max(dealt) < rows // 2
    written = spark.read.schema(gated.schema).parquet(f"{tmp_path}/live/offers")
    columns = gated.columns
    assert written.select(columns).exceptAll(gated).count() == gated.exceptAll(written.select(columns)).count() == 0
    small = {n for n in _names(spark, tmp_path / "live") if "/run_id=r" in n}
    assert 0 < len(small) <= 2 * 40  # each small run lies in one part


def test_parts_hold_all_offers_whatever_their_ids(spark, tmp_path, monkeypatch):
    gated = gates.apply_gates(fx.offers(spark, SMALL), default_entries())
    gated = gated.withColumn("offer_id", F.when(F.col("offer_id") % 2 > 0, F.lit(7).cast("long")))
    monkeypatch.setattr(publish, "SLICE_ROWS", 100)
    monkeypatch.setattr(publish, "SAMPLED", 1)
    publish.publish_report(gated, fx.runs(spark, SMALL), str(tmp_path / "live"))
    written = spark.read.schema(gated.schema).parquet(f"{tmp_path}/live/offers")
    columns = gated.columns
    assert written.select(columns).exceptAll(gated).count() == gated.exceptAll(written.select(columns)).count() == 0


def test_offers_of_the_waterfall_meet_their_pages_before_they_are_wide(spark):
    offers, _ = fx.waterfall(spark, SMALL)
    plan = offers._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().apply(0)
    assert plan.children().apply(0).output().size() < 10
