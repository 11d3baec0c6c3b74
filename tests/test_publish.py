import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from offermill.operators import gates
from offermill.plans import publish
from offermill.plans.validate import validate_reports
from offermill.sources.registry import default_entries
from offermill.sources.reports import read_reports
from offermill.streaming import checks

from reports import offer, report, write


def live(spark, root, table):
    schema = spark.read.parquet(f"{root}/{table}").schema
    # Run ids are text, whatever they look like as folder names.
    return publish.live_runs(spark, root, table, schema)


def test_runs_are_replaced_one_by_one(spark, tmp_path):
    root = str(tmp_path / "live")
    earlier = [{"name": "old", "reason": "known"}]
    write(tmp_path / "in", "r1", report([offer("a"), offer("b", suspicion_score=5)], excluded_offers=earlier))
    path = write(tmp_path / "in", "r2", report([offer("c")]))
    validate_reports(spark, path, root, default_entries())
    assert {r["run_id"]: r["excluded"] for r in live(spark, root, "report_summary").collect()} == {"r1": 2, "r2": 0}
    assert sorted((r["name"], r["origin"]) for r in live(spark, root, "excluded_offers").collect()) == [
        ("b", "gate"), ("old", "report")
    ]
    kept = live(spark, root, "offers").filter("not removed")
    assert sorted(r["name"] for r in kept.collect()) == ["a", "c"]

    # The next report of r1 has nothing to exclude: its old exclusions go, r2 stays.
    path = write(tmp_path / "next", "r1", report([offer("a")]))
    validate_reports(spark, path, root, default_entries())
    summary = {r["run_id"]: r["excluded"] for r in live(spark, root, "report_summary").collect()}
    assert summary == {"r1": 0, "r2": 0}
    assert live(spark, root, "excluded_offers").count() == 0 and live(spark, root, "offers").count() == 2


@pytest.mark.parametrize("moment", ["before", "within"])
def test_a_lost_driver_leaves_the_old_state(spark, tmp_path, monkeypatch, moment):
    root = str(tmp_path / "live")
    validate_reports(spark, write(tmp_path / "in", "r1", report([offer("a")])), root, default_entries())
    commit = publish.commit

    def lost(spark, root, names, version):
        if moment == "within":  # the manifest was begun and is not complete
            commit(spark, root, names, version)
            (tmp_path / "live" / "_manifest" / "000000000002" / "_SUCCESS").unlink()
        raise OSError("driver gone")

    monkeypatch.setattr(publish, "commit", lost)
    path = write(tmp_path / "next", "r1", report([offer("z")]))
    with pytest.raises(OSError):
        validate_reports(spark, path, root, default_entries())
    assert [r["name"] for r in live(spark, root, "offers").collect()] == ["a"]
    monkeypatch.setattr(publish, "commit", commit)
    validate_reports(spark, path, root, default_entries())
    assert [r["name"] for r in live(spark, root, "offers").collect()] == ["z"]


def _state(spark, root):
    return {r["name"]: r["version"] for r in publish.manifest(spark, root).collect()}


def _names(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def test_commits_that_overlap_are_both_kept(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "live")
    publish.commit(spark, root, _names(spark, "r1", "both"), "v1")
    slow = publish.take_number(spark, root)  # a commit that has its number and is not complete yet
    publish.commit(spark, root, _names(spark, "r3", "both"), "v3")
    assert _state(spark, root) == {"r1": "v1", "r3": "v3", "both": "v3"}
    monkeypatch.setattr(publish, "take_number", lambda *_: slow)
    publish.commit(spark, root, _names(spark, "r2", "both"), "v2")
    assert _state(spark, root) == {"r1": "v1", "r2": "v2", "r3": "v3", "both": "v3"}


def test_a_number_is_taken_once(spark, tmp_path):
    root = str(tmp_path / "live")
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda _: publish.take_number(spark, root), range(24)))
    assert sorted(numbers) == list(range(1, 25))


def test_folded_manifests_say_the_same(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "live")
    for k in range(4):
        publish.commit(spark, root, _names(spark, f"r{k}", "both"), f"v{k}")
    late = publish.take_number(spark, root)
    before = _state(spark, root)
    assert publish.fold_manifests(spark, root) == 4 and publish.fold_manifests(spark, root) == 0
    assert _state(spark, root) == before
    with monkeypatch.context() as patch:  # taken before the fold, complete after it: later than all that was folded
        patch.setattr(publish, "take_number", lambda *_: late)
        publish.commit(spark, root, _names(spark, "both"), "late")
    assert _state(spark, root) == {**before, "both": "late"}


@pytest.mark.parametrize(
    "broken",
    [
        dict(contradictions=[{"offer_name": "x", "values": ["only one"]}]),
        dict(sources=None),
    ],
)
def test_failed_check_leaves_live_tables(spark, tmp_path, broken):
    root = str(tmp_path / "live")
    validate_reports(spark, write(tmp_path / "in", "r1", report([offer("a")])), root, default_entries())
    doc = report([offer("other")], **broken)
    with pytest.raises(publish.PublicationRefused):
        validate_reports(spark, write(tmp_path / "bad", "r1", doc), root, default_entries())
    assert [r["name"] for r in live(spark, root, "offers").collect()] == ["a"]


def test_promote_is_all_or_nothing(spark, tmp_path):
    first, second, target = (str(tmp_path / n) for n in ("s1", "s2", "t"))
    spark.range(3).write.parquet(f"{first}/one")
    publish.promote(spark, first, target, ["one"])
    spark.range(5).write.parquet(f"{second}/one")
    with pytest.raises(publish.PublicationRefused, match="two"):
        publish.promote(spark, second, target, ["one", "two"])
    assert publish.live_table(spark, target, "one").count() == 3
    spark.range(7).write.parquet(f"{second}/two")
    publish.promote(spark, second, target, ["one", "two"])
    assert [publish.live_table(spark, target, n).count() for n in ("one", "two")] == [5, 7]
    with pytest.raises(publish.PublicationRefused, match="three"):
        publish.live_table(spark, target, "three")


def test_stream_gives_the_batch_result(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    for part in range(3):
        docs = [
            {**report([offer(f"{part}-{i}", suspicion_score=i)]), "run_id": f"r{i % 2}", "part": part * 10 + i}
            for i in range(6)
        ]
        (folder / f"p{part}.json").write_text("\n".join(map(json.dumps, docs)))
    stream = checks.gate_stream(checks.read_offer_stream(spark, str(folder)), default_entries())
    out = str(tmp_path / "out")
    query = checks.write_gated_stream(stream, out, str(tmp_path / "cp"))
    query.awaitTermination(120)
    offers = read_reports(spark, str(folder), one_per_line=True).offers
    batch = gates.apply_gates(offers, default_entries())
    written = spark.read.schema(batch.schema).parquet(out)
    columns = ["run_id", "name", "gate"]
    assert sorted(map(str, written.select(columns).collect())) == sorted(map(str, batch.select(columns).collect()))
    assert written.filter(F.col("removed")).count() == 6

