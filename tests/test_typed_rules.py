"""Typed rules on entries as they stand in a report."""

import json

import pytest

from offermill.operators.typed_rules import Rule, typed_violations
from offermill.sources.reports import document_schema, raw_offers_of

RULES = (
    Rule("name", ("string",), required=True, least_length=2),
    Rule("price.input", ("number",), required=True, minimum=0, maximum=9.5),
    Rule("tags", least_items=1, items=("string", "integer")),
    Rule("ok", ("boolean", "object")),
)
SOUND = {"name": "ab", "price": {"input": 0}, "tags": ["x", 2], "ok": True}
CASES = [
    (SOUND, ""),
    (SOUND | {"ok": {}, "more": [None]}, ""),
    (SOUND | {"name": None}, "@/name: must be string"),
    (SOUND | {"name": "a"}, "@/name: must NOT have fewer than 2 characters"),
    ({k: v for k, v in SOUND.items() if k != "name"}, "@: must have required property 'name'"),
    (SOUND | {"price": {}}, "@/price: must have required property 'input'"),
    (SOUND | {"price": 3}, ""),
    (SOUND | {"price": {"input": "1"}}, "@/price/input: must be number"),
    (SOUND | {"price": {"input": -0.5}}, "@/price/input: must be >= 0"),
    (SOUND | {"price": {"input": 1e300}}, "@/price/input: must be <= 9.5"),
    (SOUND | {"tags": []}, "@/tags: must NOT have fewer than 1 items"),
    (SOUND | {"tags": "x"}, ""),
    (SOUND | {"tags": [2.0, 2.5, {}]}, "@/tags/1: must be string,integer; @/tags/2: must be string,integer"),
    (SOUND | {"ok": "true"}, "@/ok: must be boolean,object"),
    ({"name": 1, "ok": 1}, "@/name: must be string; @/ok: must be boolean,object"),
    ("text", "@: must be object"), ([], "@: must be object"), (None, "@: must be object"), (7, "@: must be object"),
]


def _found(spark, raws):
    rows = spark.createDataFrame([("r", "caution_offers", k, raw) for k, raw in enumerate(raws)], "run_id string, section string, pos long, raw string")
    return {r.pos: r.detail for r in typed_violations(rows, RULES).collect()}


def test_each_kind_of_rule(spark):
    want = {k: detail.replace("@", f"/caution_offers/{k}") for k, (_, detail) in enumerate(CASES) if detail}
    assert _found(spark, [json.dumps(entry) for entry, _ in CASES]) == want


def test_texts_that_are_no_entries(spark):
    assert _found(spark, [None, "", "{", "null"]) == {k: f"/caution_offers/{k}: must be object" for k in range(4)}
    assert _found(spark, []) == {}


def test_rules_are_checked():
    for wrong in ({"path": "a..b"}, {"path": "a'b"}, {"path": "a", "types": ("text",)}):
        with pytest.raises(ValueError):
            Rule(**wrong)


def test_entries_of_a_scan_without_a_shuffle(spark, tmp_path):
    report = {"run_id": "r", "ranked_offers": [SOUND, "text"], "caution_offers": [{"name": "x"}]}
    (tmp_path / "r.json").write_text(json.dumps(report))
    docs = spark.read.schema(document_schema()).option("multiLine", True).json(str(tmp_path))
    from pyspark.sql import functions as F

    entries = raw_offers_of(docs.withColumn("part", F.coalesce("part", F.lit(0))))
    found = typed_violations(entries, RULES)
    assert {r.detail for r in found.collect()} == {
        "/ranked_offers/1: must be object", "/caution_offers/0/name: must NOT have fewer than 2 characters",
    }
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_entries_are_parsed_once(spark):
    rows = spark.range(5).selectExpr("'r' AS run_id", "'ranked_offers' AS section", "id AS pos", "'{\"name\": ' || id || '}' AS raw")
    found = typed_violations(rows, (Rule("name", ("string",), required=True), Rule("count", ("integer",), required=True)))
    assert found.count() == 5
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") == 1
