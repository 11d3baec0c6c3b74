import json
from functools import partial

import pytest
from pyspark.sql import Row

from offermill.operators import gates, ranking, rollups, skew
from offermill.operators.matching import provider_match
from offermill.sources.registry import INDEXED, default_entries
from offermill.sources.reports import read_reports

from reports import offer, report, write

NAMED = gates.OfferContract(required_if_eligible=("name", "provider", "model_id"))


def run(spark, tmp_path, ranked, pages=None, contract=NAMED, **sections):
    path = write(tmp_path / "in", "r1", report(ranked, **sections))
    reports = read_reports(spark, path)
    return reports, gates.apply_gates(reports.offers, default_entries(), pages, contract).cache()


def gate_of(gated):
    return {r["name"]: r["gate"] for r in gated.collect()}


def test_sound_offer_passes(spark, tmp_path):
    _, gated = run(spark, tmp_path, [offer()])
    row = gated.first()
    assert (row["run_id"], row["gate"], row["removed"], row["ranking_eligible"]) == ("r1", None, False, True)


CASES = [
    ("endpoint", dict(base_url=None)), ("endpoint", dict(base_url="")), ("endpoint", dict(endpoint_source="ftp://x")),
    ("endpoint", dict(base_url="https://api.deepseek.com/v9")),
    ("endpoint", dict(base_url="https://x.example", provider="Nobody")),
    ("free-claim", dict(free_limits="The API is paid")), ("free-claim", dict(rate_limits="無料API costs $5")),
    ("size", dict(total_parameters_b=29.5, benchmark={"score": 60, "version": "2.1", "tier": "B"})),
    ("no-terminal-bench", dict(benchmark={"score": 49, "version": "2.1", "tier": "A"})),
    ("no-terminal-bench", dict(benchmark={"score": "57", "version": "2.1", "tier": "A"})),
    ("no-terminal-bench", dict(benchmark_key="livecodebench_v6")),
    ("access-kind", dict(access_kind=None, effective_price_per_million={"input": 5, "output": 10})),
    ("access-prices", dict(effective_price_per_million={"input": 0.05, "output": 0.05})),
    ("access-prices", dict(effective_price_per_million="absent")),
    ("access-prices", dict(effective_price_per_million={"input": "0", "output": 0})),
    ("gate3", dict(operational_confidence="NONE")), ("gate3", dict(operational_confidence="LOW")),
    ("gate3", dict(operational_confidence=None)), ("suspicion", dict(suspicion_score=4)),
    ("nim", dict(free_endpoint_status="deprecated")), ("schema", dict(model_id=None)),
]
PASSES = [
    dict(access_kind="ULTRA_LOW", effective_price_per_million={"input": 0.2, "output": 0.4}),
    dict(total_parameters_b=29.5), dict(suspicion_score=3), dict(suspicion_score=None),
    dict(free_limits="papi is paid"), dict(ranking_eligible=False, access_kind=None),
    dict(base_url="https://api.deepseek.cn/v1/"),
]


def test_each_gate(spark, tmp_path):
    ranked = [offer(f"bad {i}", **change) for i, (_, change) in enumerate(CASES)]
    ranked += [offer(f"good {i}", **change) for i, change in enumerate(PASSES)]
    _, gated = run(spark, tmp_path, ranked)
    got = gate_of(gated)
    assert {k: v for k, v in got.items() if k.startswith("bad")} == {
        f"bad {i}": gate for i, (gate, _) in enumerate(CASES)
    }
    assert all(v is None for k, v in got.items() if k.startswith("good"))
    # Nothing is lost, and the deciding gate leads the list of failures.
    assert gated.count() == len(ranked)
    assert gates.excluded_offers(gated).count() == len(CASES)
    assert gated.filter("gate is not null and failed_gates[0] != gate").count() == 0


def test_reason_texts(spark, tmp_path):
    _, gated = run(
        spark, tmp_path,
        [
            offer("a", effective_price_per_million={"input": 0.05, "output": None}), offer("b", suspicion_score=5),
            offer("c", total_parameters_b=7, benchmark={"score": 60, "tier": "B"}), offer("d", provider="Nobody", base_url="https://x.example"),
        ],
    )
    reasons = {r["name"]: r["reason"] for r in gated.collect()}
    assert '{"input":0.05,"output":null} do not match access_kind "FREE"' in reasons["a"]
    assert "suspicion 5 >= 4" in reasons["b"]
    assert "[size] 7B total" in reasons["c"] and "tier B" in reasons["c"]
    assert '[endpoint] provider "Nobody" not in registry' in reasons["d"]


def test_minus_zero_price_is_not_free(spark, tmp_path):
    doc = json.dumps(report([offer("a"), offer("b")]))
    folder = tmp_path / "in"
    folder.mkdir()
    first = doc.index('"input": 0')
    (folder / "r1.json").write_text(doc[:first] + '"input": -0' + doc[first + len('"input": 0'):])
    offers = read_reports(spark, str(folder)).offers
    assert gate_of(gates.apply_gates(offers, default_entries())) == {"a": "access-prices", "b": None}


def test_fixes_and_log(spark, tmp_path):
    cheap = dict(access_kind="ULTRA_LOW", effective_price_per_million={"input": 0.075, "output": 0.22})
    _, gated = run(
        spark, tmp_path,
        [offer("fixed", free_allowance_rank=None, **cheap), offer("both", free_allowance_rank="HUGE", suspicion_score=5)],
        conditional_credits=[offer("cond", **cheap)],
    )
    rows = {r["name"]: r for r in gated.collect()}
    assert (rows["fixed"]["free_allowance_rank"], rows["fixed"]["classification"]) == ("NORMAL", "E_DISCOUNT")
    assert rows["cond"]["classification"] == "E_DISCOUNT"
    log = gates.fix_log(gated).orderBy("step", "pos").collect()
    assert [(r["offer"], r["action"], r["gate"]) for r in log] == [
        ("fixed", "auto-fix", "allowance"), ("both", "auto-fix", "allowance"), ("fixed", "auto-fix", "classification"),
        ("cond", "auto-fix", "classification"), ("both", "exclude", "suspicion"),
    ]


def test_discount_section(spark, tmp_path):
    price = {"input": 1, "output": 2}
    good = dict(access_kind="DISCOUNTED", normal_price_per_million=price, discount_rates={"input": 50},
                effective_price_per_million={"input": 0.5, "output": 2})
    discounts = [
        offer("good", **good), offer("kind", **{**good, "access_kind": "FREE"}),
        offer("rates", **{**good, "discount_rates": "absent"}),
        offer("same", **{**good, "effective_price_per_million": price}),
        offer("half", **{**good, "effective_price_per_million": {"input": 0.5}}),
    ]
    _, gated = run(spark, tmp_path, [], discount_offers=discounts)
    assert gate_of(gated) == {"good": None, "kind": "discount", "rates": "discount", "same": "discount", "half": "discount"}


def test_summary_sentence(spark, tmp_path):
    reports, gated = run(
        spark, tmp_path, [offer("a"), offer("b", benchmark_key="other"), offer("c", ranking_eligible=False)],
        caution_offers=[offer("w")], excluded_offers=[{"name": "old", "reason": "x"}],
    )
    text = rollups.report_summary(gated, reports.runs, reports.excluded).first()["summary"]
    assert text == (
        "無料・激安 LLM API の日次ランキング。今回ランクイン 1 件（S 1、A 0、B 0）、"
        "無料 1 件、激安 0 件、注意 1 件、対象外 2 件。"
    )


def test_empty_run_counts_zero(spark, tmp_path):
    reports, gated = run(spark, tmp_path, [])
    assert rollups.report_summary(gated, reports.runs).first()["ranked"] == 0
    assert [r["rows"] for r in rollups.section_counts(reports.offers, reports.runs).collect()] == [0, 0, 0, 0]


def test_broken_documents_fail(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "r.json").write_text('{"ranked_offers": [')
    with pytest.raises(Exception):
        read_reports(spark, str(tmp_path / "a")).offers.collect()
    with pytest.raises(Exception):
        read_reports(spark, str(tmp_path / "nothing")).offers.collect()
    path = write(tmp_path / "b", "r", {"ranked_offers": [], "changes": []})
    missing = [r["section"] for r in read_reports(spark, path).missing_sections.collect()]
    assert missing == ["new_models", "excluded_offers", "sources"]


def test_citation_gate_with_a_hot_page(spark, tmp_path, monkeypatch):
    """Against brute force, with a page that gets split over salts."""
    ranked = [
        offer(f"o{i}", endpoint_source="https://hot.example" if i % 3 else f"https://p{i % 7}.example",
              base_url=f"https://h{i % 10}.example/v{i}")
        for i in range(120)
    ]
    reports, _ = run(spark, tmp_path, ranked)
    texts = {"https://hot.example": " ".join(f"h{n}.example" for n in range(6))}
    texts.update({f"https://p{n}.example": "h1.example h2.example" for n in range(5)})
    pages = spark.createDataFrame(list(texts.items()), "url string, html string")
    monkeypatch.setattr(gates, "split_hot_keys", partial(skew.split_hot_keys, ways=4, floor=10))
    got = gates.gate_citation(reports.offers, pages).filter("gate_reason is not null")
    want = {
        o["name"] for o in ranked
        if o["endpoint_source"] in texts and o["base_url"][8:].split("/")[0] not in texts[o["endpoint_source"]]
    }
    assert {r["name"] for r in got.collect()} == want
    assert gates.join_citations(reports.offers, pages).count() == len(ranked)


def test_contradictions(spark):
    rows = spark.createDataFrame(
        [("a", ["1", "2"]), ("b", ["1"]), ("c", []), ("d", None)], "offer_name string, values array<string>"
    )
    bad = {r["offer_name"]: r["n_values"] for r in gates.contradiction_violations(rows).collect()}
    assert bad == {"b": 1, "c": 0, "d": 0}


def test_invalid_pattern_matches_nothing(spark):
    broken = [
        Row(**{**r.asDict(), "base_url_pattern": "("}) if r.idx == 4 else r for r in default_entries()
    ]
    offers = spark.createDataFrame(
        [("https://generativelanguage.googleapis.com/v1beta", "x", "y"), ("https://api.x.ai/v1\n", "Unknown", "MiniMax M3"),
         (None, "OpenAI", None), ("https://api.deepinfra.com/v1/openai", "", "")],
        "base_url string, provider string, name string",
    )
    got = [(r["provider_idx"], r["by_url"]) for r in provider_match(offers, broken).collect()]
    # Text match by host; `nim` hides in MiniMax; a line break ends no URL.
    assert got == [(4, False), (0, False), (12, False), (18, True)]


def test_top_and_admission(spark, tmp_path):
    reports, _ = run(spark, tmp_path, [offer("second"), offer("first", benchmark={"score": 90, "version": "2.1", "tier": "S"}),
                                       offer("no", access_kind=None)])
    assert ranking.top_offer(reports.offers).first()["name"] == "first"
    ranked = ranking.ranked_offers(reports.offers).orderBy("position").select("name").collect()
    assert [r[0] for r in ranked] == ["first", "second"]


def test_registry_of_any_size_matches_as_the_small_one(spark):
    fields = default_entries()[0].__fields__
    blank = dict.fromkeys(fields)

    def entry(idx, pattern, *match):
        return Row(**{**blank, "idx": idx, "key": f"k{idx}", "base_url_pattern": pattern, "match": list(match)})

    registry = [*default_entries()]
    at = len(registry)
    registry += [
        entry(at, r"^https://a\.example/v1/?$", "Alpha"), entry(at + 1, r"^https?://a\.example/", "alp"),
        entry(at + 2, "(", "ß"), entry(at + 3, r"^https://b\.example$", "mid"), entry(at + 4, "", "zz"),
        entry(at + 5, r"example\.(net|org)", "alpha"), entry(at + 6, r"^https://d\.example", "d.example"), entry(at + 7, None, "last"),
    ]
    texts = [
        ("https://a.example/v1", "x", "y"), ("https://a.example/v1/\n", "x", "y"), ("http://a.example/v2", None, None),
        ("https://b.example", None, None), ("https://b.example.evil", None, "a middle one"), ("https://b.example\n", None, "z"),
        ("https://x.example.org", "q", "q"), (None, "ALPHABET", None), ("", "pizzz", None), (None, None, None),
        (None, "Straße", "ß"), ("https://d.example.com", "u", "u"), ("https://A.example/v1", "", ""), (None, "atlas", "the last"),
        *[(r.base_url, r.label, r.key) for r in default_entries()],
    ] * 3
    offers = spark.createDataFrame([(k, *t) for k, t in enumerate(texts)], "n int, base_url string, provider string, name string")
    small = provider_match(offers, registry, chain_rows=1000)
    for given in (registry, spark.createDataFrame(registry, INDEXED)):
        joined = provider_match(offers, given, chain_rows=0)
        assert joined.columns == small.columns
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, small.collect()))
