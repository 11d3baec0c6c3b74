"""Small reports for tests."""

import json


CHECKED = "2024-11-05T06:30:00.000Z"


def _both(value):
    return {"input": value, "output": value}


def offer(name="Kept", **changes):
    """A free offer of a registered endpoint that passes every gate; "absent" takes a field out."""
    identity = {"name": name, "model_id": f"family/{name}", "provider": "DeepSeek", "provider_key": "deepseek"}
    endpoint = {"base_url": "https://api.deepseek.com/v1", "endpoint_source": "https://manual.example/endpoints"}
    price = {"access_kind": "FREE", "effective_price_per_million": _both(0), "price_verified_at": CHECKED}
    allowance = {"classification": "A_TRUE_FREE", "free_allowance_rank": "AMPLE"}
    score = {
        "benchmark_key": "terminal_bench_2_0",
        "benchmark": {"tier": "S", "version": "2.0", "score": 83.5, "benchmark_name": "Terminal-Bench 2.0"},
    }
    evidence = {
        "suspicion_score": 1, "operational_confidence": "MEDIUM", "last_verified": CHECKED,
        "sources": ["https://manual.example", "https://status.example"],
    }
    whole = {"ranking_eligible": True, **identity, **endpoint, **price, **allowance, **score, **evidence, **changes}
    return {field: value for field, value in whole.items() if value != "absent"}


def report(ranked=(), **sections):
    arrays = {name: [] for name in ("new_models", "changes", "excluded_offers", "sources")}
    return {"generated_at": CHECKED, "timezone": "Europe/Vienna", **arrays, "ranked_offers": list(ranked), **sections}


def write(folder, name, doc):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps(doc, ensure_ascii=False, indent=2), encoding="utf8")
    return str(folder)
