"""The same results in DuckDB SQL, written from the rules and not from the engine."""

from __future__ import annotations

from .. import fixed_values as fv
from .fixtures import duck_offers, duck_waterfall


def _q(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def _values(name: str, columns: str, rows) -> str:
    body = ", ".join("(" + ", ".join(_q(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


_ENTRIES = [dict(zip(fv.REGISTRY_FIELDS, row)) for row in fv.REGISTRY]
REGISTRY = _values(
    "registry",
    "idx, key, label, base_url, pattern, docs, openai_url, anthropic_url, openai, openrouter, template, clients",
    [
        (
            i, e["key"], e["label"], e["base_url"], e["base_url_pattern"], e["docs_url"], e["openai_base_url"],
            e["anthropic_base_url"], e["openai"], e["openrouter"], e["model_page_template"],
            len(e["agents"]) if e["agents"] else None,
        )
        for i, e in enumerate(_ENTRIES)
    ],
)
MATCHERS = _values("matchers", "idx, m", [(i, m) for i, e in enumerate(_ENTRIES) for m in e["match"] or ()])
OFFERS = duck_offers()
MATCHED = f"""{OFFERS}, {REGISTRY}, {MATCHERS},
urls AS (SELECT DISTINCT base_url AS u FROM offers WHERE base_url <> ''),
url_hit AS (SELECT u, min(idx) AS uidx FROM urls JOIN registry ON regexp_matches(u, pattern) GROUP BY u),
text_hit AS (
  SELECT offer_id AS tid, min(idx) AS tidx FROM offers JOIN matchers
  ON contains(lower(coalesce(base_url, '') || ' ' || coalesce(provider, '') || ' ' || coalesce(name, '')), m)
  GROUP BY offer_id),
matched AS (
  SELECT offers.*, coalesce(uidx, tidx) AS provider_idx,
    CASE WHEN uidx IS NOT NULL THEN true WHEN tidx IS NOT NULL THEN false END AS by_url
  FROM offers LEFT JOIN url_hit ON base_url = u LEFT JOIN text_hit ON offer_id = tid)"""


def known(x: str) -> str:
    return f"coalesce(isfinite({x}) AND {x} >= 0, false)"


def kind_of(i: str, o: str) -> str:
    return (
        f"CASE WHEN NOT ({known(i)} AND {known(o)}) THEN NULL"
        f" WHEN CAST({i} AS VARCHAR) = '-0.0' OR CAST({o} AS VARCHAR) = '-0.0' THEN NULL"
        f" WHEN {i} = 0 AND {o} = 0 THEN 'FREE' WHEN {i} <= 0.2::DOUBLE AND {o} <= 0.4::DOUBLE THEN 'ULTRA_LOW' END"
    )


def score_ok(score: str, limit: int) -> str:
    return (
        f"coalesce(benchmark_key IN ('terminal_bench_2_0', 'terminal_bench_2_1')"
        f" AND isfinite({score}) AND {score} >= {limit}, false)"
    )


def lower_price(ni: str, no: str, ei: str, eo: str) -> str:
    return f"({known(ni)} AND {known(no)} AND {known(ei)} AND {known(eo)} AND ({ni} > {ei} OR {no} > {eo}))"


def rate(n: str, e: str) -> str:
    return (
        f"CASE WHEN isfinite({n}) AND isfinite({e}) AND {n} > 0"
        f" THEN floor(({n} - {e}) / {n} * 1000 + 0.5::DOUBLE) / 10 END"
    )


def number(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '\\.0$', '')"


def price(x: str) -> str:
    s = f"printf('%.11e', abs({x}))"
    digits = f"replace(split_part({s}, 'e', 1), '.', '')"
    power = f"CAST(split_part({s}, 'e', 2) AS INTEGER)"
    return (
        f"CASE WHEN {x} IS NULL THEN '—' WHEN {x} = 0 THEN '$0' WHEN isnan({x}) THEN '$NaN'"
        f" WHEN isinf({x}) THEN CASE WHEN {x} > 0 THEN '$∞' ELSE '$-∞' END"
        f" ELSE '$' || CASE WHEN {x} < 0 THEN '-' ELSE '' END ||"
        f" CASE WHEN {power} >= 11 THEN {digits} || repeat('0', {power} - 11)"
        f" WHEN {power} >= 0 THEN rtrim(rtrim(substr({digits}, 1, {power} + 1) || '.' ||"
        f" substr({digits}, {power} + 2), '0'), '.')"
        f" ELSE rtrim('0.' || repeat('0', -{power} - 1) || {digits}, '0') END END"
    )


def local(x: str, tz: str) -> str:
    return f"((TRY_CAST({x} AS TIMESTAMP) AT TIME ZONE 'UTC') AT TIME ZONE {tz})"


def date_ja(x: str, tz: str) -> str:
    t = local(x, tz)
    return (
        f"CASE WHEN coalesce({x}, '') = '' THEN '不明' WHEN TRY_CAST({x} AS TIMESTAMP) IS NULL THEN 'Invalid Date'"
        f" ELSE CAST(year({t}) AS VARCHAR) || '年' || CAST(month({t}) AS VARCHAR) || '月' ||"
        f" CAST(day({t}) AS VARCHAR) || '日' END"
    )


def flat(columns: str, where: str = "") -> str:
    return f"WITH {OFFERS} SELECT offer_id, {columns} FROM offers {where}"


RANKED = "section = 'ranked_offers' AND ranking_eligible IS NOT DISTINCT FROM true"
DERIVED = kind_of("eff_in", "eff_out")
TOKYO, NEW_YORK = "'Asia/Tokyo'", "'America/New_York'"


def _json(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'null' ELSE '\"' || {x} || '\"' END"


def _side(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'null' ELSE {number(x)} END"


REASONS = {
    "endpoint": (
        f"CASE WHEN coalesce(base_url, '') = '' THEN {_q(fv.REASON_NO_BASE_URL)}"
        f" WHEN NOT coalesce(regexp_matches(endpoint_source, '^https?://'), false) THEN {_q(fv.REASON_NO_SOURCE)}"
        " WHEN provider_idx IS NULL THEN '[endpoint] provider \"' || provider ||"
        " '\" not in registry — add it from official docs first'"
        " WHEN NOT by_url THEN '[endpoint] base_url \"' || m.base_url || '\" contradicts official ' || r_label ||"
        " ' endpoint (' || r_url || '). Re-fetch ' || r_docs END"
    ).replace("m.base_url", "base_url"),
    "free-claim": (
        "CASE WHEN regexp_matches(coalesce(free_limits, '') || ' ' || coalesce(rate_limits, ''),"
        " '(?i)\\bapi is paid\\b|\\bpaid api\\b|\\bapi access is paid\\b|\\bapi costs \\$[1-9]')"
        f" THEN {_q(fv.REASON_PAID)} END"
    ),
    "size": (
        "CASE WHEN total_parameters_b < 30 AND coalesce(tier, '') NOT IN ('S', 'A') THEN '[size] ' ||"
        f" {number('total_parameters_b')} || 'B total is local-run territory and tier ' || coalesce(tier, 'null') ||"
        " ' doesn''t show competitiveness' END"
    ),
    "no-terminal-bench": f"CASE WHEN NOT {score_ok('score', 50)} THEN {_q(fv.REASON_BENCHMARK)} END",
    "access-kind": (
        "CASE WHEN coalesce(access_kind, '') NOT IN ('FREE', 'ULTRA_LOW') THEN '[access-kind] access_kind ' ||"
        f" {_json('access_kind')} || ' is not FREE or ULTRA_LOW — unknown or over-limit prices (AC-4)' END"
    ),
    "access-prices": (
        f"CASE WHEN eff_null OR ({DERIVED}) IS DISTINCT FROM access_kind THEN '[access-prices] effective prices ' ||"
        f" CASE WHEN eff_null THEN 'null' ELSE '{{\"input\":' || {_side('eff_in')} || ',\"output\":' ||"
        f" {_side('eff_out')} || '}}' END || ' do not match access_kind ' || {_json('access_kind')} || ' (AC-4)' END"
    ),
    "gate3": (
        f"CASE WHEN operational_confidence = 'NONE' THEN {_q(fv.REASON_CONFIDENCE_NONE)}"
        f" WHEN operational_confidence = 'LOW' THEN {_q(fv.REASON_CONFIDENCE_LOW)}"
        " WHEN coalesce(operational_confidence, '') NOT IN ('HIGH', 'MEDIUM') THEN '[gate3] operational_confidence ' ||"
        f" {_json('operational_confidence')} || ' is missing or invalid (spec 0008 §4.7)' END"
    ),
    "suspicion": (
        f"CASE WHEN suspicion_score > 3 THEN '[suspicion] suspicion ' || {number('suspicion_score')} ||"
        " ' >= 4 never ranks (spec 0008 §4.7)' END"
    ),
    "nim": f"CASE WHEN free_endpoint_status = 'deprecated' THEN {_q(fv.REASON_DEPRECATED)} END",
}
DISCOUNT = (
    f"CASE WHEN coalesce(access_kind, '') <> 'DISCOUNTED' OR rates_null OR NOT ({known('normal_in')} AND"
    f" {known('normal_out')} AND {known('eff_in')} AND {known('eff_out')}) THEN {_q(fv.REASON_DISCOUNT_INCOMPLETE)}"
    f" WHEN NOT (normal_in > eff_in OR normal_out > eff_out) THEN {_q(fv.REASON_DISCOUNT_NOT_LOWER)} END"
)
_PATH = "'/' || section || '/' || CAST(pos AS VARCHAR)"
_ERRORS = (
    "list_sort(list_filter(["
    + ", ".join(
        f"CASE WHEN ranking_eligible IS NOT DISTINCT FROM true AND {name} IS NULL"
        f" THEN {_PATH} || ': must have required property ''{name}''' END"
        for name in ("name", "provider", "model_id")
    )
    + "], lambda x: x IS NOT NULL))"
)
ERRORS = f"CASE WHEN section = 'discount_offers' THEN CAST([] AS VARCHAR[]) ELSE {_ERRORS} END"
SCHEMA = f"CASE WHEN len({ERRORS}) > 0 THEN '[schema] ' || array_to_string({ERRORS}, '; ') END"
CLASS_FIXED = (
    "coalesce(section <> 'discount_offers' AND classification IN"
    f" ('A_TRUE_FREE', 'B_PERMANENT_FREE_TIER', 'C_LIMITED_FREE') AND ({DERIVED}) = 'ULTRA_LOW', false)"
)
ALLOWANCE_BAD = "coalesce(free_allowance_rank NOT IN ('AMPLE', 'NORMAL', 'TIGHT', 'TINY'), true)"

_CITED = (
    "CASE WHEN NOT cited_ok THEN '[citation] ' || endpoint_source || ' does not document base_url \"' ||"
    " coalesce(base_url, 'null') || '\"' END"
)
# Without the order of the dictionary: the citation gate comes second.
REASONS = {"endpoint": REASONS.pop("endpoint"), "citation": _CITED, **REASONS}
_REASON_COLUMNS = ", ".join(f"{sql} AS \"r_{gate}\"" for gate, sql in REASONS.items())
_FIRST = ", ".join(f'"r_{gate}"' for gate in REASONS)
_FAILED = ", ".join(
    ["CASE WHEN broken IS NOT NULL THEN 'schema' END"]
    + [f"CASE WHEN in_rank AND \"r_{gate}\" IS NOT NULL THEN '{gate}' END" for gate in REASONS]
    + ["CASE WHEN r_discount IS NOT NULL THEN 'discount' END"]
)
JOINED = f"""{MATCHED},
looked AS (
  SELECT m.*, r.label AS r_label, r.base_url AS r_url, r.docs AS r_docs, r.key AS cap_key, r.openai, r.openrouter,
    r.openai_url, r.anthropic_url, r.template, r.clients
  FROM matched m LEFT JOIN registry r ON m.provider_idx = r.idx)"""
GATED = f"""{JOINED.replace(OFFERS, duck_waterfall())},
judged AS (
  SELECT *, {SCHEMA} AS broken, {CLASS_FIXED} AS class_fixed, {_REASON_COLUMNS},
    CASE WHEN section = 'discount_offers' THEN {DISCOUNT} END AS r_discount
  FROM looked),
scoped AS (SELECT *, {RANKED} AND broken IS NULL AS in_rank FROM judged),
gated AS (
  SELECT *, coalesce(broken, CASE WHEN in_rank THEN coalesce({_FIRST}) END, r_discount) AS reason,
    in_rank AND {ALLOWANCE_BAD} AS allowance_fixed,
    list_filter([{_FAILED}], lambda x: x IS NOT NULL) AS failed
  FROM scoped),
final AS (
  SELECT *, CASE WHEN reason IS NOT NULL THEN regexp_extract(reason, '^\\[([^\\]]*)', 1) END AS gate,
    reason IS NOT NULL AND broken IS NULL AS removed,
    CASE WHEN reason IS NOT NULL THEN false ELSE ranking_eligible END AS eligible_after
  FROM gated)"""
STEPS = (
    "['schema', 'allowance', 'classification', 'endpoint', 'citation', 'free-claim', 'size', 'no-terminal-bench',"
    " 'access-kind', 'access-prices', 'gate3', 'suspicion', 'nim', 'discount']"
)
RUNS = (
    "runs AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS run_id,"
    " strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S.000Z') AS generated_at,"
    " CASE WHEN CAST(year(o_orderdate) AS BIGINT) % 2 = 0 THEN 'Asia/Tokyo' ELSE 'America/New_York' END AS timezone"
    " FROM orders GROUP BY year(o_orderdate))"
)
ADMITTED = (
    f"{RANKED} AND {score_ok('score', 50)} AND coalesce(tier IN ('S', 'A', 'B'), false)"
    f" AND coalesce(access_kind IN ('FREE', 'ULTRA_LOW'), false) AND ({DERIVED}) IS NOT DISTINCT FROM access_kind"
)
RANK_ORDER = (
    "CASE tier WHEN 'S' THEN 1 WHEN 'A' THEN 2 ELSE 3 END, CASE access_kind WHEN 'FREE' THEN 0 ELSE 1 END,"
    " version DESC NULLS LAST, CASE WHEN version IS NOT NULL THEN score END DESC NULLS LAST,"
    " TRY_CAST(price_verified_at AS TIMESTAMP) DESC NULLS LAST, coalesce(name, ''), offer_id"
)
SLOTTED = f"""slotted AS (
  SELECT *, CASE WHEN section = 'ranked_offers' THEN CASE WHEN access_kind = 'FREE' THEN 'slot-free' ELSE 'slot-ultra' END
      WHEN section = 'discount_offers' THEN 'slot-discount'
      WHEN access_kind = 'ULTRA_LOW' THEN 'slot-ultra' ELSE 'slot-free' END AS slot,
    CASE section WHEN 'ranked_offers' THEN 0 WHEN 'caution_offers' THEN 2 ELSE 1 END AS src
  FROM offers WHERE section <> 'ranked_offers' OR ({ADMITTED})),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY {RANK_ORDER}) AS rk
  FROM slotted WHERE src = 0),
placed AS (
  SELECT s.run_id, s.slot, s.offer_id, s.section,
    row_number() OVER (PARTITION BY s.run_id, s.slot ORDER BY s.src, coalesce(r.rk, s.pos)) AS slot_position
  FROM slotted s LEFT JOIN ranked r ON s.offer_id = r.offer_id)"""


def _gate(name: str) -> str:
    return (
        f"WITH {JOINED} SELECT * FROM (SELECT offer_id, {REASONS[name]} AS gate_reason FROM looked WHERE {RANKED})"
        " WHERE gate_reason IS NOT NULL"
    )


def _summary_text(prefix: str = "") -> str:
    n = {c: f"CAST({c} AS VARCHAR)" for c in
         ("ranked", "tier_s", "tier_a", "tier_b", "free", "ultra_low", "caution", "excluded")}
    return (
        f"'無料・激安 LLM API の日次ランキング。今回ランクイン ' || {n['ranked']} || ' 件（S ' || {n['tier_s']} ||"
        f" '、A ' || {n['tier_a']} || '、B ' || {n['tier_b']} || '）、無料 ' || {n['free']} || ' 件、激安 ' ||"
        f" {n['ultra_low']} || ' 件、注意 ' || {n['caution']} || ' 件、対象外 ' || {n['excluded']} || ' 件。'"
    )


KEPT = "NOT removed AND section = 'ranked_offers' AND eligible_after IS NOT DISTINCT FROM true"

CONTRADICTIONS = """contradictions AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS run_id, o_orderkey AS pos,
    CASE WHEN o_orderkey % 7 <> 0 THEN 'offer ' || CAST(o_orderkey AS VARCHAR) END AS offer_name,
    CASE WHEN o_orderkey % 3 <> 0 THEN 'context_tokens' END AS fact,
    CASE WHEN o_orderkey % 4 <> 0 THEN 'v' || CAST(o_orderkey % 9 AS VARCHAR) END AS adopted_value,
    CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 5 END AS n
  FROM orders)"""

_LISTS = (
    "CASE WHEN len(registration_conditions) > 0 THEN array_to_string(registration_conditions, ' / ') END",
    "CASE WHEN len(suspicion_reasons) > 0 THEN array_to_string(suspicion_reasons, ' / ') END",
)


def _attributes() -> str:
    def text(c, value=None):
        return f"CASE WHEN coalesce({c}, '') <> '' THEN {value or c} END"

    date = {c: date_ja(c, TOKYO) for c in ("price_verified_at", "discount_end_at", "end_at")}
    rows = [
        ("Context", "CASE WHEN context_tokens <> 0 THEN format('{:,}', CAST(context_tokens AS BIGINT)) || ' tokens' END"),
        ("Tool calling", "CASE WHEN tool_calling THEN '対応' WHEN NOT tool_calling THEN '非対応' END"),
        ("Base URL", text("base_url")),
        ("Model ID", text("model_id")),
        ("価格確認日", text("price_verified_at", date["price_verified_at"])),
        ("割引期限", text("discount_end_at", f"'⏳ ' || ({date['discount_end_at']}) || 'まで'")),
        ("リミット", text("free_limits")),
        ("期限", text("end_at", f"'⏳ ' || ({date['end_at']}) || 'まで' ||"
                    " CASE WHEN end_timezone_known THEN '' ELSE ' (タイムゾーン不明)' END")),
        ("レート", text("rate_limits")),
        ("データ利用", text("training_use")),
        ("データポリシー", text("data_policy")),
        ("怪し度", f"CASE WHEN suspicion_score > 0 THEN {number('suspicion_score')} || '/5' ||"
                f" coalesce(' ・ ' || {_LISTS[1]}, '') END"),
        ("条件", _LISTS[0]),
        ("注意", "coalesce(nullif(caution_reason, ''), CASE WHEN exclusion_reason LIKE '[stale]%'"
               " THEN regexp_replace(exclusion_reason, '^\\[stale\\]\\s*', '') END)"),
    ]
    links = {"データポリシー": text("data_policy_source")}
    parts = [
        f"SELECT offer_id, CAST({i} AS BIGINT) AS attribute_no, '{label}' AS label, {sql} AS value,"
        f" CAST({links.get(label, 'NULL')} AS VARCHAR) AS link FROM offers"
        for i, (label, sql) in enumerate(rows, 1)
    ]
    return f"WITH {OFFERS} SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE value IS NOT NULL"


def _connection() -> str:
    clients = _values("clients", "client_no, client, client_label",
                      [(i, c, label) for i, (c, label) in enumerate(fv.CLIENTS)])
    builtin, openai = "coalesce(openrouter, false)", "coalesce(openai, false)"
    openai_end = "coalesce(nullif(openai_url, ''), base_url)"
    return f"""WITH {JOINED}, {clients.replace('clients(', 'client_list(')}
SELECT run_id, section, offer_id, CAST(client_no AS BIGINT) AS client_no, client, client_label,
  cap_key AS provider_key,
  CASE WHEN provider_idx IS NULL THEN 'provider_unknown' WHEN clients IS NULL THEN 'client_unverified'
    ELSE 'configured' END AS status,
  CASE WHEN clients IS NOT NULL THEN CASE client
    WHEN 'pi' THEN CASE WHEN {builtin} THEN 'built-in' ELSE 'custom' END
    WHEN 'claude_code' THEN CASE WHEN anthropic_url <> '' THEN 'direct' WHEN {openai} THEN 'proxy' ELSE 'cloud' END
    WHEN 'opencode' THEN CASE WHEN {builtin} THEN 'built-in' WHEN {openai} THEN 'custom' ELSE 'native' END
    ELSE 'custom' END END AS mode,
  CASE WHEN clients IS NOT NULL THEN CASE client
    WHEN 'pi' THEN CASE WHEN NOT {builtin} THEN base_url END
    WHEN 'claude_code' THEN CASE WHEN anthropic_url <> '' THEN anthropic_url WHEN {openai} THEN base_url END
    WHEN 'opencode' THEN CASE WHEN NOT {builtin} AND {openai} THEN base_url END
    ELSE {openai_end} END END AS endpoint
FROM looked CROSS JOIN client_list"""


def _watchlist() -> str:
    bad_channels = "s_suppkey % 11 = 2"
    key = "CASE WHEN s_suppkey % 20 = 19 THEN 'v' || CAST(s_suppkey - 1 AS VARCHAR) ELSE 'v' || CAST(s_suppkey AS VARCHAR) END"
    v = "'vendors[' || CAST(s_suppkey AS VARCHAR) || ']"
    m = "'provider_monitors[' || CAST(c_custkey AS VARCHAR) || ']"
    p = "'coding_products[' || CAST(p_partkey AS VARCHAR) || ']"
    g = "'credit_programs[' || CAST(p_partkey AS VARCHAR) || ']"
    o = "'community[' || CAST(o_orderkey AS VARCHAR) || ']"
    rules = [
        ("vendors", "s_suppkey", "label", f"{v}.label must be a non empty string'", "supplier", "s_suppkey % 13 = 3"),
        ("vendors", "s_suppkey", "tier", f"{v}.tier must be one of 1, 2, 3'", "supplier", "s_nationkey % 4 = 0"),
        ("vendors", "s_suppkey", "channel_key",
         f"{v}.channels has unknown key \"foo\" (allowed: {', '.join(fv.CHANNEL_KEYS)})'", "supplier", bad_channels),
        ("vendors", "s_suppkey", "channel_url", f"{v}.channels.blog must be null or an http(s) url'", "supplier", bad_channels),
        ("vendors", "s_suppkey", "hf_org",
         f"{v}.channels.hf_org must be null or a bare hugging face org name'", "supplier", bad_channels),
        ("vendors", "s_suppkey", "github_orgs",
         f"{v}.channels.github_orgs must be null or an array of bare github org names'", "supplier", bad_channels),
        ("vendors", "s_suppkey", "duplicate",
         f"{v}.key \"v' || CAST(s_suppkey - 1 AS VARCHAR) || '\" is duplicated'", "supplier", "s_suppkey % 20 = 19"),
        ("frontier_vendors", "c_custkey", "orphan",
         "'frontier_vendors key \"v' || CAST(c_custkey % 130 AS VARCHAR) || '\" has no matching vendors entry'",
         "customer", f"'v' || CAST(c_custkey % 130 AS VARCHAR) NOT IN (SELECT {key} FROM supplier)"),
        ("provider_monitors", "c_custkey", "provider_key",
         f"{m}.provider_key must be a lowercase identifier'", "customer", "c_custkey % 17 = 4"),
        ("provider_monitors", "c_custkey", "watch_url",
         f"{m}.watch.new_models must be an http(s) url'", "customer", "c_custkey % 19 = 5"),
        ("coding_products", "p_partkey", "pricing_url", f"{p}.pricing_url must be an http(s) url'", "part", "p_size % 10 = 1"),
        ("coding_products", "p_partkey", "changelog_url",
         f"{p}.changelog_url must be null or an http(s) url'", "part", "p_size % 10 = 2"),
        ("credit_programs", "p_partkey", "url", f"{g}.url must be an http(s) url'", "part", "p_size % 25 = 8"),
        ("credit_programs", "p_partkey", "currency",
         f"{g}.currency must be null or a non empty string'", "part", "p_size % 25 = 7"),
        ("community", "o_orderkey", "kind", f"{o}.kind must be one of reddit, hn, github'", "orders", "o_orderkey % 10 = 0"),
        ("community", "o_orderkey", "subreddits", f"{o}.subreddits must be a non empty array'", "orders",
         "o_orderkey % 10 <> 0 AND o_orderkey % 3 = 0 AND o_orderkey % 9 = 3"),
        ("community", "o_orderkey", "queries", f"{o}.queries must be a non empty array'", "orders",
         "o_orderkey % 10 <> 0 AND o_orderkey % 3 = 1 AND o_orderkey % 9 = 4"),
        ("community", "o_orderkey", "repos", f"{o} requires repos[] and orgs[] arrays'", "orders",
         "o_orderkey % 10 <> 0 AND o_orderkey % 3 = 2 AND o_orderkey % 9 = 5"),
        ("community", "o_orderkey", "keywords", f"{o}.keywords must be an array'", "orders", "o_orderkey % 21 = 6"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{domain}' AS domain, CAST({pos} AS BIGINT) AS pos, '{rule}' AS rule, {message} AS message"
        f" FROM {table} WHERE {where}"
        for domain, pos, rule, message, table, where in rules
    )


_HOST = "regexp_extract(url, '^https?://([^/?#]*)', 1)"
_CITING = f"""{OFFERS},
citing AS (
  SELECT offer_id, section, ranking_eligible,
    CASE WHEN offer_id % 17 = 3 THEN url || '&gone' WHEN offer_id % 17 = 4 THEN 'ftp://docs.example' ELSE url END AS src,
    CASE WHEN offer_id % 5 = 0 THEN 'https://other' || CAST(offer_id % 50 AS VARCHAR) || '.example/v1'
      WHEN offer_id % 41 = 0 THEN NULL
      ELSE 'https://' || {_HOST} || '/v' || CAST(offer_id % 900 AS VARCHAR) END AS base
  FROM offers LEFT JOIN pages ON page_id = CASE WHEN offer_id % 3 = 0 THEN 0
    ELSE offer_id % (SELECT count(*) FROM pages) END)"""

SQL: dict[str, str] = {
    "report_scan": f"""WITH {OFFERS} SELECT run_id, section, offer_id, name, base_url, access_kind, ranking_eligible,
        last_verified, suspicion_score, eff_in, eff_out, score, tier,
        CASE WHEN sources IS NULL THEN 'none' ELSE array_to_string(sources, '|') END AS sources_text FROM offers""",
    "registry_scan": """SELECT CAST(c_nationkey AS BIGINT) AS provider_idx, lower(n_name) AS key, n_name AS label,
        true AS by_url, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
        GROUP BY c_nationkey, n_name""",
    "watchlist_scan": """SELECT lower(n_name) AS key, n_name AS label, CAST(n_regionkey % 3 + 1 AS BIGINT) AS tier,
        'https://' || lower(n_name) || '.example/blog' AS blog, count(s_suppkey) AS suppliers
        FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name, n_regionkey""",
    "citation_pages": "SELECT page_id, url, length(html) AS chars, md5(html) AS digest FROM pages",
    "positive_zero": flat("coalesce(CAST(wild_in AS VARCHAR) = '0.0', false) AS is_positive_zero"),
    "access_kind": flat(f"{kind_of('wild_in', 'wild_out')} AS kind"),
    "price_eligible": flat(f"({kind_of('wild_in', 'wild_out')}) IS NOT NULL AS eligible"),
    "access_kind_matches": flat(
        f"({kind_of('wild_in', 'wild_out')}) IS NOT DISTINCT FROM wild_kind AS matches"
    ),
    "benchmark_key": flat("benchmark_key IN ('terminal_bench_2_0', 'terminal_bench_2_1') AS is_ranking"),
    "ranking_benchmark": flat(f"{score_ok('wild_score', 50)} AS qualifies"),
    "frontier_benchmark": flat(f"{score_ok('wild_score', 80)} AS qualifies"),
    "discount_check": flat(f"{lower_price('normal_in', 'normal_out', 'wild_in', 'wild_out')} AS is_discount"),
    "discount_rates": flat(
        f"{rate('normal_in', 'wild_in')} AS rate_input, {rate('normal_out', 'wild_out')} AS rate_output"
    ),
    "operational_confidence": flat("""CASE
        WHEN provider_key = 'nvidia' AND access_kind IN ('FREE', 'ULTRA_LOW') THEN CASE
          WHEN free_endpoint_status = 'deprecated' THEN 'NONE'
          WHEN free_endpoint_status = 'available' THEN CASE WHEN api_calls_30d > 0 THEN 'HIGH' ELSE 'MEDIUM' END
          ELSE 'LOW' END
        WHEN provider_key = 'openrouter' THEN CASE
          WHEN provider_count = 0 AND access_kind <> 'DISCOUNTED' THEN 'NONE'
          WHEN provider_count > 0 AND uptime_percent IS NOT NULL THEN 'HIGH'
          WHEN provider_count > 0 OR uptime_percent IS NOT NULL OR verified OR stale_mild THEN 'MEDIUM'
          ELSE 'LOW' END
        WHEN verified THEN 'HIGH' WHEN stale_mild THEN 'MEDIUM' ELSE 'LOW' END AS confidence"""),
    "valid_timestamp": flat("TRY_CAST(last_verified AS TIMESTAMP) IS NOT NULL AS is_valid"),
    "day_key": flat(
        f"CAST({local('last_verified', TOKYO)} AS DATE) AS day_tokyo,"
        f" CAST({local('last_verified', NEW_YORK)} AS DATE) AS day_new_york"
    ),
    "freshness": f"""WITH {OFFERS}, {RUNS}, aged AS (
        SELECT offer_id, datediff('day', CAST({local('last_verified', 'timezone')} AS DATE),
          CAST({local('generated_at', 'timezone')} AS DATE)) AS days FROM offers JOIN runs USING (run_id))
        SELECT offer_id, CASE WHEN days IS NULL THEN '未検証' WHEN days <= 0 THEN '今日' WHEN days = 1 THEN '昨日'
          ELSE CAST(days AS VARCHAR) || '日前' END AS label FROM aged""",
    "format_date": flat(
        f"{date_ja('price_verified_at', TOKYO)} AS price_date, {date_ja('discount_end_at', NEW_YORK)} AS end_date"
    ),
    "format_price": flat(
        f"{price('wild_in')} AS price, {price('(eff_in / 3e6)')} AS small, {price('(normal_out * 7e12)')} AS large"
    ),
    "price_display": f"""WITH {OFFERS}, shown AS (SELECT *, CASE WHEN eff_null THEN normal_in ELSE eff_in END AS i,
        CASE WHEN eff_null THEN normal_out ELSE eff_out END AS o FROM offers), freed AS (
        SELECT *, coalesce(access_kind = 'FREE', false) OR coalesce(i = 0 AND o = 0, false) AS f FROM shown)
        SELECT offer_id, CASE WHEN f THEN '$0' ELSE {price('i')} || ' / ' || {price('o')} END AS price_text,
        f AS price_is_free FROM freed""",
    "discount_cards": f"""WITH {OFFERS} SELECT run_id, pos, offer_id, name, provider, model_id, base_url,
        CASE WHEN normal_in IS NULL AND normal_out IS NULL THEN '未取得' ELSE
          CASE WHEN normal_in IS NULL THEN '未取得' ELSE {price('normal_in')} END || ' / ' ||
          CASE WHEN normal_out IS NULL THEN '未取得' ELSE {price('normal_out')} END END AS normal_text,
        CASE WHEN eff_in IS NULL THEN '未取得' ELSE {price('eff_in')} END || ' / ' ||
          CASE WHEN eff_out IS NULL THEN '未取得' ELSE {price('eff_out')} END AS effective_text,
        CASE WHEN rate_in IS NULL AND rate_out IS NULL THEN '—' ELSE concat_ws(' / ',
          '入力 ' || {number('rate_in')} || '%', '出力 ' || {number('rate_out')} || '%') END AS rate_text,
        CASE WHEN window_start IS NOT NULL THEN {date_ja('window_start', TOKYO)} || ' 〜 ' ||
            CASE WHEN window_end IS NULL THEN '期限不明' ELSE {date_ja('window_end', TOKYO)} END
          WHEN coalesce(discount_end_at, '') <> '' THEN {date_ja('discount_end_at', TOKYO)} || ' まで'
          ELSE '期間 未確認' END AS period_text
        FROM offers WHERE section = 'discount_offers'""",
    "client_urls": f"""WITH {JOINED} SELECT offer_id,
        CASE WHEN provider_idx IS NOT NULL THEN coalesce(nullif(openai_url, ''), base_url) END AS openai_url,
        nullif(anthropic_url, '') AS anthropic_url FROM looked""",
    "offer_link": f"""WITH {JOINED}, linked AS (SELECT offer_id,
        CASE WHEN template IS NOT NULL AND model_id <> '' THEN replace(template, '{{model_id}}', model_id) END AS page,
        nullif(sources[1], '') AS first_source FROM looked)
        SELECT offer_id, coalesce(page, first_source) AS href, CASE WHEN page IS NOT NULL THEN 'モデルページ'
          WHEN first_source IS NOT NULL THEN '公式サイト' END AS link_label FROM linked""",
    "citation_supports": f"""WITH hosts AS (SELECT *, {_HOST} AS host FROM pages)
        SELECT page_id,
          contains(html, url) OR contains(html, regexp_replace(regexp_replace(url, '^https?://', ''), '/$', ''))
            OR contains(html, lower(host)) AS own,
          contains(html, lower(host)) OR contains(html, host || '/v1') AS own_host,
          contains(html, 'api.' || lower(host)) AS sub_host, false AS "none" FROM hosts""",
    "field_predicates": flat(
        "coalesce(regexp_matches(endpoint_source, '^https?://'), false) AS url_ok,"
        " coalesce(length(trim(free_limits)) > 0, false) AS name_ok,"
        " coalesce(regexp_full_match(provider_key, '[a-z][a-z0-9_]*'), false) AS key_ok,"
        " coalesce(regexp_full_match(model_id, '[a-z][a-z0-9_]*'), false) AS model_ok"
    ),
    "display_codes": flat(
        "CASE classification "
        + " ".join(f"WHEN '{c}' THEN '{label}'" for c, label, _ in fv.CLASS_BADGES)
        + " END AS class_badge, CASE classification "
        + " ".join(f"WHEN '{c}' THEN '{style}'" for c, _, style in fv.CLASS_BADGES)
        + " END AS class_style, CASE access_kind WHEN 'FREE' THEN '無料' WHEN 'ULTRA_LOW' THEN '激安' END AS access_badge,"
        " CASE WHEN benchmark_null THEN NULL WHEN tier = 'S' THEN 'tier-s' WHEN tier = 'A' THEN 'tier-a'"
        " ELSE 'tier-b' END AS tier_style, coalesce(operational_confidence, '—') AS confidence_text,"
        " CASE operational_confidence WHEN 'HIGH' THEN 'conf-high' WHEN 'MEDIUM' THEN 'conf-med'"
        " ELSE 'conf-low' END AS confidence_style,"
        " CASE WHEN coalesce(training_use, '') = '' THEN NULL WHEN contains(training_use, 'なし')"
        " OR contains(lower(training_use), 'no') THEN 'train-no' ELSE 'train-yes' END AS training_style"
    ),
    "stale_note": flat(
        "coalesce(nullif(caution_reason, ''), CASE WHEN starts_with(exclusion_reason, '[stale]')"
        " THEN ltrim(substr(exclusion_reason, 8)) END) AS note"
    ),
    "fix_allowance": flat(
        f"CASE WHEN {RANKED} AND {ALLOWANCE_BAD} THEN 'NORMAL' ELSE free_allowance_rank END AS free_allowance_rank,"
        f" {RANKED} AND {ALLOWANCE_BAD} AS fixed"
    ),
    "fix_classification": flat(
        f"CASE WHEN {CLASS_FIXED} THEN 'E_DISCOUNT' ELSE classification END AS classification, {CLASS_FIXED} AS fixed"
    ),
    "schema_violations": f"""WITH {OFFERS}, checked AS (SELECT *, {ERRORS} AS e FROM offers)
        SELECT run_id, section, offer_id, coalesce(name, '?') AS name, len(e) AS errors,
        array_to_string(e, '; ') AS detail FROM checked WHERE len(e) > 0""",
    **{
        key: _gate(gate)
        for key, gate in {
            "gate_endpoint": "endpoint", "gate_free_claim": "free-claim", "gate_size": "size",
            "gate_benchmark": "no-terminal-bench", "gate_access_kind": "access-kind",
            "gate_access_prices": "access-prices", "gate_confidence": "gate3", "gate_suspicion": "suspicion",
            "gate_deprecated": "nim",
        }.items()
    },
    "gate_discount": f"""WITH {OFFERS} SELECT * FROM (SELECT offer_id, {DISCOUNT} AS gate_reason FROM offers
        WHERE section = 'discount_offers') WHERE gate_reason IS NOT NULL""",
    "gate_citation": f"""WITH {_CITING}, judged AS (SELECT c.*, p.html,
          regexp_extract(base, '^https?://([^/?#]*)', 1) AS host
        FROM citing c JOIN pages p ON c.src = p.url
        WHERE section = 'ranked_offers' AND ranking_eligible IS NOT DISTINCT FROM true)
        SELECT offer_id, '[citation] ' || src || ' does not document base_url "' || coalesce(base, 'null') || '"'
          AS gate_reason FROM judged
        WHERE base IS NULL OR NOT (contains(html, base) OR contains(html, substr(base, 9)) OR contains(html, lower(host)))""",
    "contradiction_violations": f"""WITH {CONTRADICTIONS} SELECT run_id, pos, coalesce(n, 0) AS n_values,
        'contradictions entry for ' || coalesce(offer_name, 'null') || ' has ' || CAST(coalesce(n, 0) AS VARCHAR) ||
        ' value(s); a contradiction needs at least two' AS message FROM contradictions WHERE coalesce(n, 0) < 2""",
    "excluded_offers": f"""WITH {GATED} SELECT run_id, section, offer_id, coalesce(name, '?') AS name, gate, reason
        FROM final WHERE reason IS NOT NULL""",
    "failed_gates": f"""WITH {GATED} SELECT offer_id, gate, array_to_string(failed, ',') AS failed FROM final
        WHERE len(failed) > 0""",
    "admitted_offers": f"WITH {OFFERS} SELECT run_id, offer_id, access_kind FROM offers WHERE {ADMITTED}",
    "gate_counts": f"""WITH {GATED} SELECT run_id, gate, count(*) AS offers FROM final WHERE gate IS NOT NULL
        GROUP BY run_id, gate""",
    "fix_log": f"""WITH {GATED}, logged AS (
        SELECT *, 'auto-fix' AS action, 'allowance' AS g, {_q(fv.DETAIL_ALLOWANCE)} AS detail FROM final WHERE allowance_fixed
        UNION ALL SELECT *, 'auto-fix', 'classification', 'non-zero ULTRA_LOW price cannot be ' || classification ||
          '; set to E_DISCOUNT' FROM final WHERE class_fixed
        UNION ALL SELECT *, 'exclude', gate, reason FROM final WHERE reason IS NOT NULL)
        SELECT run_id, CAST(list_position({STEPS}, g) AS BIGINT) AS step, section, offer_id,
          CASE WHEN action = 'exclude' THEN coalesce(name, '?') ELSE name END AS offer, action, g AS gate, detail
        FROM logged""",
    "provider_match": f"WITH {MATCHED} SELECT offer_id, CAST(provider_idx AS BIGINT) AS provider_idx, by_url FROM matched",
    "provider_capability": f"""WITH {JOINED} SELECT offer_id, cap_key, r_label AS cap_label, openai,
        CAST(clients AS BIGINT) AS clients FROM looked""",
    "connection_matrix": _connection(),
    "orphan_keys": """SELECT c_custkey AS pos, c_custkey % 130 AS vendor FROM customer
        WHERE c_custkey % 130 NOT IN (SELECT s_suppkey FROM supplier)""",
    "report_summary": f"""WITH {GATED}, {RUNS}, counted AS (SELECT run_id,
          count(*) FILTER (WHERE {KEPT}) AS ranked,
          count(*) FILTER (WHERE {KEPT} AND tier = 'S') AS tier_s,
          count(*) FILTER (WHERE {KEPT} AND tier = 'A') AS tier_a,
          count(*) FILTER (WHERE {KEPT} AND tier = 'B') AS tier_b,
          count(*) FILTER (WHERE {KEPT} AND access_kind = 'FREE') AS free,
          count(*) FILTER (WHERE {KEPT} AND access_kind = 'ULTRA_LOW') AS ultra_low,
          count(*) FILTER (WHERE NOT removed AND section = 'caution_offers') AS caution,
          count(*) FILTER (WHERE reason IS NOT NULL) AS excluded
        FROM final GROUP BY run_id)
        SELECT counted.*, {_summary_text()} AS summary FROM counted JOIN runs USING (run_id)""",
    "snapshot": f"""WITH {OFFERS} SELECT run_id, count(*) AS total, count(*) FILTER (WHERE tier = 'S') AS s_count,
        count(*) FILTER (WHERE tier = 'A') AS a_count, count(*) FILTER (WHERE access_kind = 'FREE') AS free_count,
        count(*) FILTER (WHERE coalesce(end_at, '') <> '' OR coalesce(discount_end_at, '') <> '') AS limited_count
        FROM offers WHERE {ADMITTED} GROUP BY run_id""",
    "run_stats": f"""WITH {GATED} SELECT run_id, count(*) FILTER (WHERE {KEPT}) AS ranked,
        count(*) FILTER (WHERE reason IS NOT NULL) AS excluded_this_run,
        count(*) FILTER (WHERE allowance_fixed) + count(*) FILTER (WHERE class_fixed) AS auto_fixed,
        count(*) FILTER (WHERE reason IS NOT NULL) AS excluded FROM final GROUP BY run_id""",
    "offers_per_source": f"""WITH {OFFERS} SELECT endpoint_source, count(*) AS offers FROM offers
        WHERE {RANKED} AND regexp_matches(endpoint_source, '^https?://') GROUP BY endpoint_source""",
    "duplicate_keys": """SELECT key, pos FROM (SELECT o_custkey AS key, o_orderkey AS pos,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) WHERE n > 1""",
    "section_counts": f"""WITH {OFFERS}, {RUNS}, {_values('s', 'section_no, section',
        [(i, n) for i, n in enumerate((*fv.OFFER_SECTIONS, 'product_updates'))])}
        SELECT runs.run_id, CAST(section_no AS BIGINT) AS section_no, s.section, count(offer_id) AS "rows"
        FROM runs CROSS JOIN s LEFT JOIN offers ON offers.run_id = runs.run_id AND offers.section = s.section
        GROUP BY ALL""",
    "ranked_offers": f"""WITH {OFFERS} SELECT run_id,
        row_number() OVER (PARTITION BY run_id ORDER BY {RANK_ORDER}) AS position, offer_id, name, access_kind, tier
        FROM offers WHERE {ADMITTED}""",
    "checked_ranking": f"""WITH {GATED} SELECT run_id,
        row_number() OVER (PARTITION BY run_id ORDER BY {RANK_ORDER}) AS position, offer_id, name
        FROM final WHERE NOT removed AND reason IS NULL AND {ADMITTED}""",
    "top_offer": f"""WITH {OFFERS} SELECT run_id, offer_id, name, tier FROM (SELECT *,
        row_number() OVER (PARTITION BY run_id ORDER BY {RANK_ORDER}) AS n FROM offers WHERE {ADMITTED}) WHERE n = 1""",
    "offer_slots": f"WITH {OFFERS}, {SLOTTED} SELECT run_id, slot, slot_position, offer_id, section FROM placed",
    "slot_positions": f"""WITH {OFFERS}, {SLOTTED} SELECT run_id, slot, offer_id,
        CASE WHEN slot_position < 10 THEN '0' ELSE '' END || CAST(slot_position AS VARCHAR) AS shown_position FROM placed""",
    "upsert_entries": """WITH updates AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN c_custkey * 2 + 2
          ELSE c_custkey * 2 END AS key, c_custkey AS pos, c_name AS p_name, c_nationkey + 100 AS size FROM customer),
        latest AS (SELECT key, arg_max(p_name, pos) AS p_name, arg_max(size, pos) AS size, min(pos) AS asked
          FROM updates GROUP BY key)
        SELECT p_partkey AS key, p_partkey AS pos, coalesce(l.p_name, p.p_name) AS p_name,
          coalesce(l.size, p_size) AS size FROM part p LEFT JOIN latest l ON p_partkey = l.key
        UNION ALL SELECT key, (SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY asked, key), p_name, size
        FROM latest WHERE key NOT IN (SELECT p_partkey FROM part)""",
    "remove_entries": """SELECT p_partkey AS key, p_partkey AS pos, p_name, p_size AS size FROM part
        WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)""",
    "benchmark_details": f"""WITH {OFFERS} SELECT offer_id, benchmarks_n AS benchmark_count, i - 1 AS benchmark_no,
        'Bench ' || CAST(i AS VARCHAR) || CASE WHEN i % 2 = 1 THEN ' (v' || CAST(i AS VARCHAR) || ')' ELSE '' END AS label,
        coalesce({number('score / i')}, '') || '%' AS value
        FROM (SELECT offer_id, benchmarks_n, score, unnest(range(1, benchmarks_n + 1)) AS i FROM offers)""",
    "card_attributes": _attributes(),
    "typed_violations": """WITH m AS (
          SELECT CAST(o_custkey AS VARCHAR) AS run_id, 'ranked_offers' AS section, CAST(o_orderkey AS BIGINT) AS pos, o_orderkey AS k,
            '/ranked_offers/' || CAST(o_orderkey AS VARCHAR) AS p FROM orders),
        e AS (SELECT *, CASE WHEN k % 13 = 0 OR k % 11 = 0 THEN p || ': must be object' ELSE concat_ws('; ',
            CASE WHEN k % 5 = 0 THEN p || ': must have required property ''name''' END,
            CASE WHEN k % 5 = 1 THEN p || '/name: must be string' END,
            CASE WHEN k % 5 = 2 THEN p || '/name: must NOT have fewer than 1 characters' END,
            CASE WHEN k % 7 = 3 THEN p || '/price: must have required property ''input''' END,
            CASE WHEN k % 7 = 0 THEN p || '/price/input: must be number,null' END,
            CASE WHEN k % 7 = 1 THEN p || '/price/input: must be >= 0' END,
            CASE WHEN k % 3 = 1 AND k % 2 = 1 THEN p || '/tags: must be array' END,
            CASE WHEN k % 3 = 1 AND k % 2 = 0 THEN p || '/tags: must NOT have fewer than 1 items' END,
            CASE WHEN k % 3 = 0 THEN p || '/tags/1: must be string; ' || p || '/tags/3: must be string' END,
            CASE WHEN k % 4 = 0 THEN p || '/count: must be integer' END,
            CASE WHEN k % 4 = 1 THEN p || '/count: must be <= 100' END) END AS detail FROM m)
        SELECT run_id, section, pos, detail FROM e WHERE detail <> ''""",
    "joined_lists": flat(f"{_LISTS[0]} AS conditions_text, {_LISTS[1]} AS suspicion_text"),
    "updates_list": """SELECT strftime(ts, '%Y-%m-%d') AS run_id, 'product_updates' AS section, event_id AS pos,
        CASE WHEN event_id % 4 = 0 THEN 'user' || CAST(user_id AS VARCHAR) ELSE event_type END AS headline,
        CASE WHEN event_id % 11 <> 0 AND event_id % 5 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS "date",
        CASE WHEN event_id % 11 <> 0 AND event_id % 3 <> 0 THEN 'title ' || event_type END AS title,
        CASE WHEN event_id % 11 <> 0 THEN nullif(props, '') END AS excerpt, CAST(NULL AS VARCHAR) AS url,
        CASE WHEN event_id % 2 = 0 THEN 'https://watch.example' END AS source_url FROM events""",
    "refused_publication": f"""WITH {CONTRADICTIONS} SELECT run_id, count(*) AS violations, false AS is_live
        FROM contradictions WHERE coalesce(n, 0) < 2 GROUP BY run_id""",
    "contradiction_notes": f"""WITH {CONTRADICTIONS} SELECT run_id, pos, coalesce(offer_name, '') AS offer_name,
        coalesce(fact, '') AS fact, coalesce(adopted_value, '未定') AS adopted_value FROM contradictions""",
    "watchlist_violations": _watchlist(),
    "publish_report": f"""WITH {GATED} SELECT run_id, count(*) FILTER (WHERE NOT removed) AS offers,
        count(*) FILTER (WHERE NOT removed AND coalesce(eligible_after, false)) AS eligible,
        count(*) FILTER (WHERE allowance_fixed) + count(*) FILTER (WHERE class_fixed) +
        count(*) FILTER (WHERE reason IS NOT NULL) AS logged FROM final GROUP BY run_id""",
    "write_watchlist": """SELECT 'vendors' AS domain, count(*) AS "rows" FROM supplier
        UNION ALL SELECT 'frontier_vendors', count(*) FROM customer
        UNION ALL SELECT 'provider_monitors', count(*) FROM customer
        UNION ALL SELECT 'community', count(*) FROM orders
        UNION ALL SELECT 'coding_products', count(*) FROM part
        UNION ALL SELECT 'credit_programs', count(*) FROM part""",
    "promote": f"""WITH {OFFERS}, admitted AS (SELECT *,
          row_number() OVER (PARTITION BY run_id ORDER BY {RANK_ORDER}) AS n FROM offers WHERE {ADMITTED})
        SELECT run_id, count(*) AS total, max(offer_id) FILTER (WHERE n = 1) AS offer_id FROM admitted GROUP BY run_id""",
}
SQL["registry_join"] = r"""WITH c AS (SELECT c_custkey AS idx, c_custkey % 40 AS desk, CASE WHEN c_custkey % 3 = 0 THEN '^https://none$'
          WHEN c_custkey = 5 THEN '/v1[0-4]$' ELSE '^https://c' || c_custkey || '\.example/' END AS pattern FROM customer),
        desks AS (SELECT desk, min(idx) AS idx FROM c GROUP BY desk),
        met AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN least(own.idx,
              CASE WHEN o_orderkey % 50 BETWEEN 10 AND 14 THEN (SELECT min(idx) FROM c WHERE idx = 5) END) END AS by_host,
            least(named.idx, desks.idx) AS by_text
          FROM orders LEFT JOIN c own ON own.idx = o_custkey AND own.idx % 3 > 0 AND own.idx <> 5
          LEFT JOIN c named ON named.idx = o_custkey LEFT JOIN desks ON desks.desk = o_orderkey % 90)
        SELECT o_orderkey, coalesce(by_host, by_text) AS provider_idx,
          CASE WHEN by_host IS NOT NULL THEN TRUE WHEN by_text IS NOT NULL THEN FALSE END AS by_url, pattern
        FROM met LEFT JOIN c ON c.idx = coalesce(by_host, by_text)"""
SQL["written_fix_log"] = SQL["fix_log"]
