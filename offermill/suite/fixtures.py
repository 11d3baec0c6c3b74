"""Offers, runs and watchlist tables derived from the benchmark tables.

One offer per order, one run per order year; no rows are left out. Columns are
SQL texts, written once and spoken in both dialects (Spark here, DuckDB for the
check), so that both engines start from the same rows. Every rule below is a
choice of the fixture; it covers each gate, nulls, empty texts and bad dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as fv, schemas


class Spark:
    """Spelling of the few functions whose names differ."""

    @staticmethod
    def items(*values: str) -> str:
        return f"array({', '.join(values)})"

    no_items = "cast(array() as array<string>)"

    @staticmethod
    def iso(ts: str) -> str:
        return f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")"

    @staticmethod
    def day(ts: str) -> str:
        return f"date_format({ts}, 'yyyy-MM-dd')"

    @staticmethod
    def hours(ts: str, n: str) -> str:
        return f"timestampadd(HOUR, {n}, {ts})"

    @staticmethod
    def pick(i: str, values) -> str:
        listed = ", ".join(f"'{v}'" for v in values)
        return f"get(array({listed}), cast({i} as int))"


class Duck:
    @staticmethod
    def items(*values: str) -> str:
        return f"list_value({', '.join(values)})"

    no_items = "CAST([] AS VARCHAR[])"

    @staticmethod
    def iso(ts: str) -> str:
        return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.000Z')"

    @staticmethod
    def day(ts: str) -> str:
        return f"strftime({ts}, '%Y-%m-%d')"

    @staticmethod
    def hours(ts: str, n: str) -> str:
        return f"({ts} + to_hours(CAST({n} AS INTEGER)))"

    @staticmethod
    def pick(i: str, values) -> str:
        listed = ", ".join(f"'{v}'" for v in values)
        return f"([{listed}])[{i} + 1]"


def _text(expr: str) -> str:
    return f"cast({expr} as string)"


def _double(expr: str) -> str:
    return f"cast({expr} as double)"


BASE = {
    "k": "o_orderkey",
    "c": "o_custkey",
    "d": "o_orderdate",
    "h": "(o_orderkey * 31 + o_custkey) % 101",
    "prio": "o_orderpriority",
}


def _field(n: int):
    return [entry[n] for entry in fv.REGISTRY]


def level1(q) -> dict[str, str]:
    """Columns from the base columns only."""
    registry_url = q.pick("c % 24", _field(3))
    return {
        "run_id": _text("year(d)"),
        "section": (
            "case k % 19 when 1 then 'conditional_credits' when 2 then 'caution_offers'"
            " when 3 then 'discount_offers' else 'ranked_offers' end"
        ),
        "pos": "k",
        "offer_id": "k",
        "ranking_eligible": "case when k % 31 = 7 then null else k % 11 <> 5 end",
        "name": (
            f"case when k % 401 = 0 then null else 'model ' || {_text('c % 300')} || ' #' || {_text('k')} end"
        ),
        "model_name": f"'model ' || {_text('c % 300')}",
        "provider": (
            f"case when c % 24 >= 21 then 'Unlisted ' || {_text('c % 24')} else {q.pick('c % 24', _field(1))} end"
        ),
        "provider_key": q.pick("c % 24", _field(0)),
        "model_id": (
            f"case when k % 83 = 0 then null when k % 83 = 1 then ''"
            f" else 'vendor' || {_text('c % 40')} || '/model-' || {_text('k % 300')} end"
        ),
        "base_url": (
            "case when k % 41 = 0 then null when k % 43 = 1 then ''"
            f" when c % 24 >= 21 then 'https://unlisted' || {_text('c % 24')} || '.example/v1'"
            f" when k % 23 = 0 then {registry_url} || '/beta'"
            f" when k % 5 = 0 then {registry_url} || '/' else {registry_url} end"
        ),
        "endpoint_source": (
            "case when k % 37 = 0 then null when k % 37 = 1 then 'ftp://docs.example'"
            " when k % 3 = 0 then 'https://docs.example/common'"
            f" else 'https://docs' || {_text('k % 1000')} || '.example/api' end"
        ),
        "eff_null": "k % 59 = 0",
        "eff_in": (
            "case when k % 59 = 0 then null when h % 10 < 4 then cast(0 as double)"
            f" when h % 10 < 8 then {_double('k % 25')} / 1e2 when h % 10 = 8 then {_double('k % 50')} / 1e1 end"
        ),
        "eff_out": (
            "case when k % 59 = 0 then null when h % 10 < 4 then cast(0 as double)"
            f" when h % 10 < 8 then {_double('c % 45')} / 1e2 when h % 10 = 8 then {_double('c % 60')} / 1e1 end"
        ),
        "rates_null": "k % 61 = 0",
        "rate_in": f"case when k % 61 = 0 or k % 5 = 0 then null else {_double('k % 90')} / 2e0 end",
        "rate_out": f"case when k % 61 = 0 or k % 5 < 2 then null else {_double('c % 80')} / 4e0 end",
        "benchmark_null": "k % 67 = 0",
        "benchmark_key": (
            "case when k % 8 < 4 then 'terminal_bench_2_1' when k % 8 < 7 then 'terminal_bench_2_0'"
            " else 'livecodebench_v6' end"
        ),
        "benchmark_name": (
            "case when k % 67 = 0 then null when k % 8 < 4 then 'Terminal-Bench 2.1'"
            " when k % 8 < 7 then 'Terminal-Bench 2.0' else 'LiveCodeBench v6' end"
        ),
        "version": (
            "case when k % 67 = 0 or k % 71 = 0 then null when k % 8 < 4 then '2.1'"
            " when k % 8 < 7 then '2.0' else '6' end"
        ),
        "score": f"case when k % 67 = 0 or k % 73 = 0 then null else {_double('(c * 7 + k) % 101')} end",
        "classification": q.pick(
            "k % 7",
            [code for code, _, _ in fv.CLASS_BADGES] + ["G_FREE_LIKE"],
        ),
        "operational_confidence": (
            "case when k % 47 = 0 then 'NONE' when k % 47 = 1 then 'UNSURE' when k % 47 = 2 then null"
            " when prio in ('1-URGENT', '2-HIGH') then 'HIGH' when prio = '5-LOW' then 'LOW' else 'MEDIUM' end"
        ),
        "suspicion_score": f"case when k % 29 = 9 then null else {_double('k % 7')} end",
        "suspicion_reasons": (
            f"case when k % 7 = 0 then {q.no_items} when k % 7 < 5 then"
            f" {q.items('''cast('new domain' as string)''', _text('k % 7'))} end"
        ),
        "registration_conditions": (
            f"case k % 10 when 0 then {q.items('''cast('card' as string)''', '''cast('phone' as string)''')}"
            f" when 1 then {q.no_items} end"
        ),
        "sources": (
            f"case k % 4 when 1 then {q.no_items} when 2 then"
            f" {q.items('''cast('https://a.example/' as string) || ''' + _text('k % 50'), '''cast('https://b.example' as string)''')}"
            f" when 3 then {q.items('''cast('' as string)''')} end"
        ),
        "benchmarks_n": "k % 4",
        "total_parameters_b": (
            f"case when k % 9 = 0 then null when k % 4 = 0 then {_double('c % 60')} + 5e-1"
            f" else {_double('c % 60 + 1')} end"
        ),
        "context_tokens": f"case when k % 8 = 0 then null else {_double('(c % 7) * 32768')} end",
        "tool_calling": "case k % 3 when 0 then true when 1 then false end",
        "free_limits": (
            "case k % 29 when 0 then 'The API is paid after trial' when 1 then '' when 2 then null"
            " when 3 then '無料API is paidです' when 4 then 'papi is paid' when 5 then 'rapid api access' else 'rpm 20' end"
        ),
        "rate_limits": "case when k % 97 = 0 then 'api costs $5 a call' when k % 4 = 0 then null else '20 rpm' end",
        "training_use": (
            "case k % 5 when 1 then '学習なし' when 2 then 'No training' when 3 then 'used to train' when 4 then '' end"
        ),
        "data_policy": f"case when k % 6 = 0 then 'policy ' || {_text('c % 9')} end",
        "data_policy_source": "case when k % 12 = 0 then 'https://policy.example' end",
        "caution_reason": "case k % 33 when 0 then 'limits change often' when 1 then '' end",
        "exclusion_reason": "case k % 35 when 0 then '[stale]  not seen for 3 runs' when 1 then '[other] x' end",
        "recent_activity": "case when k % 3 = 0 then 'active' end",
        "free_endpoint_status": "case when k % 43 = 0 then 'deprecated' when h % 4 = 1 then 'available' end",
        "free_allowance_rank": "case k % 6 when 0 then null when 1 then 'HUGE' when 2 then 'AMPLE' else 'NORMAL' end",
        "end_timezone_known": "k % 2 = 0",
        "last_verified": (
            "case k % 45 when 0 then null when 1 then 'not a date' when 2 then ''"
            f" when 3 then {q.day('d')} else {q.iso(q.hours('d', 'k % 24'))} end"
        ),
        "price_verified_at": (
            f"case k % 49 when 0 then null when 1 then 'soon' else {q.iso(q.hours('d', 'k % 24'))} end"
        ),
        "end_at": f"case when k % 12 = 0 then {q.iso(q.hours('d', '720'))} end",
        "discount_end_at": f"case when k % 14 = 0 then {q.iso(q.hours('d', '500'))} when k % 14 = 1 then '' end",
        "window_null": "k % 4 <> 0",
        "window_start": f"case when k % 4 = 0 and k % 3 <> 0 then {q.iso('d')} end",
        "window_end": f"case when k % 4 = 0 and k % 8 <> 0 then {q.iso(q.hours('d', '240'))} end",
        "verified": "k % 3 = 0",
        "stale_mild": "k % 5 = 0",
        "provider_count": "case k % 4 when 0 then null when 1 then cast(0 as bigint) else k % 6 end",
        "api_calls_30d": "case when h % 5 = 0 then null else (k % 3) * 10 end",
        "uptime_percent": f"case when k % 5 = 2 then null else {_double('90 + c % 10')} end",
        # Prices no report should have: NaN, infinity, minus zero, negative.
        "wild": "k % 53",
    }


LEVEL2 = {
    "normal_in": "case when c % 3 = 0 then eff_in else eff_in * 2e0 + 5e-1 end",
    "normal_out": (
        "case c % 4 when 0 then eff_out when 1 then eff_out / 2e0 else eff_out * 2e0 + 5e-1 end"
    ),
    "tier": (
        "case when benchmark_null then null when score >= 80 then 'S' when score >= 65 then 'A' else 'B' end"
    ),
    "access_kind": (
        "case when section = 'discount_offers' then case when k % 10 = 0 then null else 'DISCOUNTED' end"
        " when k % 17 = 0 then null when k % 13 = 0 then 'FREE'"
        " when eff_in = 0 and eff_out = 0 then 'FREE'"
        " when eff_in <= 2e-1 and eff_out <= 4e-1 then 'ULTRA_LOW' end"
    ),
    "wild_in": (
        "case wild when 1 then cast('NaN' as double) when 2 then cast('Infinity' as double)"
        " when 3 then cast('-0.0' as double) when 4 then cast('-0.1' as double) else eff_in end"
    ),
    "wild_out": (
        "case wild when 5 then cast('NaN' as double) when 6 then cast('-Infinity' as double)"
        " when 7 then cast('-0.0' as double) when 8 then cast(0 as double) else eff_out end"
    ),
    "wild_score": (
        "case wild when 9 then cast('NaN' as double) when 10 then cast('Infinity' as double)"
        " when 11 then cast('49.999' as double) when 12 then cast(50 as double) else score end"
    ),
    "wild_kind": "case wild when 13 then null else access_kind end",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select("*", *[F.expr(sql).alias(name) for name, sql in columns.items()])


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(*[F.expr(sql).alias(name) for name, sql in BASE.items()])


def flat_offers(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    base = _base(spark, sf_dir) if base is None else base
    first = level1(Spark)
    # The columns most others build on come out of a one-element explode: filters
    # on them are then not expanded into these rules, and they act as if scanned.
    core = [F.expr(first.pop(name)).alias(name) for name in ("section", "base_url", "eff_in", "eff_out", "score")]
    bound = base.select("*", F.inline(F.array(F.struct(*core))))
    return _with(_with(bound, first), LEVEL2)


def _pair(left: str, right: str, absent: str):
    pair = F.struct(F.col(left).alias("input"), F.col(right).alias("output"))
    return F.when(~F.col(absent), pair)


def nest(flat: DataFrame) -> DataFrame:
    """The flat fixture columns in the engine's offer schema."""
    benchmarks = F.transform(
        F.when(F.col("benchmarks_n") > 0, F.sequence(F.lit(1), F.col("benchmarks_n").cast("int"))).otherwise(
            F.array().cast("array<int>")
        ),
        lambda i: F.struct(
            F.concat(F.lit("Bench "), i.cast("string")).alias("name"),
            F.when(i % 2 == 1, F.concat(F.lit("v"), i.cast("string"))).alias("version"),
            (F.col("score") / i).alias("score"),
        ),
    )
    nested = flat.withColumns(
        {
            "effective_price_per_million": _pair("eff_in", "eff_out", "eff_null"),
            "normal_price_per_million": F.struct(
                F.col("normal_in").alias("input"), F.col("normal_out").alias("output")
            ),
            "discount_rates": _pair("rate_in", "rate_out", "rates_null"),
            "benchmark": F.when(
                ~F.col("benchmark_null"), F.struct("score", "benchmark_name", "version", "tier")
            ),
            "benchmarks": benchmarks,
            "window": F.when(
                ~F.col("window_null"),
                F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")),
            ),
        }
    )
    columns = []
    for f in schemas.OFFERS.fields:
        value = F.col(f.name) if f.name in nested.columns else F.lit(None)
        columns.append(value.cast(f.dataType).alias(f.name))
    return nested.select(*columns)


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nest(flat_offers(spark, sf_dir))


ADDRESS_MARK = "#page_id="


def cited_page(rounds: str) -> str:
    """Which page an offer of the waterfall cites: some any page, some one that names its provider's endpoint.

    `rounds` is the number of whole rounds of 24 providers among the pages.
    """
    return f"case when k % 8 = 1 then k % ({rounds} * 24) when k % 8 = 5 then (k % {rounds}) * 24 + c % 24 end"


def documented(q) -> str:
    """What a page of the waterfall says: its own text and the endpoint of one provider."""
    return f"html || ' ' || coalesce({q.pick('page_id % 24', _field(3))}, '')"


def waterfall(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Offers of which a quarter cites given pages, and those pages.

    Given pages may share a URL; each is cited by an address of its own, which `plain_addresses` takes back.
    """
    given = table(spark, sf_dir, "pages").withColumn("url", F.concat("url", F.lit(ADDRESS_MARK), F.col("page_id").cast("string")))
    rounds = max(1, given.count() // 24)
    # Offers that cite no page get keys that match none, scattered: nulls would gather in one task.
    cited = F.coalesce(F.expr(cited_page(str(rounds))), -1 - F.pmod("k", F.lit(65536)))
    places = given.select(F.col("page_id").alias("_cited"), F.col("url").alias("_url"))
    # Joined before the rules make the rows wide.
    base = _base(spark, sf_dir).withColumn("_cited", cited).join(places, "_cited", "left")
    citing = flat_offers(spark, sf_dir, base).withColumn("endpoint_source", F.coalesce("_url", "endpoint_source"))
    return nest(citing), given.select("page_id", "url", F.expr(documented(Spark)).alias("html"))


def plain_addresses(gated: DataFrame) -> DataFrame:
    """What the gates made of `waterfall`, with the pages' given URLs."""
    mark = f"{ADDRESS_MARK}[0-9]+"
    return gated.withColumns(
        {name: F.regexp_replace(name, mark, "") for name in ("endpoint_source", "reason", "exclusion_reason")}
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per order year."""
    orders = table(spark, sf_dir, "orders")
    year = F.expr(_text("year(o_orderdate)"))
    made = orders.groupBy(year.alias("run_id")).agg(F.max("o_orderdate").alias("_d"))
    zone = F.when(F.col("run_id") % 2 == 0, "Asia/Tokyo").otherwise("America/New_York")
    return made.select("run_id", F.expr(Spark.iso("_d")).alias("generated_at"), zone.alias("timezone"))


def duck_waterfall() -> str:
    """The offers of the waterfall, with `cited_ok`: whether the cited page names the endpoint, null without page."""
    plain = duck_offers().replace(" offers AS (", " plain AS (")
    rounds = "(SELECT greatest(1, count(*) // 24) FROM pages)"
    host = "regexp_extract(base_url, '^https?://([^/?#]*)', 1)"
    bare = "regexp_replace(regexp_replace(base_url, '^https?://', ''), '/$', '')"
    named = f"contains(said, base_url) OR contains(said, {bare}) OR ({host} <> '' AND contains(said, lower({host})))"
    return (
        f"{plain}, said AS (SELECT page_id, url, {documented(Duck)} AS said FROM pages),"
        f" citing AS (SELECT *, {cited_page(rounds)} AS cited FROM plain),"
        " offers AS (SELECT citing.* REPLACE (coalesce(url, endpoint_source) AS endpoint_source),"
        f" CASE WHEN url IS NOT NULL THEN coalesce(base_url, '') <> '' AND coalesce({named}, false) END AS cited_ok"
        " FROM citing LEFT JOIN said ON cited = page_id)"
    )


def duck_offers() -> str:
    """The same offers as a chain of DuckDB common table expressions."""

    def columns(exprs: dict[str, str]) -> str:
        return ", ".join(f"{sql} AS {name}" for name, sql in exprs.items())

    return (
        f"base AS (SELECT {columns(BASE)} FROM orders),"
        f" flat1 AS (SELECT *, {columns(level1(Duck))} FROM base),"
        f" offers AS (SELECT *, {columns(LEVEL2)} FROM flat1)"
    )
