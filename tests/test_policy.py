import pytest
from pyspark.sql import functions as F

from offermill.functions import policy as P

NAN, INF = float("nan"), float("inf")


def column_values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


PAIRS = [
    ((0.0, 0.0), "FREE"), ((0.0, -0.0), None), ((-0.0, 0.0), None), ((0.2, 0.4), "ULTRA_LOW"),
    ((0.199999, 0.399999), "ULTRA_LOW"), ((0.200001, 0.4), None), ((0.2, 0.400001), None),
    ((None, 0.0), None), ((NAN, 0.0), None), ((INF, 0.0), None), ((-INF, 0.0), None), ((-0.1, 0.0), None),
    ((0.0, 0.1), "ULTRA_LOW"), ((None, None), None), ((5.0, 10.0), None), ((0.1, -0.0), None),
]


def test_access_kind_limits(spark):
    got = column_values(spark, [p for p, _ in PAIRS], "i double, o double", P.access_kind(F.col("i"), F.col("o")))
    assert got == [kind for _, kind in PAIRS]
    eligible = column_values(
        spark, [p for p, _ in PAIRS], "i double, o double", P.is_price_eligible(F.col("i"), F.col("o"))
    )
    assert eligible == [kind is not None for _, kind in PAIRS]


def test_access_kind_matches(spark):
    cases = [
        (("FREE", 0.0, 0.0), True), (("FREE", 0.05, 0.05), False), (("ULTRA_LOW", 0.2, 0.4), True),
        (("ULTRA_LOW", 0.2, 0.400001), False), (("FREE", None, 0.0), False), (("ULTRA_LOW", None, None), False),
        ((None, 5.0, 5.0), True),
    ]
    got = column_values(
        spark, [c for c, _ in cases], "k string, i double, o double",
        P.access_kind_matches(F.col("k"), F.col("i"), F.col("o")),
    )
    assert got == [want for _, want in cases]


@pytest.mark.parametrize("fn, limit", [(P.qualifies_ranking, 50.0), (P.qualifies_frontier, 80.0)])
def test_score_gates(spark, fn, limit):
    cases = [
        (("terminal_bench_2_1", limit), True), (("terminal_bench_2_1", limit - 0.001), False),
        (("terminal_bench_2_0", limit), True), (("terminal_bench_2_2", 90.0), False),
        (("swe_bench_verified", 90.0), False), (("terminal_bench_2_1", None), False),
        (("terminal_bench_2_1", NAN), False), (("terminal_bench_2_1", INF), False), ((None, 90.0), False),
    ]
    got = column_values(spark, [c for c, _ in cases], "k string, s double", fn(F.col("k"), F.col("s")))
    assert got == [want for _, want in cases]


def test_positive_zero_and_finite(spark):
    values = [(0.0,), (-0.0,), (1.0,), (None,), (NAN,), (INF,)]
    assert column_values(spark, values, "x double", P.is_positive_zero(F.col("x"))) == [
        True, False, False, False, False, False,
    ]
    assert column_values(spark, values, "x double", P.is_finite(F.col("x"))) == [
        True, True, True, False, False, False,
    ]


def test_discounts(spark):
    cases = [
        ((1.0, 1.0, 0.5, 1.0), True), ((1.0, 1.0, 1.0, 1.0), False), ((1.0, 1.0, 2.0, 0.9), True),
        ((None, 1.0, 0.5, 0.5), False), ((NAN, 1.0, 0.5, 0.5), False), ((INF, 1.0, 0.5, 0.5), False),
        ((1.0, 1.0, -0.5, 0.5), False),
    ]
    names = [F.col(c) for c in "abcd"]
    schema = "a double, b double, c double, d double"
    assert column_values(spark, [c for c, _ in cases], schema, P.is_discount(*names)) == [w for _, w in cases]
    rates = [
        ((2.0, 1.0), 50.0), ((3.0, 1.0), 66.7), ((1.0, 2.0), -100.0), ((0.0, 0.0), None), ((None, 1.0), None),
        ((1.0, 1.0025), -0.2), ((NAN, 1.0), None), ((1e-300, 1e300), None),
    ]
    got = column_values(
        spark, [c for c, _ in rates], "n double, e double", P.discount_rate(F.col("n"), F.col("e"))
    )
    assert got[:-1] == [w for _, w in rates[:-1]]
    assert got[-1] < -1e300  # no overflow on the way


def test_operational_confidence(spark):
    schema = (
        "provider_key string, access_kind string, verified boolean, stale_mild boolean, provider_count bigint,"
        " uptime_percent double, free_endpoint_status string, api_calls_30d bigint"
    )
    cases = [
        (("nvidia", "FREE", True, False, None, None, "deprecated", None), "NONE"),
        (("nvidia", "FREE", False, False, None, None, "available", 1), "HIGH"),
        (("nvidia", "ULTRA_LOW", False, False, None, None, "available", 0), "MEDIUM"),
        (("nvidia", "FREE", True, True, None, None, None, 5), "LOW"),
        (("nvidia", "DISCOUNTED", True, False, None, None, "deprecated", None), "HIGH"),
        (("openrouter", "FREE", True, False, 0, 99.0, None, None), "NONE"),
        (("openrouter", "DISCOUNTED", False, False, 0, 99.0, None, None), "MEDIUM"),
        (("openrouter", None, False, False, 0, None, None, None), "LOW"),
        (("openrouter", "FREE", False, False, 2, 99.0, None, None), "HIGH"),
        (("openrouter", "FREE", False, False, 2, None, None, None), "MEDIUM"),
        (("openrouter", "FREE", False, True, None, None, None, None), "MEDIUM"),
        (("openrouter", "FREE", None, None, None, NAN, None, None), "LOW"),
        (("groq", "FREE", True, False, 0, None, None, None), "HIGH"),
        (("groq", "FREE", False, True, 0, None, None, None), "MEDIUM"),
        ((None, None, None, None, None, None, None, None), "LOW"),
    ]
    names = [f.split()[0] for f in schema.split(", ")]
    got = column_values(
        spark, [c for c, _ in cases], schema, P.operational_confidence(*map(F.col, names))
    )
    assert got == [want for _, want in cases]
