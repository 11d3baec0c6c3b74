from pyspark.sql import functions as F

from offermill.functions import dates, prices, text as X


def check(spark, cases, schema, column):
    rows = [c if isinstance(c, tuple) else (c,) for c, _ in cases]
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]
    assert got == [want for _, want in cases]


def test_price_texts(spark):
    cases = [
        (1e-7, "$0.0000001"), (6.000000000000001e-7, "$0.0000006"), (0.0000010000000000000002, "$0.000001"),
        (3e-8, "$0.00000003"), (0.00000125, "$0.00000125"), (0.1, "$0.1"), (0.0, "$0"), (-0.0, "$0"),
        (None, "—"), (12.5, "$12.5"), (1234567.0, "$1234567"), (-3.25, "$-3.25"), (1e21, "$1" + "0" * 21),
        (123456789012345.0, "$123456789012000"), (1e-30, "$0." + "0" * 29 + "1"), (float("inf"), "$∞"),
        (float("nan"), "$NaN"), (99999999999.95, "$100000000000"),
    ]
    check(spark, cases, "x double", prices.format_price(F.col("x")))


def test_number_texts(spark):
    cases = [
        (7.0, "7"), (0.05, "0.05"), (1e-7, "1e-7"), (1.5e-9, "1.5e-9"), (1e7, "10000000"), (123456789.25, "123456789.25"),
        (0.0, "0"), (-0.0, "0"), (-2.5, "-2.5"), (1e21, "1e+21"), (0.0001, "0.0001"), (1e20, "1" + "0" * 20), (None, None),
    ]
    check(spark, cases, "x double", X.number_text(F.col("x")))


def test_dates(spark):
    cases = [
        ("2026-07-31T00:00:00.000Z", True), ("2026-07-31", True), ("2026-07-31T09:00:00+09:00", True), ("12:30", False),
        ("soon", False), ("", False), (None, False), ("2026-02-30", False),
    ]
    check(spark, cases, "x string", dates.valid_timestamp(F.col("x")))
    cases = [
        ("2026-07-31T20:00:00Z", "2026年8月1日"), ("2026-07-31T00:00:00Z", "2026年7月31日"), (None, "不明"), ("", "不明"),
        ("soon", "Invalid Date"),
    ]
    check(spark, cases, "x string", dates.format_date(F.col("x")))


def test_freshness_counts_calendar_days(spark):
    report = "2026-07-31T16:00:00Z"  # 1 August in Tokyo
    cases = [
        ("2026-07-31T15:30:00Z", "今日"), ("2026-07-31T14:59:00Z", "昨日"), ("2026-07-29T00:00:00Z", "3日前"),
        ("2026-08-09T00:00:00Z", "今日"), ("bad", "未検証"), (None, "未検証"),
    ]
    check(spark, cases, "x string", dates.freshness(F.col("x"), F.lit(report), "Asia/Tokyo"))


def test_citation(spark):
    url = "https://api.example.com:8443/v1/"
    cases = [
        (("see https://api.example.com:8443/v1/ now", url), True), (("api.example.com:8443/v1", url), True),
        (("host api.example.com:8443 only", url), True), (("api.example.com/v1", url), False),
        (("anything", ""), False), (("anything", None), False),
        (("on API.example", "https://API.EXAMPLE/v1"), False), (("on api.example", "https://API.EXAMPLE:443/v1"), True),
    ]
    check(spark, cases, "h string, u string", X.citation_supports(F.col("h"), F.col("u")))


def test_field_tests(spark):
    check(spark, [("https://a", True), ("ftp://a", False), (None, False)], "x string", X.is_http_url(F.col("x")))
    check(spark, [("a", True), (" 　", False), ("", False), (None, False)], "x string", X.is_non_blank(F.col("x")))
    check(
        spark, [("a_1", True), ("A", False), ("1a", False), ("a\n", False), (None, False)], "x string",
        X.is_identifier(F.col("x")),
    )


def test_stale_note(spark):
    cases = [
        (("x", "[stale] y"), "x"), ((None, "[stale]  y"), "y"), (("", "[other] y"), None), ((None, None), None),
    ]
    check(spark, cases, "c string, e string", X.stale_note(F.col("c"), F.col("e")))
