"""Matchers met by the words of texts, against a plain search."""

from pyspark.sql import functions as F

from offermill.operators import registry_join

MATCHERS = [
    "openai", "pen", "desk 5.", "desk 5", "k 5.", "#0005", "customer#", "r#000", "--!", "...", "api.x/v1", "ある無料", "x-y-z", "x y",
    "averyveryverylongword-1", "1-averyveryverylongword", "né", "née", "a.b", "(b)", " ai ", "ai ", " ai",
]
TEXTS = [
    "https://openai.example/v1 OpenAI desk 5.", "desk 55.", "old desk 5.x", "customer#00051", "xcustomer#0005", "a --! b", "wait...",
    "api.x/v1", "myapi.x/v12", "これは ある無料です", "x-y-zoo", "xx y", "averyveryverylongword-12", "01-averyveryverylongword",
    "veryveryverylongword-1", "fiancée née", "a.b", "aa.bb", "a(b)", "the ai lab", "ai", " ai", "", "opens",
]


def test_matchers_are_found_by_words(spark):
    entries = [(k, m.lower()) for k, m in enumerate(MATCHERS) if len(m) >= registry_join.STRETCH]
    matchers = spark.createDataFrame(entries, "idx int, matcher string")
    texts = spark.createDataFrame([(k, t.lower()) for k, t in enumerate(TEXTS)], "_id long, _texts string")
    got = {r._id: r.text_idx for r in registry_join._by_texts(texts, matchers).collect()}
    found = {k: [i for i, m in entries if m in t.lower()] for k, t in enumerate(TEXTS)}
    assert got == {k: hits[0] for k, hits in found.items() if hits}


def test_a_common_word_joins_no_matcher_with_every_text(spark):
    """Of names with a number the number is the key: as many candidates as texts, not texts times matchers."""
    numbers = spark.range(300).select("id", F.lpad(F.col("id").cast("string"), 9, "0").alias("number"))
    names = F.concat(F.lit("customer#"), "number")
    matchers = numbers.select(F.col("id").cast("int").alias("idx"), names.alias("matcher"))
    texts = numbers.select(F.col("id").alias("_id"), names.alias("_texts"))
    assert registry_join._by_word(texts, matchers).count() == 300
