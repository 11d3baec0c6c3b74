import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) rows, with columns whose names operators use inside."""

    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        extra = {n: F.lit("x") for n in ("fp", "digest", "score", "found", "row", "key", "_row", "_id", "label", "terms", "lang", "source")}
        return df.withColumns(extra).withColumn("n_chars", F.length("text").cast("long"))

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, one long text, ties and repeated rows."""
    long_text = " ".join(f"word{k % 997}" for k in range(60_000))
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "Hello  wide world"), (4, "Hello  wide world"), (5, "Hello wide world"),
        (6, "short"), (None, "Hello wide\nworld"), (7, long_text), (8, "Éa ñ 漢字 İΣ ς <|endoftext|> it's  12345 ...'re"),
        (9, "mail a.b@c.example.org or 10.0.0.255, not 10.0.0.256; +1 (222) 333-4444, 4111 1111 1111 1111"), (6, "other text"),
    ]
