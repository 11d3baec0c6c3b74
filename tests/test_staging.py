"""Staged tables."""

import pyarrow as pa
from pyspark.sql import functions as F

from offermill import session

BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def _batches(df):
    """Bytes and rows of each batch that Python gets."""

    def run(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["bytes", "rows"])

    return df.mapInArrow(run, "bytes long, rows long")


def test_rows_go_to_python_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(session, "BATCH_BYTES", 1 << 20)
    texts = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("word "), 200).alias("text"))
    seen = _batches(texts)
    staged = session.stage(seen, "batches")
    assert staged.agg(F.max("bytes")).first()[0] < 2 << 20
    assert staged.agg(F.sum("rows")).first()[0] == 6000
    assert seen.count() == 1  # the session's own setting is back


def test_the_sessions_own_batch_size_counts(spark):
    spark.conf.set(BYTES, "512k")
    try:
        texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("word "), 200).alias("text"))
        staged = session.stage(_batches(texts), "batches")
        assert staged.agg(F.max("bytes")).first()[0] < 1 << 20
        assert spark.conf.get(BYTES) == "512k"
    finally:
        spark.conf.unset(BYTES)
