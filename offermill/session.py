"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20  # of rows that go to Python at once while a table is staged
SENT_BYTES = 1 << 20  # of a table, by its files, that is broadcast where tables are of short numbers
_places: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def build_session(app: str = "offermill", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's checkpoint folder.

    Staged tables must outlive a lost executor, so on a cluster they go to the
    shared folder the session names. Only a local session may fall back to a
    temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="offermill-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/offermill/{label}-{uuid.uuid4().hex}"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def dropping_shuffles(spark: SparkSession):
    """Within it, queries that are made and run drop their shuffle files when they end; each table is to be run once.

    Every map task leaves three files for a shuffle, however few its rows, until the driver happens to collect its
    garbage: with hundreds of partitions that is more than the rows of many small queries.
    """
    return _settings(spark, {_DROP_SHUFFLES: "true"})


def small_broadcasts(spark: SparkSession):
    """Within it, queries that are made and run broadcast tables of SENT_BYTES at most, or of the session's own limit if less.

    Spark goes by the bytes of files. A table of short numbers takes more than ten times as much on the driver.
    """
    own = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return _settings(spark, {_BROADCAST: str(min(own, SENT_BYTES))})


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back: cuts lineage, fixes values, gives sizes.

    The shuffle files of the write are dropped when it is done, as nothing reads them again; else they stay
    until the driver happens to collect its garbage. Rows go to Python in small batches, unless the session has a
    size of its own, as both sides hold a batch as a whole. The session keeps its settings.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    batch = spark.conf.get(_BATCH_BYTES, None) or str(BATCH_BYTES)
    with _settings(spark, {_DROP_SHUFFLES: "true", _BATCH_BYTES: batch}):
        df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    _places[staged] = path
    return staged


def unstage(*tables: DataFrame) -> None:
    """Remove staged tables, as `stage` gave them, that nothing reads any more."""
    for table in tables:
        path = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(_places.pop(table))
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
