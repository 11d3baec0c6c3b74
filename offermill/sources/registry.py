"""Provider registry: an ordered table of official endpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from .. import fixed_values as fv, schemas

Registry = DataFrame | Sequence[Row]
INDEXED = T.StructType([T.StructField("idx", T.IntegerType()), *schemas.REGISTRY_ENTRY.fields])


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a registry document with their place `idx`; none when the list is missing."""
    document = T.StructType([T.StructField("providers", T.ArrayType(schemas.REGISTRY_ENTRY))])
    docs = spark.read.schema(document).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return docs.select(F.posexplode("providers").alias("idx", "entry")).select("idx", "entry.*")


_EntryRow = Row(*INDEXED.names)


def default_entries() -> list[Row]:
    """The built-in registry as rows, usable wherever a registry is asked for."""
    return [
        _EntryRow(i, *[list(v) if isinstance(v, tuple) else v for v in entry])
        for i, entry in enumerate(fv.REGISTRY)
    ]


def entries(registry: Registry, limit: int) -> list[Row] | None:
    """The registry on the driver, in match order, to build match expressions from; None beyond `limit` entries."""
    if isinstance(registry, DataFrame):
        registry = registry.select(*INDEXED.names).orderBy("idx").limit(limit + 1).collect()
    return list(registry) if len(registry) <= limit else None
