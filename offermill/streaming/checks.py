"""The gates on a stream of reports.

Policy columns and gates look at one row only, so they run unchanged on a
streaming DataFrame, without state. Ranking and roll-ups need whole runs and stay
batch jobs over the written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.policy import DEFAULT, Policy
from ..operators.gates import OfferContract, apply_gates
from ..sources.registry import Registry
from ..sources.reports import document_schema, name_runs, offers_of


def read_offer_stream(spark: SparkSession, path: str) -> DataFrame:
    """Offers of the reports that arrive below `path`, one report per line."""
    docs = spark.readStream.schema(document_schema()).option("mode", "FAILFAST").json(path)
    return offers_of(name_runs(docs))


def gate_stream(
    offers: DataFrame,
    registry: Registry,
    contract: OfferContract = OfferContract(),
    policy: Policy = DEFAULT,
) -> DataFrame:
    return apply_gates(offers, registry, None, contract, policy)


def write_gated_stream(gated: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a table by run; each file is taken over exactly once."""
    return (
        gated.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("run_id", "removed")
        .trigger(availableNow=True)
        .start()
    )
