"""Publication: every check first, then new versions beside the live ones, then one manifest.

Executors write a publication into version folders of its own; nothing is moved. A commit is a small
manifest that names what it makes live, and no commit rewrites what another one said: of all complete
manifests, the one of the highest number counts for each name. Numbers are taken by creating a file that
must not exist yet, so two commits at once get different numbers, and both stay. If the driver is lost
before its manifest is complete, readers see the old state; afterwards they see the new one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.gates import contradiction_violations, excluded_offers, fix_log
from ..operators.rollups import report_summary
from ..session import dropping_shuffles, stage, unstage
from .files import Folders

SLICE_ROWS = 2_000_000  # offers that are joined, dealt by run and written at once
MAX_SLICES = 16  # each reads the offers anew
SAMPLED = 64  # one offer in so many tells how large the runs are
RUN_TABLES = ("offers", "excluded_offers", "fix_log", "report_summary")
_MANIFEST = "name string, version string, number long"
_VERSION = T.StructType([T.StructField("version", T.StringType())]).fields


class PublicationRefused(ValueError):
    """A check failed; the live tables are as they were."""


def refuse_if_any(violations: DataFrame, what: str, column: str = "message") -> None:
    """Stop with the first messages when there is any violation row."""
    found = violations.select(column).limit(20).collect()
    if found:
        more = f" and more, {violations.count()} in all" if len(found) == 20 else ""
        raise PublicationRefused(f"{what}: " + "; ".join(str(r[0]) for r in found) + more)


def _evened(df: DataFrame) -> DataFrame:
    """Rebalancing evens out the files: small runs share a task, a huge run is split over many."""
    return df.hint("rebalance", "run_id")


def _by_run(df: DataFrame, path: str, *more: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).partitionBy("run_id", *more).parquet(path)


def _slices(gated: DataFrame) -> list[DataFrame]:
    """All rows of `gated` in parts, to be written one after the other: only one part's shuffle files lie on disk at once.

    Shuffled rows take several times the bytes they take as Parquet. Sizes of runs, from a share of the offers, decide
    on the parts only: large runs are dealt over all of them, small ones lie in one part, so that their files stay few.
    """
    by_offer = F.xxhash64(F.lit("slice"), "offer_id")
    run = F.coalesce("run_id", F.lit(""))
    share = gated.filter(F.pmod(by_offer, F.lit(SAMPLED)) == 0)
    sizes = stage(share.groupBy(run.alias("run")).agg((F.count("*") * SAMPLED).alias("rows")), "run-sizes")
    total = sizes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    parts = min(MAX_SLICES, -(-total // SLICE_ROWS))
    if parts > 1:
        large = [row.run for row in sizes.filter(F.col("rows") > total // (2 * parts)).select("run").collect()]
    unstage(sizes)
    if parts <= 1:
        return [gated]
    part = F.pmod(F.when(run.isin(large), by_offer).otherwise(F.xxhash64("run_id")), F.lit(parts))
    return [gated.filter(part == number) for number in range(parts)]


def _place(root: str) -> str:
    return f"{root.rstrip('/')}/_manifest"


def _complete(folders: Folders, place: str) -> list[str]:
    return [n for n in folders.names(place) if n.isdigit() and folders.exists(f"{place}/{n}/_SUCCESS")]


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(name, version) of what is live: a run's id, or a table's name."""
    folders, place = Folders(spark, root), _place(root)
    whole = _complete(folders, place)
    if not whole:
        return spark.createDataFrame([], _MANIFEST).select("name", "version")
    said = spark.read.schema(_MANIFEST).parquet(*(f"{place}/{n}" for n in whole))
    return said.groupBy("name").agg(F.max_by("version", "number").alias("version"))


def take_number(spark: SparkSession, root: str) -> int:
    """A manifest number that no other commit has, above all numbers taken so far."""
    folders, place = Folders(spark, root), _place(root)
    taken = [int(n) for n in (*folders.names(place), *folders.names(f"{place}/_taken")) if n.isdigit()]
    number = max(taken, default=0) + 1
    while not folders.create(f"{place}/_taken/{number:012d}"):
        number += 1
    return number


def commit(spark: SparkSession, root: str, names: DataFrame, version: str) -> None:
    """Make `version` the live one for all `names` (column name); other names keep theirs."""
    number = take_number(spark, root)
    said = names.select("name").distinct().select("name", F.lit(version).alias("version"), F.lit(number).cast("long").alias("number"))
    said.coalesce(1).write.parquet(f"{_place(root)}/{number:012d}")


def fold_manifests(spark: SparkSession, root: str) -> int:
    """Write what the complete manifests say as one, and drop those; returns how many were folded.

    Every name keeps the number it was said with, so a commit that is still under way loses nothing, and wins
    if its number is higher. The folded manifest is complete before the first old one goes.
    """
    folders, place = Folders(spark, root), _place(root)
    whole = _complete(folders, place)
    if len(whole) < 2:
        return 0
    said = spark.read.schema(_MANIFEST).parquet(*(f"{place}/{n}" for n in whole))
    latest = said.groupBy("name").agg(F.max_by("version", "number").alias("version"), F.max("number").alias("number"))
    latest.coalesce(1).write.parquet(f"{place}/{take_number(spark, root):012d}")
    for n in whole:
        folders.remove(f"{place}/{n}")
    return len(whole)


def live_runs(spark: SparkSession, root: str, table: str, schema) -> DataFrame:
    """The live rows of a run table; versions that the manifest does not name are pruned."""
    kinds = [field for field in schema.fields if field.name != "version"]
    whole = spark.read.schema(type(schema)([*kinds, *_VERSION])).parquet(f"{root.rstrip('/')}/{table}")
    live = manifest(spark, root).withColumnRenamed("name", "run_id")
    return whole.join(live, ["run_id", "version"], "left_semi").drop("version")


def write_fix_log(log: DataFrame, root: str, version: str, evened: bool = False) -> None:
    """Write the log as a version; `evened` tells that its rows come from a table that is dealt by run already."""
    _by_run(log if evened else _evened(log), f"{root.rstrip('/')}/fix_log/version={version}")


def publish_report(
    gated: DataFrame,
    runs: DataFrame,
    root: str,
    contradictions: DataFrame | None = None,
    missing_sections: DataFrame | None = None,
    excluded: DataFrame | None = None,
) -> None:
    """Write the result of `apply_gates` for all its runs below `root`.

    Exclusions are those of the gates and those that the reports came with, told
    apart by `origin`: their number is the one in the summary.

    The gated offers are written once, partitioned by run and by `removed`; many are
    computed and written in parts, each of which reads what `gated` reads, so an `offer_id`
    must not change between reads. Exclusions, log and summary are narrow reads of that table, whose files are
    even by run, so exclusions and log are written as they are read. Only
    when all tables are complete does a manifest name their version for all `runs`.
    Other runs keep theirs.
    """
    if missing_sections is not None:
        refuse_if_any(missing_sections, "required sections are missing", "section")
    if contradictions is not None:
        refuse_if_any(contradiction_violations(contradictions), "contradictions")

    spark, version = gated.sparkSession, uuid.uuid4().hex

    def place(table: str) -> str:
        return f"{root.rstrip('/')}/{table}/version={version}"

    with dropping_shuffles(spark):
        for part in _slices(gated):
            _by_run(_evened(part), place("offers"), "removed", mode="append")
        written = spark.read.schema(gated.schema).parquet(place("offers"))
        exclusions = excluded_offers(written).withColumn("origin", F.lit("gate"))
        if excluded is not None:
            earlier = excluded.select("run_id", "name", "reason").withColumn("origin", F.lit("report"))
            exclusions = exclusions.unionByName(_evened(earlier), allowMissingColumns=True)
        _by_run(exclusions, place("excluded_offers"))
        write_fix_log(fix_log(written), root, version, evened=True)
        _by_run(_evened(report_summary(written, runs, excluded)), place("report_summary"))
    commit(spark, root, runs.select(F.col("run_id").alias("name")), version)


def promote(spark: SparkSession, staging: str, live: str, tables: Sequence[str]) -> None:
    """Make complete staged tables the live ones, all of them or none; the staging folder stays their place."""
    folders = Folders(spark, staging)
    missing = [t for t in tables if not folders.exists(f"{staging}/{t}/_SUCCESS")]
    if missing:
        raise PublicationRefused(f"not staged or incomplete: {', '.join(missing)}")
    commit(spark, live, spark.createDataFrame([(t,) for t in tables], "name string"), staging)


def live_table(spark: SparkSession, live: str, table: str) -> DataFrame:
    """A promoted table at its live place."""
    found = manifest(spark, live).filter(F.col("name") == table).first()
    if found is None:
        raise PublicationRefused(f"not published: {table}")
    return spark.read.parquet(f"{found.version}/{table}")


def checked_report(spark: SparkSession, root: str, schema) -> DataFrame:
    """The live offers of all runs; removed ones are skipped by partition."""
    return live_runs(spark, root, "offers", schema).filter(~F.col("removed"))
