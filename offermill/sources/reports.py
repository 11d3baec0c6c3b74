"""Report scan: nested JSON reports to offer, run and side tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import fixed_values as fv, schemas
from ..functions.policy import holds

UPDATE_SECTIONS = ("product_updates", "startup_credits")
PAYLOAD_SECTIONS = ("new_models", "changes", "sources")

# An offer's id holds its section (2 bits), the part of the report, and the place in the
# section of that part.
PART_BITS = 35
POS_BITS = 26

# Arrays stay raw text at first: a section that is no array then fails the scan,
# while a wrong type inside one offer only blanks that field.
_DOCUMENT = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("part", T.LongType()),
        T.StructField("generated_at", T.StringType()),
        T.StructField("timezone", T.StringType()),
    ]
    + [
        T.StructField(name, T.ArrayType(T.StringType()))
        for name in (
            *fv.OFFER_SECTIONS, "excluded_offers", "contradictions", *UPDATE_SECTIONS, *PAYLOAD_SECTIONS
        )
    ]
)
_EXCLUDED = T.StructType([T.StructField("name", T.StringType()), T.StructField("reason", T.StringType())])


@dataclass(frozen=True)
class Reports:
    """Tables of all scanned reports, keyed by `run_id`."""

    runs: DataFrame
    offers: DataFrame
    excluded: DataFrame
    contradictions: DataFrame
    updates: DataFrame
    payloads: DataFrame
    missing_sections: DataFrame


def _signed_zero(offer: Column, raw: Column, field: str, side: str) -> Column:
    """JSON reads `-0` as an integer and drops its sign; put it back."""
    value = offer[field][side]
    minus_zero = raw.rlike(rf'"{field}"\s*:\s*\{{[^{{}}]*"{side}"\s*:\s*-0(\.0*)?\s*[,}}]')
    return F.when(holds(value == 0) & minus_zero, F.lit(-0.0)).otherwise(value).alias(side)


def parse_offers(rows: DataFrame) -> DataFrame:
    """Turn the JSON text in `raw` into offer columns; fields of a wrong type become null."""
    parsed = rows.withColumn("offer", F.from_json("raw", schemas.OFFER_FIELDS))
    offer, raw = F.col("offer"), F.col("raw")
    columns = []
    for name in schemas.OFFER_FIELDS.names:
        value = offer[name]
        if name in ("effective_price_per_million", "normal_price_per_million"):
            sides = F.struct(*[_signed_zero(offer, raw, name, side) for side in ("input", "output")])
            value = F.when(value.isNotNull(), sides)
        columns.append(value.alias(name))
    return parsed.select(*schemas.OFFER_PLACE.names, *columns)


def document_schema() -> T.StructType:
    return _DOCUMENT


def name_runs(docs: DataFrame) -> DataFrame:
    """A report without `run_id` is named by its file."""
    file_name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.json)?$", 1)
    return docs.withColumns(
        {"run_id": F.coalesce("run_id", file_name), "part": F.coalesce("part", F.lit(0))}
    )


def read_documents(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Raw documents, one row each. Broken JSON or a missing path fails the job.

    A run too large for one document may come as several, numbered by `part`;
    with one document per line, files are split over tasks.
    """
    reader = spark.read.schema(_DOCUMENT).option("mode", "FAILFAST")
    return name_runs(reader.option("multiLine", str(not one_per_line).lower()).json(path))


def _explode(docs: DataFrame, section: str) -> DataFrame:
    return docs.select("run_id", "part", F.posexplode(section).alias("pos", "raw"))


def place_of(part: Column, pos: Column) -> Column:
    """Part and place in one number that rises with both. Numbers out of range fail the scan: ids never collide."""
    sound = part.between(0, (1 << PART_BITS) - 1) & (pos < (1 << POS_BITS))
    place = F.shiftleft(part, POS_BITS).bitwiseOR(pos.cast("long"))
    message = F.concat(F.lit("part or place out of range: "), part.cast("string"), F.lit(", "), pos.cast("string"))
    return F.when(sound, place).otherwise(F.raise_error(message).cast("long"))


def part_of(place: Column) -> Column:
    return F.shiftright(place, POS_BITS)


def raw_offers_of(docs: DataFrame) -> DataFrame:
    """Entries of all offer sections with their place and JSON text `raw`, entries that are no objects included."""
    # One explode over a tagged array keeps it to a single pass over the text.
    def tagged(index: int, section: str) -> Column:
        return F.transform(
            F.coalesce(F.col(section), F.array().cast("array<string>")),
            lambda raw, i: F.struct(
                F.lit(section).alias("section"), F.lit(index).alias("index"), i.alias("pos"), raw.alias("raw")
            ),
        )

    sections = [tagged(i, name) for i, name in enumerate(fv.OFFER_SECTIONS)]
    rows = docs.select("run_id", "part", F.explode(F.concat(*sections)).alias("o"))
    place = place_of(F.col("part"), F.col("o.pos"))
    return rows.select(
        "run_id",
        F.col("o.section").alias("section"),
        place.alias("pos"),
        F.shiftleft(F.col("o.index").cast("long"), PART_BITS + POS_BITS).bitwiseOR(place).alias("offer_id"),
        F.col("o.raw").alias("raw"),
    )


def offers_of(docs: DataFrame) -> DataFrame:
    return parse_offers(raw_offers_of(docs))


def missing_sections_of(docs: DataFrame) -> DataFrame:
    """Required sections a document lacks; any row here aborts the run."""
    absent = [F.when(F.col(name).isNull(), name) for name in fv.REQUIRED_SECTIONS]
    rows = docs.select("run_id", "part", F.explode(F.array_compact(F.array(*absent))).alias("section"))
    return rows.select("run_id", "part", "section", F.lit("must be an array").alias("message"))


def read_reports(spark: SparkSession, path: str, one_per_line: bool = False) -> Reports:
    """Scan reports below `path` into tables; nothing is read until they are used."""
    docs = read_documents(spark, path, one_per_line)

    def structs(section: str, kind: T.StructType) -> DataFrame:
        rows = _explode(docs, section).withColumn("row", F.from_json("raw", kind))
        return rows.select("run_id", "part", "pos", "row.*")

    updates = reduce(
        DataFrame.unionByName,
        [structs(name, schemas.UPDATE).withColumn("section", F.lit(name)) for name in UPDATE_SECTIONS],
    )
    payloads = reduce(
        DataFrame.unionByName,
        [_explode(docs, name).withColumn("section", F.lit(name)) for name in PAYLOAD_SECTIONS],
    )
    runs = docs.groupBy("run_id").agg(
        F.max("generated_at").alias("generated_at"),
        F.coalesce(F.max("timezone"), F.lit(fv.DEFAULT_TIME_ZONE)).alias("timezone"),
    )
    return Reports(
        runs=runs,
        offers=offers_of(docs),
        excluded=structs("excluded_offers", _EXCLUDED),
        contradictions=structs("contradictions", schemas.CONTRADICTION),
        updates=updates,
        payloads=payloads,
        missing_sections=missing_sections_of(docs),
    )
