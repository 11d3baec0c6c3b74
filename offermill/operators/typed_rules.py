"""Typed rules of a report's entries: types, ranges, lengths, nested fields and items.

Rules look at an entry as it stands in the report, before it becomes columns: there a field of a wrong type
would be null, and an entry that is no object would be an offer without values. Each entry is parsed once to a
VARIANT; all rules are one projection over it, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

TYPES = ("object", "array", "string", "number", "integer", "boolean", "null")


@dataclass(frozen=True)
class Rule:
    """What the field at `path` (names joined by dots) must be; None or empty: any.

    A field is absent when it or one above it is missing: that breaks `required` only, and only if the one above
    is an object. Bounds hold for numbers, lengths (in characters) for texts, `least_items` and `items` for arrays. An
    integer is a number without a fraction, whatever its form.
    """

    path: str
    types: tuple[str, ...] = ()
    required: bool = False
    minimum: float | None = None
    maximum: float | None = None
    least_length: int | None = None
    least_items: int | None = None
    items: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        names = self.path.split(".")
        if not all(name.replace("_", "a").isalnum() for name in names):
            raise ValueError(f"not a path of names: {self.path!r}")
        if unknown := set(self.types + self.items) - set(TYPES):
            raise ValueError(f"unknown types: {sorted(unknown)}")


def _kind(value: Column) -> Column:
    """The JSON type of a VARIANT; null when there is none."""
    shape = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    number = F.try_variant_get(value, "$", "double")
    names = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null"}
    found = F.when(value.isNull(), F.lit(None).cast("string"))
    for spark_name, name in names.items():
        found = found.when(shape == spark_name, name)
    return found.when((shape == "BIGINT") | (number == F.floor(number)), "integer").otherwise("number")


def _is_one(kind: Column, types: tuple[str, ...]) -> Column:
    allowed = [*types, "integer"] if "number" in types else types
    return kind.isin(*allowed)


def _expected(types: tuple[str, ...]) -> str:
    return "must be " + ",".join(types)


def _broken(entry: Column, at: Column, rule: Rule) -> list[Column]:
    """Messages of one rule: texts, null where it holds."""
    above, _, name = rule.path.rpartition(".")
    field = F.try_variant_get(entry, f"$.{rule.path}", "variant")
    holder = F.try_variant_get(entry, f"$.{above}", "variant") if above else entry
    place = F.concat(at, F.lit("/" + rule.path.replace(".", "/")))
    kind = _kind(field)

    def said(condition: Column, message: str, where: Column = place) -> Column:
        return F.when(condition, F.concat(where, F.lit(f": {message}")))

    found = []
    if rule.required:
        missing = (_kind(holder) == "object") & field.isNull()
        where = F.concat(at, F.lit("/" + above.replace(".", "/"))) if above else at
        found.append(said(missing, f"must have required property '{name}'", where))
    if rule.types:
        found.append(said(~_is_one(kind, rule.types), _expected(rule.types)))
    number = F.when(kind.isin("integer", "number"), F.try_variant_get(field, "$", "double"))
    if rule.minimum is not None:
        found.append(said(number < rule.minimum, f"must be >= {rule.minimum:g}"))
    if rule.maximum is not None:
        found.append(said(number > rule.maximum, f"must be <= {rule.maximum:g}"))
    if rule.least_length is not None:
        text = F.when(kind == "string", F.try_variant_get(field, "$", "string"))
        found.append(said(F.length(text) < rule.least_length, f"must NOT have fewer than {rule.least_length} characters"))
    if rule.least_items is not None or rule.items:
        items = F.when(kind == "array", F.try_variant_get(field, "$", "array<variant>"))
        if rule.least_items is not None:
            found.append(said(F.size(items) < rule.least_items, f"must NOT have fewer than {rule.least_items} items"))
        if rule.items:
            message = _expected(rule.items)
            places = F.transform(items, lambda item, i: F.when(
                ~_is_one(_kind(item), rule.items), F.concat(place, F.lit("/"), i.cast("string"), F.lit(f": {message}"))))
            found.append(F.array_join(places, "; "))
    return found


def typed_errors(rules: tuple[Rule, ...], entry: str = "_entry") -> Column:
    """All messages of an entry, in the order of the rules, empty when it is sound; needs `section` and `pos`."""
    at = F.concat(F.lit("/"), F.col("section"), F.lit("/"), F.col("pos").cast("string"))
    value = F.col(entry)
    none = F.array().cast("array<string>")
    messages = [message for rule in rules for message in _broken(value, at, rule)]
    sound = F.filter(F.array(*messages), lambda m: m.isNotNull() & (m != "")) if messages else none
    is_object = F.coalesce(_kind(value) == "object", F.lit(False))
    return F.when(is_object, sound).otherwise(F.array(F.concat(at, F.lit(": must be object"))))


def typed_violations(entries: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One row per entry that breaks a rule: run_id, section, pos, detail (messages joined).

    `entries` has run_id, section, pos and the entry's JSON text `raw` (`sources.reports.raw_offers_of`). Entries that
    are null, no JSON or no object break the rules in any case.
    """
    # One-element explodes bind what they hold: the filter below would else parse and test every entry anew.
    parsed = entries.select("run_id", "section", "pos", F.explode(F.array(F.try_parse_json("raw"))).alias("_entry"))
    detail = F.explode(F.array(F.array_join(typed_errors(rules), "; "))).alias("detail")
    return parsed.select("run_id", "section", "pos", detail).filter("detail <> ''")
