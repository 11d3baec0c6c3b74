"""Personal data by fixed patterns and bootstrapped contexts, in DataFrame functions only.

Seeds are the matches of four fixed patterns. The word before a match is a lexical pattern. Looser
shapes give candidates that the fixed patterns miss. Patterns and values make a graph that is scored
in rounds: a pattern is as trusted as the share of its context's occurrences, in all texts, that is
followed by trusted values; a value that is no seed is trusted as far as its patterns are. Candidates
behind a pattern with enough different seeds and enough trust are new identifiers.

Texts are read twice: for the matches, and for how often each induced context occurs. Everything
between works on narrow staged tables. Counts are sums per key with map-side combining, so a context
or value that holds a third of all matches is no large group.

The fixed patterns are written so that matching never goes back over a run of characters: a guard
lets a match begin only where the leftmost one can, and repetitions keep what they took. They match
the same spans as the plain patterns.

Defined results: null and empty texts have no spans; repeated rows and null doc_ids come back once per
row; overlapping spans of different kinds all count, a new span never overlaps a seed; without enough
seeds nothing is added; empty input gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage

KINDS = ("email", "ip", "card", "phone")
MIN_SEEDS = 5
MIN_TRUST = 0.6
ROUNDS = 3
_LEFT = 48

_LOCAL = "A-Za-z0-9._%+-"
_HOST = "[A-Za-z0-9-]++"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@{_HOST}(?:\.{_HOST})++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+(?:\x20at\x20|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]{{1,63}}+"
    r"(?:(?:\.|\x20dot\x20|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"(?<![0-9+])[0-9(][\x20().0-9-]{6,18}[0-9](?![0-9])",
}
#: What a text must have for a pattern to be tried.
_NEEDS = {"email": "@", "phone": "+"}
_CONTEXT = r"\p{L}+[:=#]?"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the weighted digit sum of a digit string is divisible by ten."""
    size = F.length(digits)

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, size - place + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(place % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    digits = _digits(value)
    size = F.length(digits)
    return size.between(14, 19) & luhn(digits) if kind == "card" else size.between(10, 15)


def _plausible(kind: str, value: Column) -> Column:
    size = F.length(_digits(value))
    return {"card": size.between(12, 19), "phone": size.between(7, 15)}.get(kind, F.lit(True))


def located(text: Column, pattern: str, kind: int) -> Column:
    """The matches of a pattern, left to right: (start, kind, end, value), in code points.

    What stands between matches and the matches alternate, so their lengths give the places.
    """
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    span = "struct<start:int,kind:int,end:int,value:string>"
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def step(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["gap"])
        hit = pair["hit"]
        found = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(hit)).alias("end"), hit.alias("value"))
        return F.when(hit.isNull(), done).otherwise(
            F.struct(found["end"].alias("at"), F.array_append(done["spans"], found).alias("spans"))
        )

    return F.aggregate(pairs, empty, step)["spans"]


def _keeps(test, kind: str):
    return lambda s: test(kind, s["value"])


def _matches(text: Column, patterns: dict[str, str], test, needs: dict[str, str]) -> Column:
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    parts = []
    for number, kind in enumerate(KINDS):
        found = F.filter(located(text, patterns[kind], number), _keeps(test, kind))
        ready = text.contains(needs[kind]) if kind in needs else text.rlike("[0-9]")
        parts.append(F.when(ready, found).otherwise(none))
    return F.array_sort(F.concat(*parts))


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns by start, then kind: array of (start, kind number, end, value)."""
    return _matches(text, BASE, _valid, _NEEDS)


def loose_spans(text: Column) -> Column:
    """Spans of the looser shapes; a text without a written-out at sign has no loose addresses."""
    return _matches(text, LOOSE, _plausible, {"email": "at"})


def _with_context(spans: Column, text: Column, is_seed: bool) -> Column:
    """Spans with the word before them as `key`, and a value that does not depend on spelling."""

    def add(s: Column) -> Column:
        begin = F.greatest(s["start"] - _LEFT, F.lit(0))
        left = F.substring(text, begin + 1, s["start"] - begin)
        key = F.regexp_extract(F.lower(left), rf"({_CONTEXT})[\s\"'(<]*$", 1)
        value = F.lower(F.regexp_replace(s["value"], r"[\s().-]", ""))
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), value.alias("value"), key.alias("key"), F.lit(is_seed).alias("seed"))

    return F.transform(spans, add)


def _trusted_patterns(found: DataFrame, texts: DataFrame, min_seeds: int, min_trust: float, rounds: int) -> DataFrame:
    """(kind, key) of the patterns that may name new identifiers."""
    edges = found.filter("key <> ''").groupBy("kind", "key", "value").agg(F.max("seed").alias("seed"), F.count("*").alias("n"))
    edges = stage(edges, "pii-edges")
    induced = edges.groupBy("kind", "key").agg(F.sum(F.col("seed").cast("long")).alias("seeds"))
    induced = stage(induced.filter(F.col("seeds") >= min_seeds), "pii-patterns")
    words = texts.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"({_CONTEXT})"), F.lit(1))).alias("key"))
    counts = words.join(induced.select("key").distinct(), "key").groupBy("key").agg(F.count("*").alias("occurrences"))
    graph = edges.join(induced.select("kind", "key"), ["kind", "key"]).join(counts, "key")
    graph = stage(graph, "pii-graph")
    trust = None
    for number in range(rounds):
        if trust is None:
            values = graph.select("kind", "key", "value", "n", "occurrences", F.col("seed").cast("double").alias("score"))
        else:
            # A value is wrong only if all its patterns are.
            doubt = F.sum(F.log(F.greatest(1 - F.col("trust"), F.lit(1e-9))))
            belief = graph.join(trust, ["kind", "key"]).groupBy("kind", "value").agg((1 - F.exp(doubt)).alias("belief"))
            score = F.when(F.col("seed"), 1.0).otherwise(F.col("belief"))
            values = graph.join(belief, ["kind", "value"]).withColumn("score", score)
        share = F.sum(F.col("n") * F.col("score")) / F.max("occurrences")
        trust = stage(values.groupBy("kind", "key").agg(F.least(share, F.lit(1.0)).alias("trust")), f"pii-trust-{number}")
    return trust.filter(F.col("trust") >= min_trust).select("kind", "key")


def find(docs: DataFrame, min_seeds: int = MIN_SEEDS, min_trust: float = MIN_TRUST, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of `docs`: doc_id, base and added: arrays of (start, kind number, end), sorted."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    both = texts.select("doc_id", "text", base_spans(text).alias("base"), loose_spans(text).alias("loose"))
    free = F.filter("loose", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    rows = both.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.concat(_with_context(F.col("base"), text, True), _with_context(free, text, False)).alias("found"),
    )
    rows = stage(rows, "pii-rows")
    found = rows.select("row", F.explode("found").alias("s")).select("row", "s.*")
    patterns = _trusted_patterns(found, texts, min_seeds, min_trust, rounds)
    added = found.filter("NOT seed").join(patterns, ["kind", "key"], "left_semi")
    added = added.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("added"))
    seeds = F.transform(F.filter("found", lambda s: s["seed"]), lambda s: F.struct(s["start"], s["kind"], s["end"]))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return rows.join(added, "row", "left").select("doc_id", seeds.alias("base"), F.coalesce("added", none).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def counted(spans: Column) -> list[Column]:
    """The number of spans of each kind, as n_<kind>."""

    def of(number: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")

    return [of(number).alias(f"n_{kind}") for number, kind in enumerate(KINDS)]
