"""Offers against a registry of any size, by joins in place of one branch for each entry.

Distinct (URL, texts) are matched once. A pattern that names a whole host meets the URLs of that host by an
equality join and is then tested. A matcher meets texts by the rarest of its words: a word (letters and digits) with
other characters on both sides is a whole word of the text, with those on one side the begin or the end of one, and
alone it lies within one, by its rarest stretch of three letters. The words of all texts are a dictionary that meets the
matchers first; of each text only the numbers of its words travel, and what meets is searched in the whole text.
Matchers without words meet the texts by stretches. What no key can carry is tested in order, as the small registry is:
patterns of other forms, and matchers of fewer than three letters; their number, not that of the registry, is what
the driver holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import stage
from .skew import join_counted, join_split

STRETCH = 3
EDGE = 16  # letters of a word's begin or end that a key holds
IDLE = 1000  # most frequent words without matchers that are left out early
_WORD = r"[\p{L}\p{N}]+"
_ATOM = r"(?:[A-Za-z0-9_/.-]|\\[^A-Za-z0-9])"
_GROUP = rf"\((?:{_ATOM}|\|)*\)"
#: A host, then its end or a path. Patterns of this form always compile.
KEYED = rf"^\^https\??://((?:[A-Za-z0-9-]|\\\.)+)(?:\$|/\?\$|/(?:(?:{_ATOM}|{_GROUP})[?*+]?)*\$?)$"


def spread(df: DataFrame) -> Column:
    """Deals rows, equal ones too, alike in every run of a task."""
    plain = [F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    return F.xxhash64(F.spark_partition_id(), *plain)


def _to_the_end(pattern: Column) -> Column:
    """`$` ends the text, never before a last line break."""
    closed = pattern.endswith("$") & ~pattern.endswith("\\$")
    return F.when(closed, F.concat(pattern.substr(F.lit(1), F.length(pattern) - 1), F.lit(r"\z"))).otherwise(pattern)


def _stretches(text: Column) -> Column:
    last = F.length(text) - STRETCH + 1
    places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda k: F.substring(text, k, F.lit(STRETCH))))


def _by_host(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """_id, url_idx: the first entry whose pattern names the URL's host and fits."""
    host = F.regexp_replace(F.regexp_extract("pattern", KEYED, 1), r"\\\.", ".")
    first = patterns.filter(F.col("pattern").rlike(KEYED)).groupBy("pattern").agg(F.min("idx").alias("idx"))
    keyed = first.select("idx", _to_the_end(F.col("pattern")).alias("pattern"), host.alias("_host"))
    urls = texts.select("_id", "_url", F.regexp_extract("_url", r"^https?://([^/]*)", 1).alias("_host")).filter("_host <> ''")
    met = join_split(urls, keyed, "_host", F.col("_id")).filter(F.rlike(F.col("_url"), F.col("pattern")))
    return met.groupBy("_id").agg(F.min("idx").alias("url_idx"))


def _rarest(listed: DataFrame) -> DataFrame:
    """(matcher, idx, _part) of the part that fewest matchers have, from one row for each part."""
    uses = listed.groupBy("_part").agg(F.count("*").alias("n"))
    least = listed.join(uses, "_part").groupBy("matcher").agg(F.min("idx").alias("idx"), F.min(F.struct("n", "_part")).alias("least"))
    return least.select("matcher", "idx", F.col("least._part").alias("_part"))


def _word_parts(matcher: Column) -> Column:
    """What a text must have that holds the matcher: `=` words, `<` begins, `>` ends, `~` stretches of words."""
    pieces = F.regexp_extract_all(matcher, F.lit(f"({_WORD}|[^\\p{{L}}\\p{{N}}]+)"), F.lit(0))

    def parts(piece: Column, i: Column) -> Column:
        before, behind = i > 0, i < F.size(pieces) - 1
        short = F.when(before, F.concat(F.lit("<"), F.substring(piece, 1, EDGE))).otherwise(F.concat(F.lit(">"), _tail(piece)))
        found = F.when(before & behind, F.array(F.concat(F.lit("="), piece))).when(before | behind, F.array(short))
        found = found.otherwise(F.transform(_stretches(piece), lambda s: F.concat(F.lit("~"), s)))
        return F.when(piece.rlike(f"^{_WORD}$"), found).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.transform(pieces, parts)))


def _tail(text: Column) -> Column:
    n = F.least(F.length(text), F.lit(EDGE))
    return text.substr(F.length(text) - n + 1, n)


def _parts_of_word(word: Column, kinds: list[tuple[str, int]]) -> Column:
    """The parts of a text's word, of the kinds and lengths that matchers have."""
    found = []
    for kind, n in kinds:
        own = word if kind == "=" else F.substring(word, 1, n) if kind == "<" else word.substr(F.length(word) - n + 1, F.lit(n))
        if kind != "~":
            fits = F.lit(True) if kind == "=" else F.length(word) >= n
            found.append(F.when(fits, F.array(F.concat(F.lit(kind), own))).otherwise(F.array().cast("array<string>")))
    if any(kind == "~" for kind, _ in kinds):
        found.append(F.transform(_stretches(word), lambda s: F.concat(F.lit("~"), s)))
    return F.concat(*found)


def _by_word(texts: DataFrame, matchers: DataFrame) -> DataFrame:
    """(_id, matcher, idx) of the texts and the matchers that have words and may lie in them."""
    listed = matchers.select("idx", "matcher", F.explode(_word_parts(F.col("matcher"))).alias("_part"))
    keyed = stage(_rarest(listed), "registry-parts")
    kind, length = F.substring("_part", 1, 1), F.length("_part") - 1
    length = F.when(kind.isin("<", ">"), length).otherwise(0)
    kinds = [tuple(r) for r in keyed.select(kind, length).distinct().collect()]  # 34 at most
    placed = texts.select("_id", F.explode(F.array_distinct(F.regexp_extract_all("_texts", F.lit(f"({_WORD})"), F.lit(0)))).alias("_word"))
    if not kinds:
        return placed.select("_id", F.lit("").alias("matcher"), F.lit(0).alias("idx")).limit(0)
    words = stage(placed.groupBy("_word").agg(F.count("*").alias("n")), "registry-words")
    parts = words.select("_word", F.explode(_parts_of_word(F.col("_word"), kinds)).alias("_part"))
    met = stage(join_split(parts, keyed, "_part", F.col("_word")).select("_word", "matcher", "idx"), "registry-met")
    idle = words.join(met.select("_word").distinct(), "_word", "left_anti").orderBy(F.desc("n"), "_word").limit(IDLE).select("_word")
    placed = placed.join(F.broadcast(stage(idle, "registry-idle")), "_word", "left_anti")
    counts = words.select("_word", F.col("n").alias("_rows"))
    return join_counted(placed, met, ("_word",), counts, F.col("_id"), "inner").select("_id", "matcher", "idx")


def _by_stretch(texts: DataFrame, matchers: DataFrame) -> DataFrame:
    """(_id, matcher, idx) of the texts and the matchers without words whose rarest stretch they hold."""
    keyed = _rarest(matchers.select("idx", "matcher", F.explode(_stretches(F.col("matcher"))).alias("_part")))
    parts = texts.select("_id", F.explode(_stretches(F.col("_texts"))).alias("_part"))
    return join_split(parts, keyed, "_part", F.col("_id")).select("_id", "matcher", "idx")


def _by_texts(texts: DataFrame, matchers: DataFrame) -> DataFrame:
    """_id, text_idx: the first entry with a matcher inside the texts."""
    matchers = matchers.filter(F.length("matcher") >= STRETCH)
    has_word = F.col("matcher").rlike(_WORD)
    met, wordless = _by_word(texts, matchers.filter(has_word)), matchers.filter(~has_word)
    if not wordless.isEmpty():
        met = met.unionByName(_by_stretch(texts, wordless))
    found = met.distinct().join(texts.select("_id", "_texts"), "_id").filter(F.contains("_texts", "matcher"))
    return found.groupBy("_id").agg(F.min("idx").alias("text_idx"))


def with_matches(offers: DataFrame, registry: DataFrame, loose_code, code_of) -> DataFrame:
    """Add `_match` to `offers`, which have `_url` and `_texts`: idx by URL, -1 - idx by texts, null for none.

    `loose_code(patterns, matchers)` gives two columns, the first idx by URL and by texts, from listed
    (idx, pattern) and (idx, matcher); `code_of(url_idx, text_idx)` joins both ways to one code.
    """
    key = F.concat(F.coalesce("_url", F.lit("")), F.lit("\0"), F.col("_texts"))
    keyed = offers.withColumn("_key", key)
    distinct = keyed.groupBy("_url", "_texts").agg(F.count("*").alias("_rows"))
    texts = stage(distinct.select("_url", "_texts", "_rows", key.alias("_key"), F.monotonically_increasing_id().alias("_id")), "registry-texts")
    patterns = registry.select("idx", F.col("base_url_pattern").alias("pattern"))
    matchers = registry.select("idx", F.explode("match").alias("matcher")).select("idx", F.lower("matcher").alias("matcher"))
    matchers = matchers.groupBy("matcher").agg(F.min("idx").alias("idx")).filter("matcher IS NOT NULL")
    # An entry without a pattern fits every URL: only the first of them counts.
    open_idx = patterns.filter("pattern IS NULL").agg(F.min("idx")).first()[0]
    others = patterns.filter((F.col("pattern") != "") & ~F.col("pattern").rlike(KEYED)).groupBy("pattern").agg(F.min("idx").alias("idx"))
    loose = [(r.idx, r.pattern) for r in others.orderBy("idx").collect()] + ([(open_idx, None)] if open_idx is not None else [])
    short = matchers.filter(F.length("matcher") < STRETCH).orderBy("idx").collect()
    by_url, by_text = loose_code(sorted(loose, key=lambda p: p[0]), [(r.idx, r.matcher) for r in short])
    found = (
        texts.withColumns({"_loose_url": by_url, "_loose_text": by_text})
        .join(_by_host(texts, patterns), "_id", "left")
        .join(_by_texts(texts, matchers), "_id", "left")
    )
    first_url, first_text = F.least("_loose_url", "url_idx"), F.least("_loose_text", "text_idx")
    matches = found.select("_key", code_of(first_url, first_text).alias("_match")).filter("_match IS NOT NULL")
    return join_counted(keyed, matches, ("_key",), texts.select("_key", "_rows"), spread(keyed)).drop("_key")
