"""Licence families of paragraphs by a trained classifier, in DataFrame functions only.

A sparse logistic regression over words and word pairs scores each paragraph (line) for each licence
family. It learns from variants of family templates, with words left out, against paragraphs of a
bounded sample of documents that share no three words in a row with a template. Training is gradient
descent as joins and sums over the bounded example table.

A paragraph's best score is calibrated on examples that training did not see: the probability that it
is a licence at all follows from the spread of best scores of licences and of other paragraphs. Below
one half it is none; above, the family counts as confirmed if a template of that family is close enough,
else the paragraph is an `unknown` licence.

All paragraphs of all texts are scored. Only words and pairs that carry a weight meet the weight table,
whose size is bounded by the templates; a paragraph without any of them has the score of the constant.

Defined results: null and empty texts, and blank paragraphs, have no licence; rows that share a doc_id
(null too) are one document, each of its rows gets the findings of all, repeated rows count as often as
they occur; empty input gives no rows and trains on templates alone; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import stage

SAMPLE_DOCS = 400
SAMPLE_PARAGRAPHS = 4_000
VARIANTS = 12
ROUNDS = 10
STEP = 0.3
SHRINK = 1e-3
COMMON = 0.01  # words in a larger share of other paragraphs carry no weight
CLOSE = 0.6

# Notices as licensors write them, by family.
TEMPLATES = {
    "agpl": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Dedicated to the public domain under CC0 1.0.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "reserved": (
        "All rights reserved.",
        "No part of this publication may be reproduced or distributed without the prior written permission of the"
        " publisher.",
    ),
}
FAMILIES = tuple(TEMPLATES)
_CONSTANT = 0


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _grams(tokens: Column, width: int) -> Column:
    """Stretches of `width` words."""
    last = F.size(tokens) - width + 1
    places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda k: F.array_join(F.slice(tokens, k, width), " "))


def features(tokens: Column) -> Column:
    """Hashes of the distinct words and word pairs; a pair's hash is made of the hashes of its words."""
    hashed = F.transform(tokens, lambda w: F.xxhash64(w))
    return F.array_distinct(F.aggregate(F.array(hashed), F.array().cast("array<bigint>"), _with_pairs))


def _with_pairs(_: Column, hashed: Column) -> Column:
    """Within the lambda the hashes are a value, made once for both uses."""
    following = F.slice(hashed, 2, F.greatest(F.size(hashed) - 1, F.lit(0)))
    pairs = F.zip_with(F.slice(hashed, 1, F.size(following)), following, lambda a, b: F.xxhash64(a, b))
    return F.concat(hashed, pairs)


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph (line number from 0), line, tokens."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    rows = docs.select("doc_id", F.posexplode(lines).alias("paragraph", "line")).filter("trim(line) <> ''")
    return rows.withColumn("tokens", words(F.col("line")))


def templates(spark: SparkSession) -> DataFrame:
    rows = [(number, line) for number, family in enumerate(FAMILIES) for line in TEMPLATES[family]]
    literals = F.array(*(F.struct(F.lit(n).alias("family"), F.lit(line).alias("line")) for n, line in rows))
    listed = spark.range(1).select(F.inline(literals))
    return listed.withColumn("tokens", words(F.col("line")))


def _licence_examples(spark: SparkSession) -> DataFrame:
    """example, family, tokens: templates, whole and with every fifth word left out, a different fifth each time."""
    varied = templates(spark).withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))

    def stays(word: Column, place: Column) -> Column:
        return (F.col("variant") == 0) | (F.pmod(F.hash(F.col("variant"), place), F.lit(5)) != 0)

    kept = varied.withColumn("tokens", F.filter("tokens", stays))
    return kept.select(F.xxhash64("line", "variant").alias("example"), "family", "tokens")


def _other_examples(docs: DataFrame) -> DataFrame:
    """Paragraphs of the sampled documents that share no three words with a template; family -1."""
    # Tasks send ids only; the sampled texts are read by a bounded list of ids.
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).distinct()
    sampled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")
    lines = paragraphs(sampled).orderBy(F.xxhash64("doc_id", "paragraph", "line")).limit(SAMPLE_PARAGRAPHS)
    lines = lines.select(F.xxhash64("doc_id", "paragraph", "line").alias("example"), "tokens")
    known = templates(docs.sparkSession).select(F.explode(_grams(F.col("tokens"), 3)).alias("gram"))
    alike = lines.select("example", F.explode(_grams(F.col("tokens"), 3)).alias("gram")).join(known, "gram").select("example")
    return lines.join(alike.distinct(), "example", "left_anti").select("example", F.lit(-1).alias("family"), "tokens")


def _margins(scored: DataFrame, keys: list[str], *carried: Column) -> DataFrame:
    sums = [F.sum(f"w{k}").alias(f"z{k}") for k in range(len(FAMILIES))]
    return scored.groupBy(*keys).agg(*sums, *carried)


def train(docs: DataFrame) -> tuple[DataFrame, tuple[float, float]]:
    """Weights (feature, w0, w1, ...), staged, and the slope and offset that turn a best score into a probability."""
    spark = docs.sparkSession
    examples = stage(_licence_examples(spark).union(_other_examples(docs)), "licence-examples")
    raw = examples.select("example", "family", F.explode(features(F.col("tokens"))).alias("feature"))
    others = examples.filter("family < 0").count()
    uses = raw.groupBy("feature").agg(F.max("family").alias("best"), F.count_if(F.col("family") < 0).alias("n_other"))
    chosen = uses.filter((F.col("best") >= 0) & (F.col("n_other") <= COMMON * max(others, 1))).select("feature")
    constant = examples.select("example", "family", F.lit(_CONSTANT).cast("long").alias("feature"))
    rows = stage(raw.join(chosen, "feature").select("example", "family", "feature").union(constant), "licence-features")
    # A quarter of the examples calibrates.
    held = F.pmod(F.xxhash64("example", F.lit("calibrate")), F.lit(4)) == 0
    learn = rows.filter(~held)
    sizes = {r.family: r.n for r in learn.filter(F.col("feature") == _CONSTANT).groupBy("family").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    zeros = [F.lit(0.0).alias(f"w{k}") for k in range(len(FAMILIES))]
    weights = stage(rows.select("feature").distinct().select("feature", *zeros), "licence-weights")
    for _ in range(ROUNDS):
        scored = _margins(learn.join(weights, "feature"), ["example", "family"])
        errors = []
        for k in range(len(FAMILIES)):
            # Both sides of a family weigh one half together.
            own = sizes.get(k, 0)
            share = F.when(F.col("family") == k, 0.5 / max(own, 1)).otherwise(0.5 / max(total - own, 1))
            wanted = (F.col("family") == k).cast("double")
            errors.append((share * (1 / (1 + F.exp(-F.col(f"z{k}"))) - wanted)).alias(f"e{k}"))
        slopes = learn.join(scored.select("example", *errors), "example").groupBy("feature")
        slopes = slopes.agg(*(F.sum(f"e{k}").alias(f"g{k}") for k in range(len(FAMILIES))))
        moved = [
            (F.col(f"w{k}") * (1 - SHRINK) - 10 * STEP * F.coalesce(f"g{k}", F.lit(0.0))).alias(f"w{k}")
            for k in range(len(FAMILIES))
        ]
        weights = stage(weights.join(slopes, "feature", "left").select("feature", *moved), "licence-weights")
    best = F.greatest(*(f"z{k}" for k in range(len(FAMILIES))))
    seen = _margins(rows.filter(held).join(weights, "feature"), ["example", "family"])
    spread = seen.groupBy((F.col("family") >= 0).alias("is_licence")).agg(
        F.count("*").alias("n"), F.avg(best).alias("mean"), F.var_pop(best).alias("variance")
    )
    return weights, _calibration({r.is_licence: r for r in spread.collect()})


def _calibration(spread: dict) -> tuple[float, float]:
    """Slope and offset of the log odds of two normal spreads with a pooled variance, at even prior odds."""
    if True not in spread or False not in spread:
        return 1.0, 0.0
    yes, no = spread[True], spread[False]
    pooled = max((yes.n * yes.variance + no.n * no.variance) / (yes.n + no.n), 1e-3)
    slope = max((yes.mean - no.mean) / pooled, 1e-3)
    return slope, -slope * (yes.mean + no.mean) / 2


def scan(docs: DataFrame, model: tuple[DataFrame, tuple[float, float]] | None = None, close: float = CLOSE) -> DataFrame:
    """Licence paragraphs: doc_id, paragraph, line, family (`unknown` if no template confirms it), probability, similarity."""
    weights, (slope, offset) = model or train(docs)
    spark = docs.sparkSession
    # The weight table is bounded by the templates: some hundred rows.
    constant = weights.filter(F.col("feature") == _CONSTANT).first()
    weighted = [w.feature for w in weights.select("feature").collect() if w.feature != _CONSTANT]
    lines = paragraphs(docs).withColumn("weighted", F.filter(features(F.col("tokens")), lambda h: h.isin(*weighted)))
    lines = lines.filter(F.size("weighted") > 0).withColumn("row", F.monotonically_increasing_id())
    met = lines.select("row", "doc_id", "paragraph", "line", F.explode("weighted").alias("feature"))
    met = met.join(F.broadcast(weights), "feature")
    scored = _margins(met, ["row", "doc_id", "paragraph", "line"])
    totals = [(F.col(f"z{k}") + F.lit(constant[f"w{k}"])).alias(f"z{k}") for k in range(len(FAMILIES))]
    ranked = F.array_max(F.array(*(F.struct(F.col(f"z{k}").alias("z"), F.lit(-k).alias("k")) for k in range(len(FAMILIES)))))
    found = scored.select("doc_id", "paragraph", "line", *totals).select("doc_id", "paragraph", "line", ranked.alias("best"))
    found = found.withColumn("probability", 1 / (1 + F.exp(-(F.lit(slope) * F.col("best.z") + F.lit(offset)))))
    found = found.filter("probability >= 0.5").withColumn("family", -F.col("best.k"))
    models = templates(spark).groupBy("family").agg(F.collect_list(features(F.col("tokens"))).alias("models"))
    tokens = found.withColumn("tokens", words(F.col("line")))
    compared = tokens.withColumn("own", features(F.col("tokens"))).join(F.broadcast(models), "family")

    def alike(model: Column) -> Column:
        return F.size(F.array_intersect(model, F.col("own"))) / F.size(model)

    similarity = F.array_max(F.transform("models", alike))
    names = F.array(*map(F.lit, FAMILIES))
    return compared.withColumn("similarity", similarity).select(
        "doc_id", "paragraph", "line",
        F.when(F.col("similarity") >= close, F.element_at(names, F.col("family") + 1)).otherwise("unknown").alias("family"),
        F.round("probability", 6).alias("probability"), F.round("similarity", 6).alias("similarity"),
    )


def per_document(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, families (confirmed, sorted, comma-joined), n_confirmed, n_unknown."""
    known = F.col("family") != "unknown"
    sums = found.groupBy(F.col("doc_id").alias("_id")).agg(
        F.array_join(F.array_sort(F.collect_set(F.when(known, F.col("family")))), ",").alias("families"),
        F.count_if(known).alias("n_confirmed"), F.count_if(~known).alias("n_unknown"),
    )
    joined = docs.select("doc_id").join(sums, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_confirmed", "n_unknown")]
    return joined.select("doc_id", F.coalesce("families", F.lit("")).alias("families"), *zero)
