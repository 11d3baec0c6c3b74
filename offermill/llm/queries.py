"""Registered queries of the operators, and their DuckDB statements."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontam, exact, licenses, lm, packing, phrases, pieces, pii, ranked, simhash, tokens, toxicity, warc
from .common import read_table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_same")


def digested(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return digested(packing.pack(read_table(spark, sf_dir, "documents"), path))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokens.token_counts(read_table(spark, sf_dir, "documents"), path)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return licenses.per_document(docs, licenses.scan(docs))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(read_table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents"))
    every = F.array_sort(F.concat("base", "added"))
    return found.select(
        "doc_id", *pii.counted(F.col("base")), F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(every).alias("spans")
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is what labels call good quality."""
    targets = read_table(spark, sf_dir, "labels").filter("quality = 1")
    return lm.score(read_table(spark, sf_dir, "documents"), targets)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.encode_decode(read_table(spark, sf_dir, "documents"), path, keep=["doc_id"])
    digest = F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_exact": op5_exact,
    "op6_licenses": op6_licenses,
    "op7_warc": op7_warc,
    "op8_pii": op8_pii,
    "op9_decontaminate": op9_decontaminate,
    "op10_lm_score": op10_lm_score,
    "op11_phrases": op11_phrases,
    "op12_pieces": op12_pieces,
    "op13_ranked": op13_ranked,
}

SQL: dict[str, str] = {
    "op5_exact": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY length(t) DESC, doc_id)
    """,
    "op9_decontaminate": r"""
        WITH words AS (
            SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
            UNION ALL
            SELECT 'b', item_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
            FROM benchmark),
        lengths AS (
            SELECT DISTINCT least(10, len(w)) AS n FROM words WHERE kind = 'b' AND len(w) > 0),
        item_windows AS (
            SELECT DISTINCT id, n, array_to_string(w[i:i + n - 1], ' ') AS win
            FROM (SELECT id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
                  FROM words WHERE kind = 'b' AND len(w) > 0)),
        doc_windows AS (
            SELECT id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
            FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM words, lengths WHERE kind = 'd' AND len(w) >= n)),
        hits AS (
            SELECT d.id, d.i, d.n, b.id AS item FROM doc_windows d JOIN item_windows b USING (n, win)),
        hit_words AS (
            SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY id),
        hit_items AS (
            SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM hits) GROUP BY id)
        SELECT w.id AS doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM words w LEFT JOIN hit_words USING (id) LEFT JOIN hit_items USING (id) WHERE kind = 'd'
    """,
    "op11_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        grams AS (
            SELECT lang, k, w[i:i + k - 1] AS g FROM (
                SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, (VALUES (1), (2), (3)) AS sizes(k))),
        f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY lang, k, g),
        totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
        candidates AS (SELECT lang, k, g, f AS a FROM f WHERE k > 1 AND f >= 10),
        parts AS (
            SELECT lang, k, g, a, cut, g[1:cut] AS front, g[cut + 1:k] AS rest
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)),
        cuts AS (
            SELECT c.lang, c.k, c.g, c.a, x.f AS l, y.f AS r, c.cut,
                   (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
            FROM parts c JOIN f x ON x.lang = c.lang AND x.g = c.front JOIN f y ON y.lang = c.lang AND y.g = c.rest),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
        longer AS (
            SELECT lang, g[1:2] AS g, a FROM candidates WHERE k = 3 UNION ALL SELECT lang, g[2:3], a FROM candidates WHERE k = 3),
        kept AS (
            SELECT * FROM lowest c WHERE NOT EXISTS (
                SELECT 1 FROM longer b WHERE b.lang = c.lang AND b.g = c.g AND 100 * b.a >= 50 * c.a)),
        ranked AS (
            SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, CAST(score AS BIGINT) AS score FROM kept)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM ranked JOIN totals USING (lang)
        QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
    """,
    "op13_ranked": r"""
        WITH doc_terms AS (
            SELECT rid, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM (
                SELECT row_number() OVER () AS rid, doc_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents) GROUP BY rid, term),
        lengths AS (SELECT rid, CAST(sum(tf) AS BIGINT) AS n FROM doc_terms GROUP BY rid),
        totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
        asked AS (
            SELECT item_id, term, count(*) AS repeats FROM (
                SELECT item_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM doc_terms, totals WHERE term IN (SELECT term FROM asked) GROUP BY term),
        scored AS (
            SELECT item_id, rid, any_value(doc_id) AS doc_id,
                   CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN doc_terms USING (term) JOIN lengths USING (rid), totals
            GROUP BY item_id, rid)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
    """,
}
