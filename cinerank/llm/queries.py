"""Registered queries of the corpus operators: ``(spark, sf_dir) -> DataFrame`` and their DuckDB SQL.

Each query applies one operator, with production parameters, to its whole table and derives
the contract's columns from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.llm import ann, decontaminate, langid, licenses, line_dedup, lm, near_dup, pieces, quality, vector_queries, warc
from cinerank.sources.testdata import load_tables

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_tables(spark, sf_dir, name)[name]


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       decontaminate.items_digest("items").alias("items_sha256"), "contaminated")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, p, s.n, array_to_string(w[p:p + s.n - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d) JOIN sizes s ON p + s.n - 1 <= len(w)),
hits AS (SELECT doc_id, p, grams.n AS n, item_id FROM grams JOIN win ON grams.g = win.g AND grams.n = win.n),
places AS (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS p FROM hits),
n_hits AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n_hits ON d.doc_id = n_hits.doc_id LEFT JOIN ids ON d.doc_id = ids.doc_id
"""

def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    named = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return rows.select(
        "doc_id", "n_words", F.size("base_starts").cast("long").alias("n_base"),
        F.array_min("base_starts").alias("first_word"), F.array_max("base_starts").alias("last_word"),
        named(F.col("base_labels")).alias("base_labels"),
        named(F.concat("base_labels", "match_labels")).alias("labels"),
        F.when(F.size("base_starts") > 0, F.lit(1.0))
        .otherwise(F.coalesce(F.array_max("match_scores"), F.lit(0.0))).alias("score"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text <> ''),
u AS (
  SELECT doc_id, i, part, concat(part, line) AS unit FROM l, (VALUES (1), (2)) AS p(part)
  WHERE trim(line, ' ') <> '' AND (part = 1 OR length(line) >= 30)),
w AS (
  SELECT doc_id, i, unit, row_number() OVER o AS j, lead(unit) OVER o AS next_unit, lead(i) OVER o AS next_i
  FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i, part)),
later AS (
  SELECT doc_id, i, next_i FROM w WHERE next_unit IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY unit, next_unit ORDER BY doc_id, j) > 1),
gone AS (SELECT doc_id, i FROM later UNION SELECT doc_id, next_i FROM later),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(gone.i) AS n_removed,
         string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL) AS text
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    model = langid.train(docs.filter(~held_out))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op10_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.round_trip(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    sound = F.when(~F.col("intact"), F.raise_error(F.lit("a payload differs from its digest")).cast("string"))
    return rows.select("page_id", "payload_bytes", F.coalesce(sound, F.col("payload_digest")).alias("payload_digest"),
                       "record_type", "refers_to")


OP10_SQL = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                  sha1(coalesce(html, '')) AS payload_digest FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM w
"""


def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.load()
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = pieces.round_trip(docs, model)
    same = F.col("decoded").eqNullSafe(F.replace("text", F.lit(pieces.BLANK), F.lit(" ")))
    return rows.select("doc_id", F.when(F.col("text").isNotNull(), F.size("ids")).cast("long").alias("n_pieces"),
                       "ids", same.alias("round_trip"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


QUERIES: dict[str, Query] = {
    "op9_decontamination": op9_decontamination,
    "op1_license_scan": op1_license_scan,
    "op2_lm_score": op2_lm_score,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op6_language_id": op6_language_id,
    "op10_warc_archive": op10_warc_archive,
    "op7_nearest_vectors": op7_nearest_vectors,
    "op8_sentencepiece": op8_sentencepiece,
    "op4_quality_classifier": op4_quality_classifier,
    **vector_queries.QUERIES,
}

ORACLE: dict[str, str] = {
    "op9_decontamination": OP9_SQL,
    "op3_line_dedup": OP3_SQL,
    "op10_warc_archive": OP10_SQL,
    **vector_queries.ORACLE,
}
