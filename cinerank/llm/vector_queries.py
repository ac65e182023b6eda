"""Registered queries of the exact vector operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cinerank.llm import clusters, negatives, topk
from cinerank.sources.testdata import load_tables


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_tables(spark, sf_dir, "embeddings")["embeddings"]


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_embeddings(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _embeddings(spark, sf_dir).selectExpr(
        "vec_id", "embedding", "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label")
    return negatives.mine(rows)


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(_embeddings(spark, sf_dir))


def _whole(scale: int) -> str:
    """Rows (vec_id, v: whole numbers) of the valid vectors."""
    return f"""SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


OP11_SQL = f"""
WITH e AS ({_whole(topk.SCALE)}),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM e q, e c WHERE q.vec_id % {topk.QUERY_EVERY} = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {topk.K}
"""

OP12_SQL = f"""
WITH e AS (
  SELECT w.vec_id, CAST(v AS DOUBLE[]) AS v, CASE WHEN w.vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM ({_whole(negatives.SCALE)}) w JOIN embeddings ON w.vec_id = embeddings.vec_id WHERE label IS NOT NULL),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM e a, e c WHERE a.vec_id % {negatives.ANCHOR_EVERY} = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same)
  WHERE r <= {negatives.POSITIVES}),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
   AND {negatives.LOW} * positive_score <= 100 * s.score AND 100 * s.score <= {negatives.HIGH} * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= {negatives.NEGATIVES}
"""


def _op13_sql(rounds: int = clusters.ROUNDS) -> str:
    def placed(r: int) -> str:
        d = "list_sum(list_transform(list_zip(e.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
        return f"""
a{r} AS (
  SELECT row_id, arg_min(c.cluster, CAST({d} AS HUGEINT) * {clusters.K} + c.cluster) AS cluster, CAST(min({d}) AS BIGINT) AS distance
  FROM e, c{r} c GROUP BY row_id),"""

    def moved(r: int) -> str:
        return f"""
s{r + 1} AS (
  SELECT cluster, j, CAST(sum(x) AS BIGINT) AS t, count(*) AS n
  FROM (SELECT a.cluster, unnest(e.v) AS x, unnest(range({clusters.DIM})) AS j FROM e JOIN a{r} a ON e.row_id = a.row_id)
  GROUP BY cluster, j),
m{r + 1} AS (SELECT cluster, list((t - ((t % n) + n) % n) // n ORDER BY j) AS v FROM s{r + 1} GROUP BY cluster),
c{r + 1} AS (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r + 1} m ON c.cluster = m.cluster),"""

    steps = "".join(placed(r) + moved(r) for r in range(rounds)) + placed(rounds)
    return f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, v FROM ({_whole(clusters.SCALE)}) WHERE len(v) = {clusters.DIM}),
c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY h) AS INTEGER) - 1 AS cluster, v FROM (
    SELECT sha256('{clusters.SALT}:' || vec_id) AS h, v FROM e ORDER BY h LIMIT {clusters.K})),{steps}
i AS (
  SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia, CAST(sum(sum(distance)) OVER () AS BIGINT) AS inertia
  FROM a{rounds} GROUP BY cluster)
SELECT e.vec_id, a.cluster, a.distance, i.cluster_inertia, i.inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM e JOIN a{rounds} a ON e.row_id = a.row_id JOIN i ON a.cluster = i.cluster JOIN c{rounds} c ON a.cluster = c.cluster
"""


OP13_SQL = _op13_sql()

QUERIES = {
    "op11_exact_top_k": op11_exact_top_k,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_centroid_clustering": op13_centroid_clustering,
}
ORACLE = {"op11_exact_top_k": OP11_SQL, "op12_hard_negatives": OP12_SQL, "op13_centroid_clustering": OP13_SQL}
