"""Queries of the vector searches: cross-polytope (4) and multi-index hashing (5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm import cross_polytope, multi_index
from quarterdeck.llm.common import query, table

SQL_TOP = """
WITH codes AS (
  SELECT DISTINCT vec_id, list_transform(embedding[1:64], lambda x: x >= 0) AS code FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(len(list_filter(list_zip(q.code, c.code), lambda p: p[1] <> p[2])) AS INTEGER) AS distance
  FROM codes q JOIN codes c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs)
WHERE rank <= 10"""


@query("op4_cross_polytope")
def op4_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


@query("op5_multi_index", SQL_TOP)
def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = multi_index.sign_codes(table(spark, sf_dir, "embeddings"))
    return multi_index.search(codes, "vec_id % 50 = 0")
