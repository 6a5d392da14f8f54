"""Queries of the vector searches."""

from __future__ import annotations

from . import forest, voronoi
from .registry import query, table

OP2 = """
WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20"""


@query("op2_voronoi", OP2)
def op2_voronoi(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return voronoi.exact_top_k(vectors, vectors.where("vec_id % 20 = 0"))


@query("op10_forest")
def op10_forest(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return forest.HashForest(vectors).search(vectors.where("vec_id % 20 = 0"))
