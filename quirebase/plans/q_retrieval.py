"""Queries on vectors, collections and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirebase.functions.values import fit_vector
from quirebase.operators import retrieval as R
from quirebase.operators.ordering import number_rows
from quirebase.plans.registry import query
from quirebase.session import load

_COS = "round(1 - list_sum(list_transform(range(1, 65), lambda i: CAST(q.embedding[i] AS DOUBLE) * CAST(v.embedding[i] AS DOUBLE))) / sqrt(list_sum(list_transform(q.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) * list_sum(list_transform(v.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 9)"
_L2 = "round(list_sum(list_transform(range(1, 65), lambda i: (CAST(q.embedding[i] AS DOUBLE) - CAST(v.embedding[i] AS DOUBLE)) * (CAST(q.embedding[i] AS DOUBLE) - CAST(v.embedding[i] AS DOUBLE)))), 9)"


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    vectors = load(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("collection"), "embedding")
    return vectors, vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def _knn_sql(distance: str, partition: str, columns: str) -> str:
    return f"""
WITH d AS (SELECT q.vec_id AS query_id, CAST(v.label AS VARCHAR) AS collection, v.vec_id, {distance} AS distance FROM embeddings v CROSS JOIN (SELECT * FROM embeddings WHERE vec_id % 100 = 0) q),
r AS (SELECT *, row_number() OVER (PARTITION BY {partition} ORDER BY distance, vec_id) AS rank FROM d)
SELECT {columns} FROM r WHERE rank <= 10"""


@query(_knn_sql(_COS, "query_id, collection", "query_id, collection, vec_id, round(distance, 6) AS distance, rank"))
def knn_per_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector in each collection, by cosine distance."""
    return R.nearest(*_inputs(spark, sf_dir), 10).withColumn("distance", F.round("distance", 6))


@query(_knn_sql(_COS, "query_id", "query_id, vec_id, round(distance, 6) AS distance, rank"))
def knn_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest over all collections."""
    return R.merge_collections(R.nearest(*_inputs(spark, sf_dir), 10), 10).select("query_id", "vec_id", F.round("distance", 6).alias("distance"), "rank")


@query(_knn_sql(_L2, "query_id", "query_id, vec_id, round(distance, 5) AS distance"))
def knn_squared_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.merge_collections(R.nearest(*_inputs(spark, sf_dir), 10, "l2"), 10).select("query_id", "vec_id", F.round("distance", 5).alias("distance"))


@query("SELECT DISTINCT id, metadata.course_code AS course_code, metadata.level AS level, metadata.chunk_index AS chunk_index FROM chunks WHERE metadata.department = 'AGX' AND metadata.semester = '2'")
def metadata_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks by equality of metadata fields; only the wanted columns are read."""
    found = R.equal_to(load(spark, sf_dir, "chunks"), {"metadata.department": "AGX", "metadata.semester": "2"})
    return found.select("id", F.col("metadata.course_code").alias("course_code"), F.col("metadata.level").alias("level"), F.col("metadata.chunk_index").alias("chunk_index")).distinct()


@query("SELECT DISTINCT id, metadata.group_key AS group_key FROM chunks WHERE coalesce(metadata.category = 'GENERAL', false) OR metadata.level = '300'")
def everytag_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows under a tag's value together with those visible everywhere."""
    rows = load(spark, sf_dir, "chunks").select("id", F.col("metadata.group_key").alias("group_key"), F.col("metadata.level").alias("level"), (F.col("metadata.category") == "GENERAL").alias("everytag"))
    return R.tagged(rows, "level", "300").select("id", "group_key").distinct()


@query("""
SELECT coalesce(collection, '') AS collection, count(*) AS vectors, count(embedding) AS with_vector, CAST(max(len(embedding)) AS INTEGER) AS dimension, count(DISTINCT id) AS chunks FROM chunk_vectors GROUP BY 1
""")
def collection_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = load(spark, sf_dir, "chunk_vectors")
    return v.groupBy(F.coalesce("collection", F.lit("")).alias("collection")).agg(F.count("*").alias("vectors"), F.count("embedding").alias("with_vector"), F.max(F.when(F.col("embedding").isNotNull(), F.size("embedding"))).alias("dimension"), F.count_distinct("id").alias("chunks"))


@query("""
WITH f AS (SELECT vec_id, list_transform(list_slice(list_concat(coalesce(embedding, CAST([] AS FLOAT[])), list_transform(range(0, 96), lambda i: CAST(0 AS FLOAT))), 1, 96), lambda x: CAST(x AS DOUBLE)) AS v,
  embedding IS NULL OR len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AS finite FROM chunk_vectors)
SELECT vec_id, CAST(len(v) AS INTEGER) AS dimension, finite, CASE WHEN finite THEN round(v[1], 6) END AS first, CASE WHEN finite THEN round(v[96], 6) END AS last FROM f
""")
def vector_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors cut or padded to 96 elements; those with an element that is no number are fitted too, and flagged."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = load(spark, sf_dir, "chunk_vectors").select("vec_id", fit_vector(F.col("embedding"), 96).alias("v"), (~F.coalesce(bad, F.lit(False))).alias("finite"))
    at = lambda k, name: F.when(F.col("finite"), F.round(F.get("v", F.lit(k)).cast("double"), 6)).alias(name)
    return v.select("vec_id", F.size("v").alias("dimension"), "finite", at(0, "first"), at(95, "last"))


@query("SELECT CASE WHEN count(*) FILTER (WHERE collection = 'course_bly') > 0 THEN 'course_bly' ELSE min(collection) END AS resolved, count(DISTINCT collection) AS collections FROM chunk_vectors")
def resolve_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection by name, else the first of those there are."""
    v = load(spark, sf_dir, "chunk_vectors").select("collection")
    return v.agg(F.when(F.count_if(F.col("collection") == "course_bly") > 0, F.lit("course_bly")).otherwise(F.min("collection")).alias("resolved"), F.count_distinct("collection").alias("collections"))


@query("""
WITH p AS (SELECT vec_id, (row_number() OVER (PARTITION BY coalesce(collection, '') ORDER BY vec_id) - 1) // 1000 AS page, coalesce(collection, '') AS collection FROM chunk_vectors)
SELECT collection, CAST(page AS BIGINT) AS page, count(*) AS rows, min(vec_id) AS first, max(vec_id) AS last FROM p GROUP BY 1, 2
""")
def collection_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a thousand rows in order of id, in each collection."""
    rows = load(spark, sf_dir, "chunk_vectors").select("vec_id", F.coalesce("collection", F.lit("")).alias("collection"))
    p = number_rows(rows, ["collection"], ["vec_id"]).select("vec_id", "collection", F.floor((F.col("place") - 1) / 1000).cast("bigint").alias("page"))
    return p.groupBy("collection", "page").agg(F.count("*").alias("rows"), F.min("vec_id").alias("first"), F.max("vec_id").alias("last"))
