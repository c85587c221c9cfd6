"""Queries on exact duplicates, upserts and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirebase.operators import dedupe
from quirebase.plans.registry import query
from quirebase.session import load


@query("""
SELECT md5(text) AS content, count(*) AS copies, min(doc_id) AS kept FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1
""")
def document_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.duplicate_groups(load(spark, sf_dir, "documents").where("text is not null"), F.md5("text"), "doc_id")


@query("""
WITH r AS (SELECT doc_id, n_chars, row_number() OVER (PARTITION BY md5(text) ORDER BY path NULLS LAST, doc_id) AS place FROM documents WHERE text IS NOT NULL)
SELECT count(*) AS removed, CAST(sum(n_chars) AS BIGINT) AS saved FROM r WHERE place > 1
""")
def duplicate_savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What goes when only the first path of each content stays."""
    first = Window.partitionBy(F.md5("text")).orderBy(F.asc_nulls_last("path"), "doc_id")
    placed = load(spark, sf_dir, "documents").where("text is not null").withColumn("place", F.row_number().over(first))
    return placed.where("place > 1").agg(F.count("*").alias("removed"), F.sum("n_chars").alias("saved"))


@query("""
WITH owner AS (SELECT file_hash, min(path) AS path FROM file_index WHERE path IS NOT NULL GROUP BY 1)
SELECT d.doc_id, o.path AS duplicate_of FROM documents d JOIN owner o ON d.file_hash = o.file_hash AND d.path <> o.path
UNION ALL
SELECT d.doc_id, NULL AS duplicate_of FROM documents d LEFT JOIN owner o ON d.file_hash = o.file_hash WHERE d.path IS NOT NULL AND o.path IS NULL
""")
def file_duplicate_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose hash another path owns, and files whose hash nobody knows yet (null)."""
    owner = load(spark, sf_dir, "file_index").where("path is not null").groupBy("file_hash").agg(F.min("path").alias("duplicate_of"))
    docs = load(spark, sf_dir, "documents").select("doc_id", "path", "file_hash").where("path is not null")
    found = docs.join(owner, "file_hash", "left")
    return found.where("duplicate_of is null or duplicate_of <> path").select("doc_id", "duplicate_of")


@query("""
WITH r AS (SELECT DISTINCT id, metadata.file_hash AS file_hash, coalesce(metadata.is_duplicate, false) AS dup, metadata.chunk_index AS i FROM chunks)
SELECT coalesce(file_hash, '') AS file_hash, count(*) FILTER (WHERE NOT dup) AS unique_chunks, count(*) FILTER (WHERE dup) AS duplicate_chunks FROM r GROUP BY 1
""")
def chunk_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = load(spark, sf_dir, "chunks").select("id", F.coalesce("metadata.file_hash", F.lit("")).alias("file_hash"), F.coalesce("metadata.is_duplicate", F.lit(False)).alias("dup"), F.col("metadata.chunk_index").alias("i")).distinct()
    return r.groupBy("file_hash").agg(F.count_if(~F.col("dup")).alias("unique_chunks"), F.count_if("dup").alias("duplicate_chunks"))


_INDEXED = """indexed AS (SELECT id, text, metadata, embedding_type FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY metadata.file_mtime DESC NULLS LAST, metadata.chunk_hash, metadata.path NULLS LAST, text) AS rn FROM chunks
    WHERE NOT coalesce(metadata.is_duplicate, false) AND NOT coalesce(metadata.skip_index, false)) WHERE rn = 1)"""


def indexed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each id that goes into the index, the last upserted."""
    rows = load(spark, sf_dir, "chunks").where("not coalesce(metadata.is_duplicate, false) and not coalesce(metadata.skip_index, false)")
    return dedupe.latest(rows, ["id"], [F.desc_nulls_last("metadata.file_mtime"), F.col("metadata.chunk_hash"), F.asc_nulls_last("metadata.path"), F.col("text")])


@query(f"WITH {_INDEXED} SELECT id, sha1(text) AS text_hash, metadata.chunk_index AS chunk_index, embedding_type FROM indexed")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexed_chunks(spark, sf_dir).select("id", F.sha1("text").alias("text_hash"), F.col("metadata.chunk_index").alias("chunk_index"), "embedding_type")


@query("""
WITH v AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY upserted_at DESC, vec_id DESC) AS rn FROM chunk_vectors WHERE embedding IS NOT NULL)
SELECT id, vec_id, coalesce(collection, '') AS collection, len(embedding) AS dimension FROM v WHERE rn = 1
""")
def vector_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last vector of each chunk id by time of upsert."""
    rows = load(spark, sf_dir, "chunk_vectors").where("embedding is not null")
    return dedupe.latest(rows, ["id"], [F.desc("upserted_at"), F.desc("vec_id")]).select("id", "vec_id", F.coalesce("collection", F.lit("")).alias("collection"), F.size("embedding").alias("dimension"))


@query(f"""
WITH {_INDEXED},
v AS (SELECT id, vec_id, row_number() OVER (PARTITION BY id ORDER BY upserted_at DESC, vec_id DESC) AS rn FROM chunk_vectors WHERE embedding IS NOT NULL)
SELECT i.id, v.vec_id, length(i.text) AS n_chars, coalesce(i.metadata.group_key, '') AS group_key FROM indexed i JOIN v ON v.id = i.id AND v.rn = 1
""")
def chunk_vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each indexed chunk beside its vector, by id instead of by position."""
    v = dedupe.latest(load(spark, sf_dir, "chunk_vectors").where("embedding is not null"), ["id"], [F.desc("upserted_at"), F.desc("vec_id")]).select("id", "vec_id")
    return indexed_chunks(spark, sf_dir).join(v, "id").select("id", "vec_id", F.length("text").alias("n_chars"), F.coalesce("metadata.group_key", F.lit("")).alias("group_key"))


@query(f"WITH {_INDEXED} SELECT coalesce(metadata.group_key, '') AS group_key, count(*) AS records, CAST(sum(length(text)) AS BIGINT) AS characters FROM indexed GROUP BY 1")
def jsonl_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index records written as JSON lines by group and read back with the declared schema; counts of each group."""
    from quirebase.session import scratch_dir
    from quirebase.sources.files import read_records
    from quirebase.sources.sinks import write_records

    where = f"{scratch_dir(spark)}/records"
    write_records(indexed_chunks(spark, sf_dir), where)
    return read_records(spark, where).groupBy(F.coalesce("metadata.group_key", F.lit("")).alias("group_key")).agg(F.count("*").alias("records"), F.sum(F.length("text")).alias("characters"))


_CSV = ("path", "filename", "stem", "file_size", "file_mtime", "file_hash", "chunk_hash", "group_key", "department", "course_code", "course_number", "level", "semester", "category", "course_folder", "subcategory", "chunk_index", "total_chunks_in_doc")


@query(f"WITH {_INDEXED} SELECT id, " + ", ".join("'' AS subcategory" if c == "subcategory" else f"coalesce(CAST(metadata.{c} AS VARCHAR), '') AS {c}" for c in _CSV) + " FROM indexed")
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nineteen fixed columns as written to CSV: '' for missing values, unknown keys left out."""
    from quirebase.sources.sinks import csv_columns

    return csv_columns(indexed_chunks(spark, sf_dir), _CSV)


@query("""
SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY doc_id) AS place FROM documents
QUALIFY row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY doc_id) <= 5
""")
def sample_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five documents of every source."""
    w = Window.partitionBy(F.coalesce("source", F.lit(""))).orderBy("doc_id")
    placed = load(spark, sf_dir, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"), F.row_number().over(w).alias("place"))
    return placed.where("place <= 5")
