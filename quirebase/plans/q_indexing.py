"""Queries on the indexing run as a whole and on what it writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirebase.operators import indexing as I
from quirebase.operators.external import hashing_client, with_retries
from quirebase.plans.q_paths import path_metadata  # noqa: F401 (its SQL is used here)
from quirebase.plans.q_text import SQL_CHUNKS
from quirebase.plans.registry import SQL, query
from quirebase.session import load, scratch_dir
from quirebase.sources.files import read_records
from quirebase.sources.sinks import write_records

_FILE_SIZE, _FILE_MTIME = "coalesce(strlen(text), 0)", "CAST(floor(coalesce(epoch(extracted_at), 0)) AS BIGINT)"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").where("path is not null")
    return docs.select("path", "text", "file_hash", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("file_size"), F.coalesce(F.unix_timestamp(F.col("extracted_at").cast("timestamp")), F.lit(0)).alias("file_mtime"))


_MARKED = f"""{SQL_CHUNKS},
    hashed AS (SELECT doc_id, path, file_hash, sha1(text) AS doc_hash, {_FILE_SIZE} AS file_size, {_FILE_MTIME} AS file_mtime, chunk_index, len(base) AS total, chunk, sha1(chunk) AS h FROM chunked WHERE path IS NOT NULL),
    firsts AS (SELECT *, min(chunk_index) OVER (PARTITION BY doc_id, h) AS first_index FROM hashed),
    running AS (SELECT *, sum(CASE WHEN first_index = chunk_index THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY chunk_index) - 1 AS running FROM firsts),
    marked AS (SELECT *, first_index <> chunk_index AS again, max(CASE WHEN first_index = chunk_index THEN running END) OVER (PARTITION BY doc_id, h) AS unique_index FROM running)"""
_RECORDS = f"""{_MARKED},
    records AS (SELECT CASE WHEN again THEN sha1(concat_ws(':', doc_hash, CAST(chunk_index AS VARCHAR), h, 'dup')) ELSE sha1(concat_ws(':', doc_hash, CAST(chunk_index AS VARCHAR), h)) END AS id, m.path, chunk_index, total AS total_chunks_in_doc,
        CASE WHEN NOT again THEN CAST(file_size AS BIGINT) END AS file_size, CASE WHEN NOT again THEN file_mtime END AS file_mtime, file_hash, h AS chunk_hash, department, level, semester, category, course_folder, course_code, course_number, filename, stem, group_key,
        CASE WHEN again THEN true END AS is_duplicate, CASE WHEN again THEN CAST(unique_index AS INTEGER) END AS duplicate_of_index, CASE WHEN again THEN h END AS duplicate_of_hash, CASE WHEN again THEN true END AS skip_index
        FROM marked k JOIN ({SQL["path_metadata"]}) m ON m.path = k.path)"""


@query(f"WITH {_RECORDS} SELECT * FROM records")
def chunk_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of every chunk of every document, seven technical and ten path fields, and the marks of repeats."""
    return I.chunk_records(_files(spark, sf_dir)).select("id", "metadata.*")


@query(f"WITH {_RECORDS} SELECT group_key, count(*) FILTER (WHERE skip_index IS NULL) AS indexed, count(*) FILTER (WHERE skip_index) AS repeats FROM records GROUP BY 1")
def record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of record as JSON lines in a folder for each group, counted as they are read back."""
    where = f"{scratch_dir(spark)}/records"
    rows = I.chunk_records(_files(spark, sf_dir))
    write_records(rows.withColumn("embedding", F.lit(None).cast("array<float>")).withColumn("embedding_type", F.lit(None).cast("string")), where, by_group=True)
    back = read_records(spark, where).select("metadata.group_key", F.col("metadata.skip_index").alias("skip"))
    return back.groupBy("group_key").agg(F.count_if(F.col("skip").isNull()).alias("indexed"), F.count_if("skip").alias("repeats"))


_STATE = f"""{_MARKED},
    owner AS (SELECT file_hash, min(path) AS owner FROM documents WHERE path IS NOT NULL AND file_hash IS NOT NULL GROUP BY 1),
    counted AS (SELECT doc_id, count(*) FILTER (WHERE NOT again) AS chunks, count(*) FILTER (WHERE again) AS duplicates, CAST(sum(CASE WHEN NOT again THEN greatest(1, length(chunk) // 4) END) AS BIGINT) AS tokens FROM marked GROUP BY 1),
    first_run AS (SELECT d.path, o.owner, c.*, CASE WHEN o.owner <> d.path THEN 'file_duplicate' WHEN c.chunks IS NULL THEN 'empty_text' END AS reason
        FROM documents d LEFT JOIN owner o ON o.file_hash = d.file_hash LEFT JOIN counted c ON c.doc_id = d.doc_id WHERE d.path IS NOT NULL)"""


@query(f"""
WITH {_STATE}
SELECT path, CASE WHEN reason IS NULL THEN 'completed' ELSE 'skipped' END AS status, coalesce(reason, 'already_processed') AS last_reason, CASE WHEN reason = 'file_duplicate' THEN owner END AS duplicate_of,
  CASE WHEN reason IS NULL THEN CAST(chunks AS INTEGER) END AS chunks, CASE WHEN reason IS NULL THEN CAST(duplicates AS INTEGER) END AS duplicates, CASE WHEN reason IS NULL THEN tokens END AS tokens,
  CASE WHEN reason IS NULL THEN CAST(CAST(tokens AS DECIMAL(18,0)) * CAST('0.012' AS DECIMAL(9,6)) / 1000000 AS DECIMAL(18,9)) END AS cost, CASE WHEN reason IS NULL THEN CAST(ceil(chunks / 96) AS INTEGER) END AS batches, 2 AS ledger_rows
FROM first_run
""")
def indexing_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of every document's file after two runs over the same files; the second finds nothing to do."""
    index = I.Index(spark, f"{scratch_dir(spark)}/index")
    client = lambda: with_retries(hashing_client())
    for moment in ("2024-01-01", "2024-01-02"):
        index.run(_files(spark, sf_dir), client, F.lit(moment).cast("timestamp"))
    ledger = index.table("ledger")
    each = ledger.groupBy("path").agg(F.min_by("status", "run").alias("status"), F.max_by("reason", "run").alias("last_reason"), F.max_by("duplicate_of", "run").alias("duplicate_of"), F.max("chunks").alias("chunks"), F.max("duplicates").alias("duplicates"), F.count("*").alias("ledger_rows"))
    bills = index.table("billing").groupBy(F.col("file").alias("path")).agg(F.sum("tokens").alias("tokens"), F.sum("cost").cast("decimal(18,9)").alias("cost"), F.sum("batches").cast("int").alias("batches"))
    return each.join(bills, "path", "left").select("path", "status", "last_reason", "duplicate_of", "chunks", "duplicates", "tokens", "cost", "batches", F.col("ledger_rows").cast("int").alias("ledger_rows"))


@query(f"""
WITH {_STATE}
SELECT (SELECT count(DISTINCT sha1(concat_ws(':', m.doc_hash, CAST(m.chunk_index AS VARCHAR), m.h))) FROM marked m JOIN first_run f ON f.doc_id = m.doc_id WHERE f.reason IS NULL AND NOT m.again) AS vectors,
  (SELECT count(*) FROM marked m JOIN first_run f ON f.doc_id = m.doc_id WHERE f.reason IS NULL AND m.again) AS repeats,
  (SELECT count(*) FROM first_run f JOIN documents d USING (path) WHERE f.reason IS NULL AND d.file_hash IS NOT NULL) AS known_files,
  (SELECT count(*) FROM first_run f JOIN documents d USING (path) WHERE f.reason IS NULL AND d.file_hash IS NOT NULL AND length(regexp_replace(d.text, '\\s+', '', 'g')) >= 50) AS texts, 'cosine' AS metric
""".replace("AS known_files", "+ (SELECT count(*) FROM first_run f JOIN documents d USING (path) WHERE f.reason = 'empty_text' AND d.file_hash IS NOT NULL) AS known_files"))
def indexing_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the tables that one run writes: searched records, repeats, known files, cached texts, and the collection's metric."""
    index = I.Index(spark, f"{scratch_dir(spark)}/index")
    index.run(_files(spark, sf_dir), hashing_client, F.lit("2024-01-01").cast("timestamp"))
    n = lambda df, name: df.agg(F.count("*").alias(name))
    vectors = n(index.collection().where("embedding is not null"), "vectors")
    repeats = n(index.table("records").where("metadata.skip_index"), "repeats")
    known, texts = n(index.table("file_index").select("file_hash", "path").distinct(), "known_files"), n(index.table("texts").where("key is not null"), "texts")
    one = lambda df: df.withColumn("_", F.lit(1))
    return one(vectors).join(one(repeats), "_").join(one(known), "_").join(one(texts), "_").select("vectors", "repeats", "known_files", "texts", F.lit(index.metric).alias("metric"))
