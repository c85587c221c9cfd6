"""Queries on the ledger, the billing and the index of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirebase.operators import ledger as L
from quirebase.plans.registry import query
from quirebase.session import load

_STEP = "CASE lower(trim(status)) WHEN 'completed' THEN 5 WHEN 'failed' THEN 4 WHEN 'skipped' THEN 3 WHEN 'in_progress' THEN 2 WHEN 'pending' THEN 1 ELSE 0 END"
_TIES = ", ".join(f"{c} DESC NULLS LAST" for c in ("file_size", "file_mtime", "reason", "error", "duplicate_of", "jsonl_name", "jsonl_archived", "chroma_upserted", "chunks", "duplicates"))


def _current(where: str = "true") -> str:
    return f"""(SELECT * EXCLUDE (rn) FROM (SELECT path, lower(trim(status)) AS status, file_size, file_mtime, reason, jsonl_archived, chroma_upserted, chunks, duplicates,
    row_number() OVER (PARTITION BY path ORDER BY coalesce(finished_at, started_at, discovered_at) DESC NULLS LAST, {_STEP} DESC, {_TIES}) AS rn FROM ledger WHERE path IS NOT NULL AND {where}) WHERE rn = 1)"""


@query(f"SELECT path, status, file_size, reason, chunks, duplicates FROM {_current()}")
def ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.current(load(spark, sf_dir, "ledger")).select("path", "status", "file_size", "reason", "chunks", "duplicates")


@query(f"""
WITH s AS {_current()},
c AS (SELECT count(*) AS total, count(*) FILTER (WHERE status = 'completed') AS completed, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'skipped') AS skipped FROM s)
SELECT *, total - completed - failed - skipped AS "open", CASE WHEN total > 0 THEN round(CAST(completed AS DOUBLE) / total * 100, 6) ELSE 0.0 END AS percent, total - completed - skipped > 0 AS can_resume FROM c
""")
def session_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.summary(L.current(load(spark, sf_dir, "ledger")))


@query(f"""
WITH s AS {_current()}
SELECT d.path, coalesce(s.status, 'new') AS status FROM (SELECT DISTINCT path FROM file_index WHERE path IS NOT NULL) d LEFT JOIN s ON s.path = d.path WHERE s.path IS NULL OR s.status IN ('pending', 'failed')
""")
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known files that nothing was done for or that failed; a run in progress isn't pending."""
    known = load(spark, sf_dir, "file_index").select("path").where("path is not null").distinct()
    state = L.current(load(spark, sf_dir, "ledger")).select("path", "status")
    return known.join(state, "path", "left").where("status is null or status in ('pending', 'failed')").select("path", F.coalesce("status", F.lit("new")).alias("status"))


@query(f"""
WITH s AS {_current("lower(trim(status)) <> 'skipped'")},
f AS (SELECT path, max(file_size) AS now_size, max(file_mtime) AS now_mtime FROM ledger WHERE path IS NOT NULL GROUP BY 1)
SELECT f.path, CASE WHEN coalesce(s.status = 'completed' AND s.file_size = f.now_size AND s.file_mtime = f.now_mtime AND coalesce(s.jsonl_archived, false) AND coalesce(s.chroma_upserted, false), false) THEN 'skip' ELSE 'run' END AS decision
FROM f LEFT JOIN s ON s.path = f.path
""")
def resume_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which files a rerun leaves alone."""
    ledger = load(spark, sf_dir, "ledger")
    found = ledger.where("path is not null").groupBy("path").agg(F.max("file_size").alias("now_size"), F.max("file_mtime").alias("now_mtime"))
    return L.to_process(found, ledger)


@query("""
WITH m AS (SELECT path FROM (SELECT path, row_number() OVER (ORDER BY md5(path)) AS n FROM (SELECT DISTINCT path FROM file_index WHERE path IS NOT NULL)) WHERE n = 1),
p AS (SELECT DISTINCT path FROM file_index WHERE path IS NOT NULL)
SELECT p.path FROM p, m WHERE string_split(p.path, '/') > string_split(m.path, '/')
""")
def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files after the last one done, here the path with the least hash."""
    paths = load(spark, sf_dir, "file_index").select("path").where("path is not null").distinct()
    mark = paths.agg(F.min_by("path", F.md5("path")).alias("path")).first().path
    return L.after_mark(paths, mark or "")


@query("""
WITH b AS (SELECT DISTINCT file, tokens, cost, batches FROM billing_state)
SELECT CASE WHEN grouping(file) = 1 THEN 'all files' ELSE file END AS file, CAST(sum(tokens) AS BIGINT) AS tokens, sum(cost) AS cost, CAST(sum(batches) AS BIGINT) AS batches, count(DISTINCT file) AS files
FROM b GROUP BY ROLLUP(file)
""")
def billing_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, cost and batches of each file and in total; repeated rows count once, further runs add up."""
    b = load(spark, sf_dir, "billing_state").select("file", "tokens", "cost", "batches").distinct()
    r = b.groupBy("file").agg(F.sum("tokens").alias("tokens"), F.sum("cost").alias("cost"), F.sum("batches").alias("batches")).rollup("file")
    rolled = r.agg(F.sum("tokens").alias("tokens"), F.sum("cost").alias("cost"), F.sum("batches").alias("batches"), F.count("file").alias("files"), F.grouping("file").alias("g"))
    return rolled.select(F.when(F.col("g") == 1, "all files").otherwise(F.col("file")).alias("file"), "tokens", F.col("cost").cast("decimal(38,9)").alias("cost"), "batches", "files")


@query("""
SELECT status, count(*) AS changes, count(DISTINCT path) AS paths, count(*) FILTER (WHERE error IS NOT NULL) AS errors FROM (SELECT DISTINCT *, lower(trim(status)) AS s FROM ledger) x(path, raw, file_size, file_mtime, discovered_at, started_at, finished_at, reason, error, duplicate_of, jsonl_name, jsonl_archived, chroma_upserted, chunks, duplicates, status) GROUP BY 1
""")
def transition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes by status, repeated rows once."""
    rows = load(spark, sf_dir, "ledger").distinct()
    return rows.groupBy(L.status(F.col("status")).alias("status")).agg(F.count("*").alias("changes"), F.count_distinct("path").alias("paths"), F.count("error").alias("errors"))


@query("""
WITH k AS (SELECT path, count(*) AS hashes, min(file_hash) AS first_hash FROM file_index WHERE path IS NOT NULL GROUP BY 1)
SELECT path, hashes, first_hash FROM k WHERE hashes > 1
""")
def rehashed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths seen with more than one content."""
    k = load(spark, sf_dir, "file_index").where("path is not null").groupBy("path").agg(F.count("*").alias("hashes"), F.min("file_hash").alias("first_hash"))
    return k.where("hashes > 1")
