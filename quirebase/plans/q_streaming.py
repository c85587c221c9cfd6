"""Streaming queries, run over what is there, and queries with outside engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirebase.operators.dedupe import latest
from quirebase.operators.external import embed, hashing_client, with_retries
from quirebase.plans.registry import query
from quirebase.session import load, scratch_dir
from quirebase.streaming import ingest as S


@query("""
SELECT id, vec_id, len(embedding) AS dimension FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY vec_id DESC) AS rn FROM chunk_vectors WHERE id IS NOT NULL) WHERE rn = 1
""")
def stream_vector_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector table merged from a stream, the highest vec_id of each chunk last."""
    base = scratch_dir(spark)
    stream = S.stream_table(spark, f"{sf_dir}/chunk_vectors.parquet", 1).where("id is not null").select("id", "vec_id", F.size("embedding").alias("dimension"))
    table = S.upsert_stream(stream, f"{base}/table", f"{base}/checkpoint", "id", "vec_id")
    return table.select("id", "vec_id", F.when(F.col("dimension") >= 0, F.col("dimension")).alias("dimension"))


@query("""
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS requests FROM events
GROUP BY 1, 2
""")
def stream_hourly_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests an hour and model as a stream in update mode: windows past the watermark leave the state, of each the last row holds."""
    base = scratch_dir(spark)
    events = S.stream_table(spark, f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    counts = S.windowed_counts(events, "ts", ["event_type"], "1 hour", "2 days")
    counts.writeStream.outputMode("update").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).foreachBatch(
        lambda batch, n: batch.write.mode("overwrite").parquet(f"{base}/out/v={n}")
    ).start().awaitTermination()
    out = latest(spark.read.parquet(f"{base}/out"), ["window_start", "event_type"], [F.desc("v")])
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "requests")


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL '12 hours' THEN 1 ELSE 0 END AS fresh FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS life FROM g),
l AS (SELECT user_id, max(life) AS life FROM s GROUP BY 1)
SELECT CAST(s.user_id AS VARCHAR) AS key, count(*) AS touches, round(epoch_us(min(s.ts)) / 1000000.0, 3) AS created FROM s JOIN l USING (user_id, life) GROUP BY 1
""")
def stream_cache_touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache with a time to live, merged batch by batch from a stream: each key's touches in its present life."""
    base = scratch_dir(spark)
    events = S.stream_table(spark, f"{sf_dir}/events.parquet")
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    states = S.last_seen(events, "user_id", at, 12 * 3600, f"{base}/state", f"{base}/checkpoint")
    return states.select("key", "touches", F.round("created", 3).alias("created"))


@query("""
WITH known AS (SELECT DISTINCT file_hash FROM documents WHERE file_hash IS NOT NULL AND length(text) >= 50)
SELECT CASE WHEN k.file_hash IS NULL THEN 'miss' ELSE 'hit' END AS lookup, count(*) AS files FROM file_index f LEFT JOIN known k ON k.file_hash = f.file_hash GROUP BY 1
""")
def text_cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose text is there already, and those it must still be made of."""
    known = load(spark, sf_dir, "documents").where("file_hash is not null and length(text) >= 50").select("file_hash", F.lit(True).alias("cached")).distinct()
    found = load(spark, sf_dir, "file_index").join(known, "file_hash", "left")
    return found.groupBy(F.when(F.col("cached"), "hit").otherwise("miss").alias("lookup")).agg(F.count("*").alias("files"))


@query()
def embed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct chunk text embedded once by a pluggable client, here one without a network."""
    texts = load(spark, sf_dir, "chunks").select(F.col("metadata.chunk_hash").alias("chunk_hash"), "text").groupBy("chunk_hash").agg(F.min("text").alias("text"))
    return texts.select("chunk_hash", embed(F.col("text"), lambda: with_retries(hashing_client()), 96).alias("embedding"))


@query("SELECT count(*) AS vectors, CAST(min(l) AS INTEGER) AS shortest, CAST(max(l) AS INTEGER) AS longest FROM (SELECT len(embedding) AS l FROM chunk_vectors WHERE embedding IS NOT NULL)")
def vector_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guard on the length of vectors."""
    v = load(spark, sf_dir, "chunk_vectors").where("embedding is not null").select(F.size("embedding").alias("l"))
    return v.agg(F.count("*").alias("vectors"), F.min("l").alias("shortest"), F.max("l").alias("longest"))


@query("""
WITH d AS (SELECT doc_id, extracted_at, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY extracted_at DESC NULLS LAST, doc_id) AS place, coalesce(source, '') AS source FROM documents)
SELECT source, doc_id, place FROM d WHERE place <= 10
""")
def newest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten newest documents of every source."""
    w = Window.partitionBy(F.coalesce("source", F.lit(""))).orderBy(F.desc_nulls_last("extracted_at"), "doc_id")
    return load(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("")).alias("source"), "doc_id", F.row_number().over(w).alias("place")).where("place <= 10")
