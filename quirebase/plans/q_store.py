"""Queries on stores: gates, caches, sessions, collections, context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirebase.functions import text as X
from quirebase.functions.values import RATE_LIMITS, canonical_key, file_action, human_bytes, json_text, model_family, parse_size
from quirebase.operators import dedupe, retrieval, usage
from quirebase.operators import ledger as L
from quirebase.operators import pages as G
from quirebase.plans.q_catalogue import _COURSES, _courses
from quirebase.plans.q_dedupe import _INDEXED, indexed_chunks
from quirebase.plans.q_ledger import _STEP, _current
from quirebase.plans.q_pages import _HUMAN, _PAGES
from quirebase.plans.q_text import SQL_CHUNKS, exploded_chunks
from quirebase.plans.q_usage import _FAMILY, _model
from quirebase.plans.registry import query
from quirebase.session import load, scratch_dir
from quirebase.sources import sinks
from quirebase.sources.files import discoverable, with_place


@query(f"""
WITH {SQL_CHUNKS}, n AS (SELECT doc_id, count(*) AS chunks, count(DISTINCT sha1(chunk)) AS uniq FROM chunked GROUP BY 1)
SELECT d.doc_id, CASE WHEN length(regexp_replace(coalesce(d.text, ''), '\\s+', '', 'g')) = 0 AND n.chunks IS NULL THEN 'empty_text' WHEN n.chunks IS NULL THEN 'no_chunks' ELSE 'ready' END AS gate, coalesce(n.chunks, 0) AS chunks, coalesce(n.uniq, 0) AS uniq
FROM documents d LEFT JOIN n USING (doc_id)
""")
def pipeline_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a document gets as far as to its vectors: it has text, and chunks."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    n = exploded_chunks(docs).groupBy("doc_id").agg(F.count("*").alias("chunks"), F.count_distinct(F.sha1("chunk")).alias("uniq"))
    gate = F.when(F.col("chunks").isNotNull(), "ready").when(X.effective_length(F.col("text")) == 0, "empty_text").otherwise("no_chunks")
    return docs.join(n, "doc_id", "left").select("doc_id", gate.alias("gate"), F.coalesce("chunks", F.lit(0)).alias("chunks"), F.coalesce("uniq", F.lit(0)).alias("uniq"))


@query(f"""
WITH {_INDEXED}, v AS (SELECT DISTINCT id FROM chunk_vectors WHERE embedding IS NOT NULL)
SELECT coalesce(metadata.file_hash, '') AS file_hash, count(*) AS chunks, count(v.id) AS vectors, CASE WHEN count(*) = count(v.id) THEN 'completed' ELSE 'embedding_mismatch' END AS status FROM indexed LEFT JOIN v ON v.id = indexed.id GROUP BY 1
""")
def vector_count_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose chunks all have a vector, and those where some lack one."""
    v = load(spark, sf_dir, "chunk_vectors").where("embedding is not null").select("id", F.lit(1).alias("has")).distinct()
    each = indexed_chunks(spark, sf_dir).select("id", F.coalesce("metadata.file_hash", F.lit("")).alias("file_hash")).join(v, "id", "left")
    return each.groupBy("file_hash").agg(F.count("*").alias("chunks"), F.count("has").alias("vectors")).select("*", F.when(F.col("chunks") == F.col("vectors"), "completed").otherwise("embedding_mismatch").alias("status"))


@query(f"""
WITH {_PAGES}, c AS (SELECT file_hash, count(*) FILTER (WHERE length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) < 100 AND n_images > 0) / count(*) >= 0.85 AS computed FROM pg GROUP BY 1),
k AS (SELECT file_hash, avg(CASE WHEN length(text) < 200 THEN 1 ELSE 0 END) >= 0.6 AS cached FROM pg WHERE page_no <= 8 AND file_hash IN (SELECT file_hash FROM file_index WHERE path IS NOT NULL) GROUP BY 1)
SELECT c.file_hash, coalesce(k.cached, c.computed) AS needs_ocr, k.cached IS NOT NULL AS from_cache FROM c LEFT JOIN k USING (file_hash)
""")
def cached_ocr_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision on every scanned file: what an earlier run noted of the known files, else what its pages say."""
    pages = load(spark, sf_dir, "scan_pages")
    known = load(spark, sf_dir, "file_index").where("path is not null").select("file_hash").distinct()
    cache = G.needs_ocr(pages).join(known, "file_hash", "left_semi").select("file_hash", F.col("needs_ocr").alias("cached"))
    return G.image_focus(pages).join(cache, "file_hash", "left").select("file_hash", F.coalesce("cached", "image_focused").alias("needs_ocr"), F.col("cached").isNotNull().alias("from_cache"))


_LISTED = _HUMAN.replace("|| ' KB'", "|| 'K'").replace("|| ' MB'", "|| 'M'").replace("|| ' GB'", "|| 'G'").replace("|| ' TB'", "|| 'T'").replace("|| ' B'", "|| 'B'")


@query(f"""
WITH {_PAGES}, s AS (SELECT *, CAST(length(text) * n_images AS DOUBLE) AS f FROM pg), l AS (SELECT *, {_LISTED} AS listed FROM s),
c AS (SELECT file_hash, CAST(sum(length(text) * (n_images + 1)) AS BIGINT) AS file_bytes, round(sum(CASE WHEN n_images > 0 THEN CAST(left(listed, length(listed) - 1) AS DOUBLE) * CASE right(listed, 1) WHEN 'B' THEN 1 WHEN 'K' THEN 1024 ELSE 1048576 END ELSE 0 END), 3) AS image_bytes FROM l GROUP BY 1)
SELECT file_hash, file_bytes, image_bytes, CASE WHEN image_bytes / greatest(1, file_bytes) >= 0.5 THEN 'image_heavy' WHEN image_bytes / greatest(1, file_bytes) <= 0.25 THEN 'typed' ELSE 'mixed' END AS pdf_class FROM c
""")
def image_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image bytes of a file, summed from sizes as a listing shows them, as a share of the file, and the class that gives; a page's image counts as large as its text."""
    size = F.length("text") * F.col("n_images")
    listed = F.regexp_replace(F.regexp_replace(human_bytes(size), " ", ""), "([BKMG])B$", "$1")
    c = G.distinct_pages(load(spark, sf_dir, "scan_pages")).groupBy("file_hash").agg(F.sum(F.length("text") * (F.col("n_images") + 1)).cast("bigint").alias("file_bytes"), F.round(F.sum(F.when(F.col("n_images") > 0, parse_size(listed)).otherwise(0.0)), 3).alias("image_bytes"))
    return c.select("*", G.pdf_class(F.col("image_bytes") / F.greatest(F.lit(1), "file_bytes")).alias("pdf_class"))


_DELETE = "regexp_extract(lower(path), '[^/](\\.[^./]+)$', 1)"


@query(f"""
WITH s AS {_current()}, a AS (SELECT path, status, {_DELETE} AS suffix, regexp_replace(path, '/[^/]*$', '') AS folder FROM s),
k AS (SELECT *, CASE WHEN suffix IN ('.docx', '.txt', '.ppt', '.pptx', '.odt') THEN CASE WHEN status = 'failed' THEN 'failed' ELSE 'converted' END
  WHEN suffix IN ('.m', '.matcad', '.htm', '.html', '.mp3', '.mp4', '.aac', '.ogg', '.mat', '.tmp', '.dthumb', '.eml', '.ods', '.xlsx', '.xls') THEN 'deleted' ELSE 'kept' END AS outcome FROM a)
SELECT count(*) FILTER (WHERE outcome = 'converted') AS converted, count(*) FILTER (WHERE outcome = 'failed') AS failed, count(*) FILTER (WHERE outcome = 'deleted') AS deleted, count(*) FILTER (WHERE outcome = 'kept') AS kept,
  (SELECT count(*) FROM (SELECT folder FROM k GROUP BY folder HAVING bool_and(outcome = 'deleted'))) AS folders_removed FROM k
""")
def conversion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files converted, failed, deleted and kept, and the folders that are empty then."""
    state = L.current(load(spark, sf_dir, "ledger")).select("path", "status", file_action(F.col("path")).alias("action"), F.regexp_replace("path", "/[^/]*$", "").alias("folder"))
    outcome = F.when(F.col("action") == "convert", F.when(F.col("status") == "failed", "failed").otherwise("converted")).when(F.col("action") == "delete", "deleted").otherwise("kept")
    names = ("converted", "failed", "deleted", "kept")
    folders = state.withColumn("outcome", outcome).groupBy("folder").agg(*[F.count_if(F.col("outcome") == n).alias(n) for n in names])
    gone = (F.col("deleted") > 0) & (F.col("converted") + F.col("failed") + F.col("kept") == 0)
    return folders.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names], F.count_if(gone).alias("folders_removed"))


@query(f"""
WITH r AS (SELECT DISTINCT path, lower(trim(status)) AS status, coalesce(finished_at, started_at, discovered_at) AS moment, {_STEP} AS step FROM ledger WHERE path IS NOT NULL),
c AS (SELECT path, status, lag(status) OVER (PARTITION BY path ORDER BY moment NULLS FIRST, step, status) AS before FROM r)
SELECT before AS from_status, status AS to_status, count(*) AS changes, count(DISTINCT path) AS paths FROM c WHERE before IS NOT NULL AND before <> status GROUP BY 1, 2
""")
def status_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes from one status to another; a row that changes nothing, and a path's first row, don't count."""
    return L.changes(load(spark, sf_dir, "ledger")).groupBy("from_status", "to_status").agg(F.count("*").alias("changes"), F.count_distinct("path").alias("paths"))


@query(f"""
WITH s AS {_current()}, m AS (SELECT max(coalesce(finished_at, started_at, discovered_at)) AS last, min(coalesce(finished_at, started_at, discovered_at)) AS first FROM ledger WHERE path IS NOT NULL),
c AS (SELECT count(*) AS total, count(*) FILTER (WHERE status = 'completed') AS completed, count(*) FILTER (WHERE status = 'skipped') AS skipped FROM s)
SELECT 'session_' || CAST(CAST(floor(epoch(CASE WHEN total - completed - skipped > 0 THEN first ELSE last END)) AS BIGINT) AS VARCHAR) AS session_id, total - completed - skipped > 0 AS resumed, CASE WHEN total - completed - skipped > 0 THEN total ELSE 0 END AS total, CASE WHEN total - completed - skipped > 0 THEN completed ELSE 0 END AS completed FROM c, m
""")
def session_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session that goes on: the one that began with the ledger if anything is left of it, else a new one with its counters at 0."""
    return L.session(load(spark, sf_dir, "ledger"))


@query(f"WITH s AS {_current()} SELECT path, status, reason, file_size, chunks, duplicates, (SELECT count(*) FROM s) AS total FROM s")
def session_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary and details of all files written as JSON and read back."""
    where = scratch_dir(spark)
    state = L.current(load(spark, sf_dir, "ledger"))
    L.summary(state).write.json(f"{where}/summary")
    state.write.json(f"{where}/details")
    summary = spark.read.schema("total bigint").json(f"{where}/summary")
    details = spark.read.schema("path string, status string, reason string, file_size bigint, chunks int, duplicates int").json(f"{where}/details")
    return details.withColumn("_", F.lit(1)).join(F.broadcast(summary.withColumn("_", F.lit(1))), "_").drop("_")


_LAST_FILE = "SELECT path, max(file_size) AS file_size, max(file_mtime) AS file_mtime FROM ledger WHERE path IS NOT NULL AND file_size IS NOT NULL AND file_mtime IS NOT NULL GROUP BY 1"


@query(f"""
WITH f AS ({_LAST_FILE})
SELECT path, path || ':' || file_mtime AS path_key,
  left(sha256('{{"args": [{{"file_size": ' || file_size || ', "modified_time": ' || file_mtime || ', "operation": "text", "pdf_path": ' || CAST(to_json(path) AS VARCHAR) || '}}], "kwargs": {{}}}}'), 16) AS operation_key,
  left(sha256('{{"args": ["embedding", "' || sha1(path) || '", "bge-m3"], "kwargs": {{}}}}'), 16) AS embedding_key FROM f
""")
def cache_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of caches: by path and time, and hashes of canonical JSON arguments."""
    f = load(spark, sf_dir, "ledger").where("path is not null and file_size is not null and file_mtime is not null").groupBy("path").agg(F.max("file_size").alias("file_size"), F.max("file_mtime").alias("file_mtime"))
    operation = canonical_key({"file_size": F.col("file_size"), "modified_time": F.col("file_mtime"), "operation": json_text(F.lit("text")), "pdf_path": json_text(F.col("path"))})
    return f.select("path", F.concat_ws(":", "path", "file_mtime").alias("path_key"), operation.alias("operation_key"), canonical_key(json_text(F.lit("embedding")), json_text(F.sha1("path")), json_text(F.lit("bge-m3"))).alias("embedding_key"))


@query("""
WITH c AS (SELECT coalesce(collection, '') AS collection, embedding FROM chunk_vectors)
SELECT collection, CASE WHEN collection = 'course_bly' THEN count(embedding) ELSE 2 * count(*) END AS rows FROM c GROUP BY 1 HAVING rows > 0
""")
def collection_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors added to their collections twice; then one collection is made anew, and the others stay as they are."""
    where = f"{scratch_dir(spark)}/collections"
    rows = load(spark, sf_dir, "chunk_vectors").select("vec_id", "id", F.coalesce(F.nullif("collection", F.lit("")), F.lit("none")).alias("collection"), "embedding")
    sinks.append_collection(rows, where)
    sinks.append_collection(rows, where)
    sinks.replace_collections(rows.where("collection = 'course_bly' and embedding is not null"), where)
    back = spark.read.schema("vec_id bigint, id string, collection string").parquet(where)
    return back.groupBy(F.when(F.col("collection") == "none", "").otherwise(F.col("collection")).alias("collection")).agg(F.count("*").alias("rows"))


@query("""
WITH l AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events),
w AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type <> 'error')
SELECT w.user_id, round(w.value, 6) AS value FROM w JOIN l ON l.user_id = w.user_id AND l.rn = 1 WHERE w.rn = 1 AND l.event_type <> 'error'
""")
def cache_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys written, written again, and deleted where the last event is an error."""
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    order = [F.desc("ts"), F.desc("event_id")]
    written = dedupe.latest(events.where("event_type <> 'error'"), ["user_id"], order)
    gone = dedupe.latest(events, ["user_id"], order).where("event_type = 'error'")
    return sinks.without_keys(written, gone, "user_id").select("user_id", F.round("value", 6).alias("value"))


@query("""
WITH n AS (SELECT max(epoch_us(ts)) / 1000000.0 AS now FROM events),
e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN now ELSE epoch_us(ts) / 1000000.0 END AS created_at, CASE WHEN event_type = 'error' THEN 3600.0 ELSE 86400.0 * (1 + user_id % 20) END AS ttl, event_type = 'error' AS upgraded, now FROM events, n)
SELECT upgraded, count(*) AS entries, round(min(created_at), 3) AS oldest FROM e WHERE now - created_at <= ttl GROUP BY 1
""")
def cache_upgrade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache loaded: entries of the old form, without a time, get the present one and an hour to live; expired ones are dropped."""
    e = load(spark, sf_dir, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    now = F.lit(e.agg(F.max("at")).first()[0]).cast("double")
    old = F.col("event_type") == "error"
    entries = e.select(F.when(~old, F.col("at")).alias("created_at"), F.when(~old, F.lit(86400.0) * (1 + F.col("user_id") % 20)).alias("ttl"))
    loaded = usage.upgraded(entries, now, 3600.0)
    return loaded.where(~usage.expired(F.col("created_at"), F.col("ttl"), now)).groupBy("upgraded").agg(F.count("*").alias("entries"), F.round(F.min("created_at"), 3).alias("oldest"))


_MINUTE = "PARTITION BY user_id, family ORDER BY ts RANGE BETWEEN INTERVAL '59999999 microseconds' PRECEDING AND CURRENT ROW"
_PER_MINUTE = "CASE family " + " ".join(f"WHEN '{m}' THEN {n}" for m, (_, n) in RATE_LIMITS.items()) + " END"


@query(f"""
WITH e AS (SELECT event_id, user_id, {_FAMILY} AS family, ts FROM events), w AS (SELECT *, count(*) OVER ({_MINUTE}) AS in_window, min(ts) OVER ({_MINUTE}) AS oldest FROM e)
SELECT event_id, family, in_window, in_window < {_PER_MINUTE} AS available, CASE WHEN in_window >= {_PER_MINUTE} THEN round(61 - CAST(date_diff('microsecond', oldest, ts) AS DOUBLE) / 1000000, 6) ELSE 0.0 END AS wait FROM w
""")
def minute_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of a key and model family in the 60 seconds up to each, whether the limit a minute leaves room for one more, and the wait if not."""
    e = load(spark, sf_dir, "events").select("event_id", "user_id", model_family(_model(F.col("event_type"))).alias("family"), "ts")
    w = usage.rate_window(e, ["user_id", "family"], "ts", 60)
    _, most = usage.limits_of(F.col("family"))
    wait = F.when(F.col("in_window") >= most, F.round(usage.wait_seconds(F.col("ts"), F.col("oldest"), 60), 6)).otherwise(0.0)
    return w.select("event_id", "family", "in_window", (F.col("in_window") < most).alias("available"), wait.alias("wait"))


@query(f"WITH {_INDEXED} SELECT id, metadata.course_code AS course_code, metadata.chunk_index AS chunk_index FROM indexed WHERE metadata.semester = '1' ORDER BY id LIMIT 25")
def limited_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 25 chunks by id of those with a metadata value."""
    rows = indexed_chunks(spark, sf_dir).select("id", F.col("metadata.course_code").alias("course_code"), F.col("metadata.chunk_index").alias("chunk_index"), F.col("metadata.semester").alias("semester"))
    return retrieval.equal_to(rows, {"semester": "1"}, ["id", "course_code", "chunk_index"], 25, ["id"])


_USABLE = "embedding IS NOT NULL AND len(embedding) = 128 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"
_COS128 = "round(1 - list_sum(list_transform(range(1, 129), lambda i: CAST(q.embedding[i] AS DOUBLE) * CAST(v.embedding[i] AS DOUBLE))) / sqrt(list_sum(list_transform(q.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) * list_sum(list_transform(v.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 9)"


@query(f"""
WITH t AS (SELECT id, min(text) AS text FROM chunks WHERE id IS NOT NULL AND text IS NOT NULL GROUP BY 1),
v AS (SELECT vec_id, embedding, text FROM chunk_vectors JOIN t USING (id) WHERE {_USABLE}),
q AS (SELECT vec_id, embedding FROM chunk_vectors WHERE vec_id % 100 = 0 AND {_USABLE}),
d AS (SELECT q.vec_id AS query_id, v.vec_id, v.text, {_COS128} AS distance FROM v CROSS JOIN q),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS place FROM d)
SELECT query_id, count(*) AS chunks, md5(string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY place)) AS context FROM r WHERE place <= 20 GROUP BY 1
""")
def context_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest chunks of every hundredth vector joined into one context, as a generator would get it."""
    texts = load(spark, sf_dir, "chunks").where("id is not null and text is not null").groupBy("id").agg(F.min("text").alias("text"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    usable = load(spark, sf_dir, "chunk_vectors").where((F.size("embedding") == 128) & finite)
    known = usable.join(texts.select("id"), "id", "left_semi").select("vec_id", F.lit("all").alias("collection"), "embedding")
    near = retrieval.nearest(known, usable.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), 20)
    return retrieval.contexts(near, usable.select("vec_id", "id").join(texts, "id")).select("query_id", "chunks", F.md5("context").alias("context"))


@query("""
WITH u AS (SELECT path FROM file_index UNION SELECT path FROM ledger UNION SELECT path FROM documents),
k AS (SELECT path FROM u WHERE path IS NOT NULL AND (lower(path) LIKE '%.pdf' OR lower(path) LIKE '%.pptx') AND NOT regexp_matches(path, '(^|/)~\\$[^/]*$'))
SELECT path, row_number() OVER (ORDER BY lower(path), path) AS place FROM k
""")
def gathered_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of several lists, each once, in the order of their paths in lower case."""
    from quirebase.operators.ordering import number_rows

    every = [load(spark, sf_dir, t).select("path") for t in ("file_index", "ledger", "documents")]
    paths = every[0].unionByName(every[1]).unionByName(every[2]).where("path is not null").distinct()
    return number_rows(paths.where(discoverable(F.col("path"), (".pdf", ".pptx"), prune=False)), [], [F.lower("path"), "path"])


@query("""
WITH m AS (SELECT DISTINCT id, unnest(['chunk_index', 'group_key', 'is_duplicate', 'options']) AS key, unnest([CAST(metadata.chunk_index AS VARCHAR), metadata.group_key, CASE WHEN metadata.is_duplicate THEN 'true' END, '["' || metadata.level || '","' || metadata.semester || '"]']) AS value FROM chunks)
SELECT id, key, value FROM m WHERE value IS NOT NULL
""")
def sanitised_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of open form as a store takes it: scalars as they are, lists and objects as JSON text."""
    chunks = load(spark, sf_dir, "chunks").select("id", F.to_json(F.struct("metadata.chunk_index", "metadata.group_key", "metadata.is_duplicate", F.array("metadata.level", "metadata.semester").alias("options"))).alias("json"))
    return chunks.distinct().select("id", F.explode(retrieval.sanitised(F.col("json"))).alias("key", "value")).where("value is not null").distinct()


@query(f"WITH {_COURSES} SELECT count(*) AS courses, count(*) AS ids FROM courses")
def course_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Courses added as documents under ids of their own; as many ids as courses."""
    where = f"{scratch_dir(spark)}/courses"
    sinks.append_with_ids(_courses(spark, sf_dir), where)
    return spark.read.schema("id string, code string").parquet(where).agg(F.count("*").alias("courses"), F.count_distinct("id").alias("ids"))
