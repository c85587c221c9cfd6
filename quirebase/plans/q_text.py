"""Queries on the text of documents and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirebase.functions import text as X
from quirebase.operators import dedupe
from quirebase.operators.ordering import number_rows
from quirebase.plans.registry import query
from quirebase.session import load

WS = X.SPACE
NWS = X.NOT_SPACE


def sql_strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def sql_paragraphs(x: str) -> str:
    return f"list_filter(list_transform(string_split_regex(regexp_replace(coalesce({x}, ''), '\\r\\n?', chr(10), 'g'), '\\n{WS}*\\n'), lambda p: {sql_strip('p')}), lambda p: p <> '')"


def sql_lines(x: str) -> str:
    return f"list_filter(list_transform(string_split_regex(coalesce({x}, ''), '\\r\\n?|\\n'), lambda p: {sql_strip('p')}), lambda p: p <> '')"


def sql_fold(parts: str, joins: str) -> str:
    """Greedy merge; ``joins`` compares a.open with b.open. Empty lists give an empty list."""
    items = f"list_transform({parts}, lambda p: {{'out': CAST([] AS VARCHAR[]), 'open': p}})"
    step = f"lambda a, b: CASE WHEN {joins} THEN {{'out': a.out, 'open': a.open || chr(10) || chr(10) || b.open}} ELSE {{'out': list_append(a.out, a.open), 'open': b.open}} END"
    return f"CASE WHEN len({parts}) = 0 THEN NULL ELSE list_reduce({items}, {step}) END"


_MERGE = "length(a.open) < 200 OR length(a.open) + 2 + length(b.open) <= 1600"
SQL_CHUNKS = f"""
    parts AS (SELECT *, {sql_paragraphs('text')} AS paras FROM documents),
    folded AS (SELECT *, {sql_fold('paras', _MERGE)} AS f FROM parts),
    base AS (SELECT *, CASE WHEN f IS NULL THEN CAST([] AS VARCHAR[]) ELSE list_append(f.out, f.open) END AS base FROM folded),
    placed AS (SELECT *, unnest(base) AS body, unnest(range(0, len(base))) AS chunk_index FROM base WHERE len(base) > 0),
    tailed AS (SELECT *, CASE WHEN chunk_index > 0 THEN right(base[chunk_index], 80) END AS tail FROM placed),
    chunked AS (SELECT *, CASE WHEN chunk_index = 0 THEN body
        ELSE (CASE WHEN strpos(tail, ' ') > 1 THEN substring(tail, strpos(tail, ' ') + 1) ELSE tail END) || ' ' || body END AS chunk FROM tailed)"""


def exploded_chunks(docs: DataFrame) -> DataFrame:
    """(doc columns, chunk_index, total_chunks, chunk) of every document with text."""
    chunks = docs.withColumn("chunks", X.chunk(X.paragraphs(F.col("text"))))
    return chunks.select(*[c for c in docs.columns], F.size("chunks").alias("total_chunks"), F.posexplode("chunks").alias("chunk_index", "chunk"))


@query(f"""
WITH {SQL_CHUNKS},
uniq AS (SELECT lang, doc_id, chunk, sha1(chunk) AS h FROM chunked)
SELECT coalesce(lang, '') AS lang, count(DISTINCT doc_id) AS documents, count(*) AS chunks, count(DISTINCT h) AS unique_chunks,
       CAST(sum(greatest(1, length(chunk) // 4)) AS BIGINT) AS token_estimate
FROM uniq GROUP BY 1
""")
def chunk_language_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = exploded_chunks(load(spark, sf_dir, "documents").select("doc_id", "lang", "text")).select(F.coalesce("lang", F.lit("")).alias("lang"), "doc_id", "chunk")
    return chunks.groupBy("lang").agg(
        F.count_distinct("doc_id").alias("documents"), F.count("*").alias("chunks"), F.count_distinct(F.sha1("chunk")).alias("unique_chunks"), F.sum(X.token_estimate(F.col("chunk"))).alias("token_estimate")
    )


@query(f"""
WITH {SQL_CHUNKS}
SELECT doc_id, chunk_index, len(base) AS total_chunks, sha1(chunk) AS chunk_hash, length(chunk) AS n_chars,
       sha1(concat_ws(':', file_hash, CAST(chunk_index AS VARCHAR), sha1(chunk))) AS chunk_id
FROM chunked
""")
def chunk_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = exploded_chunks(load(spark, sf_dir, "documents").select("doc_id", "file_hash", "text"))
    return chunks.select("doc_id", "chunk_index", "total_chunks", F.sha1("chunk").alias("chunk_hash"), F.length("chunk").alias("n_chars"), dedupe.chunk_id(F.col("file_hash"), F.col("chunk_index"), F.sha1("chunk")).alias("chunk_id"))


@query(f"""
WITH l AS (SELECT doc_id, {sql_lines('text')} AS ls FROM documents),
x AS (SELECT doc_id, unnest(ls) AS chunk, unnest(range(0, len(ls))) AS chunk_index FROM l WHERE len(ls) > 0),
h AS (SELECT doc_id, chunk_index, sha1(chunk) AS chunk_hash FROM x),
f AS (SELECT *, min(chunk_index) OVER (PARTITION BY doc_id, chunk_hash) AS first_index FROM h),
u AS (SELECT *, sum(CASE WHEN first_index = chunk_index THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY chunk_index) - 1 AS running FROM f)
SELECT doc_id, chunk_index, chunk_hash, first_index <> chunk_index AS is_duplicate,
       CASE WHEN first_index <> chunk_index THEN CAST(max(CASE WHEN first_index = chunk_index THEN running END) OVER (PARTITION BY doc_id, chunk_hash) AS BIGINT) END AS duplicate_of_index,
       CASE WHEN first_index <> chunk_index THEN first_index END AS duplicate_of_original
FROM u
""")
def chunk_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First occurrences and repeats of lines within each document."""
    lines = load(spark, sf_dir, "documents").select("doc_id", F.posexplode(X.lines(F.col("text"))).alias("chunk_index", "chunk"))
    return dedupe.mark_repeats(lines.select("doc_id", "chunk_index", F.sha1("chunk").alias("chunk_hash")))


@query(f"""
WITH src AS (SELECT doc_id, {sql_paragraphs("regexp_replace(coalesce(text, ''), '\\n?-+ PAGE BREAK -+\\n?', chr(10) || chr(10), 'g')")} AS paras FROM documents),
f AS (SELECT doc_id, {sql_fold('paras', 'length(a.open) + 2 + length(b.open) < 1000')} AS f FROM src),
c AS (SELECT doc_id, CASE WHEN f IS NULL THEN CAST([] AS VARCHAR[]) ELSE list_append(f.out, f.open) END AS cs FROM f)
SELECT doc_id, len(cs) AS chunks, md5(array_to_string(cs, chr(1))) AS content FROM c
""")
def chunk_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", X.chunk_by_characters(F.col("text")).alias("cs"))
    return docs.select("doc_id", F.size("cs").alias("chunks"), F.md5(F.array_join("cs", "\x01")).alias("content"))


def _sql_words(parts: str, tail: str) -> str:
    n = lambda x: f"len(list_filter(string_split_regex({x}, '{WS}+'), lambda w: w <> ''))"
    held = f"list_filter(string_split_regex(a.open, '{WS}+'), lambda w: w <> '')"
    items = f"list_transform({parts}, lambda p: {{'out': CAST([] AS VARCHAR[]), 'open': p}})"
    again = f"array_to_string(list_slice({held}, greatest(len({held}) - 49, 1), len({held})), ' ') || chr(10) || chr(10) || b.open"
    fresh = again if not tail else f"CASE WHEN len({held}) >= 50 THEN {again} ELSE b.open END"
    step = f"lambda a, b: CASE WHEN {n('a.open')} + {n('b.open')} <= 300 THEN {{'out': a.out, 'open': a.open || chr(10) || chr(10) || b.open}} ELSE {{'out': list_append(a.out, a.open), 'open': {fresh}}} END"
    folded = f"CASE WHEN len({parts}) = 0 THEN NULL ELSE list_reduce({items}, {step}) END"
    return f"""
f AS (SELECT doc_id, {folded} AS f FROM src),
c AS (SELECT doc_id, list_filter(CASE WHEN f IS NULL THEN CAST([] AS VARCHAR[]) ELSE list_append(f.out, f.open) END, lambda c: {n('c')} >= 20) AS cs FROM f)
SELECT doc_id, len(cs) AS chunks, md5(array_to_string(cs, chr(1))) AS content FROM c"""


@query(f"WITH src AS (SELECT doc_id, {sql_lines('text')} AS paras FROM documents), {_sql_words('paras', '')}")
def chunk_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word chunks over lines, so that documents without blank lines are divided too."""
    docs = load(spark, sf_dir, "documents").select("doc_id", X.chunk_by_words(X.lines(F.col("text"))).alias("cs"))
    return docs.select("doc_id", F.size("cs").alias("chunks"), F.md5(F.array_join("cs", "\x01")).alias("content"))


@query(f"WITH src AS (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10) || chr(10)), lambda p: {sql_strip('p')}), lambda p: p <> '') AS paras FROM documents), {_sql_words('paras', 'full')}")
def chunk_words_full_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word chunks over parts between two line feeds; only full overlaps are repeated."""
    parts = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n\n"), X.strip), lambda p: p != "")
    docs = load(spark, sf_dir, "documents").select("doc_id", X.chunk_by_words(parts, full_overlap_only=True).alias("cs"))
    return docs.select("doc_id", F.size("cs").alias("chunks"), F.md5(F.array_join("cs", "\x01")).alias("content"))


_ENGLISH_SQL = " + ".join(f"CASE WHEN contains(lower(text), ' {w} ') THEN 1 ELSE 0 END" for w in X.ENGLISH)


@query(f"""
WITH q AS (SELECT doc_id, text, length(text) AS n_characters,
    len(list_filter(string_split_regex(text, '{WS}+'), lambda w: w <> '')) AS n_words,
    length(regexp_replace(text, '{WS}+', '', 'g')) AS n_letters,
    len(list_filter(string_split_regex(text, '[.!?]+'), lambda s: length(regexp_replace(s, '{WS}+', '', 'g')) > 0)) AS n_sentences
  FROM documents WHERE text IS NOT NULL)
SELECT doc_id, n_characters, n_words, n_sentences, CASE WHEN {_ENGLISH_SQL} >= 3 THEN 'english' ELSE 'unknown' END AS language,
  CASE WHEN n_words > 0 AND n_sentences > 0 THEN round(greatest(0.0, least(100.0, CAST(100 AS DOUBLE) - (CAST(n_words AS DOUBLE) / n_sentences * 0.5 + CAST(n_letters AS DOUBLE) / n_words * 2.0))), 6) END AS readability
FROM q
""")
def text_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    counted = load(spark, sf_dir, "documents").where("text is not null").select(
        "doc_id", F.length(text).alias("n_characters"), X.word_count(text).alias("n_words"), X.sentence_count(text).alias("n_sentences"), X.effective_length(text).alias("n_letters"), X.language_flag(text).alias("language")
    )
    score = X.readability_of(F.col("n_words"), F.col("n_letters"), F.col("n_sentences"))
    return counted.select("doc_id", "n_characters", "n_words", "n_sentences", "language", F.round(score, 6).alias("readability"))


_TYPES_SQL = " ".join(f"WHEN regexp_matches(lower(text), '{p}') THEN '{t}'" for p, t in X.DOCUMENT_TYPES_ANY_SCRIPT)


@query(f"SELECT doc_id, CASE {_TYPES_SQL} END AS document_type FROM documents WHERE text IS NOT NULL")
def document_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type by keyword of every text, whatever its script."""
    return load(spark, sf_dir, "documents").where("text is not null").select("doc_id", X.document_type(F.col("text")).alias("document_type"))


@query(f"SELECT doc_id, CASE {_TYPES_SQL} END AS document_type FROM documents WHERE text IS NOT NULL")
def document_type_all_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same under its earlier name."""
    return document_type(spark, sf_dir)


@query(f"""
SELECT doc_id, CAST(length(regexp_replace(coalesce(text, ''), '{WS}+', '', 'g')) AS INTEGER) AS effective_chars,
  CASE WHEN length(regexp_replace(coalesce(text, ''), '{WS}+', '', 'g')) = 0 THEN 'empty_text'
       WHEN length(regexp_replace(coalesce(text, ''), '{WS}+', '', 'g')) < 50 THEN 'needs_ocr' ELSE 'text_layer' END AS gate
FROM documents
""")
def effective_text_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = X.effective_length(F.col("text"))
    return load(spark, sf_dir, "documents").select("doc_id", n.alias("effective_chars"), F.when(n == 0, "empty_text").when(n < 50, "needs_ocr").otherwise("text_layer").alias("gate"))


@query("""
WITH t AS (SELECT source, lang, greatest(1, coalesce(length(text), 0) // 4) AS tokens FROM documents)
SELECT coalesce(source, '') AS source, CAST(grouping(source) AS BIGINT) AS is_total, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) AS documents,
  CAST(CAST(sum(tokens) AS DECIMAL(18,0)) * CAST('0.012' AS DECIMAL(9,6)) / 1000000 AS DECIMAL(18,9)) AS cost
FROM t GROUP BY ROLLUP(source)
""")
def token_cost_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quirebase.functions.values import cost

    tokens = load(spark, sf_dir, "documents").select("source", X.token_estimate(F.col("text")).alias("tokens"))
    rolled = tokens.rollup("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents"), F.grouping("source").cast("bigint").alias("is_total"))
    return rolled.select(F.coalesce("source", F.lit("")).alias("source"), "is_total", "tokens", "documents", cost(F.col("tokens")).alias("cost"))


@query("""
WITH t AS (SELECT id, metadata.file_hash AS file_hash, metadata.chunk_index AS chunk_index, greatest(1, length(text) // 4) AS tokens FROM (SELECT DISTINCT * FROM chunks) WHERE metadata.file_hash IS NOT NULL AND text IS NOT NULL),
d AS (SELECT file_hash, chunk_index, max(tokens) AS tokens FROM t GROUP BY 1, 2),
l AS (SELECT file_hash, list(tokens ORDER BY chunk_index) AS ts FROM d GROUP BY 1),
f AS (SELECT file_hash, list_reduce(list_transform(ts, lambda x: {'batches': CAST([] AS BIGINT[]), 'open': CAST(x AS BIGINT)}),
   lambda a, b: CASE WHEN a.open + b.open > 2000 THEN {'batches': list_append(a.batches, a.open), 'open': b.open} ELSE {'batches': a.batches, 'open': a.open + b.open} END) AS f FROM l)
SELECT file_hash, len(f.batches) + 1 AS batches, CAST(list_max(list_append(f.batches, f.open)) AS BIGINT) AS fullest FROM f
""")
def token_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of each file in order, in batches within a token budget."""
    t = load(spark, sf_dir, "chunks").where("metadata.file_hash is not null and text is not null")
    d = t.groupBy(F.col("metadata.file_hash").alias("file_hash"), F.col("metadata.chunk_index").alias("chunk_index")).agg(F.max(X.token_estimate(F.col("text"))).alias("tokens"))
    return dedupe.budget_batches(d, "file_hash", "chunk_index", "tokens", 2000).groupBy("file_hash").agg(F.count("*").alias("batches"), F.max("tokens").alias("fullest"))


_MUTTER = X.MUTTERING.replace("'", "''")


@query(f"""
WITH s AS (SELECT item_id, string_split(regexp_replace({sql_strip("coalesce(explanation, '') || ' ' || question")}, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)) AS parts FROM exam_items)
SELECT item_id, regexp_replace({sql_strip(f"array_to_string(list_filter(parts, lambda p: NOT regexp_matches(p, '{_MUTTER}')), ' ')")}, '{WS}+', ' ', 'g') AS cleaned,
  CAST(len(parts) AS INTEGER) AS sentences FROM s
""")
def sentence_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat_ws(" ", F.coalesce("explanation", F.lit("")), "question")
    return load(spark, sf_dir, "exam_items").select("item_id", X.drop_muttering(text).alias("cleaned"), F.size(F.split(X.strip(text), r"(?<=[.!?])" + WS + "+")).alias("sentences"))


@query(f"""
WITH s AS (SELECT doc_id, {sql_strip(f"regexp_replace(coalesce(text, ''), '{WS}+', ' ', 'g')")} AS flat FROM documents)
SELECT doc_id, CASE WHEN length(flat) > 240 THEN left(flat, 240) || '…' ELSE flat END AS snapshot FROM s
""")
def log_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", X.snapshot(F.col("text")).alias("snapshot"))


@query("""
SELECT doc_id, sha1(text) AS sha1_text, left(sha256(text), 16) AS file_hash, md5(text) AS md5_text, coalesce(left(sha256(text), 16), 'unknown') AS hash_or_unknown,
  concat(coalesce(file_hash, ''), '.text.', coalesce(lang, ''), '.txt.cache') AS text_key, concat(coalesce(file_hash, ''), '.ocr.', coalesce(lang, ''), '.dpi300.fallback.cache') AS ocr_key
FROM documents
""")
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, fh, lang = F.col("text"), F.coalesce("file_hash", F.lit("")), F.coalesce("lang", F.lit(""))
    digest = F.left(F.sha2(text, 256), F.lit(16))
    return load(spark, sf_dir, "documents").select(
        "doc_id", F.sha1(text).alias("sha1_text"), digest.alias("file_hash"), F.md5(text).alias("md5_text"), F.coalesce(digest, F.lit("unknown")).alias("hash_or_unknown"),
        F.concat(fh, F.lit(".text."), lang, F.lit(".txt.cache")).alias("text_key"), F.concat(fh, F.lit(".ocr."), lang, F.lit(".dpi300.fallback.cache")).alias("ocr_key"),
    )


@query("""
SELECT doc_id, CAST((row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY doc_id) - 1) // 96 AS BIGINT) AS batch_no FROM documents
""")
def fixed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 96 documents within each source."""
    docs = load(spark, sf_dir, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"))
    return number_rows(docs, ["source"], ["doc_id"]).select("doc_id", F.floor((F.col("place") - 1) / 96).cast("bigint").alias("batch_no"))
