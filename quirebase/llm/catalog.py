"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quirebase.llm.history import repeated_arrivals
from quirebase.llm.leaks import LeakParams, find_leaks, near_leaks
from quirebase.llm.mojibake import damaged_documents, restored_documents
from quirebase.llm.neighbours import ForestParams, neighbour_rows, similar_pairs
from quirebase.llm.packing import fill_report, pack
from quirebase.llm.scans import line_findings, paragraphs
from quirebase.llm.tokens import token_counts, token_totals
from quirebase.llm.versions import VersionParams, version_groups, version_pairs
from quirebase.session import load

Query = Callable[[SparkSession, str], DataFrame]


def p1_token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return token_totals(docs, token_counts(docs), load(spark, sf_dir, "billing_state"))


def p1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(load(spark, sf_dir, "documents"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_findings(load(spark, sf_dir, "scan_pages"))


def p2_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs(load(spark, sf_dir, "scan_pages"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_pairs(load(spark, sf_dir, "chunk_vectors"), 0.70)


def p3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_rows(load(spark, sf_dir, "chunk_vectors"), ForestParams(trees=4, probes=32)).selectExpr("vec_id", "neighbour", "round(similarity, 4) AS similarity")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_arrivals(load(spark, sf_dir, "intake"))


_VERSIONS = VersionParams(words=3, similarity=0.6)


def _chunk_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "chunks").select("metadata.chunk_hash", "text")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_pairs(_chunk_texts(spark, sf_dir), _VERSIONS).selectExpr("hash_a AS chunk_hash_a", "hash_b AS chunk_hash_b")


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_groups(_chunk_texts(spark, sf_dir), _VERSIONS)


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_counts(load(spark, sf_dir, "documents")), load(spark, sf_dir, "pack_targets"))


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_report(p6_containers(spark, sf_dir))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "exam_items"))


def p7_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that one inserted, deleted or replaced word tells from ten words of an item."""
    return near_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "exam_items"), params=LeakParams(max_edits=1))


def p7_near_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that at most two such edits tell from twenty words of an item."""
    return near_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "exam_items"), params=LeakParams(window=20, max_edits=2))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_documents(load(spark, sf_dir, "documents"))


def p8_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restored_documents(load(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in (p1_token_totals, p1_token_counts, p2_found, p2_paragraphs, p3_found, p3_neighbours, p4_found, p5_found, p5_groups, p6_containers, p6_fill, p7_found, p7_near, p7_near_long, p8_found, p8_restored)}


#: SQL of the queries that it can express; the others are tested against brute force.
_SQL = {
    "p4_found": """
WITH RECURSIVE f AS (SELECT arrival_id, min(batch_no) AS batch_no, min(file_hash) AS file_hash FROM intake GROUP BY 1),
c AS (SELECT DISTINCT arrival_id, chunk_hash FROM intake WHERE chunk_hash IS NOT NULL),
n AS (SELECT arrival_id, count(*) AS n FROM c GROUP BY 1),
shared AS (SELECT x.arrival_id AS old, y.arrival_id AS new, count(*) AS k FROM c x JOIN c y ON x.chunk_hash = y.chunk_hash JOIN f a ON a.arrival_id = x.arrival_id JOIN f b ON b.arrival_id = y.arrival_id WHERE a.batch_no < b.batch_no GROUP BY 1, 2),
sim AS (SELECT old, new FROM shared JOIN n a ON a.arrival_id = old JOIN n b ON b.arrival_id = new WHERE k >= 0.5 * (a.n + b.n - k)
  UNION SELECT a.arrival_id, b.arrival_id FROM f a JOIN f b ON a.file_hash = b.file_hash AND a.batch_no < b.batch_no),
acc AS (SELECT 0 AS b, (SELECT list(arrival_id) FROM f WHERE batch_no = 0) AS ids
  UNION ALL SELECT b + 1, list_concat(ids, coalesce((SELECT list(f.arrival_id) FROM f WHERE f.batch_no = acc.b + 1 AND NOT EXISTS (SELECT 1 FROM sim WHERE sim.new = f.arrival_id AND list_contains(acc.ids, sim.old))), CAST([] AS BIGINT[]))) FROM acc WHERE b < 20),
ok AS (SELECT unnest(ids) AS id FROM acc WHERE b = 20)
SELECT DISTINCT least(old, new) AS accepted_id, greatest(old, new) AS arrival_id FROM sim JOIN ok ON ok.id = sim.old
""",
    "p5_found": """
WITH t AS (SELECT metadata.chunk_hash AS h, min(text) AS text FROM chunks WHERE text IS NOT NULL GROUP BY 1),
w AS (SELECT h, list_transform(regexp_extract_all(text, '[\\p{L}\\p{N}]+'), lambda x: lower(x)) AS w FROM t),
s AS (SELECT DISTINCT h, unnest(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) AS g FROM w WHERE len(w) >= 3),
n AS (SELECT h, count(*) AS n FROM s GROUP BY 1),
b AS (SELECT x.h AS a, y.h AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.h < y.h GROUP BY 1, 2)
SELECT a AS chunk_hash_a, b AS chunk_hash_b FROM b JOIN n na ON na.h = a JOIN n nb ON nb.h = b WHERE shared >= 0.6 * (na.n + nb.n - shared)
""",
    "p7_found": """
WITH d AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[\\p{L}\\p{N}]+'), lambda x: lower(x)) AS w FROM documents),
i AS (SELECT item_id, list_transform(regexp_extract_all(t, '[\\p{L}\\p{N}]+'), lambda x: lower(x)) AS w FROM (SELECT item_id, unnest([question, explanation]) AS t FROM exam_items)),
iw AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 8), lambda k: array_to_string(list_slice(w, k, k + 9), ' '))) AS g FROM i WHERE len(w) >= 10),
dp AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM d WHERE len(w) >= 10),
dg AS (SELECT doc_id, string_agg(x, ' ') OVER f AS g, count(*) OVER f AS n FROM dp WINDOW f AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING))
SELECT DISTINCT doc_id, item_id FROM dg JOIN iw USING (g) WHERE n = 10
""",
}


def oracle_sql() -> dict[str, str]:
    return {name: sql.strip() for name, sql in _SQL.items()}
