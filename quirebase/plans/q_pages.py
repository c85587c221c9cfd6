"""Queries on pages of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirebase.functions.text import SPACE, effective_length, strip
from quirebase.functions.values import human_bytes, parse_size, reduction_percent
from quirebase.operators import pages as G
from quirebase.operators.ledger import status
from quirebase.plans.q_text import sql_strip
from quirebase.plans.registry import query
from quirebase.session import load
from quirebase.sources.files import page_texts

_PAGES = "pg AS (SELECT file_hash, page_no, coalesce(min(text), '') AS text, max(coalesce(n_images, 0)) AS n_images FROM scan_pages WHERE file_hash IS NOT NULL AND page_no IS NOT NULL GROUP BY 1, 2)"


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "scan_pages")


@query(f"WITH {_PAGES} SELECT file_hash, count(*) AS sampled, avg(CASE WHEN length(text) < 200 THEN 1 ELSE 0 END) >= 0.6 AS needs_ocr FROM pg WHERE page_no <= 8 GROUP BY 1")
def page_needs_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.needs_ocr(_pages(spark, sf_dir))


@query(f"""
WITH {_PAGES}, c AS (SELECT file_hash, count(*) AS pages, count(*) FILTER (WHERE length({sql_strip('text')}) < 100 AND n_images > 0) AS image_only, bool_or(n_images > 0) AS has_images FROM pg GROUP BY 1)
SELECT *, image_only / pages >= 0.85 AS image_focused FROM c
""")
def image_focused_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.image_focus(_pages(spark, sf_dir))


@query(f"""
WITH {_PAGES}, c AS (SELECT file_hash, count(*) AS pages, CAST(sum(length(text)) AS BIGINT) AS characters, CAST(count(*) FILTER (WHERE n_images > 0) AS DOUBLE) / count(*) AS image_ratio FROM pg GROUP BY 1)
SELECT file_hash, pages, characters, round(CAST(characters AS DOUBLE) / pages, 6) AS density, round(image_ratio, 6) AS image_ratio,
  CASE WHEN image_ratio > 0.75 THEN 'ocr' WHEN image_ratio < 0.25 THEN 'direct_text' ELSE 'hybrid' END AS processing_method,
  CASE WHEN image_ratio >= 0.5 THEN 'image_heavy' WHEN image_ratio <= 0.25 THEN 'typed' ELSE 'mixed' END AS pdf_class
FROM c
""")
def page_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, characters, density, and the classes that the share of pages with images gives."""
    once = G.distinct_pages(_pages(spark, sf_dir))
    ratio = once.groupBy("file_hash").agg(F.count("*").alias("pages"), F.sum(F.length("text")).cast("bigint").alias("characters"), F.avg((F.col("n_images") > 0).cast("double")).alias("ratio"))
    return ratio.select("file_hash", "pages", "characters", F.round(F.col("characters") / F.col("pages"), 6).alias("density"), F.round("ratio", 6).alias("image_ratio"), G.processing_method(F.col("ratio")).alias("processing_method"), G.pdf_class(F.col("ratio")).alias("pdf_class"))


@query(f"WITH {_PAGES} SELECT file_hash, count(*) AS pages, md5(string_agg(text, chr(10) ORDER BY page_no)) AS content FROM pg GROUP BY 1")
def page_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page texts joined in order into one text a file."""
    once = G.distinct_pages(_pages(spark, sf_dir))
    return page_texts(once).select("file_hash", "pages", F.md5("text").alias("content"))


@query(f"""
WITH {_PAGES}
SELECT file_hash, page_no, CASE WHEN length({sql_strip('text')}) > 50 THEN 'text' WHEN n_images > 0 THEN 'ocr' ELSE 'empty' END AS route,
  length(regexp_replace(text, '{SPACE}+', '', 'g')) AS effective_chars FROM pg
""")
def page_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's way: its text layer, recognition of its images, or neither."""
    text = F.col("text")
    route = F.when(F.length(strip(text)) > 50, "text").when(F.col("n_images") > 0, "ocr").otherwise("empty")
    return G.distinct_pages(_pages(spark, sf_dir)).select("file_hash", "page_no", route.alias("route"), effective_length(text).alias("effective_chars"))


@query(f"""
WITH {_PAGES},
l AS (SELECT file_hash, page_no, unnest(string_split(text, chr(10))) AS text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS seq FROM pg),
b AS (SELECT *, CAST((seq * 37) % 101 AS DOUBLE) AS cx, CAST((seq * 53) % 97 AS DOUBLE) AS cy FROM l)
SELECT file_hash, page_no, count(*) AS pieces, md5(string_agg(text, chr(10) ORDER BY round_even(cy / 16, 0), round_even(cx / 16, 0), seq)) AS content
FROM b WHERE text <> '' GROUP BY 1, 2
""")
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines at scattered places put in reading order; these have no confidence, so that none is doubtful."""
    lines = G.distinct_pages(_pages(spark, sf_dir)).select("file_hash", "page_no", F.posexplode(F.split("text", "\n")).alias("at", "text")).withColumn("seq", F.col("at") + 1)
    placed = lines.select("*", ((F.col("seq") * 37) % 101).cast("double").alias("cx"), ((F.col("seq") * 53) % 97).cast("double").alias("cy"), F.lit(1.0).alias("conf"))
    return G.reading_order(placed, ["file_hash", "page_no"]).select("file_hash", "page_no", "pieces", F.md5("text").alias("content"))


_HUMAN = "CASE WHEN f < 1024 THEN CAST(CAST(f AS BIGINT) AS VARCHAR) || ' B' WHEN f < 1048576 THEN printf('%.1f', f / 1024) || ' KB' WHEN f < 1073741824 THEN printf('%.1f', f / 1048576) || ' MB' WHEN f < 1099511627776 THEN printf('%.1f', f / 1073741824) || ' GB' ELSE printf('%.1f', f / 1099511627776) || ' TB' END"


@query(f"""
WITH s AS (SELECT path, file_size, CAST(file_size AS DOUBLE) AS f FROM (SELECT path, max(file_size) AS file_size FROM ledger WHERE path IS NOT NULL AND file_size IS NOT NULL GROUP BY 1)),
h AS (SELECT path, file_size, {_HUMAN} AS human FROM s),
p AS (SELECT *, replace(human, ' ', '') AS compact FROM h)
SELECT path, human, round((1 - (file_size * 7 // 10) / CAST(greatest(1, file_size) AS DOUBLE)) * 100, 6) AS reduction,
  CASE WHEN file_size < 262144 THEN 'skipped_small' WHEN (1 - (file_size * 7 // 10) / CAST(greatest(1, file_size) AS DOUBLE)) * 100 >= 10 THEN 'compressed' ELSE 'kept' END AS action,
  round(CAST(nullif(regexp_extract(compact, '(?i)([0-9]+(?:\\.[0-9]+)?)([BKMG])', 1), '') AS DOUBLE) * CASE upper(regexp_extract(compact, '(?i)([0-9]+(?:\\.[0-9]+)?)([BKMG])', 2)) WHEN 'B' THEN 1 WHEN 'K' THEN 1024 WHEN 'M' THEN 1048576 ELSE 1073741824 END, 3) AS parsed
FROM p
""")
def size_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes for reading and back, and the outcome of a reduction to seven tenths."""
    s = load(spark, sf_dir, "ledger").where("path is not null and file_size is not null").groupBy("path").agg(F.max("file_size").alias("file_size"))
    after = F.expr("file_size * 7 div 10")
    cut = reduction_percent(F.col("file_size"), after)
    human = human_bytes(F.col("file_size"))
    action = F.when(F.col("file_size") < 262144, "skipped_small").when(cut >= 10, "compressed").otherwise("kept")
    unit = F.regexp_replace(F.regexp_replace(human, " ", ""), "([BKMG])B$", "$1")
    return s.select("path", human.alias("human"), F.round(cut, 6).alias("reduction"), action.alias("action"), F.round(parse_size(unit), 3).alias("parsed"))


@query("""
WITH s AS (SELECT path, max(file_size) AS before, min(file_size) AS after, bool_or(coalesce(lower(trim(status)) = 'failed', false)) AS failed FROM ledger WHERE path IS NOT NULL AND file_size IS NOT NULL GROUP BY 1),
a AS (SELECT CASE WHEN failed THEN 'failed' WHEN before < 262144 THEN 'skipped_small' WHEN (1 - after / CAST(greatest(1, before) AS DOUBLE)) * 100 >= 10 THEN 'compressed' ELSE 'kept' END AS action FROM s)
SELECT count(*) FILTER (WHERE action = 'skipped_small') AS skipped_small, count(*) FILTER (WHERE action = 'compressed') AS compressed, count(*) FILTER (WHERE action = 'kept') AS kept, count(*) FILTER (WHERE action = 'failed') AS failed, count(*) AS files FROM a
""")
def action_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by what became of them, from their largest size to their smallest; one that ever failed counts as failed."""
    sizes = load(spark, sf_dir, "ledger").where("path is not null and file_size is not null").groupBy("path").agg(F.max("file_size").alias("before"), F.min("file_size").alias("after"), F.bool_or(F.coalesce(status(F.col("status")) == "failed", F.lit(False))).alias("failed"))
    cut = reduction_percent(F.col("before"), F.col("after"))
    action = F.when(F.col("failed"), "failed").when(F.col("before") < 262144, "skipped_small").when(cut >= 10, "compressed").otherwise("kept")
    return sizes.select(action.alias("action")).agg(*[F.count_if(F.col("action") == a).alias(a) for a in ("skipped_small", "compressed", "kept", "failed")], F.count("*").alias("files"))
