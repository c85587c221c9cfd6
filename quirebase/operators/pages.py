"""Decisions on files from their pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirebase.functions.text import strip


def distinct_pages(pages: DataFrame) -> DataFrame:
    """Each page once; pages without file or number are left out, a null text counts as blank."""
    return pages.where("file_hash is not null and page_no is not null").groupBy("file_hash", "page_no").agg(F.coalesce(F.min("text"), F.lit("")).alias("text"), F.max(F.coalesce("n_images", F.lit(0))).alias("n_images"))


def needs_ocr(pages: DataFrame, sampled: int = 8, least: int = 200, share: float = 0.6) -> DataFrame:
    """(file_hash, sampled, needs_ocr): whether most of the first pages have little text."""
    head = distinct_pages(pages).where(F.col("page_no") <= sampled)
    return head.groupBy("file_hash").agg(F.count("*").alias("sampled"), (F.avg((F.length("text") < least).cast("int")) >= share).alias("needs_ocr"))


def image_focus(pages: DataFrame, least: int = 100, share: float = 0.85) -> DataFrame:
    """Per file: pages, pages of image only, whether those prevail, whether any page has an image."""
    only = (F.length(strip(F.col("text"))) < least) & (F.col("n_images") > 0)
    counted = distinct_pages(pages).groupBy("file_hash").agg(F.count("*").alias("pages"), F.count_if(only).alias("image_only"), F.bool_or(F.col("n_images") > 0).alias("has_images"))
    return counted.select("*", (F.col("image_only") / F.col("pages") >= share).alias("image_focused"))


def page_totals(pages: DataFrame) -> DataFrame:
    """Per file: pages, characters, and characters a page."""
    totals = distinct_pages(pages).groupBy("file_hash").agg(F.count("*").alias("pages"), F.sum(F.length("text")).cast("bigint").alias("characters"))
    return totals.select("*", F.round(F.col("characters") / F.col("pages"), 6).alias("density"))


def processing_method(image_ratio):
    return F.when(image_ratio > 0.75, "ocr").when(image_ratio < 0.25, "direct_text").otherwise("hybrid")


def pdf_class(image_ratio):
    return F.when(image_ratio >= 0.5, "image_heavy").when(image_ratio <= 0.25, "typed").otherwise("mixed")


def page_class(edge_density, mean, deviation):
    """Class of a page image from its share of edges, mean and deviation of brightness."""
    return F.when((edge_density < 0.01) & (deviation > 40), "image").when((edge_density > 0.08) & (mean > 120), "printed").otherwise("handwriting")


def reading_order(lines: DataFrame, key: list[str], cell: float = 16.0, confidence: float = 0.35) -> DataFrame:
    """Recognised pieces of text joined row by row on a coarse grid.

    ``lines`` has text, conf, cx and cy. Empty and doubtful pieces go; cells
    round half to even; pieces of one cell keep the order of ``seq``.
    """
    kept = lines.where((F.col("text") != "") & (F.col("conf") >= confidence))
    piece = F.struct(F.bround(F.col("cy") / cell).alias("r"), F.bround(F.col("cx") / cell).alias("c"), "seq", "text")
    return kept.groupBy(*key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(piece)), lambda p: p["text"]), "\n").alias("text"), F.count("*").alias("pieces"))
