"""The metadata record of a document, from its path, its text and its PDF's information."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirebase.functions import paths as P
from quirebase.functions import text as X


def document_records(docs: DataFrame, info: DataFrame | None = None) -> DataFrame:
    """One record for each row of ``docs`` (doc_id, path, text, file_hash, n_chars, extracted_at).

    ``info`` holds what PDF files say of themselves (path, title, created,
    modified, pages; see ``sources.pdf``); without it, or without a row for a
    path, these fields are null. A null path gives no academic field, a null
    text no language, type or words. ``completeness`` is the percentage of ten
    flags that hold: the hash, title and both dates of the PDF, department,
    course, level, semester, characters and type.
    """
    if info is None:
        named = docs.select("*", *[F.lit(None).cast("string").alias(c) for c in ("title", "created", "modified")], F.lit(0).alias("pages"))
    else:
        once = info.where("path is not null").groupBy("path").agg(*[F.max(c).alias(c) for c in ("title", "created", "modified", "pages")])
        named = docs.join(once, "path", "left").withColumn("pages", F.coalesce("pages", F.lit(0)))
    text = F.col("text")
    academic = [F.when(F.col("path").isNotNull(), c).alias(n) for c, n in zip(P.extended_metadata(F.col("path")), EXTENDED)]
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    record = named.select(
        "doc_id", F.col("path").alias("file_path"), F.try_element_at(parts, F.lit(-1)).alias("file_name"), "file_hash", F.col("title").alias("pdf_title"), F.col("created").alias("pdf_creation_date"),
        F.col("modified").alias("pdf_modification_date"), F.col("pages").cast("int").alias("page_count"), F.coalesce("n_chars", F.lit(0)).cast("bigint").alias("total_characters"), X.word_count(text).cast("bigint").alias("word_count"),
        F.when(text.isNotNull(), X.language_flag(text)).alias("language"), *academic, X.document_type(text).alias("document_type"), F.col("extracted_at").alias("extraction_timestamp"),
    )
    known = ("file_hash", "pdf_title", "pdf_creation_date", "pdf_modification_date", "department", "course_code", "level", "semester", "document_type")
    score = sum((F.col(c).isNotNull().cast("double") for c in known), (F.col("total_characters") > 0).cast("double")) * 10
    return record.withColumn("completeness", score).drop("explicit_department")


#: Columns of ``paths.extended_metadata``, in its order.
EXTENDED = ("department", "explicit_department", "level", "semester", "course_code", "course_number", "category", "group_key")
