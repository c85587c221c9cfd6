"""Files as rows: discovery, page text, JSON lines, catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folders that discovery leaves out, beside hidden ones.
IGNORED = (".git", "node_modules", "__pycache__", ".venv", ".idea", ".vscode", "build", "dist")

METADATA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("path",)]
    + [T.StructField(n, T.IntegerType()) for n in ("chunk_index", "total_chunks_in_doc")]
    + [T.StructField(n, T.LongType()) for n in ("file_size", "file_mtime")]
    + [T.StructField(n, T.StringType()) for n in ("file_hash", "chunk_hash", "department", "level", "semester", "category", "course_folder", "course_code", "course_number", "filename", "stem", "group_key")]
    + [T.StructField("is_duplicate", T.BooleanType()), T.StructField("duplicate_of_index", T.IntegerType()), T.StructField("duplicate_of_hash", T.StringType()), T.StructField("skip_index", T.BooleanType())]
)
#: A line of a vector file.
RECORD = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("text", T.StringType()), T.StructField("metadata", METADATA), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("embedding_type", T.StringType())]
)


def discoverable(path: Column, suffixes: tuple[str, ...] = (".pdf",), prune: bool = True) -> Column:
    """Whether discovery keeps a path: a wanted suffix in any case, no hidden file and, with ``prune``, no hidden or ignored folder; no lock file."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    name = F.try_element_at(parts, F.lit(-1))
    folders = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    wanted = F.lit(False)
    for s in suffixes:
        wanted = wanted | F.endswith(F.lower(path), F.lit(s))
    keep = wanted & ~F.startswith(name, F.lit("~$"))
    if prune:
        keep = keep & ~F.startswith(name, F.lit(".")) & ~F.exists(folders, lambda p: F.startswith(p, F.lit(".")) | p.isin(*IGNORED))
    return keep


def with_place(files: DataFrame) -> DataFrame:
    """``place`` of each path in the order of its parts, counted from 1."""
    from quirebase.operators.ordering import number_rows

    return number_rows(files, [], [F.split("path", "/")])


def scan_files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = (".pdf",), prune: bool = True, most: int | None = None, content: bool = False) -> DataFrame:
    """Files below ``root``: path, length, modificationTime and, if asked for, content.

    Unreadable files are left out. ``most`` keeps the first in path order.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").load(root)
    relative = F.regexp_replace("path", "^[a-z]+:/*", "/")
    base = "/" + root.split(":", 1)[-1].strip("/") + "/"
    kept = files.where(discoverable(F.substring(relative, F.lit(len(base)), F.length(relative)), suffixes, prune))
    kept = kept.select("path", "length", "modificationTime", *(["content"] if content else []))
    return kept.orderBy(F.split("path", "/")).limit(most) if most else kept


def gather_files(spark: SparkSession, inputs: list[str], suffixes: tuple[str, ...] = (".pdf", ".pptx")) -> DataFrame:
    """Files of several folders or single files, each once, in the order of their paths in lower case."""
    out = None
    for root in inputs:
        part = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true").load(root).select("path", "length", "modificationTime")
        out = part if out is None else out.unionByName(part)
    return out.where(discoverable(F.col("path"), suffixes, prune=False)).distinct().orderBy(F.lower("path"), "path")


def hash_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, md5, file_hash) of every file below ``root``: the content is hashed where it is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").load(root)
    return files.select("path", "length", F.unix_timestamp("modificationTime").alias("file_mtime"), F.md5("content").alias("md5"), F.left(F.sha2("content", 256), F.lit(16)).alias("file_hash"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Vector files of JSON lines with their declared schema; blank lines are skipped, broken ones are rows of nulls."""
    return spark.read.schema(RECORD).json(path)


def read_courses(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue that is one JSON array: code, units, type, title, department, semester ('1' for FIRST, else '2')."""
    schema = "code string, units int, type string, title string, offered_by_programs array<string>, semesters string"
    rows = spark.read.schema(schema).option("multiLine", "true").json(path)
    return rows.select("code", "units", "type", "title", F.col("offered_by_programs").alias("department"), F.when(F.trim(F.coalesce("semesters", F.lit(""))) == "FIRST", "1").otherwise("2").alias("semester"))


def page_texts(pages: DataFrame, glue: str = "\n") -> DataFrame:
    """(file_hash, pages, text): page texts joined in page order, each page once. A file's pages are one value."""
    once = pages.groupBy("file_hash", "page_no").agg(F.min("text").alias("text"))
    return once.groupBy("file_hash").agg(F.count("*").alias("pages"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page_no", "text"))), lambda p: p["text"]), glue).alias("text"))
