"""Queries on paths and the metadata they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirebase.functions import paths as P
from quirebase.functions import text as X
from quirebase.functions.values import CONVERTED, DELETED, file_action, suffix
from quirebase.operators import metadata as M
from quirebase.plans.q_text import WS, sql_strip
from quirebase.plans.registry import query
from quirebase.session import load

_SEMESTERS = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in P.SEMESTERS.items()) + "}"
_COURSE = P._COURSE
_COURSE2 = P._COURSE_WITH_APOSTROPHE.replace("'", "''")
_STEM = "CASE WHEN regexp_matches(filename, '^.+\\.[^.]+$') THEN regexp_replace(filename, '\\.[^.]+$', '') ELSE filename END"
#: Path parts from the end, as p1 to p5; the paths of both tables begin with a slash.
_PARTS = """
    paths AS (SELECT path FROM documents WHERE path IS NOT NULL UNION SELECT path FROM file_index WHERE path IS NOT NULL),
    pp AS (SELECT path, list_concat(CASE WHEN starts_with(path, '/') THEN ['/'] ELSE CAST([] AS VARCHAR[]) END, list_filter(string_split(path, '/'), lambda x: x <> '' AND x <> '.')) AS ps FROM paths),
    five AS (SELECT path, coalesce(ps[-1], '') AS filename, coalesce(ps[-2], '') AS folder, coalesce(ps[-3], '') AS sem, coalesce(ps[-4], '') AS lev, coalesce(ps[-5], '') AS dept FROM pp)"""


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("path").unionByName(load(spark, sf_dir, "file_index").select("path")).where("path is not null").distinct()


@query(f"""
WITH {_PARTS},
s AS (SELECT *, {_STEM} AS stem FROM five),
c AS (SELECT *, CASE WHEN regexp_extract(folder, '{_COURSE}', 2) <> '' THEN folder ELSE stem END AS src, regexp_extract(regexp_replace(lev, '(?i)level', '', 'g'), '(100|200|300|400|500)', 1) AS named FROM s),
n AS (SELECT *, upper(regexp_extract(src, '{_COURSE}', 1)) AS code, regexp_extract(src, '{_COURSE}', 2) AS num FROM c),
r AS (SELECT path, dept AS department,
  CASE WHEN named <> '' THEN named WHEN length(num) >= 3 AND left(num, 1) IN ('1','2','3','4','5') THEN left(num, 1) || '00' ELSE '' END AS level,
  coalesce({_SEMESTERS}[replace(upper({sql_strip('sem')}), ' ', '')], '') AS semester,
  CASE WHEN upper(folder) IN ('PQ', 'PQS', 'PASTQUESTIONS') OR contains(upper(filename), 'PQ') OR contains(upper(filename), 'PAST QUESTION') THEN 'PQ' WHEN upper(folder) = 'GENERAL' THEN 'GENERAL' ELSE '' END AS category,
  folder AS course_folder, code AS course_code, num AS course_number, filename, stem,
  CASE WHEN dept <> '' AND code <> '' THEN dept || '-' || code || '-' || num WHEN code <> '' THEN code || '-' || num WHEN dept <> '' THEN dept ELSE 'MISC' END AS group_key FROM n)
SELECT *, regexp_replace(group_key, '[^A-Za-z0-9._-]+', '_', 'g') || '__' || sha1(path) || '.jsonl' AS output_name,
  regexp_replace(regexp_replace(path, '\\.[^./]+$', ''), '[ \\t\\n\\x0b\\f\\r/-]+', '_', 'g') AS tree_collection,
  'course_' || regexp_replace(stem, '[^A-Za-z0-9_-]', '_', 'g') || '_' || left(md5(path || '0'), 12) AS source_collection FROM r
""")
def path_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = _paths(spark, sf_dir).select("path", *P.path_metadata(F.col("path")))
    return meta.select("*", P.output_name(F.col("group_key"), F.col("path")).alias("output_name"), P.tree_collection(F.col("path")).alias("tree_collection"), P.source_collection(F.col("path"), F.lit("0")).alias("source_collection"))


_EXTENDED = f"""{_PARTS},
s AS (SELECT *, {_STEM} AS stem, regexp_replace(regexp_replace(lev, '(?i)([0-9]{{3}})L', '\\1', 'g'), '(?i)([0-9]{{3}})\\s+LEVEL', '\\1', 'g') AS lv FROM five),
c AS (SELECT *, CASE WHEN regexp_extract(folder, '{_COURSE2}', 2) <> '' THEN folder ELSE stem END AS src FROM s),
n AS (SELECT *, nullif(upper(regexp_replace(regexp_extract(src, '{_COURSE2}', 1), '''[Ss]', '', 'g')), '') AS code, nullif(regexp_extract(src, '{_COURSE2}', 2), '') AS num, regexp_matches(upper(dept), '^[A-Z]{{2,4}}$') AS explicit FROM c),
d AS (SELECT *, CASE WHEN explicit THEN upper(dept) ELSE code END AS department,
  CASE WHEN upper(folder) IN ('PQ', 'PQS', 'PASTQUESTIONS', 'PAST QUESTIONS') OR contains(upper(filename), 'PQ') THEN 'PQ' WHEN upper(folder) = 'GENERAL' THEN 'GENERAL' END AS category FROM n),
x AS (SELECT path, department, explicit AS explicit_department,
  CASE WHEN regexp_matches(lv, '^[1-5]00$') THEN lv WHEN length(num) >= 3 AND left(num, 1) IN ('1','2','3','4','5') THEN left(num, 1) || '00' END AS level,
  CASE WHEN {sql_strip('sem')} IN ('1', '2') THEN {sql_strip('sem')} END AS semester, code AS course_code, num AS course_number, category,
  CASE WHEN category = 'GENERAL' THEN coalesce(department, 'UNKNOWN')
       WHEN department IS NOT NULL AND code IS NOT NULL AND num IS NOT NULL THEN CASE WHEN department = code AND NOT explicit THEN department || '-' || num ELSE department || '-' || code || '-' || num END
       WHEN code IS NOT NULL AND num IS NOT NULL THEN code || '-' || num WHEN department IS NOT NULL AND num IS NOT NULL THEN department || '-' || num
       ELSE coalesce(department, code, 'UNKNOWN') END AS group_key FROM d)"""


@query(f"WITH {_EXTENDED} SELECT * FROM x")
def extended_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir).select("path", *P.extended_metadata(F.col("path")))


_TYPES = " ".join(f"WHEN regexp_matches(lower(t.text), '{p}') THEN '{n}'" for p, n in X.DOCUMENT_TYPES_ANY_SCRIPT)
_FOUR = ["x.department IS NOT NULL", "x.course_code IS NOT NULL", "x.level IS NOT NULL", "x.semester IS NOT NULL"]
_TEN = ["t.file_hash IS NOT NULL", "false", "false", "false", *_FOUR, "coalesce(t.n_chars, 0) > 0", f"(CASE {_TYPES} END) IS NOT NULL"]
_RECORD = f"""{_EXTENDED},
z AS (SELECT t.doc_id, t.path AS file_path, list_filter(string_split(t.path, '/'), lambda p: p <> '')[-1] AS file_name, t.file_hash, CAST(NULL AS VARCHAR) AS pdf_title, CAST(NULL AS VARCHAR) AS pdf_creation_date,
  CAST(NULL AS VARCHAR) AS pdf_modification_date, 0 AS page_count, coalesce(t.n_chars, 0) AS total_characters, len(list_filter(string_split_regex(coalesce(t.text, ''), '{WS}+'), lambda w: w <> '')) AS word_count,
  CASE WHEN t.text IS NULL THEN NULL WHEN {" + ".join(f"CASE WHEN contains(lower(t.text), ' {w} ') THEN 1 ELSE 0 END" for w in X.ENGLISH)} >= 3 THEN 'english' ELSE 'unknown' END AS language,
  x.department, x.course_code, x.course_number, x.level, x.semester, x.category, x.group_key, CASE {_TYPES} END AS document_type, t.extracted_at AS extraction_timestamp,
  CAST({" + ".join(f"CASE WHEN {f} THEN 1 ELSE 0 END" for f in _TEN)} AS DOUBLE) * 10 AS completeness
  FROM documents t LEFT JOIN x ON t.path = x.path)"""
_FLAGS = ["file_hash IS NOT NULL", "title IS NOT NULL", "department IS NOT NULL", "course_code IS NOT NULL", "level IS NOT NULL", "semester IS NOT NULL", "n_chars > 0", "document_type IS NOT NULL"]
_METADATA_ALL_TEXTS = f"""{_EXTENDED},
m AS (SELECT t.doc_id, t.file_hash, nullif({sql_strip("split_part(t.text, chr(10), 1)")}, '') AS title, t.n_chars, x.department, x.course_code, x.level, x.semester, x.group_key,
  CASE {_TYPES} END AS document_type
  FROM documents t LEFT JOIN x ON t.path = x.path WHERE t.text IS NOT NULL),
z AS (SELECT doc_id, group_key, department, document_type, CAST({" + ".join(f"CASE WHEN {f} THEN 10 ELSE 0 END" for f in _FLAGS)} AS DOUBLE) / {10 * len(_FLAGS)} * 100 AS completeness FROM m)"""


def _summary(z: DataFrame) -> DataFrame:
    return z.groupBy(F.coalesce("department", F.lit("")).alias("department"), F.coalesce("document_type", F.lit("")).alias("document_type")).agg(F.count("*").alias("documents"), F.round(F.avg("completeness"), 6).alias("completeness"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.document_records(load(spark, sf_dir, "documents"))


@query(f"WITH {_RECORD} SELECT * FROM z")
def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole metadata record of every document; these have no PDF beside them, so that its fields are null."""
    return _records(spark, sf_dir)


@query(f"WITH {_RECORD} SELECT doc_id, group_key, department, document_type, completeness FROM z")
def metadata_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of ten flags that hold, of every document."""
    return _records(spark, sf_dir).select("doc_id", "group_key", "department", "document_type", "completeness")


@query(f"""
WITH {_RECORD}
SELECT coalesce(department, '') AS department, coalesce(document_type, '') AS document_type, count(*) AS documents, round(avg(completeness), 6) AS completeness FROM z GROUP BY 1, 2
""")
def metadata_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(_records(spark, sf_dir))


def _eight_flags(docs: DataFrame) -> DataFrame:
    meta = docs.select("doc_id", "file_hash", F.nullif(X.strip(F.split_part("text", F.lit("\n"), F.lit(1))), F.lit("")).alias("title"), "n_chars", X.document_type(F.col("text")).alias("document_type"), *P.extended_metadata(F.col("path")), F.col("path").isNull().alias("pathless"))
    known = {c: F.when(~F.col("pathless"), F.col(c)) for c in ("department", "course_code", "level", "semester", "group_key")}
    flags = [F.col("file_hash").isNotNull(), F.col("title").isNotNull(), *(known[c].isNotNull() for c in ("department", "course_code", "level", "semester")), F.col("n_chars") > 0, F.col("document_type").isNotNull()]
    score = sum((F.when(f, 10.0).otherwise(0.0) for f in flags), F.lit(0.0)) / (10 * len(flags)) * 100
    return meta.select("doc_id", known["group_key"].alias("group_key"), known["department"].alias("department"), "document_type", score.alias("completeness"))


@query(f"WITH {_METADATA_ALL_TEXTS} SELECT * FROM z")
def metadata_completeness_all_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of eight flags, for files without document information: the title is the text's first line."""
    return _eight_flags(load(spark, sf_dir, "documents").where("text is not null"))


@query(f"""
WITH {_METADATA_ALL_TEXTS}
SELECT coalesce(department, '') AS department, coalesce(document_type, '') AS document_type, count(*) AS documents, round(avg(completeness), 6) AS completeness FROM z GROUP BY 1, 2
""")
def metadata_summary_all_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(_eight_flags(load(spark, sf_dir, "documents").where("text is not null")))


_LIST = lambda xs: ", ".join(f"'{x}'" for x in xs)


@query(f"""
WITH paths AS (SELECT DISTINCT path FROM ledger WHERE path IS NOT NULL)
SELECT path, coalesce(regexp_extract(lower(path), '[^/](\\.[^./]+)$', 1), '') AS suffix,
  CASE WHEN regexp_extract(lower(path), '[^/](\\.[^./]+)$', 1) IN ({_LIST(DELETED)}) THEN 'delete' WHEN regexp_extract(lower(path), '[^/](\\.[^./]+)$', 1) IN ({_LIST(CONVERTED)}) THEN 'convert' ELSE 'keep' END AS action,
  regexp_matches(path, '(?i)^https?://') AS is_url
FROM paths
""")
def extension_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "ledger").select("path").where("path is not null").distinct()
    return p.select("path", F.coalesce(suffix(F.col("path")), F.lit("")).alias("suffix"), file_action(F.col("path")).alias("action"), F.col("path").rlike(r"^(?i)https?://").alias("is_url"))


@query(f"""
WITH paths AS (SELECT DISTINCT path FROM file_index WHERE path IS NOT NULL),
kept AS (SELECT path, string_split(path, '/') AS ps FROM paths WHERE lower(path) LIKE '%.pdf' AND NOT regexp_matches(path, '(^|/)\\.[^/]'))
SELECT path, row_number() OVER (ORDER BY ps) AS place, len(ps) AS depth FROM kept
""")
def discovered_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovery over the known paths: PDF files outside hidden and ignored folders, in the order of their parts."""
    from quirebase.sources.files import discoverable, with_place

    paths = load(spark, sf_dir, "file_index").select("path").where("path is not null").distinct()
    return with_place(paths.where(discoverable(F.col("path"), (".pdf",)))).select("path", "place", F.size(F.split("path", "/")).alias("depth"))


@query("""
WITH d AS (SELECT DISTINCT array_to_string(list_slice(string_split(path, '/'), 1, len(string_split(path, '/')) - 1), '/') AS folder FROM file_index WHERE path IS NOT NULL)
SELECT folder, row_number() OVER (ORDER BY len(string_split(folder, '/')) DESC, folder) AS place FROM d WHERE folder <> ''
""")
def directory_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of the known files, the deepest first, as they would be emptied."""
    from quirebase.operators.ordering import number_rows

    parts = F.split("path", "/")
    folders = load(spark, sf_dir, "file_index").where("path is not null").select(F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/").alias("folder")).where("folder <> ''").distinct()
    return number_rows(folders, [], [-F.size(F.split("folder", "/")), F.col("folder")])
