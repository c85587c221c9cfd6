"""Metadata from a file's path: the last five parts are department, level, semester, course folder and file."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirebase.functions.text import strip

#: Spellings of semesters.
SEMESTERS = {"1": "1", "2": "2", "FIRST": "1", "SECOND": "2", "SEM1": "1", "SEM2": "2", "SEMESTER1": "1", "SEMESTER2": "2"}
#: What a course's code and number look like, in a folder's or a file's name.
_COURSE = r"([A-Za-z]{2,})\s*[-_ ]*\s*(\d{2,3})"
_COURSE_WITH_APOSTROPHE = r"([A-Za-z]+(?:'[A-Za-z]*)?[A-Za-z]*)\s*[-_ ]*\s*(\d{2,3})"


def parts(path: Column) -> Column:
    """Parts between slashes; a leading slash is a part of its own, as in a POSIX path."""
    names = F.filter(F.split(F.coalesce(path, F.lit("")), "/"), lambda p: (p != "") & (p != "."))
    return F.when(F.startswith(path, F.lit("/")), F.concat(F.array(F.lit("/")), names)).otherwise(names)


def from_end(path: Column, k: int) -> Column:
    """The k-th part from the end; '' where the path is shorter."""
    return F.coalesce(F.try_element_at(parts(path), F.lit(-k)), F.lit(""))


def stem(name: Column) -> Column:
    """A file name without its last suffix; a leading dot isn't one."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]+\z", "")


def level(raw: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(raw, "(?i)level", ""), "(100|200|300|400|500)", 1)


def semester(raw: Column) -> Column:
    key = F.replace(F.upper(strip(raw)), F.lit(" "), F.lit(""))
    table = F.create_map(*[F.lit(x) for pair in SEMESTERS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), F.lit(""))


def path_metadata(path: Column) -> list[Column]:
    """Ten string columns, '' where a part is missing."""
    filename, folder = from_end(path, 1), from_end(path, 2)
    in_folder = F.regexp_extract(folder, _COURSE, 2) != ""
    source = F.when(in_folder, folder).otherwise(stem(filename))
    code = F.upper(F.regexp_extract(source, _COURSE, 1))
    number = F.regexp_extract(source, _COURSE, 2)
    named = level(from_end(path, 4))
    derived = F.when((F.length(number) >= 3) & F.left(number, F.lit(1)).isin(*"12345"), F.concat(F.left(number, F.lit(1)), F.lit("00"))).otherwise("")
    department = from_end(path, 5)
    category = (
        F.when(F.upper(folder).isin("PQ", "PQS", "PASTQUESTIONS") | F.contains(F.upper(filename), F.lit("PQ")) | F.contains(F.upper(filename), F.lit("PAST QUESTION")), "PQ")
        .when(F.upper(folder) == "GENERAL", "GENERAL")
        .otherwise("")
    )
    group = (
        F.when((department != "") & (code != ""), F.concat_ws("-", department, code, number))
        .when(code != "", F.concat_ws("-", code, number))
        .when(department != "", department)
        .otherwise("MISC")
    )
    return [
        department.alias("department"), F.when(named != "", named).otherwise(derived).alias("level"), semester(from_end(path, 3)).alias("semester"), category.alias("category"),
        folder.alias("course_folder"), code.alias("course_code"), number.alias("course_number"), filename.alias("filename"), stem(filename).alias("stem"), group.alias("group_key"),
    ]


def output_name(group_key: Column, path: Column) -> Column:
    """A safe file name that the whole path makes unique."""
    return F.concat(F.regexp_replace(group_key, r"[^A-Za-z0-9._-]+", "_"), F.lit("__"), F.sha1(path), F.lit(".jsonl"))


def tree_collection(relative: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(relative, r"\.[^./]+\z", ""), r"[\s/-]+", "_")


def source_collection(path: Column, version: Column) -> Column:
    """'course_', a safe stem and twelve hex digits of path and version."""
    safe = F.regexp_replace(stem(from_end(path, 1)), r"[^A-Za-z0-9_-]", "_")
    return F.concat(F.lit("course_"), safe, F.lit("_"), F.left(F.md5(F.concat(path, version)), F.lit(12)))


def extended_metadata(path: Column) -> list[Column]:
    """Stricter metadata: department of two to four letters, level of hundreds, semester 1 or 2; null where missing."""
    filename, folder = from_end(path, 1), from_end(path, 2)
    explicit = F.upper(from_end(path, 5)).rlike(r"^[A-Z]{2,4}\z")
    raw = F.regexp_replace(F.regexp_replace(from_end(path, 4), r"(?i)(\d{3})L", "$1"), r"(?i)(\d{3})\s+LEVEL", "$1")
    in_folder = F.regexp_extract(folder, _COURSE_WITH_APOSTROPHE, 2) != ""
    source = F.when(in_folder, folder).otherwise(stem(filename))
    code = F.nullif(F.upper(F.regexp_replace(F.regexp_extract(source, _COURSE_WITH_APOSTROPHE, 1), "'[Ss]", "")), F.lit(""))
    number = F.nullif(F.regexp_extract(source, _COURSE_WITH_APOSTROPHE, 2), F.lit(""))
    first = F.left(number, F.lit(1))
    derived = F.when((F.length(number) >= 3) & first.isin(*"12345"), F.concat(first, F.lit("00")))
    department = F.when(explicit, F.upper(from_end(path, 5))).otherwise(code)
    category = F.when(F.upper(folder).isin("PQ", "PQS", "PASTQUESTIONS", "PAST QUESTIONS") | F.contains(F.upper(filename), F.lit("PQ")), "PQ").when(F.upper(folder) == "GENERAL", "GENERAL")
    group = (
        F.when(category == "GENERAL", F.coalesce(department, F.lit("UNKNOWN")))
        .when(department.isNotNull() & code.isNotNull() & number.isNotNull(), F.when((department == code) & ~explicit, F.concat_ws("-", department, number)).otherwise(F.concat_ws("-", department, code, number)))
        .otherwise(F.coalesce(F.when(code.isNotNull() & number.isNotNull(), F.concat_ws("-", code, number)), F.when(department.isNotNull() & number.isNotNull(), F.concat_ws("-", department, number)), department, code, F.lit("UNKNOWN")))
    )
    return [
        department.alias("department"), explicit.alias("explicit_department"), F.coalesce(F.when(raw.rlike(r"^[1-5]00\z"), raw), derived).alias("level"),
        F.when(strip(from_end(path, 3)).isin("1", "2"), strip(from_end(path, 3))).alias("semester"), code.alias("course_code"), number.alias("course_number"), category.alias("category"), group.alias("group_key"),
    ]
