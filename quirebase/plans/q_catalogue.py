"""Queries on catalogues, generated records and questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirebase.functions.values import DEPARTMENT_CODES
from quirebase.operators import catalogue as C
from quirebase.plans.registry import query
from quirebase.session import load

_COURSES = """courses AS (SELECT DISTINCT upper(metadata.department) AS department, metadata.level AS level, metadata.semester AS semester, metadata.course_code || ' ' || metadata.course_number AS code, metadata.course_folder AS title FROM chunks
    WHERE metadata.course_code <> '' AND metadata.level <> '' AND metadata.semester <> '' AND metadata.department <> '')"""


def _courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = load(spark, sf_dir, "chunks").select("metadata.*").where("course_code <> '' and level <> '' and semester <> '' and department <> ''")
    return m.select(F.upper("department").alias("department"), "level", "semester", F.concat_ws(" ", "course_code", "course_number").alias("code"), F.col("course_folder").alias("title")).distinct()


@query(f"WITH {_COURSES} SELECT department, level, semester, code, title FROM courses")
def catalogue_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Courses nested as department, levels, semesters, list in JSON, and flattened again."""
    return C.flatten(C.nest(_courses(spark, sf_dir)))


_CODES = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in DEPARTMENT_CODES.items()) + "}"


@query(f"""
WITH d AS (SELECT DISTINCT domain, CASE WHEN domain IN ('engineering', 'computing') THEN CASE doc_id % 4 WHEN 0 THEN 'CHEMICAL' WHEN 1 THEN 'COMPUTER' WHEN 2 THEN 'CIVIL' ELSE 'MECHANICAL' END || ' ENGINEERING' ELSE upper(domain) END AS department FROM documents WHERE domain IS NOT NULL)
SELECT domain, department, coalesce({_CODES}[department], 'ENG') AS department_code FROM d
""")
def department_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("domain").isin("engineering", "computing"), F.concat(F.element_at(F.array(*map(F.lit, ("CHEMICAL", "COMPUTER", "CIVIL", "MECHANICAL"))), (F.col("doc_id") % 4 + 1).cast("int")), F.lit(" ENGINEERING"))).otherwise(F.upper("domain"))
    d = load(spark, sf_dir, "documents").where("domain is not null").select("domain", name.alias("department")).distinct()
    return d.select("*", C.department_code(F.col("department")).alias("department_code"))


@query(f"WITH {_COURSES} SELECT DISTINCT c.code FROM courses c WHERE NOT EXISTS (SELECT 1 FROM exam_items e WHERE e.course_code = c.code)")
def courses_without_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anti join: courses that no question was made for yet."""
    asked = load(spark, sf_dir, "exam_items").select(F.col("course_code").alias("code"))
    return _courses(spark, sf_dir).select("code").distinct().join(asked, "code", "left_anti")


@query(f"WITH {_COURSES}, u AS (SELECT code FROM courses UNION SELECT course_code FROM exam_items) SELECT code FROM u WHERE code IS NOT NULL")
def known_courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set insert: what was known and what came, each once."""
    return _courses(spark, sf_dir).select("code").unionByName(load(spark, sf_dir, "exam_items").select(F.col("course_code").alias("code"))).where("code is not null").distinct()


@query(f"""
WITH {_COURSES}, f AS (SELECT code, title, department, row_number() OVER (PARTITION BY code ORDER BY department, level, semester, title) AS rn FROM courses)
SELECT e.item_id, f.title, f.department FROM exam_items e JOIN f ON f.code = e.course_code AND f.rn = 1
""")
def generated_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each generated question with the first course of its code; questions without a course drop out."""
    return C.match_first(load(spark, sf_dir, "exam_items").select("item_id", F.col("course_code").alias("code")), _courses(spark, sf_dir), "code", ["department", "level", "semester", "title"]).select("item_id", "title", "department")


@query("""
SELECT item_id, coalesce(difficulty IN ('Easy', 'Medium', 'Hard') AND difficulty_ranking BETWEEN 1 AND 10 AND len(options) = 4 AND len(list_distinct(options)) = 4 AND list_contains(options, correct_answer) AND explanation IS NOT NULL AND len(coalesce(solution_steps, CAST([] AS VARCHAR[]))) <= 5, false) AS valid,
  CAST(len(list_slice(coalesce(solution_steps, CAST([] AS VARCHAR[])), 1, 5)) AS INTEGER) AS steps, chr(CAST(64 + list_position(options, correct_answer) AS INTEGER)) AS letter
FROM exam_items
""")
def question_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which questions satisfy their schema; the answer as a letter; the first five steps."""
    q = load(spark, sf_dir, "exam_items")
    steps = F.size(F.slice(F.coalesce("solution_steps", F.array().cast("array<string>")), 1, 5))
    return q.select("item_id", C.valid_question().alias("valid"), steps.alias("steps"), F.char(F.lit(64) + F.array_position("options", F.col("correct_answer"))).alias("letter"))


@query("SELECT course_code, difficulty, count(*) AS questions, round(avg(difficulty_ranking), 6) AS ranking FROM exam_items GROUP BY 1, 2")
def question_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions written in folders by course and difficulty, and counted from there."""
    from quirebase.session import scratch_dir

    where = f"{scratch_dir(spark)}/questions"
    load(spark, sf_dir, "exam_items").select("item_id", "difficulty_ranking", "course_code", "difficulty").repartition("course_code").write.partitionBy("course_code", "difficulty").parquet(where)
    back = spark.read.schema("item_id bigint, difficulty_ranking int, course_code string, difficulty string").parquet(where)
    return back.groupBy("course_code", "difficulty").agg(F.count("*").alias("questions"), F.round(F.avg("difficulty_ranking"), 6).alias("ranking"))


@query("SELECT DISTINCT unnest(json_keys(props)) AS key FROM events WHERE props IS NOT NULL")
def property_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All keys that any JSON object in the log has."""
    return load(spark, sf_dir, "events").where("props is not null").select(F.explode(F.json_object_keys("props")).alias("key")).distinct()


@query()
def json_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of the log in code fences, with text around them or cut short, parsed again."""
    from quirebase.operators.json_repair import parse

    cut = F.expr("substring(props, 1, cast(length(props) * 0.8 as int))")
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("Here it is: "), "props", F.lit(" That's all."))).otherwise(cut)
    return load(spark, sf_dir, "events").where("props is not null").select("event_id", parse(text).alias("parsed")).select("event_id", "parsed.*")
