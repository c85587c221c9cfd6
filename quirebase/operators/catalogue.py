"""Nested course catalogues, matching of generated records, questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirebase.functions.values import DEPARTMENT_CODES

NESTED = "map<string,struct<levels:map<string,map<string,struct<courses:array<struct<code:string,title:string>>>>>>>"


def nest(courses: DataFrame) -> DataFrame:
    """A JSON object for each department: levels, in them semesters, in them lists of courses."""
    lists = courses.groupBy("department", "level", "semester").agg(F.struct(F.sort_array(F.collect_set(F.struct("code", "title"))).alias("courses")).alias("c"))
    semesters = lists.groupBy("department", "level").agg(F.map_from_entries(F.collect_list(F.struct("semester", "c"))).alias("s"))
    levels = semesters.groupBy("department").agg(F.struct(F.map_from_entries(F.collect_list(F.struct("level", "s"))).alias("levels")).alias("d"))
    return levels.select(F.to_json(F.create_map("department", "d")).alias("json"))


def flatten(catalogue: DataFrame) -> DataFrame:
    """One row for each course, with its department, level and semester."""
    departments = catalogue.select(F.explode(F.from_json("json", NESTED)).alias("department", "d"))
    levels = departments.select("department", F.explode("d.levels").alias("level", "semesters"))
    semesters = levels.select("department", "level", F.explode("semesters").alias("semester", "c"))
    return semesters.select("department", "level", "semester", F.explode("c.courses").alias("course")).select("department", "level", "semester", "course.code", "course.title")


def department_code(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in DEPARTMENT_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, name), F.lit("ENG"))


def match_first(records: DataFrame, known: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Records joined with the first known row of their key; unmatched records drop out."""
    first = known.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")
    return records.join(first, key)


def valid_question() -> Column:
    """Whether a question satisfies its schema; a null in a required field fails."""
    steps = F.size(F.coalesce("solution_steps", F.array().cast("array<string>")))
    ok = F.col("difficulty").isin("Easy", "Medium", "Hard") & F.col("difficulty_ranking").between(1, 10) & (F.size("options") == 4) & (F.size(F.array_distinct("options")) == 4)
    return F.coalesce(ok & F.array_contains("options", F.col("correct_answer")) & F.col("explanation").isNotNull() & (steps <= 5), F.lit(False))
