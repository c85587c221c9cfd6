"""Writers: JSON lines, CSV, upserts, ragged reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirebase.session import names_in, remove


def write_records(records: DataFrame, path: str, by_group: bool = False, mode: str = "overwrite") -> None:
    """Vector records as JSON lines; a null embedding leaves its key out.

    With ``by_group`` the files lie in a folder for each group key. Spark's
    commit makes the files visible only when all are written.
    """
    if by_group:
        # a group lies in few files, and one that holds most rows isn't one task's
        records.withColumn("group", F.coalesce("metadata.group_key", F.lit("MISC"))).repartitionByRange("group", "id").write.mode(mode).partitionBy("group").json(path)
    else:
        records.write.mode(mode).json(path)


def csv_columns(records: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """id and the given metadata fields as strings, '' where missing; fields the metadata lacks are all ''."""
    known = set(records.schema["metadata"].dataType.fieldNames())
    return records.select("id", *[F.coalesce(F.col(f"metadata.{k}").cast("string"), F.lit("")).alias(k) if k in known else F.lit("").alias(k) for k in keys])


def write_csv(records: DataFrame, keys: tuple[str, ...], path: str) -> None:
    csv_columns(records, keys).write.mode("overwrite").option("header", "true").csv(path)


def append_collection(rows: DataFrame, path: str, collection: str = "collection") -> None:
    """Add rows to the collections that they name; nothing that is there is read or rewritten."""
    rows.write.mode("append").partitionBy(collection).parquet(path)


def replace_collections(rows: DataFrame, path: str, collection: str = "collection") -> None:
    """Put rows in place of all that the collections they name held; other collections stay untouched."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(collection).parquet(path)


def append_with_ids(rows: DataFrame, path: str) -> None:
    """Add documents under random ids of their own, in place of an ``id`` they may have."""
    rows.withColumn("id", F.uuid()).write.mode("append").parquet(path)


def without_keys(stored: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """A keyed table without the keys in ``gone``."""
    return stored.join(gone.select(key).distinct(), key, "left_anti")


def upsert_table(arriving: DataFrame, path: str, key: str, version: str) -> DataFrame:
    """Merge rows into a table of snapshots ``path``/v=N by key: the last version of each key of both sides stays.

    Of equal versions the arriving one stays. The new snapshot is written beside
    the old one and read from then on; the one before the old is deleted.
    """
    from quirebase.operators.dedupe import latest

    spark = arriving.sparkSession
    fresh = latest(arriving, [key], [F.desc(version)])
    done = snapshots(spark, path)
    if done:
        stored = spark.read.parquet(f"{path}/v={done[-1]}").withColumn("_came", F.lit(0))
        both = stored.unionByName(fresh.withColumn("_came", F.lit(1)), allowMissingColumns=True)
        merged = latest(both, [key], [F.desc(version), F.desc("_came")]).drop("_came")
    else:
        merged = fresh
    number = (done[-1] if done else 0) + 1
    merged.write.mode("overwrite").parquet(f"{path}/v={number}")
    for old in done[:-1]:
        remove(spark, f"{path}/v={old}")
    return spark.read.parquet(f"{path}/v={number}")


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the snapshots under ``path`` that are whole."""
    return sorted(int(n[2:]) for n in names_in(spark, path) if n.startswith("v=") and "_SUCCESS" in names_in(spark, f"{path}/{n}"))


def union_reports(parts: list[DataFrame]) -> DataFrame:
    """Ragged reports as one table: all columns, in order of name, null where a part lacks one."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.select(*sorted(out.columns))
