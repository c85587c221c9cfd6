"""Incremental runs as structured streams over growing folders of files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirebase.operators.dedupe import latest
from quirebase.session import remove
from quirebase.sources.sinks import snapshots, upsert_table


def stream_table(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a stream of its files, under the schema it has now."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isFile():
        return reader.option("pathGlobFilter", where.getName()).parquet(where.getParent().toString())
    return reader.parquet(path)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Process what has come since the last run, batch by batch, and stop; a rerun with the same checkpoint takes only new files."""
    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start().awaitTermination()


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, key: str, version: str) -> DataFrame:
    """Merge every batch of a stream into a table of snapshots; the table as it then is."""
    run_available(stream, checkpoint, lambda batch, _: upsert_table(batch, path, key, version) and None)
    return stream.sparkSession.read.parquet(f"{path}/v={snapshots(stream.sparkSession, path)[-1]}")


def new_files(found: DataFrame, known: DataFrame) -> DataFrame:
    """Found files (path, length, modificationTime) that aren't known as they are: new ones and changed ones."""
    same = known.select("path", "length", "modificationTime").distinct()
    return found.join(same, ["path", "length", "modificationTime"], "left_anti")


def stream_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Files below ``root`` as they arrive, with their content; a checkpoint makes each come once."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)


def windowed_counts(events: DataFrame, ts: str, keys: list[str], width: str, late: str) -> DataFrame:
    """Requests in tumbling windows of event time, for update mode: a window comes again as it changes, and its state goes once it is ``late``."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count("*").alias("requests")).select(F.col("w.start").alias("window_start"), *keys, "requests")


def lives(touches: DataFrame, ttl_seconds: float) -> DataFrame:
    """(key, created, last, touches) of every life of a key: one ends where nothing touched it for longer than ``ttl_seconds``.

    ``touches`` has the same columns; a single touch is a life of one. Lives
    that overlap or follow within the time become one. A key's rows are sorted
    in one task, which may spill.
    """
    before = Window.partitionBy("key").orderBy("created", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("key").orderBy("created", "last").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fresh = F.coalesce(F.col("created") - F.max("last").over(before) > ttl_seconds, F.lit(True))
    numbered = touches.withColumn("_fresh", fresh.cast("int")).withColumn("_life", F.sum("_fresh").over(upto))
    return numbered.groupBy("key", "_life").agg(F.min("created").alias("created"), F.max("last").alias("last"), F.sum("touches").alias("touches")).drop("_life")


def merge_touches(batch: DataFrame, path: str, ttl_seconds: float, evict_seconds: float | None = None) -> None:
    """Merge a batch of touches (key, at) into the table of present lives under ``path``.

    A batch is reduced to lives before it meets the table. A touch that comes
    late joins the life it lies in, or is left out if that life is over. With
    ``evict_seconds`` keys go that were touched that long before the newest.
    """
    spark = batch.sparkSession
    rows = batch.where("key is not null and at is not null").groupBy("key", F.col("at").alias("created")).agg(F.max("at").alias("last"), F.count("*").alias("touches"))
    done = snapshots(spark, path)
    if done:
        rows = rows.unionByName(spark.read.parquet(f"{path}/v={done[-1]}"))
    present = latest(lives(rows, ttl_seconds), ["key"], [F.desc("created")])
    if evict_seconds is not None:
        newest = present.agg(F.max("last")).first()[0]
        present = present.where(F.col("last") >= F.lit((newest or 0) - evict_seconds))
    present.write.mode("overwrite").parquet(f"{path}/v={(done[-1] if done else 0) + 1}")
    for old in done[:-1]:
        remove(spark, f"{path}/v={old}")


def last_seen(events: DataFrame, key: str, at: Column, ttl_seconds: float, path: str, checkpoint: str, evict_seconds: float | None = None) -> DataFrame:
    """Entries of a cache that stream by, each with its touches since it was made or had expired; the table of them under ``path``."""
    rows = events.select(F.col(key).cast("string").alias("key"), at.cast("double").alias("at"))
    run_available(rows, checkpoint, lambda batch, _: merge_touches(batch, path, ttl_seconds, evict_seconds))
    spark = events.sparkSession
    return spark.read.parquet(f"{path}/v={snapshots(spark, path)[-1]}")
