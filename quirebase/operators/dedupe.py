"""Exact duplicates: of chunks within a document, of documents, of files; last writers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunk_id(file_hash: Column, index: Column, chunk_hash: Column, repeat: bool = False) -> Column:
    """Id of a chunk from file, place and text; repeats have their own."""
    parts = [file_hash, index.cast("string"), chunk_hash]
    return F.sha1(F.concat_ws(":", *parts, *([F.lit("dup")] if repeat else [])))


def mark_repeats(chunks: DataFrame) -> DataFrame:
    """Mark later occurrences of a hash within its document.

    ``duplicate_of_index`` counts among the unique chunks of the document,
    ``duplicate_of_original`` among all of them. Two windows over one
    partitioning by document. A document of very many chunks is sorted, not
    held in memory.
    """
    same = Window.partitionBy("doc_id", "chunk_hash")
    before = Window.partitionBy("doc_id").orderBy("chunk_index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = chunks.repartition("doc_id").withColumn("first_index", F.min("chunk_index").over(same))
    is_first = F.col("first_index") == F.col("chunk_index")
    counted = marked.withColumn("running", F.sum(is_first.cast("bigint")).over(before) - 1)
    named = counted.withColumn("unique_index", F.max(F.when(is_first, F.col("running"))).over(same))
    return named.select(
        "doc_id", "chunk_index", "chunk_hash", (~is_first).alias("is_duplicate"), F.when(~is_first, F.col("unique_index")).alias("duplicate_of_index"), F.when(~is_first, F.col("first_index")).alias("duplicate_of_original")
    )


def budget_batches(items: DataFrame, key: str, order: str, weight: str, budget: int) -> DataFrame:
    """(key, batch, weight) of greedy batches in order; an item above the budget is a batch alone.

    Each key's items pass in order through one task, which keeps the open
    batch only: a key may have any number of items. A null key is a key.
    """

    def fold(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, number, total, started = None, 0, 0, False
        for part in parts:
            out: list[tuple] = []
            for k, w in zip(part.column("k").to_pylist(), part.column("w").to_pylist()):
                if started and k == now and total + w <= budget:
                    total += w
                    continue
                if started:
                    out.append((now, number, total))
                number, now, total, started = (number + 1 if started and k == now else 0), k, w, True
            yield _batch_rows(out)
        if started:
            yield _batch_rows([(now, number, total)])

    rows = items.select(F.col(key).cast("string").alias("k"), F.col(order).alias("o"), F.col(weight).cast("bigint").alias("w")).where("w is not null")
    folded = rows.repartition("k").sortWithinPartitions("k", "o", "w").mapInArrow(fold, "k string, batch bigint, w bigint")
    return folded.select(F.col("k").alias(key), "batch", F.col("w").alias(weight))


def _batch_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["k", "batch", "w"])


def duplicate_groups(items: DataFrame, content: Column, name: str) -> DataFrame:
    """(content, copies, kept): contents that occur more than once, with the least name. Null content isn't compared."""
    return items.where(content.isNotNull()).groupBy(content.alias("content")).agg(F.count("*").alias("copies"), F.min(name).alias("kept")).where("copies > 1")


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key; a window with a limit before and after the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def upsert(stored: DataFrame, arriving: DataFrame, key: str) -> DataFrame:
    """Stored rows without those that arrive again, and the arriving ones."""
    return stored.join(arriving.select(key).distinct(), key, "left_anti").unionByName(arriving, allowMissingColumns=True)
