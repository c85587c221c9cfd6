"""Lookup by metadata and exact nearest neighbours of given query vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Query vectors that one pass over the data carries to all tasks.
QUERIES_PER_PASS = 2_048


def equal_to(rows: DataFrame, wanted: dict[str, object], columns: list[str] | None = None, limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Rows whose fields equal all given values; a wanted null matches nulls. Filters and columns reach the scan.

    ``limit`` keeps the first rows in ``order``.
    """
    for field, value in wanted.items():
        rows = rows.where(F.col(field).isNull() if value is None else F.col(field) == F.lit(value))
    found = rows.select(*columns) if columns else rows
    return found.orderBy(*(order or [])).limit(limit) if limit is not None else found


def sanitised(metadata: Column) -> Column:
    """A JSON object as a map of its keys: scalars as text, lists and objects as JSON text, a null as null."""
    return F.from_json(metadata, "map<string,string>")


def contexts(near: DataFrame, texts: DataFrame, glue: str = "\n\n---\n\n") -> DataFrame:
    """(query_id, chunks, context): the texts (vec_id, text) of each query's nearest, the nearest first, joined into one."""
    each = near.join(texts.select("vec_id", "text"), "vec_id")
    ordered = F.sort_array(F.collect_list(F.struct("rank", "vec_id", "text")))
    return each.groupBy("query_id").agg(F.count("*").alias("chunks"), F.array_join(F.transform(ordered, lambda p: p["text"]), glue).alias("context"))


def tagged(rows: DataFrame, tag: str, value: object, everywhere: str = "everytag") -> DataFrame:
    """Rows with a tag's value, and those that are visible under any."""
    return rows.where(F.coalesce(F.col(everywhere), F.lit(False)) | (F.col(tag) == F.lit(value)))


def _scan(ids: np.ndarray, queries: np.ndarray, k: int, metric: str):
    sq = (queries**2).sum(axis=1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            if not len(column):
                continue
            data = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
            own = batch.column("vec_id").to_numpy()
            groups = np.array(batch.column("collection").to_pylist(), dtype=object)
            sd = (data**2).sum(axis=1)
            dots = queries @ data.T
            if metric == "cosine":
                distance = 1 - dots / np.maximum(np.sqrt(np.outer(sq, sd)), 1e-300)
            else:
                distance = np.maximum(sq[:, None] + sd - 2 * dots, 0)
            for name in sorted(set(groups.tolist()), key=str):
                at = np.flatnonzero(groups == name)
                part = np.round(distance[:, at], 9)
                # ties at the edge stay in, so that the id can decide among all of them later
                edge = np.partition(part, min(k, len(at)) - 1, axis=1)[:, min(k, len(at)) - 1]
                row, col = np.nonzero(part <= edge[:, None])
                yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array([name] * len(row), pa.string()), pa.array(own[at[col]]), pa.array(part[row, col])], ["query_id", "collection", "vec_id", "distance"])

    return scan


def nearest(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "cosine") -> DataFrame:
    """(query_id, collection, vec_id, distance, rank): the ``k`` nearest of each query in each collection.

    ``vectors``: vec_id, collection, embedding; ``queries``: query_id,
    embedding. Exact: blocks of at most ``QUERIES_PER_PASS`` queries meet all
    vectors; a task keeps the best of each Arrow batch, so little is shuffled.
    Null vectors are left out; distances are rounded to nine decimals and ties
    go to the smaller id.
    """
    data = vectors.where("embedding is not null").select("vec_id", F.col("collection").cast("string").alias("collection"), "embedding")
    best: DataFrame | None = None
    block: list = []

    def flush() -> None:
        nonlocal best, block
        ids = np.array([r.query_id for r in block], np.int64)
        part = data.mapInArrow(_scan(ids, np.array([r.embedding for r in block], np.float64), k, metric), "query_id bigint, collection string, vec_id bigint, distance double")
        best, block = part if best is None else best.unionAll(part), []

    for row in queries.where("embedding is not null").select("query_id", "embedding").toLocalIterator():
        block.append(row)
        if len(block) == QUERIES_PER_PASS:
            flush()
    if block:
        flush()
    if best is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, collection string, vec_id bigint, distance double, rank int")
    w = Window.partitionBy("query_id", "collection").orderBy("distance", "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def merge_collections(hits: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query over all collections."""
    w = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
