"""Containers of fixed capacity filled with texts (problem 6).

Hierarchical residual packing. Each partition packs its texts by best fit in
falling order and emits the containers that are nearly full, and those into
which nothing that is left over there would fit. The underfull ones are merged
as a tree: what they hold goes on as items into half as many partitions, for
another round of best fit. Only ids and sizes travel between the rounds.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirebase.session import materialise, scratch_dir

#: Share of the capacity from which a container counts as nearly full.
NEARLY = 0.995
#: Items that one task packs at a time, on average; the tree has as many leaves
#: as that takes and isn't merged further where more than this would be left.
ITEMS_PER_TASK = 10_000
#: Rounds in which the tree may stay as wide as it is.
IDLE_ROUNDS = 2
#: Kinds of containers; they are read by the driver.
MOST_TARGETS = 1_000


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Number of the container of each item: the largest first, each into the fullest container with room."""
    bins = np.empty(len(sizes), np.int64)
    open_bins: list[tuple[int, int]] = []  # (room, number), rising
    used = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        at = bisect_left(open_bins, (size, -1))
        if at == len(open_bins):
            room, number = capacity, used
            used += 1
        else:
            room, number = open_bins.pop(at)
        bins[item] = number
        if room > size:
            insort(open_bins, (room - size, number))
    return bins


def _pack_group(last: bool, round_no: int):
    def pack(key: tuple, items: pa.Table) -> pa.Table:
        target, leaf = key[0].as_py(), key[1].as_py()
        items = items.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("part_no", "ascending")])
        sizes = items.column("n_tokens").to_numpy()
        capacity = int(items.column("capacity")[0].as_py())
        bins = best_fit(sizes, capacity)
        fill = np.bincount(bins, weights=sizes).astype(np.int64)
        done = fill >= NEARLY * capacity
        if last:
            done[:] = True
        elif not done.all():
            smallest = sizes[~done[bins]].min()
            done |= capacity - fill < smallest
        names = [f"{target}-{round_no}-{leaf}-{b}" for b in range(len(fill))]
        return pa.table(
            {
                "target_id": items.column("target_id"),
                "capacity": items.column("capacity"),
                "doc_id": items.column("doc_id"),
                "part_no": items.column("part_no"),
                "n_tokens": items.column("n_tokens"),
                "leaf": items.column("leaf"),
                "container_id": pa.array([names[b] for b in bins.tolist()], pa.string()),
                "fill": pa.array(fill[bins], pa.int64()),
                "done": pa.array(done[bins], pa.bool_()),
            }
        )

    return pack


_PACKED = "target_id int, capacity int, doc_id bigint, part_no int, n_tokens bigint, leaf int, container_id string, fill bigint, done boolean"


def pack(counts: DataFrame, targets: DataFrame, items_per_task: int = ITEMS_PER_TASK) -> DataFrame:
    """Containers of every target with the texts in them.

    ``counts``: doc_id and tokens, one row for each text; ``targets``:
    target_id and capacity, at most ``MOST_TARGETS`` rows. Texts without tokens
    (null or empty) need no container and don't occur. A text of more tokens
    than the capacity is cut into full containers and a rest, which is packed
    like a text; ``start_token`` and ``n_tokens`` give the part's place. Rows
    with the same doc_id are packed each for itself. Targets with a null or
    non-positive capacity are left out.

    Returns target_id, capacity, container_id, fill, doc_id, part_no,
    start_token, n_tokens.
    """
    spark = counts.sparkSession
    base = scratch_dir(spark)
    kinds = targets.select(F.col("target_id").cast("int").alias("target_id"), F.col("capacity").cast("int").alias("capacity")).where("capacity > 0 and target_id is not null").distinct().limit(MOST_TARGETS + 1).collect()
    if len(kinds) > MOST_TARGETS:
        raise ValueError(f"more than {MOST_TARGETS} targets")
    columns = ["target_id", "capacity", "container_id", "fill", "doc_id", "part_no", "start_token", "n_tokens"]
    if not kinds:
        return spark.createDataFrame([], "target_id int, capacity int, container_id string, fill bigint, doc_id bigint, part_no int, start_token bigint, n_tokens bigint")
    each = F.explode(F.array(*[F.struct(F.lit(k.target_id).alias("target_id"), F.lit(k.capacity).alias("capacity")) for k in kinds]))
    texts = counts.where("tokens > 0").select("doc_id", "tokens", each.alias("kind")).select("doc_id", F.col("tokens").cast("bigint").alias("tokens"), "kind.*")
    parts = texts.withColumn("part_no", F.explode(F.sequence(F.lit(0), F.expr("cast((tokens - 1) div capacity as int)")))).withColumn(
        "n_tokens", F.expr("least(cast(capacity as bigint), tokens - cast(part_no as bigint) * capacity)")
    )
    parts = materialise(parts.select("target_id", "capacity", "doc_id", "part_no", "n_tokens"), f"{base}/parts")
    full = parts.where("n_tokens = capacity").select(
        "target_id", "capacity", F.concat_ws("-", "target_id", F.lit("full"), "doc_id", "part_no", F.hex(F.monotonically_increasing_id())).alias("container_id"), F.col("n_tokens").alias("fill"), "doc_id", "part_no", "n_tokens"
    )
    rest = parts.where("n_tokens < capacity")
    most = max((r["count"] for r in rest.groupBy("target_id").count().collect()), default=0)
    leaves = 1 << max(0, -(-most // items_per_task) - 1).bit_length()
    rest = rest.withColumn("leaf", F.pmod(F.xxhash64("doc_id", "part_no"), F.lit(leaves)).cast("int"))
    finished = [full]
    idle, round_no = 0, 0
    while True:
        last = leaves == 1 or idle > IDLE_ROUNDS
        packed = materialise(rest.groupBy("target_id", "leaf").applyInArrow(_pack_group(last, round_no), _PACKED), f"{base}/round{round_no}")
        finished.append(packed.where("done").select(*[c for c in columns if c != "start_token"]))
        if last:
            break
        rest = packed.where("not done").select("target_id", "capacity", "doc_id", "part_no", "n_tokens", "leaf")
        left = max((r["count"] for r in rest.groupBy("target_id").count().collect()), default=0)
        if left <= items_per_task * leaves // 2:
            leaves, idle = leaves // 2, 0
            rest = rest.withColumn("leaf", F.expr("leaf div 2").cast("int"))
        else:
            idle += 1
            rest = rest.withColumn("leaf", F.pmod(F.xxhash64("doc_id", "part_no", F.lit(round_no)), F.lit(leaves)).cast("int"))
        round_no += 1
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out.withColumn("start_token", F.expr("cast(part_no as bigint) * capacity")).select(*columns)


def fill_report(packed: DataFrame) -> DataFrame:
    """Of each target: containers, tokens in them, the fewest containers any packing could do with, and the share filled."""
    bins = packed.groupBy("target_id", "capacity", "container_id").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("parts"))
    return bins.groupBy("target_id", "capacity").agg(
        F.count("*").alias("containers"),
        F.sum("parts").alias("parts"),
        F.sum("used").alias("tokens"),
        F.ceil(F.sum("used") / F.first("capacity")).alias("fewest"),
        F.round(F.sum("used") / (F.count("*") * F.first("capacity")), 6).alias("filled"),
    )
