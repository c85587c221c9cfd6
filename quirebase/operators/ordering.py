"""Numbers of rows in an order, without bringing a key's rows together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirebase.session import materialise, scratch_dir


def number_rows(rows: DataFrame, keys: list, order: list, name: str = "place") -> DataFrame:
    """``rows`` with each row's number from 1 among those of equal keys, in order; null is a key.

    The rows are range partitioned by keys and order and written, so that each
    keeps its place in its partition. A row's number is that place, counted
    from its key's first row there, plus the key's rows in the partitions
    before. One key may hold most rows: they lie in many partitions.
    """
    columns = rows.columns
    keyed = rows.select("*", F.struct(*keys, F.lit(0)).alias("_key"), F.struct(*order).alias("_order"))
    ranged = keyed.repartitionByRange("_key", "_order").sortWithinPartitions("_key", "_order").withColumn("_id", F.monotonically_increasing_id())
    fixed = materialise(ranged.drop("_order"), f"{scratch_dir(rows.sparkSession)}/numbered").withColumn("_part", F.shiftright("_id", 33))
    starts = fixed.groupBy("_key", "_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(F.col("_key").alias("_of"), F.col("_part").alias("_in"), "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    joined = fixed.join(starts, F.col("_key").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_in")))
    return joined.select(*columns, (F.col("_before") + F.col("_id") - F.col("_first") + 1).cast("bigint").alias(name))
