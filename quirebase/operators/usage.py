"""Request rates and token use, and keyed entries that expire."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirebase.functions.values import RATE_LIMITS

#: Fixed value: tokens a key may use of a model.
MOST_TOKENS = 2_000_000


def rate_window(events: DataFrame, keys: list[str], ts: str, seconds: int = 60) -> DataFrame:
    """``in_window``: requests of the same key less than ``seconds`` before each, itself included; ``oldest`` of them."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    w = Window.partitionBy(*keys).orderBy("_at").rangeBetween(-(seconds * 1_000_000 - 1), Window.currentRow)
    return events.withColumn("_at", micros).withColumn("in_window", F.count("*").over(w)).withColumn("oldest", F.min(F.col(ts)).over(w)).drop("_at")


def wait_seconds(now: Column, oldest: Column, seconds: int = 60) -> Column:
    """Seconds until the oldest request leaves the window, and one more."""
    return F.lit(float(seconds)) - (F.unix_micros(now.cast("timestamp")) - F.unix_micros(oldest.cast("timestamp"))) / 1_000_000 + 1


def limits_of(model: Column) -> tuple[Column, Column]:
    """(requests a day, requests a minute) of a model family."""
    day = F.create_map(*[F.lit(x) for m, (d, _) in RATE_LIMITS.items() for x in (m, d)])
    minute = F.create_map(*[F.lit(x) for m, (_, n) in RATE_LIMITS.items() for x in (m, n)])
    return F.try_element_at(day, model), F.try_element_at(minute, model)


def upgraded(entries: DataFrame, now: Column, ttl: float) -> DataFrame:
    """Entries (created_at, ttl) with ``upgraded``: those without a time of creation get the present one and the usual time to live."""
    old = F.col("created_at").isNull()
    return entries.withColumn("upgraded", old).withColumn("ttl", F.when(old, F.lit(ttl)).otherwise(F.col("ttl"))).withColumn("created_at", F.coalesce("created_at", now))


def expired(created_at: Column, ttl: Column, now: Column) -> Column:
    """Whether an entry is past its time to live; one without never is."""
    return F.coalesce(ttl, F.lit(float("inf"))) < (now - created_at)
