"""Queries on request logs: a user is a key, an event type a model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirebase.functions.values import RATE_LIMITS, model_family
from quirebase.operators import usage as U
from quirebase.operators.ordering import number_rows
from quirebase.plans.registry import query
from quirebase.session import load

_FRAME = "PARTITION BY user_id, event_type ORDER BY ts RANGE BETWEEN INTERVAL '{m} seconds' PRECEDING AND CURRENT ROW"
_DAY = "PARTITION BY user_id, event_type ORDER BY ts RANGE BETWEEN INTERVAL '86399999999 microseconds' PRECEDING AND CURRENT ROW"
#: The model that stands behind an event type.
MODELS = {"click": "lite-1", "view": "flash-1", "purchase": "pro-1", "signup": "text-embedding-1", "error": "other"}
_MODEL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MODELS.items()) + " END"
_FAMILY = f"CASE WHEN contains({_MODEL}, 'lite') THEN 'lite' WHEN contains({_MODEL}, 'flash') THEN 'flash' WHEN contains({_MODEL}, 'pro') THEN 'pro' WHEN contains({_MODEL}, 'embedding') THEN 'embedding' ELSE 'flash' END"
_LIMIT = "CASE family " + " ".join(f"WHEN '{m}' THEN {d}" for m, (d, _) in RATE_LIMITS.items()) + " END"


def _model(event_type):
    table = F.create_map(*[F.lit(x) for pair in MODELS.items() for x in pair])
    return F.try_element_at(table, event_type)


@query(f"SELECT event_id, count(*) OVER ({_DAY}) AS in_window FROM events")
def rate_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of a key and model in the day before each, a sliding log."""
    return U.rate_window(load(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", 86_400).select("event_id", "in_window")


@query(f"""
WITH w AS (SELECT event_id, ts, min(ts) OVER ({_DAY}) AS oldest FROM events)
SELECT event_id, round(86400 - CAST(date_diff('microsecond', oldest, ts) AS DOUBLE) / 1000000 + 1, 6) AS wait FROM w
""")
def wait_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = U.rate_window(load(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", 86_400)
    return w.select("event_id", F.round(U.wait_seconds(F.col("ts"), F.col("oldest"), 86_400), 6).alias("wait"))


@query("""
SELECT CAST(date_trunc('day', ts) AS DATE) AS day, CASE WHEN grouping(user_id) = 1 THEN -1 ELSE user_id END AS user_id, CASE WHEN grouping(event_type) = 1 THEN 'all' ELSE event_type END AS event_type, count(*) AS requests, round(sum(value), 4) AS tokens
FROM events GROUP BY GROUPING SETS ((1, user_id, event_type), (1, user_id), (1))
""".replace("(1,", "(date_trunc('day', ts),").replace("(1)", "(date_trunc('day', ts))"))
def daily_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests and tokens by day, with subtotals of keys and of days; a new day starts at 0."""
    e = load(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "user_id", "event_type", "value")
    r = e.groupingSets([["day", "user_id", "event_type"], ["day", "user_id"], ["day"]], "day", "user_id", "event_type").agg(F.count("*").alias("requests"), F.round(F.sum("value"), 4).alias("tokens"), F.grouping("user_id").alias("gu"), F.grouping("event_type").alias("ge"))
    return r.select("day", F.when(F.col("gu") == 1, -1).otherwise(F.col("user_id")).alias("user_id"), F.when(F.col("ge") == 1, "all").otherwise(F.col("event_type")).alias("event_type"), "requests", "tokens")


@query(f"""
WITH d AS (SELECT user_id, {_FAMILY} AS family, CAST(date_trunc('day', ts) AS DATE) AS day, count(*) AS requests, sum(value) AS tokens FROM events GROUP BY 1, 2, 3)
SELECT day, family, count(*) AS keys, count(*) FILTER (WHERE requests < {_LIMIT} AND tokens < {U.MOST_TOKENS}) AS available, CAST(max(requests) AS BIGINT) AS busiest FROM d GROUP BY 1, 2
""")
def key_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys within the limits of each model family and day."""
    e = load(spark, sf_dir, "events").select("user_id", model_family(_model(F.col("event_type"))).alias("family"), F.to_date("ts").alias("day"), "value")
    d = e.groupBy("user_id", "family", "day").agg(F.count("*").alias("requests"), F.sum("value").alias("tokens"))
    day, _ = U.limits_of(F.col("family"))
    return d.groupBy("day", "family").agg(F.count("*").alias("keys"), F.count_if((F.col("requests") < day) & (F.col("tokens") < U.MOST_TOKENS)).alias("available"), F.max("requests").alias("busiest"))


@query("""
SELECT event_id, CAST((row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) % 7 AS BIGINT) AS slot FROM events
""")
def round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of each model dealt to seven keys in turn."""
    events = load(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return number_rows(events, ["event_type"], ["ts", "event_id"]).select("event_id", F.pmod(F.col("place") - 1, F.lit(7)).cast("bigint").alias("slot"))


_ENTRIES = """entries AS (SELECT event_id, user_id, event_type AS tag, epoch_us(ts) / 1000000.0 AS created_at, CASE WHEN event_type = 'error' THEN NULL ELSE 86400.0 * (1 + user_id % 20) END AS ttl, (SELECT max(epoch_us(ts)) / 1000000.0 FROM events) AS now FROM events)"""


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as cache entries; the last event is now."""
    e = load(spark, sf_dir, "events").withColumn("created_at", F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    now = e.agg(F.max("created_at")).first()[0]
    ttl = F.when(F.col("event_type") != "error", F.lit(86400.0) * (1 + F.col("user_id") % 20))
    return e.select("event_id", "user_id", F.col("event_type").alias("tag"), "created_at", ttl.alias("ttl"), F.lit(now).cast("double").alias("now"))


@query(f"WITH {_ENTRIES} SELECT event_id FROM entries WHERE coalesce(now - created_at > ttl, false)")
def ttl_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entries(spark, sf_dir).where(U.expired(F.col("created_at"), F.col("ttl"), F.col("now"))).select("event_id")


@query(f"WITH {_ENTRIES} SELECT count(*) AS total, count(*) FILTER (WHERE coalesce(now - created_at > ttl, false)) AS expired, count(*) FILTER (WHERE NOT coalesce(now - created_at > ttl, false)) AS active FROM entries")
def cache_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = U.expired(F.col("created_at"), F.col("ttl"), F.col("now"))
    return _entries(spark, sf_dir).agg(F.count("*").alias("total"), F.count_if(gone).alias("expired"), F.count_if(~gone).alias("active"))


@query("""
WITH t AS (SELECT user_id, list(DISTINCT event_type) AS tags FROM events GROUP BY 1)
SELECT user_id, len(tags) AS tags FROM t WHERE list_contains(tags, 'purchase') OR list_contains(tags, 'signup')
""")
def tag_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries that have one of the wanted tags."""
    t = load(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("tags"))
    return t.where(F.arrays_overlap("tags", F.array(F.lit("purchase"), F.lit("signup")))).select("user_id", F.size("tags").alias("tags"))
