"""State of files from an append-only ledger of status changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirebase.operators.dedupe import latest


def status(raw: Column) -> Column:
    """One spelling of a status."""
    return F.lower(F.trim(raw))


def moment() -> Column:
    """When a row's change happened: its end, else its start, else its discovery."""
    return F.coalesce("finished_at", "started_at", "discovered_at")


#: Fixed value: statuses in the order in which a file passes them.
ORDER = ("pending", "in_progress", "skipped", "failed", "completed")


def current(ledger: DataFrame) -> DataFrame:
    """The last change of each path; of changes at one moment the further status holds.

    Rows may repeat and arrive late; rows without a path are left out, rows
    without any time come before all others.
    """
    rows = ledger.where("path is not null").withColumn("status", status(F.col("status"))).withColumn("at", moment())
    step = F.array_position(F.array(*map(F.lit, ORDER)), F.col("status"))
    ties = [F.desc_nulls_last(c) for c in ("file_size", "file_mtime", "reason", "error", "duplicate_of", "jsonl_name", "jsonl_archived", "chroma_upserted", "chunks", "duplicates")]
    return latest(rows, ["path"], [F.desc_nulls_last("at"), F.desc(step), *ties])


def summary(state: DataFrame) -> DataFrame:
    """Files by status, what is left, and percent done (0 without files)."""
    counted = state.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ORDER], F.count("*").alias("total"))
    left = F.col("total") - F.col("completed") - F.col("failed") - F.col("skipped")
    percent = F.when(F.col("total") > 0, F.round(F.col("completed") / F.col("total") * 100, 6)).otherwise(0.0)
    return counted.select("total", "completed", "failed", "skipped", left.alias("open"), percent.alias("percent"), (F.col("total") - F.col("completed") - F.col("skipped") > 0).alias("can_resume"))


def changes(ledger: DataFrame) -> DataFrame:
    """(path, from_status, to_status, at) of every change; a first row is none, nor is a row with the same status."""
    rows = ledger.where("path is not null").select("path", status(F.col("status")).alias("to_status"), moment().alias("at")).distinct()
    step = F.array_position(F.array(*map(F.lit, ORDER)), F.col("to_status"))
    before = Window.partitionBy("path").orderBy(F.asc_nulls_first("at"), step, "to_status")
    return rows.withColumn("from_status", F.lag("to_status").over(before)).where("from_status <> to_status")


def session(ledger: DataFrame) -> DataFrame:
    """(session_id, resumed, total, completed): the session that the next run belongs to.

    If anything is left to do, it is the one that began with the first row;
    else a new one, named by the last moment, whose counters are 0.
    """
    bounds = ledger.where("path is not null").agg(F.min(moment()).alias("first"), F.max(moment()).alias("last"))
    both = summary(current(ledger)).withColumn("_", F.lit(1)).join(bounds.withColumn("_", F.lit(1)), "_")
    goes_on = F.col("can_resume")
    began = F.floor(F.unix_micros(F.when(goes_on, F.col("first")).otherwise(F.col("last")).cast("timestamp")) / 1_000_000)
    kept = lambda c: F.when(goes_on, F.col(c)).otherwise(0).alias(c)
    return both.select(F.concat(F.lit("session_"), began.cast("bigint").cast("string")).alias("session_id"), goes_on.alias("resumed"), kept("total"), kept("completed"))


def unchanged(state: DataFrame) -> Column:
    """Whether a finished file needn't be run again: same size and time, archived and upserted.

    A skip is an event and not a state: it doesn't undo a completion.
    """
    return (
        (F.col("status") == "completed") & (F.col("file_size") == F.col("now_size")) & (F.col("file_mtime") == F.col("now_mtime")) & F.coalesce("jsonl_archived", F.lit(False)) & F.coalesce("chroma_upserted", F.lit(False))
    )


def to_process(found: DataFrame, ledger: DataFrame) -> DataFrame:
    """Discovered files (path, now_size, now_mtime) with the decision ``skip`` or ``run``."""
    done = current(ledger.where(status(F.col("status")) != "skipped"))
    return found.join(done, "path", "left").select("path", F.when(F.coalesce(unchanged(done), F.lit(False)), "skip").otherwise("run").alias("decision"))


def after_mark(files: DataFrame, mark: str) -> DataFrame:
    """Files after a path in the order of path parts; all of them if the mark isn't one of them."""
    if not files.where(F.col("path") == F.lit(mark)).limit(1).count():
        return files
    return files.where(F.split("path", "/") > F.split(F.lit(mark), "/"))
