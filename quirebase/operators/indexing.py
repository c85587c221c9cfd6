"""The indexing run: from texts of files to records with vectors, with ledger, billing and index of files.

Every table is append-only and divided by run. A run writes its parts first
and its number into the list of runs last, so that a run that broke off leaves
nothing that a reader sees, and is simply made again.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirebase.functions import paths as P
from quirebase.functions import text as X
from quirebase.functions.values import cost
from quirebase.operators import dedupe
from quirebase.operators import ledger as L
from quirebase.operators.external import Client, embed
from quirebase.session import get_text, materialise, names_in, put_text, remove
from quirebase.sources.files import METADATA

#: Fixed value: texts under one request to the embedding client.
BATCH = 96
#: Columns of each table.
SCHEMAS = {
    "ledger": "path string, status string, file_size bigint, file_mtime bigint, discovered_at timestamp, started_at timestamp, finished_at timestamp, reason string, error string, duplicate_of string, jsonl_name string, jsonl_archived boolean, chroma_upserted boolean, chunks int, duplicates int",
    "billing": "file string, tokens bigint, cost decimal(18,9), batches int",
    "file_index": "file_hash string, path string",
    "texts": "key string, text string",
    "records": f"id string, text string, metadata {METADATA.simpleString()}, embedding array<float>, embedding_type string",
}


def chunk_records(files: DataFrame) -> DataFrame:
    """(id, text, metadata) of every chunk of every file, repeats within a file included.

    ``files``: path, text, file_hash, file_size, file_mtime. Chunks that were
    in their file before have ``is_duplicate`` and ``skip_index``, the place of
    the first among the file's distinct chunks and its hash, but no size and
    time. A null or blank text gives no row.
    """
    chunks = files.select("*", X.chunk(X.paragraphs(F.col("text"))).alias("all")).select(
        "path", "file_hash", "file_size", "file_mtime", F.sha1("text").alias("doc_hash"), F.size("all").alias("total"), F.posexplode("all").alias("chunk_index", "chunk")
    )
    hashed = chunks.withColumn("chunk_hash", F.sha1("chunk")).withColumn("doc_id", F.struct("path", "doc_hash"))
    marks = dedupe.mark_repeats(hashed.select("doc_id", "chunk_index", "chunk_hash"))
    marked = hashed.join(marks.drop("chunk_hash"), ["doc_id", "chunk_index"])
    again = F.col("is_duplicate")
    fields = {
        "path": F.col("path"), "chunk_index": F.col("chunk_index"), "total_chunks_in_doc": F.col("total"), "file_size": F.when(~again, F.col("file_size")), "file_mtime": F.when(~again, F.col("file_mtime")),
        "file_hash": F.col("file_hash"), "chunk_hash": F.col("chunk_hash"),
        "is_duplicate": F.when(again, True), "duplicate_of_index": F.when(again, F.col("duplicate_of_index")), "duplicate_of_hash": F.when(again, F.col("chunk_hash")), "skip_index": F.when(again, True),
    }
    named = dict(zip(("department", "level", "semester", "category", "course_folder", "course_code", "course_number", "filename", "stem", "group_key"), P.path_metadata(F.col("path"))))
    metadata = F.struct(*[(fields | named)[f.name].cast(f.dataType).alias(f.name) for f in METADATA.fields])
    key = lambda repeat: dedupe.chunk_id(F.col("doc_hash"), F.col("chunk_index"), F.col("chunk_hash"), repeat)
    return marked.select(F.when(again, key(True)).otherwise(key(False)).alias("id"), F.col("chunk").alias("text"), metadata.alias("metadata"))


@dataclass
class Index:
    """Tables of an index under ``path``."""

    spark: SparkSession
    path: str
    metric: str = "cosine"

    def __post_init__(self) -> None:
        if "collection.json" not in names_in(self.spark, self.path):
            put_text(self.spark, f"{self.path}/collection.json", json.dumps({"metric": self.metric}))
        self.metric = json.loads(get_text(self.spark, f"{self.path}/collection.json"))["metric"]

    def runs(self) -> list[int]:
        """Numbers of the runs that ended."""
        return [int(n.split("-")[1].split(".")[0]) for n in names_in(self.spark, self.path) if n.startswith("run-")]

    def table(self, name: str) -> DataFrame:
        """A table as it is after the last run that ended, with the column ``run``."""
        done = [f"{self.path}/{name}/run={n}" for n in self.runs() if f"run={n}" in names_in(self.spark, f"{self.path}/{name}")]
        schema = f"{SCHEMAS[name]}, run int"
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*done) if done else self.spark.createDataFrame([], schema)

    def collection(self) -> DataFrame:
        """The records that are searched: of each id the last run's, without repeats."""
        indexed = self.table("records").where("not coalesce(metadata.skip_index, false)")
        return dedupe.latest(indexed, ["id"], [F.desc("run")])

    def _append(self, name: str, rows: DataFrame, number: int) -> DataFrame:
        columns = [c.split()[0] for c in SCHEMAS[name].split(", ")] if name != "records" else ["id", "text", "metadata", "embedding", "embedding_type"]
        where = f"{self.path}/{name}/run={number}"
        rows.select(*columns).write.mode("overwrite").parquet(where)
        return self.spark.read.schema(SCHEMAS[name]).parquet(where)

    def run(self, files: DataFrame, client: Callable[[], Client], at: Column, kind: str = "hashing") -> int:
        """Index what is new or changed among ``files`` (path, text, file_hash, file_size, file_mtime); the run's number.

        A file that is done and unchanged is skipped (``already_processed``), as
        is one whose hash another path has (``file_duplicate``; of new files
        with one hash the least path owns it) and one without text
        (``empty_text``) or chunks (``no_chunks``). A file whose chunks didn't
        all get a vector fails and leaves no record. Rows without a path are
        left out, of several with one path the largest time holds. ``at`` is
        the time that the ledger gets.
        """
        number = max(self.runs(), default=-1) + 1
        found = dedupe.latest(files.where("path is not null"), ["path"], [F.desc_nulls_last("file_mtime"), F.desc_nulls_last("file_size"), F.desc_nulls_last("file_hash")])
        decided = L.to_process(found.select("path", F.col("file_size").alias("now_size"), F.col("file_mtime").alias("now_mtime")), self.table("ledger"))
        owners = self.table("file_index").groupBy("file_hash").agg(F.min_by("path", "run").alias("known"))
        fresh = found.where("file_hash is not null").groupBy("file_hash").agg(F.min("path").alias("first"))
        seen = found.join(decided, "path").join(owners, "file_hash", "left").join(fresh, "file_hash", "left").withColumn("owner", F.coalesce("known", "first", "path"))
        reason = F.when(F.col("decision") == "skip", "already_processed").when(F.col("owner") != F.col("path"), "file_duplicate").when(X.effective_length(F.col("text")) == 0, "empty_text")
        sorted_out = self._work("decided", seen.withColumn("reason", reason), number)
        todo = sorted_out.where("reason is null")
        records = chunk_records(todo)
        vectors = F.when(~F.coalesce("metadata.is_duplicate", F.lit(False)), F.col("text"))
        with_vectors = records.withColumn("embedding", embed(vectors, client, BATCH)).withColumn("embedding_type", F.when(vectors.isNotNull(), F.lit(kind)))
        made = self._work("made", with_vectors, number)
        unique = ~F.coalesce("metadata.is_duplicate", F.lit(False))
        counted = made.groupBy(F.col("metadata.path").alias("path")).agg(
            F.count_if(unique).cast("int").alias("chunks"), F.count_if(~unique).cast("int").alias("duplicates"), F.count("embedding").cast("int").alias("vectors"), F.sum(F.when(unique, X.token_estimate(F.col("text")))).alias("tokens"), F.first("metadata.group_key").alias("group_key")
        )
        outcome = sorted_out.join(counted, "path", "left").withColumn("reason", F.when(F.col("reason").isNull() & F.col("chunks").isNull(), "no_chunks").otherwise(F.col("reason")))
        failed = F.col("reason").isNull() & (F.col("vectors") != F.col("chunks"))
        status = F.when(F.col("reason").isNotNull(), "skipped").when(failed, "failed").otherwise("completed")
        rows = outcome.select("*", status.alias("status")).select(
            "path", "status", "file_size", "file_mtime", at.alias("discovered_at"), at.alias("started_at"), at.alias("finished_at"), "reason", F.when(F.col("status") == "failed", "embedding_mismatch").alias("error"),
            F.when(F.col("reason") == "file_duplicate", F.col("owner")).alias("duplicate_of"), F.when(F.col("status") == "completed", P.output_name(F.col("group_key"), F.col("path"))).alias("jsonl_name"),
            (F.col("status") == "completed").alias("jsonl_archived"), (F.col("status") == "completed").alias("chroma_upserted"), "chunks", "duplicates", "tokens", "file_hash", "text",
        )
        rows = self._work("outcome", rows, number)
        done = rows.where("status = 'completed'")
        self._append("records", made.join(done.select("path"), F.col("metadata.path") == done["path"], "left_semi"), number)
        self._append("ledger", rows, number)
        self._append("billing", done.select(F.col("path").alias("file"), "tokens", cost(F.col("tokens")).alias("cost"), F.ceil(F.col("chunks") / BATCH).cast("int").alias("batches")), number)
        self._append("file_index", rows.where("file_hash is not null and coalesce(reason, '') not in ('already_processed', 'file_duplicate')").select("file_hash", "path"), number)
        self._append("texts", rows.where((F.col("status") == "completed") & (X.effective_length(F.col("text")) >= 50)).select(F.concat("file_hash", F.lit(".text")).alias("key"), "text"), number)
        put_text(self.spark, f"{self.path}/run-{number}.json", json.dumps({"run": number}))
        remove(self.spark, f"{self.path}/work/run={number}")
        return number

    def _work(self, name: str, rows: DataFrame, number: int) -> DataFrame:
        """A table of the run's own, which nobody reads after it."""
        return materialise(rows, f"{self.path}/work/run={number}/{name}")

    def export(self, path: str) -> DataFrame:
        """The present state of all files, as JSON under ``path``: a summary, and details, which are read back."""
        state = L.current(self.table("ledger").drop("run"))
        L.summary(state).write.mode("overwrite").json(f"{path}/summary")
        state.write.mode("overwrite").json(f"{path}/details")
        return self.spark.read.schema(f"{SCHEMAS['ledger']}, at timestamp").json(f"{path}/details")
