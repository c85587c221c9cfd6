"""New batches against everything accepted before (problem 4).

Multi-key sorted neighbourhood over persisted runs. An arriving file has a key
for its file hash and one for each of its rarest chunk hashes, as many as any
file of at least the wanted similarity must share one of. Accepted files'
records lie in runs: tables divided into ranges of the key, as many as their
rows ask for, and sorted in each by key, number of chunks and place. A batch
is sorted the same way and merged with only those ranges of each run that its
keys fall into. Its records meet those in their window alone: the same key, a
number of chunks within reach of the similarity, and a place in the order from
which enough common chunks can still follow. The chunks of both then decide.

What is accepted becomes a run of the lowest level. Several runs of one level
are merged into one of the next, so that a record is rewritten a number of
times that grows as the logarithm of the batches. The state is a manifest
beside the runs, written last: ``History.open`` goes on from it.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirebase.session import get_text, materialise, names_in, put_text, remove, scratch_dir

_RECORD, _SET = 0, 1  # kinds of a run's rows: keys with their places, and accepted files' chunks
_ROWS = "run int, kind int, range int, key bigint, size int, chunks bigint, place bigint, arrival_id bigint"
_PAIR = "accepted_id bigint, arrival_id bigint"


@dataclass(frozen=True)
class HistoryParams:
    similarity: float = 0.5
    ranges: int = 1  # of a run at least
    rows_per_range: int = 500_000  # a run has as many ranges as that takes, a power of two
    compact_every: int = 6  # runs of a level that stand side by side
    hot_share: float = 0.001  # of all files that hold a chunk: above it the chunk comes last as a key


def arrivals(intake: DataFrame) -> DataFrame:
    """(batch_no, arrival_id, file_hash) of every arriving file.

    Rows without arrival or batch are left out. Of differing values in one
    arrival the least batch and the least non-null hash hold.
    """
    rows = intake.where("arrival_id is not null and batch_no is not null")
    return rows.groupBy(F.col("arrival_id").cast("bigint").alias("arrival_id")).agg(F.min("batch_no").cast("int").alias("batch_no"), F.min("file_hash").alias("file_hash"))


def chunk_rows(intake: DataFrame) -> DataFrame:
    """(arrival_id, chunk) of each distinct non-null chunk hash, as the hash of its whole text in 64 bits."""
    return intake.where("arrival_id is not null and batch_no is not null and chunk_hash is not null").select(F.col("arrival_id").cast("bigint").alias("arrival_id"), F.xxhash64("chunk_hash").alias("chunk")).distinct()


def _range(of: str, bits: int) -> str:
    """The first bits of a hash: ranges of a coarser division are whole ranges of a finer one."""
    return f"cast(shiftrightunsigned({of}, {64 - bits}) as int)" if bits else "0"


@dataclass
class History:
    """Accepted files as persisted runs under ``path``; a new one begins empty."""

    spark: SparkSession
    path: str
    params: HistoryParams = HistoryParams()
    written: int = 0
    hot: str = ""  # table of the chunks that very many files share
    learned: int = 0  # rows of the stock when they were noted
    runs: list[dict] = field(default_factory=list)  # path, level, rows, bits
    found: list[str] = field(default_factory=list)  # tables of pairs, one for each batch that had some to compare with
    batches: list = field(default_factory=list)  # names of the batches that are in
    ranges_read: int = 0  # of records, by the last batch

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> History:
        """The history as the last batch left it."""
        last = [n for n in names_in(spark, path) if n.startswith("manifest-") and n.endswith(".json")]
        if not last:
            raise FileNotFoundError(f"no history in {path}")
        state = json.loads(get_text(spark, f"{path}/{last[-1]}"))
        return cls(spark, path, HistoryParams(**state.pop("params")), **state)

    def _save(self) -> None:
        state = {k: getattr(self, k) for k in ("written", "hot", "learned", "runs", "found", "batches")}
        put_text(self.spark, f"{self.path}/manifest-{self.written:08d}.json", json.dumps(state | {"params": asdict(self.params)}))

    def _next(self, name: str) -> str:
        self.written += 1
        return f"{self.path}/{name}{self.written:06d}"

    def _write(self, rows: DataFrame, count: int, level: int) -> dict:
        """A run of rows (kind, key, size, chunks, place, arrival_id); a range with a hot key may be several files."""
        where = self._next("run=")
        parts = -(-count // self.params.rows_per_range)
        bits = max(0, max(self.params.ranges, parts) - 1).bit_length()
        of = "CASE kind WHEN 0 THEN key ELSE xxhash64(arrival_id) END"
        placed = rows.selectExpr("kind", f"{_range(of, bits)} AS range", "key", "size", "chunks", "place", "arrival_id")
        spread = placed.repartitionByRange(parts, "kind", "range", "key", "arrival_id") if parts > 1 else placed.coalesce(1)
        spread.sortWithinPartitions("kind", "range", F.expr("CASE kind WHEN 0 THEN key ELSE arrival_id END"), "chunks", "place").write.mode("overwrite").partitionBy("kind", "range").parquet(where)
        return {"path": where, "number": self.written, "level": level, "rows": count, "bits": bits}

    def _read(self, runs: list[dict]) -> DataFrame:
        """The rows of runs, with the columns kind and range by which folders are left out."""
        return self.spark.read.schema(_ROWS).option("basePath", self.path).parquet(*[r["path"] for r in runs])

    def _folders(self, hashes: DataFrame | None) -> str:
        """A condition on run and range that keeps the folders which hashes (a column ``h``) fall into.

        Their number is that of the finest division at most.
        """
        finest = max(r["bits"] for r in self.runs)
        self.ranges_read = len(self.runs)
        if not finest or hashes is None:
            return "true"
        every = [r[0] for r in hashes.selectExpr(_range("h", finest)).distinct().collect()]
        touched = {r["number"]: sorted({e >> (finest - r["bits"]) for e in every}) for r in self.runs}
        self.ranges_read = sum(map(len, touched.values()))
        return " OR ".join(f"(run = {run} AND range IN ({', '.join(map(str, ranges))}))" for run, ranges in touched.items() if ranges) or "false"

    def _order(self, chunks: DataFrame) -> None:
        """Note the chunks that very many files share; they come last in the order of keys.

        There are fewer than (chunks a file) / ``hot_share`` of them, whatever
        the stock's size. The order only spares work: a wrong one is slow, not wrong.
        """
        files = chunks.agg(F.approx_count_distinct("arrival_id")).first()[0]
        counted = chunks.groupBy("chunk").agg(F.count("*").alias("files"))
        self.hot = self._next("hot")
        materialise(counted.where(F.col("files") >= max(20, int(self.params.hot_share * files))), self.hot)

    def _records(self, files: DataFrame | None, chunks: DataFrame) -> DataFrame:
        """(kind, key, size, chunks, place, arrival_id): keys of each file, its rarest chunks first.

        ``size`` is the number of chunks where the key is hot, so that records
        of one hot key meet only those of a size in reach; else 0.
        """
        hot = self.spark.read.schema("chunk bigint, files bigint").parquet(self.hot)
        by_chunk = f"""
            SELECT 0 AS kind, chunk AS key, if(files IS NULL, 0, cast(chunks AS int)) AS size, chunks, place, arrival_id FROM (
                SELECT c.arrival_id, c.chunk, h.files, count(*) OVER (PARTITION BY c.arrival_id) AS chunks,
                    cast(row_number() OVER (PARTITION BY c.arrival_id ORDER BY coalesce(h.files, 0), c.chunk) AS bigint) AS place
                FROM {{chunks}} c LEFT JOIN {{hot}} h ON h.chunk = c.chunk)
            WHERE place <= chunks - ceil(chunks * {self.params.similarity}D - 1e-9D) + 1"""
        if files is None:
            return self.spark.sql(by_chunk, chunks=chunks, hot=hot)
        by_file = "SELECT 0, xxhash64('file', file_hash), 0, cast(0 AS bigint), cast(0 AS bigint), arrival_id FROM {files} WHERE file_hash IS NOT NULL"
        return self.spark.sql(f"{by_chunk} UNION ALL {by_file}", chunks=chunks, hot=hot, files=files)

    def _compare(self, records: DataFrame, chunks: DataFrame) -> DataFrame:
        """(accepted_id, arrival_id) of the files whose chunks, or whose file hash, are those of accepted ones."""
        t, join = f"{self.params.similarity}D", f"{self.params.similarity / (1 + self.params.similarity)}D"
        stock = self._read(self.runs)
        least, most = f"cast(ceil(chunks * {t} - 1e-9D) AS int)", f"cast(floor(least(chunks / {t}, (chunks - place + 1) / {join} - chunks) + 1e-9D) AS int)"
        sizes = f"CASE WHEN size = 0 THEN array(0) WHEN {most} >= {least} THEN sequence({least}, {most}) ELSE cast(array() AS array<int>) END"
        need = f"ceil((n.chunks + s.chunks) * {join} - 1e-9D)"
        near = self.spark.sql(
            f"""
            SELECT s.arrival_id AS accepted_id, n.arrival_id, bool_or(n.place = 0) AS same_file, max(n.chunks) AS chunks, max(s.chunks) AS their_chunks
            FROM (SELECT key, explode({sizes}) AS size, chunks, place, arrival_id FROM {{records}} WHERE arrival_id IS NOT NULL) n
            JOIN (SELECT * FROM {{stock}} WHERE kind = {_RECORD} AND arrival_id IS NOT NULL AND ({self._folders(records.selectExpr("key AS h"))})) s ON n.key = s.key AND n.size = s.size
            WHERE s.chunks >= n.chunks * {t} - 1e-9D AND s.chunks * {t} <= n.chunks + 1e-9D AND n.chunks - n.place + 1 >= {need} AND s.chunks - s.place + 1 >= {need}
            GROUP BY s.arrival_id, n.arrival_id""",
            records=records, stock=stock,
        )
        read, folders = self.ranges_read, "true"
        if any(r["bits"] for r in self.runs):
            near = materialise(near, self._next("near"))
            folders = self._folders(near.where("not same_file").selectExpr("xxhash64(accepted_id) AS h"))
            self.ranges_read = read
        # both parts name all columns, so that they share one exchange
        return self.spark.sql(
            f"""
            SELECT accepted_id, arrival_id FROM {{near}} WHERE same_file OR chunks < 0 OR their_chunks < 0 UNION ALL
            SELECT accepted_id, arrival_id FROM (
                SELECT p.accepted_id, p.arrival_id, p.chunks, p.their_chunks, count(*) AS both FROM {{near}} p
                JOIN {{chunks}} c ON c.arrival_id = p.arrival_id
                JOIN (SELECT arrival_id, key FROM {{stock}} WHERE kind = {_SET} AND ({folders})) s ON s.arrival_id = p.accepted_id AND s.key = c.chunk
                WHERE NOT p.same_file GROUP BY 1, 2, 3, 4)
            WHERE both >= {t} * (chunks + their_chunks - both) - 1e-9D""",
            near=near, chunks=chunks, stock=stock,
        )

    def ingest(self, files: DataFrame, chunks: DataFrame, batch: int | str | None = None) -> DataFrame:
        """Compare one batch with what is accepted, accept the rest of it, return (accepted_id, arrival_id).

        ``files``: arrival_id, file_hash; ``chunks``: arrival_id, chunk. The
        files of a batch aren't compared with each other. A file without any
        hash has no partner and is accepted. A named batch that is in already
        changes nothing.
        """
        self.spark = chunks.sparkSession
        if batch is not None and batch in self.batches:
            return self.pairs()
        if not self.hot:
            self._order(chunks)
        # each chunk is a row of its own and one key at most
        count, records = 2 * chunks.count(), self._records(files, chunks)
        if any(r["bits"] for r in self.runs) or count > self.params.rows_per_range:
            records = materialise(records, self._next("new"))
        found = None
        if self.runs:
            where = self._next("found")
            found = materialise(self._compare(records, chunks), where)
            self.found.append(where)
        rows = f"SELECT * FROM {{records}} UNION ALL SELECT {_SET}, chunk, 0, cast(0 AS bigint), cast(0 AS bigint), arrival_id FROM {{chunks}}"
        if found is None:
            rows = self.spark.sql(rows, records=records, chunks=chunks)
        else:
            rows = self.spark.sql(f"SELECT r.* FROM ({rows}) r LEFT ANTI JOIN {{found}} f ON f.arrival_id = r.arrival_id", records=records, chunks=chunks, found=found)
        self.runs.append(self._write(rows, count, 0))
        gone = self._compact()
        if batch is not None:
            self.batches.append(batch)
        self._save()
        for path in gone:
            remove(self.spark, path)
        return self.spark.createDataFrame([], _PAIR) if found is None else found

    def pairs(self) -> DataFrame:
        """(accepted_id, arrival_id) of all batches so far."""
        return self.spark.read.schema(_PAIR).parquet(*self.found) if self.found else self.spark.createDataFrame([], _PAIR)

    def _compact(self) -> list[str]:
        """Merge runs where a level has too many; the folders that are out of use then.

        When the stock has doubled since the hot chunks were noted, they are
        noted anew and all records made again in the new order: two records
        meet only if both were made in one order.
        """
        gone: list[dict] = []
        total = sum(r["rows"] for r in self.runs)
        if self.learned and total >= 2 * self.learned:
            everything = self._read(self.runs)
            stored = everything.where(f"kind = {_SET}")
            chunks = stored.selectExpr("arrival_id", "key AS chunk")
            self._order(chunks)
            by_file = everything.where(f"kind = {_RECORD} AND place = 0")
            columns = ["kind", "key", "size", "chunks", "place", "arrival_id"]
            rows = self._records(None, chunks).unionByName(by_file.select(columns)).unionByName(stored.select(columns))
            gone, self.runs = self.runs, [self._write(rows, total, max(r["level"] for r in self.runs) + 1)]
            self.learned = total
        self.learned = self.learned or total
        level = 0
        while level <= max(r["level"] for r in self.runs):
            same = [r for r in self.runs if r["level"] == level]
            if len(same) > self.params.compact_every:
                merged = self._write(self._read(same), sum(r["rows"] for r in same), level + 1)
                self.runs = [r for r in self.runs if r["level"] != level] + [merged]
                gone += same
            level += 1
        return [r["path"] for r in gone]


def repeated_arrivals(intake: DataFrame, params: HistoryParams = HistoryParams()) -> DataFrame:
    """(accepted_id, arrival_id) over all batches of a log, the smaller id first, each pair once.

    The log is divided by batch once; each batch then meets the history alone.
    The number of batches is that of the driver's steps.
    """
    spark = intake.sparkSession
    base = scratch_dir(spark)
    files = arrivals(intake)
    files.repartition("batch_no").write.partitionBy("batch_no").parquet(f"{base}/files")
    chunks = chunk_rows(intake).join(files.select("arrival_id", "batch_no"), "arrival_id")
    chunks.repartition("batch_no", F.pmod(F.xxhash64("arrival_id"), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions"))))).write.partitionBy("batch_no").parquet(f"{base}/chunks")
    history = History(spark, f"{base}/history", params)
    folders = {int(n.split("=")[1]): n for n in names_in(spark, f"{base}/files") if n.startswith("batch_no=")}
    with_chunks = set(names_in(spark, f"{base}/chunks"))
    nothing = spark.createDataFrame([], "arrival_id bigint, chunk bigint")
    for number in sorted(folders):
        of_batch = spark.read.schema("arrival_id bigint, file_hash string").parquet(f"{base}/files/{folders[number]}")
        theirs = spark.read.schema("arrival_id bigint, chunk bigint").parquet(f"{base}/chunks/{folders[number]}") if folders[number] in with_chunks else nothing
        history.ingest(of_batch, theirs, number)
    return history.pairs().select(F.least("accepted_id", "arrival_id").alias("accepted_id"), F.greatest("accepted_id", "arrival_id").alias("arrival_id")).distinct()
