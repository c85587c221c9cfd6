"""The indexing run, collections, caches and sources on small inputs."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from quirebase.functions import values as V
from quirebase.operators import external, retrieval, usage
from quirebase.operators import ledger as L
from quirebase.operators.indexing import Index, chunk_records
from quirebase.session import build_session, release, scratch_dir
from quirebase.sources import files, pdf, sinks
from quirebase.streaming import ingest

FILES = "path string, text string, file_hash string, file_size long, file_mtime long, id int"
def at():
    return F.lit("2024-01-01").cast("timestamp")

LONG = "\n\n".join(f"Paragraph {k} of words that are many enough. " * 6 for k in range(9))


def some_files(spark, *more):
    rows = [("/d/100/1/ABC 101/a.pdf", LONG, "h1", 10, 1, 0), ("/d/b.pdf", LONG, "h1", 10, 1, 0), ("/d/c.pdf", " \n", "h2", 0, 1, 0), ("/d/e.pdf", None, None, None, None, 0), (None, "x", "h9", 1, 1, 0)]
    return spark.createDataFrame([*rows, rows[0], *more], FILES)


def state(index):
    return {r.path: (r.status, r.reason) for r in index.table("ledger").where(F.col("run") == max(index.runs())).collect()}


def test_second_run_does_what_is_new_or_changed(spark, tmp_path):
    index = Index(spark, str(tmp_path / "i"))
    assert index.table("ledger").count() == 0 and index.collection().count() == 0
    index.run(some_files(spark), external.hashing_client, at())
    skipped = {"/d/b.pdf": ("skipped", "file_duplicate"), "/d/c.pdf": ("skipped", "empty_text"), "/d/e.pdf": ("skipped", "empty_text")}
    assert state(index) == {"/d/100/1/ABC 101/a.pdf": ("completed", None), **skipped}
    held = index.collection().count()
    assert held > 1 and index.table("billing").count() == 1 and index.table("texts").count() == 1
    again = Index(spark, str(tmp_path / "i"), metric="other")
    assert again.metric == "cosine"
    again.run(some_files(spark, ("/d/f.pdf", "a new text of some length", "h3", 5, 2, 0)), external.hashing_client, at())
    assert state(again) == {"/d/100/1/ABC 101/a.pdf": ("skipped", "already_processed"), "/d/f.pdf": ("completed", None), **skipped}
    assert again.collection().count() == held + 1 and again.table("billing").count() == 2
    changed = some_files(spark).where("path like '%a.pdf'").withColumn("text", F.lit("changed")).withColumn("file_mtime", F.lit(9)).withColumn("file_hash", F.lit("h7"))
    again.run(changed, external.hashing_client, at())
    assert state(again) == {"/d/100/1/ABC 101/a.pdf": ("completed", None)}
    assert again.export(str(tmp_path / "out")).count() == 5


def test_a_file_without_all_vectors_fails(spark, tmp_path):
    index = Index(spark, str(tmp_path / "i"))
    index.run(some_files(spark), lambda: lambda texts: [None] * len(texts), at())
    assert state(index)["/d/100/1/ABC 101/a.pdf"] == ("failed", None) and index.table("records").count() == 0 and index.table("billing").count() == 0


def test_a_broken_run_leaves_nothing(spark, tmp_path):
    def client():
        raise RuntimeError("no network")

    index = Index(spark, str(tmp_path / "i"))
    with pytest.raises(Exception):
        index.run(some_files(spark), client, at())
    assert index.runs() == [] and index.table("ledger").count() == 0
    assert index.run(some_files(spark), external.hashing_client, at()) == 0


def test_records_of_repeats(spark):
    part = "These words stand in a paragraph of their own. " * 40
    rows = chunk_records(spark.createDataFrame([("/p.pdf", "\n\n".join([part] * 4), "h", 1, 2, 0), ("/q.pdf", None, "h", 1, 2, 0)], FILES)).select("id", "metadata.*").collect()
    assert {r.path for r in rows} == {"/p.pdf"} and len({r.id for r in rows}) == len(rows)
    again = [r for r in rows if r.is_duplicate]
    assert again and all(r.skip_index and r.file_size is None and r.duplicate_of_hash == r.chunk_hash for r in again) and all(r.file_size == 1 for r in rows if not r.is_duplicate)


def test_canonical_keys(spark):
    path = 'a "q" \\ é漢\U0001f600.pdf'
    row = spark.createDataFrame([(path, 5)], "p string, n long").select(V.canonical_key({"pdf_path": V.json_text(F.col("p")), "file_size": F.col("n")}).alias("a"), V.canonical_key(V.json_text(F.lit("x")), V.json_text(F.col("p"))).alias("b")).first()
    key = lambda *args: hashlib.sha256(json.dumps({"args": args, "kwargs": {}}, sort_keys=True).encode()).hexdigest()[:16]
    assert (row.a, row.b) == (key({"pdf_path": path, "file_size": 5}), key("x", path))


def test_collections(spark, tmp_path):
    where = str(tmp_path / "c")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id int, collection string")
    sinks.append_collection(rows, where)
    sinks.append_collection(rows.where("id = 1"), where)
    sinks.replace_collections(spark.createDataFrame([(9, "b")], "id int, collection string"), where)
    assert sorted((r.id, r.collection) for r in spark.read.schema("id int, collection string").parquet(where).collect()) == [(1, "a"), (1, "a"), (9, "b")]
    sinks.append_with_ids(rows, str(tmp_path / "d"))
    assert len({r.id for r in spark.read.parquet(str(tmp_path / "d")).select("id").collect()}) >= 2
    assert [r.id for r in sinks.without_keys(rows, rows.where("id = 2"), "id").collect()] == [1]


def test_lives_merge_in_any_order(spark, tmp_path):
    where = str(tmp_path / "t")
    batch = lambda *rows: spark.createDataFrame(rows, "key string, at double")
    ingest.merge_touches(batch(("a", 0.0), ("a", 5.0), ("b", 1.0), (None, 1.0), ("c", None)), where, 10)
    ingest.merge_touches(batch(("a", 30.0), ("a", 34.0), ("a", 4.0), ("b", 9.0), ("b", 3.0)), where, 10)
    ingest.merge_touches(batch(("a", 25.0)), where, 10)
    read = lambda: {r.key: (r.created, r.last, r.touches) for r in spark.read.parquet(f"{where}/v={sinks.snapshots(spark, where)[-1]}").collect()}
    assert read() == {"a": (25.0, 34.0, 3), "b": (1.0, 9.0, 3)} and len(sinks.snapshots(spark, where)) == 2
    ingest.merge_touches(batch(("c", 100.0)), where, 10, evict_seconds=80)
    assert set(read()) == {"a", "c"}


def test_pages_and_information_of_contents(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in (("a.txt", "one\ftwo"), ("b.txt", " "), ("c.txt", "broken")):
        (tmp_path / "in" / name).write_text(text)

    def pages(content):
        if content == b"broken":
            raise ValueError("cut short")
        return [(p, 0) for p in content.decode().split("\f")]

    source = files.scan_files(spark, str(tmp_path / "in"), (".txt",), content=True)
    out = {(r.path[-5:], r.page_no): (r.text, r.error) for r in pdf.extract_pages(source, pages).collect()}
    assert out["a.txt", 2] == ("two", None) and out["b.txt", 1] == (" ", None) and "cut short" in out["c.txt", None][1]
    info = {r.path[-5:]: tuple(r)[1:] for r in pdf.document_info(source, lambda c: (" T ", " ", None, 3 if c != b" " else 1 // 0)).collect()}
    assert info["a.txt"] == ("T", None, None, 3) and info["b.txt"] == (None, None, None, None)
    assert pdf.extract_pages(source.where("false"), pages).count() == 0


def test_gathered_and_new_files(spark, tmp_path):
    for name in ("B.pdf", "a.PPTX", "c.txt", "~$x.pdf"):
        (tmp_path / name).write_text("x")
    found = files.gather_files(spark, [str(tmp_path), str(tmp_path / "B.pdf")])
    assert [r.path.rsplit("/", 1)[1] for r in found.collect()] == ["a.PPTX", "B.pdf"]
    known = found.where("path like '%B.pdf'")
    assert [r.path[-6:] for r in ingest.new_files(found, known).collect()] == ["a.PPTX"]
    assert ingest.new_files(found, known.withColumn("length", F.lit(0))).count() == 2
    batches = []
    ingest.run_available(ingest.stream_files(spark, str(tmp_path), "*.pdf").select("path", "length"), str(tmp_path / "check"), lambda b, n: batches.append(b.count()))
    assert sum(batches) == 2


def test_changes_and_sessions(spark):
    day = lambda n: f"2024-01-0{n} 00:00:00"
    columns = "path string, status string, discovered_at string, started_at string, finished_at string, file_size long, file_mtime long, reason string, error string, duplicate_of string, jsonl_name string, jsonl_archived boolean, chroma_upserted boolean, chunks int, duplicates int"
    rest = (1, 1, None, None, None, None, True, True, 1, 0)
    rows = [("a", "pending", day(1), None, None), ("a", "Completed ", day(1), None, day(3)), ("a", "completed", day(1), None, day(4)), ("b", "failed", None, None, None), (None, "failed", day(1), None, None)]
    table = spark.createDataFrame([(*r, *rest) for r in rows + rows[:1]], columns)
    for c in ("discovered_at", "started_at", "finished_at"):
        table = table.withColumn(c, F.col(c).cast("timestamp_ntz"))
    assert [(r.path, r.from_status, r.to_status) for r in L.changes(table).collect()] == [("a", "pending", "completed")]
    assert tuple(L.session(table).first()) == ("session_1704067200", True, 2, 1)
    assert tuple(L.session(table.where("path = 'a'")).first()) == ("session_1704326400", False, 0, 0)


def test_upgrade_and_context(spark):
    old = usage.upgraded(spark.createDataFrame([(None, None), (3.0, None)], "created_at double, ttl double"), F.lit(9.0), 60.0)
    assert sorted(tuple(r) for r in old.select("created_at", F.coalesce("ttl", F.lit(-1.0)), "upgraded").collect()) == [(3.0, -1.0, False), (9.0, 60.0, True)]
    near = spark.createDataFrame([(1, 7, 2), (1, 8, 1), (2, 5, 1)], "query_id int, vec_id int, rank int")
    out = {r.query_id: r.context for r in retrieval.contexts(near, spark.createDataFrame([(7, "b"), (8, "a")], "vec_id int, text string"), "|").collect()}
    assert out == {1: "a|b"}
    assert spark.createDataFrame([('{"a": 1, "b": [1, {"c": 2}], "d": null}',)], "j string").select(retrieval.sanitised(F.col("j")).alias("m")).first().m == {"a": "1", "b": '[1,{"c":2}]', "d": None}


def test_release_deletes_scratch_folders(spark):
    import os

    folder = scratch_dir(spark)
    spark.range(3).write.parquet(f"{folder}/x")
    assert release(spark) >= 1 and not os.path.exists(folder.removeprefix("file://").removeprefix("file:"))
    assert build_session is not None
