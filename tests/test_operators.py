"""Operators on small tables with nulls, ties, repeats and empty inputs."""

import datetime as dt
import json
import random
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from quirebase.functions import paths as P
from quirebase.functions import values as V
from quirebase.operators import catalogue, dedupe, external, json_repair, ledger, pages, retrieval, usage
from quirebase.sources import files, sinks


def test_path_metadata_golden(spark):
    path = "/x/COMPILATION/100/1/BIO 101/BIO 103 - All notes.pdf"
    row = spark.createDataFrame([(path,), ("",), ("a.pdf",), ("/PQ/file",)], "path string").select("path", *P.path_metadata(F.col("path"))).collect()
    first = row[0].asDict()
    assert (first["department"], first["level"], first["semester"], first["course_code"], first["course_number"], first["group_key"]) == ("COMPILATION", "100", "1", "BIO", "101", "COMPILATION-BIO-101")
    assert first["stem"] == PurePosixPath(path).stem
    assert row[1].group_key == "MISC" and row[1].filename == ""
    assert row[3].category == "PQ"


def test_cost_golden(spark):
    assert str(spark.range(1).select(V.cost(F.lit(15540))).first()[0]) == "0.000186480"


@pytest.mark.parametrize("n,shown", [(0, "0 B"), (1023, "1023 B"), (1024, "1.0 KB"), (306432, "299.2 KB"), (5 * 1024**3, "5.0 GB"), (3 * 1024**5, "3072.0 TB")])
def test_human_bytes(spark, n, shown):
    assert spark.range(1).select(V.human_bytes(F.lit(n))).first()[0] == shown


def test_sizes_and_families(spark):
    row = spark.range(1).select(V.parse_size(F.lit("x 12.5K y")), V.parse_size(F.lit("none")), V.model_family(F.lit("flash-lite")), V.model_family(F.lit("other")), V.fit_vector(F.array(F.lit(1.0)).cast("array<float>"), 3), V.fit_vector(F.lit(None).cast("array<float>"), 2)).first()
    assert tuple(row) == (12800.0, None, "lite", "flash", [1.0, 0.0, 0.0], [0.0, 0.0])


def test_repeats_are_marked(spark):
    rows = [(1, 0, "a"), (1, 1, "b"), (1, 2, "a"), (1, 3, "b"), (2, 0, "a"), (3, 0, None), (3, 1, None)]
    out = {(r.doc_id, r.chunk_index): (r.is_duplicate, r.duplicate_of_index, r.duplicate_of_original) for r in dedupe.mark_repeats(spark.createDataFrame(rows, "doc_id long, chunk_index int, chunk_hash string")).collect()}
    assert out[1, 2] == (True, 0, 0) and out[1, 3] == (True, 1, 1) and out[2, 0] == (False, None, None)


def test_budget_batches_keep_order_and_budget(spark):
    random.seed(4)
    sizes = [random.randint(1, 60) for _ in range(300)] + [500]
    out = dedupe.budget_batches(spark.createDataFrame([("k", i, s) for i, s in enumerate(sizes)], "k string, o int, w int"), "k", "o", "w", 100).orderBy("batch").collect()
    assert sum(r.w for r in out) == sum(sizes) and all(r.w <= 100 or r.w == 500 for r in out)


def test_latest_and_upsert(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 1)], "id int, v string, n int")
    b = spark.createDataFrame([(2, "z", 2), (3, "w", 2)], "id int, v string, n int")
    assert {tuple(r) for r in dedupe.upsert(a, b, "id").collect()} == {(1, "x", 1), (2, "z", 2), (3, "w", 2)}
    assert dedupe.latest(a.where("false"), ["id"], [F.desc("n")]).count() == 0


def test_upsert_table_keeps_the_last_version(spark, tmp_path):
    for rows in ([(1, 1), (2, 1), (2, 3)], [(2, 4), (3, 1)]):
        table = sinks.upsert_table(spark.createDataFrame(rows, "id int, version int"), f"{tmp_path}/t", "id", "version")
    assert sorted(map(tuple, table.collect())) == [(1, 1), (2, 4), (3, 1)]


def test_upsert_table_keeps_a_higher_version_that_came_before(spark, tmp_path):
    for rows in ([(1, 5, "a"), (2, 1, "b")], [(1, 4, "c"), (2, 1, "d"), (3, 1, "e")], [(1, 2, "f"), (3, 2, "g")]):
        table = sinks.upsert_table(spark.createDataFrame(rows, "id int, version int, text string"), f"{tmp_path}/t", "id", "version")
    assert sorted(map(tuple, table.collect())) == [(1, 5, "a"), (2, 1, "d"), (3, 2, "g")]


def test_stream_upsert_of_files_in_any_order(spark, tmp_path):
    from quirebase.plans import catalog

    files_of = [[(9, "a"), (2, "b")], [(3, "a"), (5, "b")], [(4, "c"), (7, "a")]]
    for rows in files_of:
        spark.createDataFrame([(v, i, [1.0, 2.0]) for v, i in rows], "vec_id long, id string, embedding array<float>").coalesce(1).write.mode("append").parquet(f"{tmp_path}/chunk_vectors.parquet")
    out = catalog.queries()["stream_vector_upsert"](spark, str(tmp_path)).collect()
    assert {r.id: r.vec_id for r in out} == {"a": 9, "b": 5, "c": 4}


def test_reports_and_records(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x")], "n int, file string"), spark.createDataFrame([(2.5,)], "gain double")
    assert sinks.union_reports([a, b]).columns == ["file", "gain", "n"]
    record = spark.createDataFrame([("1", "t", None, [1.0], "f"), ("2", "u", None, None, None)], files.RECORD)
    sinks.write_records(record, f"{tmp_path}/r")
    assert files.read_records(spark, f"{tmp_path}/r").orderBy("id").collect() == record.orderBy("id").collect()


def test_file_scan(spark, tmp_path):
    for name in ("b/2.PDF", "a/1.pdf", ".git/3.pdf", "node_modules/4.pdf", "a/._5.pdf", "a/6.txt", "~$7.pdf"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    found = [r.path.rsplit("/", 1)[1] for r in files.scan_files(spark, str(tmp_path), most=5).collect()]
    assert found == ["1.pdf", "2.PDF"]
    hashes = {r.path.rsplit("/", 1)[1]: r.md5 for r in files.hash_files(spark, str(tmp_path)).collect()}
    import hashlib

    assert hashes["6.txt"] == hashlib.md5(b"a/6.txt").hexdigest()


def test_courses(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps([{"code": "A 1", "units": 2, "type": "C", "title": "T", "offered_by_programs": ["X"], "semesters": " FIRST "}, {"code": "B 1"}]))
    assert [r.semester for r in files.read_courses(spark, f"{tmp_path}/c.json").orderBy("code").collect()] == ["1", "2"]


def fake_extractor(path):
    text = open(path).read()
    if text == "broken":
        raise ValueError("no pages")
    for page in text.split("\f"):
        yield page, page.count("#")


def test_pdf_source(spark, tmp_path, monkeypatch):
    from quirebase.sources.pdf import PdfPages, _Reader

    (tmp_path / "x.pdf").write_text("one\ftwo#")
    (tmp_path / "y.pdf").write_text("broken")
    assert PdfPages.name() == "pdf_pages"
    reader = _Reader({"path": str(tmp_path), "extractor": "test_operators:fake_extractor"})
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert [(r[1], r[2], r[3]) for r in rows[:2]] == [(1, "one", 0), (2, "two#", 1)] and "no pages" in rows[2][4]


def test_pages(spark):
    rows = [("f", 1, "x" * 300, 0), ("f", 2, "", 1), ("f", 3, None, 2), ("f", 3, None, 2), ("g", 1, " ", 1), (None, 1, "x", 0)]
    table = spark.createDataFrame(rows, "file_hash string, page_no int, text string, n_images int")
    assert {r.file_hash: r.needs_ocr for r in pages.needs_ocr(table).collect()} == {"f": True, "g": True}
    focus = {r.file_hash: (r.pages, r.image_only, r.image_focused) for r in pages.image_focus(table).collect()}
    assert focus == {"f": (3, 2, False), "g": (1, 1, True)}
    assert {r.file_hash: r.text for r in files.page_texts(pages.distinct_pages(table), "|").collect()}["f"] == "x" * 300 + "||"


def test_reading_order_rounds_half_to_even(spark):
    rows = [("k", 0, "b", 0.9, 8.0, 0.0), ("k", 1, "a", 0.9, 0.0, 8.0), ("k", 2, "", 0.9, 0.0, 0.0), ("k", 3, "no", 0.34, 0.0, 0.0), ("k", 4, "c", 0.35, 0.0, 24.0)]
    out = pages.reading_order(spark.createDataFrame(rows, "k string, seq int, text string, conf double, cx double, cy double"), ["k"]).first()
    assert out.text == "b\na\nc"


def test_nearest_is_exact_with_ties(spark):
    random.seed(1)
    vectors = [(i, "c" if i % 3 else None, [random.choice([0.0, 1.0, 2.0]) + 0.5 for _ in range(4)]) for i in range(60)] + [(99, "c", None)]
    table = spark.createDataFrame(vectors, "vec_id long, collection string, embedding array<float>")
    got = {(r.query_id, r.collection, r["rank"]): r.vec_id for r in retrieval.nearest(table, table.where("vec_id < 5").selectExpr("vec_id AS query_id", "embedding"), 3).collect()}

    def distance(a, b):
        dot = sum(x * y for x, y in zip(a, b))
        return round(1 - dot / (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5, 9)

    for q in range(5):
        for name in ("c", None):
            ranked = sorted((distance(vectors[q][2], v), i) for i, c, v in vectors[:60] if c == name)[:3]
            assert [got[q, name, k + 1] for k in range(3)] == [i for _, i in ranked]
    assert retrieval.nearest(table.where("false"), table.where("false").selectExpr("vec_id AS query_id", "embedding"), 3).count() == 0


def test_ledger_ties_and_marks(spark):
    t = dt.datetime(2024, 1, 1)
    schema = "path string, status string, file_size long, file_mtime long, discovered_at timestamp, started_at timestamp, finished_at timestamp, reason string, error string, duplicate_of string, jsonl_name string, jsonl_archived boolean, chroma_upserted boolean, chunks int, duplicates int"
    row = lambda path, status, at=None, done=False: (path, status, 1, 1, t, at, at if done else None, None, None, None, None, done, done, 1, 0)
    rows = [row("a", "pending"), row("a", " Completed", t, True), row("a", "skipped", t + dt.timedelta(1), True), row("b", "pending"), row(None, "failed"), row("b", "pending")]
    table = spark.createDataFrame(rows, schema)
    assert {r.path: r.status for r in ledger.current(table).collect()} == {"a": "skipped", "b": "pending"}
    found = spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("c", 1, 1)], "path string, now_size long, now_mtime long")
    assert {r.path: r.decision for r in ledger.to_process(found, table).collect()} == {"a": "skip", "b": "run", "c": "run"}
    assert ledger.summary(ledger.current(table.where("false"))).first().percent == 0.0
    paths = spark.createDataFrame([("a/b",), ("a b",), ("b",)], "path string")
    assert {r.path for r in ledger.after_mark(paths, "a/b").collect()} == {"a b", "b"}
    assert ledger.after_mark(paths, "unknown").count() == 3


def test_rates(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("k", t + dt.timedelta(seconds=s)) for s in (0, 59, 60, 61)]
    out = usage.rate_window(spark.createDataFrame(rows, "k string, ts timestamp_ntz"), ["k"], "ts").orderBy("ts").collect()
    assert [r.in_window for r in out] == [1, 2, 2, 3]


def test_json_cascade():
    assert json_repair.cascade('```json\n{"a": 1}\n```') == ("direct", '{"a": 1}')
    assert json_repair.cascade('so: {"a": "}"} and {') == ("balanced", '{"a": "}"}')
    assert json_repair.cascade('{"a": [1, {"b": "x\\"y') == ("repaired", '{"a": [1, {"b": "x\\"y"}]}')
    assert json_repair.cascade("nothing") == ("raw", "nothing")
    assert json_repair.cascade(None) == ("raw", None)


def test_catalogue_round_trip(spark):
    rows = [("D", "100", "1", "A 1", "x"), ("D", "100", "2", "A 2", "y"), ("E", "200", "1", "B 1", None), ("D", "100", "1", "A 1", "x")]
    courses = spark.createDataFrame(rows, "department string, level string, semester string, code string, title string")
    assert {tuple(r) for r in catalogue.flatten(catalogue.nest(courses)).collect()} == set(rows)


def test_embedding_and_recognition(spark):
    texts = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "id int, text string")
    rows = {r.id: r.v for r in texts.select("id", external.embed(F.col("text"), external.hashing_client, 2).alias("v")).collect()}
    assert len(rows[1]) == 64 and rows[2] is None and rows[3] is None
    calls = []

    def flaky(batch):
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return [[0.0]] * len(batch)

    assert external.with_retries(flaky, pause=0)(["x"]) == [[0.0]] and len(calls) == 3
    page = spark.createDataFrame([(1, "long " * 30, b"i"), (2, "", b"image"), (3, None, None)], "n int, text string, image binary")
    assert {r.n: r.text for r in external.recognise(page, lambda: lambda image: image.decode()).collect()} == {1: "long " * 30, 2: "image", 3: ""}


def test_page_class_and_everytag(spark):
    row = spark.range(1).select(pages.page_class(F.lit(0.005), F.lit(10), F.lit(50)), pages.page_class(F.lit(0.1), F.lit(130), F.lit(5)), pages.page_class(F.lit(0.05), F.lit(0), F.lit(0))).first()
    assert tuple(row) == ("image", "printed", "handwriting")
    tags = spark.createDataFrame([(1, "x", None), (2, "y", True), (3, None, False)], "id int, tag string, everytag boolean")
    assert {r.id for r in retrieval.tagged(tags, "tag", "x").collect()} == {1, 2}


def test_numbers_of_a_hot_key(spark):
    from quirebase.operators.ordering import number_rows

    rows = [("hot" if k % 3 else None if k % 2 else f"k{k % 5}", k % 50, k) for k in range(2000)]
    table = spark.createDataFrame(rows, "key string, ts int, id int").repartition(7)
    got = {r.id: r.place for r in number_rows(table, ["key"], ["ts", "id"]).collect()}
    counts: dict = {}
    for key, ts, k in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        counts[key] = counts.get(key, 0) + 1
        assert got[k] == counts[key]
    assert number_rows(table.where("false"), ["key"], ["id"]).count() == 0


def test_pdf_source_in_spark(spark, tmp_path):
    from quirebase.sources.pdf import PdfPages

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\ftwo")
    (tmp_path / "b.txt").write_text("")
    spark.dataSource.register(PdfPages)
    pages = spark.read.format("pdf_pages").option("suffix", ".txt").option("extractor", "quirebase.sources.pdf:read_text_pages").load(str(tmp_path))
    rows = sorted((r.path.rsplit("/", 1)[1], r.page_no, r.text) for r in pages.collect())
    assert rows == [("a.txt", 1, "one"), ("a.txt", 2, "two"), ("b.txt", 1, "")]
