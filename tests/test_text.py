"""Text expressions against plain Python, with property tests."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirebase.functions import text as X

TEXTS = [None, "", "   \n\t ", "one", "a b\r\n\r\nc d\re", "x" * 5000, "　wide space  ", "p1\n\n\n p2 \n \np3", "Dr. Who? Yes! No.", "word " * 900, "é́ ß 漢字 \U0001f600"]


def column(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", expression.alias("out")).collect()
    return [r.out for r in sorted(rows, key=lambda r: r.i)]


def test_python_white_space(spark):
    every = "".join(map(chr, range(0xD800)))
    assert column(spark, [every], F.regexp_replace("text", X.SPACE, "")) == ["".join(c for c in every if not c.isspace())]


#: Recorded values: a text, its paragraphs, and its chunks of at least 8 and at most 20 characters with an overlap of 6.
RECORDED = [
    (None, [], []),
    ("   \n\t ", [], []),
    ("a b\r\n\r\nc d\re", ["a b", "c d\ne"], ["a b\n\nc d\ne"]),
    ("p1\n\n\n p2 \n \np3", ["p1", "p2", "p3"], ["p1\n\np2\n\np3"]),
    ("one two three four\n\nfive six seven eight\n\nnine", ["one two three four", "five six seven eight", "nine"], ["one two three four", "four five six seven eight", " eight nine"]),
    ("short\n\na paragraph beyond the limit\n\nend", ["short", "a paragraph beyond the limit", "end"], ["short\n\na paragraph beyond the limit", " limit end"]),
    ("unbrokenword\n\nanotherunbrokenone", ["unbrokenword", "anotherunbrokenone"], ["unbrokenword", "enword anotherunbrokenone"]),
]


def test_recorded_paragraphs_and_chunks(spark):
    texts = [t for t, *_ in RECORDED]
    assert column(spark, texts, X.paragraphs(F.col("text"))) == [p for _, p, _ in RECORDED]
    assert column(spark, texts, X.chunk(X.paragraphs(F.col("text")), 8, 20, 6)) == [c for *_, c in RECORDED]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n", max_size=900), min_size=1, max_size=40))
def test_properties_of_chunks(spark, texts):
    least, most, glue = 20, 60, "\n\n"
    parts = column(spark, texts, X.paragraphs(F.col("text")))
    merged = column(spark, texts, X.merge_paragraphs(X.paragraphs(F.col("text")), least, most))
    overlapped = column(spark, texts, X.chunk(X.paragraphs(F.col("text")), least, most, 10))
    for text, paragraphs, chunks, overlaps in zip(texts, parts, merged, overlapped):
        assert all(p and p == p.strip() for p in paragraphs) and "".join("".join(paragraphs).split()) == "".join(text.split())
        assert [p for c in chunks for p in c.split(glue)] == [q for p in paragraphs for q in p.split(glue)]
        assert all(len(c) >= least for c in chunks[:-1])
        assert all(len(c) <= most or len(c.rpartition(glue)[0]) < least for c in chunks)
        assert all(len(a) + 2 + len(b.split(glue)[0]) > most for a, b in zip(chunks, chunks[1:]))
        assert overlaps[:1] == chunks[:1] and len(overlaps) == len(chunks)
        for before, plain, over in zip(chunks, chunks[1:], overlaps[1:]):
            assert over.endswith(" " + plain) and len(over) - len(plain) <= 11 and before.endswith(over[: -len(plain) - 1])


def test_words_and_quality(spark):
    assert column(spark, TEXTS, X.word_count(F.col("text"))) == [len((t or "").split()) for t in TEXTS]
    assert column(spark, TEXTS, X.effective_length(F.col("text"))) == [len("".join((t or "").split())) for t in TEXTS]
    assert column(spark, TEXTS, X.token_estimate(F.col("text"))) == [max(1, len(t or "") // 4) for t in TEXTS]
    assert column(spark, [None, "", "!!!"], X.readability(F.col("text"))) == [None, None, None]


@pytest.mark.parametrize("full", [False, True])
def test_chunks_by_words(spark, full):
    most, overlap, least = 30, 5, 4
    texts = ["\n".join(f"w{n}x{k} " * (k % 17 + 1) for k in range(n)) for n in (0, 1, 5, 60)] + [None]
    out = column(spark, texts, X.chunk_by_words(X.lines(F.col("text")), most, overlap, least, full))
    assert out[0] == [] and out[1] == [] and out[4] == [] and len(out[3]) > 10
    for text, chunks in zip(texts, out):
        fresh = []
        for before, chunk in zip([None, *chunks], chunks):
            assert len(chunk.split()) >= least
            repeated = before is not None and chunk.split()[:overlap] == before.split()[-overlap:] and "\n\n" in chunk
            assert before is None or repeated or full and len(before.split()) < overlap
            lines = chunk.split("\n\n")[repeated:]
            fresh += lines
            assert len(chunk.split()) <= most or len(lines) == 1
        assert fresh == [x.strip() for x in (text or "").split("\n") if x.strip()][: len(fresh)]


def test_recorded_chunks_by_words(spark):
    text = "a b c\nd e f\ng h\ni j k l m n o p\nq"
    by_words = lambda **k: column(spark, [text], X.chunk_by_words(X.lines(F.col("text")), 6, 2, 2, **k))[0]
    assert by_words() == ["a b c\n\nd e f", "e f\n\ng h", "g h\n\ni j k l m n o p", "o p\n\nq"]
    assert column(spark, ["a\nb c d e f g\nh"], X.chunk_by_words(X.lines(F.col("text")), 6, 2, 1, full_overlap_only=True))[0] == ["a", "b c d e f g", "f g\n\nh"]


def test_muttering_and_snapshot(spark):
    assert column(spark, ["Let me see. It is 4! We recalculate now. Done", None], X.drop_muttering(F.col("text"))) == ["It is 4! Done", None]
    assert column(spark, ["a\n b" * 200, None], X.snapshot(F.col("text")))[0][-1] == "…"
    assert column(spark, ["a\n----- PAGE BREAK ---\nb"], X.drop_page_breaks(F.col("text"))) == ["a\n\nb"]


def test_document_type_in_any_script(spark):
    texts = ["été — lecture", "“exam” à Noël", "Это test.", "quiz\n", "électure", "lectureé", "тестlab", "book漢", "x_test", "数 PQ 学", "ſ notes", "naïve", "", None]
    patterns = [(re.compile(p), t) for p, t in X.DOCUMENT_TYPES]
    wanted = [None if t is None else next((n for p, n in patterns if p.search(t.lower())), None) for t in texts]
    assert wanted[:5] == ["lecture", "exam", "exam", "exam", None]
    assert column(spark, texts, X.document_type(F.col("text"))) == wanted


def test_all_texts_are_typed_and_counted(spark, tmp_path):
    from quirebase.plans import catalog

    rows = [(1, "Été: lecture", 12, "/a/GLG/400/1/GLG 401/x.pdf", "h"), (2, "plain exam", 10, None, None), (3, "урок", 4, "/b", "g"), (4, None, None, "/c", "k")]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, path string, file_hash string").withColumn("extracted_at", F.lit(None).cast("timestamp_ntz"))
    table.write.parquet(f"{tmp_path}/documents.parquet")
    run = lambda name: catalog.queries()[name](spark, str(tmp_path)).collect()
    for name in ("document_type", "document_type_all_texts"):
        assert {r.doc_id: r.document_type for r in run(name)} == {1: "lecture", 2: "exam", 3: None}
    scores = {r.doc_id: r.completeness for r in run("metadata_completeness_all_texts")}
    assert scores == {1: 100.0, 2: 37.5, 3: 37.5}
    assert sum(r.documents for r in run("metadata_summary_all_texts")) == 3
    assert {r.doc_id: r.completeness for r in run("metadata_completeness")} == {1: 70.0, 2: 20.0, 3: 20.0, 4: 10.0}
    assert sum(r.documents for r in run("metadata_summary")) == 4


def test_records_with_document_information(spark):
    from quirebase.operators.metadata import document_records

    docs = spark.createDataFrame([(1, "/a.pdf", "a lecture", "h", 9), (2, None, None, None, None), (1, "/a.pdf", "a lecture", "h", 9)], "doc_id long, path string, text string, file_hash string, n_chars long").withColumn("extracted_at", F.current_timestamp())
    info = spark.createDataFrame([("/a.pdf", "T", "D:2020", None, 7), ("/a.pdf", "T", "D:2020", None, 7), (None, "x", "x", "x", 1)], "path string, title string, created string, modified string, pages int")
    out = [(r.doc_id, r.pdf_title, r.page_count, r.word_count, r.completeness) for r in document_records(docs, info).orderBy("doc_id").collect()]
    assert out == [(1, "T", 7, 2, 50.0), (1, "T", 7, 2, 50.0), (2, None, 0, 0, 0.0)]
    assert document_records(docs.where("false"), info).count() == 0
