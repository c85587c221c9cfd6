"""Repair of scanned pages and of wrongly decoded text."""

import random

import pytest

pytest.importorskip("quirebase.llm")
from quirebase.llm import mojibake, scans  # noqa: E402

WORDS = "the model shows that membrane pattern controls relative summary between internal conditions because modern library figures remain visible under direct sunlight while certain minerals dissolve".split()
PAGES = "file_hash string, page_no int, text string, word string"


def corpus(spark):
    random.seed(6)
    rows, wanted = [], set()
    for f in range(30):
        for p in range(1, 5):
            lines = [" ".join(random.choice(WORDS) for _ in range(8)) + " end." for _ in range(12)]
            name = f"f{f:02}"
            if f < 8 and p == 2:
                lines[3] = "some mernbrane she11 and c0ntrols it"
                lines[5] = "there is a sum-"
                lines[6] = "mary that the mode1 shows here"
                wanted |= {(name, p, 6, "misread"), (name, p, 8, "hyphen"), (name, p, 9, "misread")}
            text = [f"A short course | Part {f}", "", *lines, "", f"- {p + 4} -"]
            wanted |= {(name, p, 1, "furniture"), (name, p, len(text), "furniture")}
            rows.append((name, p, "\n".join(text), None))
    extra = [rows[0], (None, 1, "x", None), ("g", None, "x", None), ("g", 1, None, None), ("g", 2, "", None), ("h", 1, "x" * 100_000 + " long", None)]
    return spark.createDataFrame(rows + extra, PAGES), wanted


def test_line_findings(spark):
    table, wanted = corpus(spark)
    got = {tuple(r) for r in scans.line_findings(table).collect() if r.file_hash != "h"}
    assert wanted - got == set() and len(got - wanted) <= 2


def test_paragraphs(spark):
    table, _ = corpus(spark)
    text = " ".join(r.text for r in scans.paragraphs(table).where("file_hash = 'f03'").orderBy("page_no", "paragraph_no").collect())
    assert "membrane" in text and "controls it" in text and "summary that the model shows" in text
    assert "mernbrane" not in text and "A short course" not in text and "- 6 -" not in text


def test_a_file_of_many_pages_is_one_text(spark):
    random.seed(8)
    words = [random.choice(WORDS) for _ in range(20_000)]
    pages, at = [], 0
    for p in range(1, 1_101):
        lines = [" ".join(words[at + 9 * k : at + 9 * k + 9]) for k in range(2)]
        at += 18
        if p == 511:
            lines[-1] += " sum-"
        if p == 512:
            lines[0] = "mary " + lines[0]
        pages.append(("long", p, "\n".join(lines), None))
    pages += [("other", p, "the summary shows the summary and the summary remains\nsummary again and summary.", None) for p in range(1, 4)]
    rows = scans.paragraphs(spark.createDataFrame(pages, PAGES)).where("file_hash = 'long'").orderBy("paragraph_no").collect()
    assert [r.paragraph_no for r in rows] == list(range(1, len(rows) + 1))
    text = " ".join(r.text for r in rows).split()
    assert "summary" in text and "sum" not in text and "mary" not in text
    assert [w for w in text if w != "summary"] == [w for w in words[:at] if w != "summary"]
    whole = scans.paragraphs(spark.createDataFrame(pages, PAGES), scans.ScanParams(pages=10_000)).where("file_hash = 'long'").orderBy("paragraph_no").collect()
    assert [r.text for r in whole] == [r.text for r in rows]


def test_no_pages(spark):
    none = spark.createDataFrame([], PAGES)
    assert scans.line_findings(none).count() == 0 and scans.paragraphs(none).count() == 0


@pytest.mark.parametrize("read,word,most", [("mernbrane", "membrane", 0.3), ("m0del", "model", 0.3), ("pattem", "pattern", 0.3), ("giUes".lower(), "gilles", 0.3), ("une\\/en", "uneven", 0.3), ("model", "model", 0.0)])
def test_cost(read, word, most):
    assert scans.cost(read, word) <= most
    assert scans.cost("abcdef", "uvwxyz") > 1


SENTENCES = ["La théorie est limitée à l’été.", "Größe und Maß für Übung", "você não têm razão — “sim”", "простой вывод и корень", "señor, mañana será así", "plain ascii text only"]


def damaged(text, read_as, written_in="utf-8"):
    return text.encode(written_in, "replace").decode(read_as, "replace")


def test_damage(spark):
    rows = [(k, SENTENCES[k % len(SENTENCES)]) for k in range(600)]
    bad = [(1000, damaged(SENTENCES[0], "cp1252")), (1001, damaged(SENTENCES[1], "latin-1")), (1002, damaged(SENTENCES[4], "mac_roman")), (1003, damaged(SENTENCES[3], "koi8_r", "cp1251")), (1004, "plain then " + damaged(damaged(SENTENCES[0], "latin-1"), "cp1252")), (1005, "t�xt"), (1006, "la th&eacute;orie est")]
    table = spark.createDataFrame([(i, t, "x") for i, t in rows + bad] + [(2000, None, "x"), (2001, "", "x"), (2002, " \n", "x"), (None, "é", "x")], "doc_id long, text string, token string")
    assert {r.doc_id for r in mojibake.damaged_documents(table).collect()} == {i for i, _ in bad}
    out = {r.doc_id: r for r in mojibake.restored_documents(table).collect()}
    assert out[1000].restored == SENTENCES[0] and out[1001].restored == SENTENCES[1] and out[1002].restored == SENTENCES[4] and out[1003].restored == SENTENCES[3]
    assert out[1004].restored == "plain then " + SENTENCES[0] and out[1005].lost == 1 and out[1006].restored == "la théorie est"
    assert mojibake.damaged_documents(table.where("false")).count() == 0


@pytest.mark.parametrize("times", [1, 10])
def test_one_misreading_of_many_documents(spark, times):
    clean = [(k, SENTENCES[k % len(SENTENCES)]) for k in range(300 * times)]
    bad = [(10_000 + k, damaged(SENTENCES[3], "koi8_r", "cp1251")) for k in range(4 * times)]
    table = spark.createDataFrame(clean + bad, "doc_id long, text string")
    assert {r.doc_id for r in mojibake.damaged_documents(table).collect()} == {i for i, _ in bad}
    assert {r.restored for r in mojibake.restored_documents(table).collect()} == {SENTENCES[3]}
