"""Token counts against the tokenizer itself; invariants of packing."""

import random
from collections import defaultdict

import pytest

tokens = pytest.importorskip("quirebase.llm.tokens")
packing = pytest.importorskip("quirebase.llm.packing")

TEXTS = [None, "", " ", "a", "  two  spaces ", "I'll don't we'd", "naïve café – “x”", "数学 и русский", "word\n\n\n next\tline \n", "x" * 3000, "12345 6789 1.5e10", "\x00\x85　 end ", "ab " * 5000, "a", "\U0001f600\U0001f601 é́"]


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=tokens.PIECES, mergeable_ranks=tokens.vocabulary(tokens.VOCABULARY), special_tokens={})


def test_units_hold_whole_pieces():
    for text in TEXTS:
        if text:
            assert [p for u in tokens._units(text) for p in tokens.pieces_of(u)] == tokens.pieces_of(text)


def test_prefix_states_equal_the_tokenizer(encoding):
    random.seed(3)
    pieces = sorted({bytes(random.choice(b"aeinrst xyz\xc3\xa9\xff0") for _ in range(random.randint(1, 12))) for _ in range(3000)} | {t.encode() for t in TEXTS if t and len(t) < 4000})
    states = tokens.PrefixStates(tokens.vocabulary(tokens.VOCABULARY))
    for piece in pieces:
        assert states.tokens(piece) == len(encoding._encode_single_piece(piece))


def test_counts(spark, encoding):
    rows = [(i, t, "clash", i) for i, t in enumerate(TEXTS)] + [(3, "a", "again", 0)]
    out = tokens.token_counts(spark.createDataFrame(rows, "doc_id long, text string, piece string, tokens int")).collect()
    assert sorted((r.doc_id, -1 if r.tokens is None else r.tokens) for r in out) == sorted((i, -1 if t is None else len(encoding.encode_ordinary(t))) for i, t, *_ in rows)
    assert tokens.token_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_totals_have_one_name_for_a_slice(spark):
    docs = spark.createDataFrame([(1, "Lab Manual", "en-GB", "Physics", "/a//b.pdf"), (2, "lab-manual ", "EN", None, None), (3, None, "xx", "", "/c")], "doc_id long, source string, lang string, domain string, path string")
    counts = spark.createDataFrame([(1, 5), (2, 7), (3, None)], "doc_id long, tokens long")
    bills = spark.createDataFrame([("/a/b.pdf", 4, 1), ("/a/b.pdf", 4, 1), ("/a/b.pdf", 2, 1)], "file string, tokens long, batches int").selectExpr("*", "cast(null as decimal(18,9)) AS cost")
    out = {(r.source, r.lang, r.domain): (r.documents, r.tokens, r.billed_tokens) for r in tokens.token_totals(docs, counts, bills).collect()}
    assert out["all", "en", "all"] == (2, 12, 6) and out["all", "all", "physics"][0] == 1 and out["lab_manual", "all", "unknown"][0] == 1
    assert out["all", "all", "all"] == (3, 12, 6) and out["lab_manual", "en", "all"] == (2, 12, 6) and out["unknown", "unknown", "unknown"] == (1, 0, 0)


def test_every_notation_of_a_path_is_one(spark):
    plain = "/data/archive/GLG/400/x.pdf"
    notations = [plain, r"C:\data\archive\GLG\400\x.pdf", "c:/data/archive/GLG/400/x.pdf", "file:///data/archive/GLG/400/x.pdf", "file:///C:/data/archive/GLG/400/x.pdf", " /data//archive/./GLG/400/x.pdf "]
    rows = spark.createDataFrame([(n,) for n in notations], "file string").select(tokens.clean_path("file").alias("path")).collect()
    assert [r.path for r in rows] == [plain] * len(notations)


def test_bills_without_a_document_only_stay_unmatched(spark, small):
    clean = lambda name, column: spark.read.parquet(f"{small}/{name}.parquet").where(f"{column} is not null").select(tokens.clean_path(column).alias("cleaned"), column)
    bills, docs = clean("billing_state", "file").distinct(), clean("documents", "path").select("cleaned").distinct()
    unmatched = [r.file for r in bills.join(docs, "cleaned", "left_anti").collect()]
    assert bills.where(r"file rlike '^[A-Za-z]:'").count() > 0
    assert not [f for f in unmatched if not f.startswith("/data/")]


@pytest.mark.parametrize("per_task", [10_000, 40])
def test_packing(spark, per_task):
    random.seed(5)
    sizes = {i: random.choice([0, 1, 5, 50, 99, 100, 101, 250, 1000, random.randint(1, 400)]) for i in range(600)}
    counts = spark.createDataFrame([(i, s) for i, s in sizes.items()] + [(999, None)], "doc_id long, tokens long")
    targets = spark.createDataFrame([(1, 100), (2, 1000), (3, None), (4, 0)], "target_id int, capacity int")
    out = packing.pack(counts, targets, per_task).collect()
    bins, placed = defaultdict(int), defaultdict(list)
    for r in out:
        bins[r.target_id, r.container_id] += r.n_tokens
        placed[r.target_id, r.doc_id].append((r.start_token, r.n_tokens))
    for target, capacity in ((1, 100), (2, 1000)):
        for doc, size in sizes.items():
            parts = sorted(placed.get((target, doc), []))
            assert sum(n for _, n in parts) == size and [s for s, _ in parts] == [k * capacity for k in range(len(parts))]
            assert len(parts) == -(-size // capacity)
        fills = [f for (t, _), f in bins.items() if t == target]
        assert max(fills) <= capacity
        assert sum(fills) / (len(fills) * capacity) > (0.9 if per_task == 10_000 else 0.8)
    assert not [r for r in out if r.target_id > 2]
    assert {r.target_id: r.tokens for r in packing.fill_report(packing.pack(counts, targets)).collect()} == {1: sum(sizes.values()), 2: sum(sizes.values())}


def test_packing_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, tokens long")
    assert packing.pack(none, spark.createDataFrame([(1, 10)], "target_id int, capacity int")).count() == 0
    assert packing.pack(none, spark.createDataFrame([], "target_id int, capacity int")).count() == 0
