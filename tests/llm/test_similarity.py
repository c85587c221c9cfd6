"""Neighbours, versions, history and leaks against brute force."""

import os
import random
import time
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("quirebase.llm")
from quirebase.llm.history import History, HistoryParams, arrivals, chunk_rows, repeated_arrivals  # noqa: E402
from quirebase.llm.leaks import LeakParams, edits_within, find_leaks, near_leaks  # noqa: E402
from quirebase.llm.neighbours import Forest, ForestParams, Regions, decode, encode, neighbour_rows, similar_pairs  # noqa: E402
from quirebase.llm.versions import VersionParams, version_groups, version_pairs  # noqa: E402
from quirebase.llm.words import WORD, words_of  # noqa: E402

VECTORS = "vec_id long, embedding array<float>, rep string, key int"


def clustered(n, dimension, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(n // 8, dimension))
    return (centres[draw.integers(0, len(centres), n)] + 0.55 * draw.normal(size=(n, dimension))).astype(np.float32)


def exact_top(v, k):
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    return np.argsort(-s, axis=1)[:, :k], s


def test_codes_keep_angles():
    v = clustered(50, 33, 1)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    assert np.abs(decode(encode(v))[:, :33] @ decode(encode(v))[:, :33].T - u @ u.T).max() < 5e-4


def test_neighbours_of_many_leaves(spark):
    v = clustered(3000, 16, 2)
    table = spark.createDataFrame([(i, x.tolist(), "clash", 0) for i, x in enumerate(v)], VECTORS)
    rows = neighbour_rows(table, ForestParams(k=10, dimension=16, leaf_size=150, probes=8)).collect()
    top, _ = exact_top(v, 10)
    wanted = {(i, j) for i, near in enumerate(top) for j in near.tolist()}
    got = {(r.vec_id, r.neighbour) for r in rows}
    assert len(wanted & got) / len(wanted) >= 0.9
    assert max(np.unique([r.vec_id for r in rows], return_counts=True)[1]) <= 10


def test_leaves_that_the_sample_leaves_large_are_divided(spark):
    v = clustered(3000, 16, 4)
    table = spark.createDataFrame([(i, x.tolist(), "clash", 0) for i, x in enumerate(v)], VECTORS)
    rows = neighbour_rows(table, ForestParams(k=10, dimension=16, leaf_size=100, per_leaf=1_000, probes=3)).collect()
    top, _ = exact_top(v, 10)
    wanted = {(i, j) for i, near in enumerate(top) for j in near.tolist()}
    assert len(wanted & {(r.vec_id, r.neighbour) for r in rows}) / len(wanted) >= 0.8


def test_a_queue_takes_the_best_leaves_of_all_trees():
    v = clustered(2000, 16, 5)
    forest = Forest(v, 2000, ForestParams(dimension=16, leaf_size=100, probes=6))
    rows, leaves, own = forest.visit(v)
    assert (np.bincount(rows) == 6).all() and (np.bincount(rows[own]) == len(forest.trees)).all()
    every = [t.visit(v[:50], 9.0) for t in forest.trees]
    for r in range(50):
        ranked = sorted(((p, leaf + o) for t, o in zip(every, forest.offsets) for row, leaf, p in zip(*t) if row == r), reverse=True)
        priority = {leaf: p for p, leaf in ranked}
        assert sorted(priority[leaf] for leaf in leaves[rows == r].tolist()) == sorted(p for p, _ in ranked[:6])


def test_few_pairs_are_missed_in_a_table_of_many_leaves(spark):
    v = clustered(24_000, 32, 6)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    wanted = set()
    for start in range(0, len(u), 2_000):
        s = u[start : start + 2_000] @ u.T
        s[np.arange(len(s)), start + np.arange(len(s))] = -2
        top = np.argpartition(-s, 9, axis=1)[:, :10]
        row, col = np.nonzero(np.take_along_axis(s, top, 1) >= 0.7)
        wanted |= {(min(a, b), max(a, b)) for a, b in zip((start + row).tolist(), top[row, col].tolist())}
    table = spark.createDataFrame(pa.table({"vec_id": np.arange(len(v)), "embedding": pa.array(list(v))}))
    got = {(r.vec_id_a, r.vec_id_b) for r in similar_pairs(table, 0.7, ForestParams(dimension=32, leaf_size=30)).collect()}
    assert len(wanted & got) / len(wanted) >= 0.985
    assert len(wanted & got) / len(got) >= 0.985


def test_a_vector_belongs_to_more_regions_in_a_larger_table():
    v = clustered(20_000, 64, 7)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    few, many = Regions(v, 100_000, ForestParams()), Regions(v, 3_000_000, ForestParams())
    assert Regions(v, 20_000, ForestParams()).each == 1 < few.each < many.each
    assert len(many.centres) * 60_000 >= 3_000_000 * many.each
    draw = np.random.default_rng(8)
    near = v[:2_000] + 0.8 * draw.normal(size=(2_000, 64)).astype(np.float32) / 8
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    x, y = many.of(v[:2_000]), many.of(near)
    assert (x[:, :, None] == y[:, None, :]).any(axis=(1, 2)).mean() >= 0.98
    flat = np.zeros_like(v)
    flat[:, :2] = draw.normal(size=(len(v), 2))
    assert Regions(flat / np.linalg.norm(flat, axis=1, keepdims=True), 3_000_000, ForestParams()).each < 10


def test_similar_pairs_with_copies_and_unusable(spark):
    v = clustered(300, 8, 3)
    rows = [(i, x.tolist(), None, 0) for i, x in enumerate(v)]
    copies = [(1000 + i, v[0].tolist(), None, 0) for i in range(40)]
    bad = [(2000, None, None, 0), (2001, [0.0] * 8, None, 0), (2002, [1.0] * 7, None, 0), (2003, [float("nan")] * 8, None, 0), (2004, [float("inf")] + [0.0] * 7, None, 0), (2005, [None] + [1.0] * 7, None, 0), (None, [1.0] * 8, None, 0)]
    got = {(r.vec_id_a, r.vec_id_b) for r in similar_pairs(spark.createDataFrame(rows + copies + bad, VECTORS), 0.7, ForestParams(dimension=8)).collect()}
    assert not {x for p in got for x in p} & set(range(2000, 2006))
    same = {0, *range(1000, 1040)}
    inside = defaultdict(set)
    for a, b in got:
        if a in same and b in same:
            inside[a].add(b), inside[b].add(a)
    assert set(inside) == same and all(len(p) >= 10 for p in inside.values())
    top, s = exact_top(v, 10)
    lone = {(min(i, j), max(i, j)) for i, near in enumerate(top) for j in near.tolist() if s[i, j] >= 0.7 and i and j and s[i, 0] < s[i, near[-1]] and s[j, 0] < s[i, j]}
    assert lone - got == set()
    assert similar_pairs(spark.createDataFrame([], VECTORS)).count() == 0
    assert similar_pairs(spark.createDataFrame(rows[:1], VECTORS), 0.7, ForestParams(dimension=8)).count() == 0


def texts_of(seed, n=120):
    random.seed(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    standing = [random.choice(vocabulary) for _ in range(25)]
    out = []
    for k in range(n):
        base = [random.choice(vocabulary) for _ in range(random.randint(5, 60))] if k % 3 or not out else list(random.choice(out))
        for _ in range(random.randint(0, 4) if not k % 3 else 0):
            base[random.randrange(len(base))] = random.choice(vocabulary)
        out.append(base + (standing if k % 5 == 0 else []))
    return [" ".join(x).upper() if k % 7 == 0 else ", ".join(x) for k, x in enumerate(out)]


def jaccard_pairs(rows, k, t):
    sets = {h: set(zip(*(words_of(x)[i:] for i in range(k)))) for h, x in rows}
    names = sorted(sets)
    return {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if sets[a] & sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= t - 1e-12}


@pytest.mark.parametrize("words,similarity,hot", [(3, 0.6, 20_000), (5, 0.8, 20_000), (3, 0.6, 4)])
def test_versions(spark, words, similarity, hot):
    rows = [(f"h{k:03}", t) for k, t in enumerate(texts_of(words))]
    extra = [*rows[:20], ("nul", None), (None, "w1 w2 w3 w4"), ("short", "one two"), ("empty", "")]
    table = spark.createDataFrame([(h, t, 1, "x") for h, t in rows + extra], "chunk_hash string, text string, id int, block string")
    params = VersionParams(words, similarity, hot)
    got = {(r.hash_a, r.hash_b) for r in version_pairs(table, params).collect()}
    wanted = jaccard_pairs(rows, words, similarity)
    assert wanted and got == wanted
    if hot == 20_000 and words == 3:
        group = {r.chunk_hash: (r.group, r.links) for r in version_groups(table, params).collect()}
        assert all(group[a][0] == group[b][0] <= a for a, b in wanted) and group["short"] == ("short", 0)
        assert sum(n for _, n in group.values()) == 2 * len(wanted)


def test_copies_of_a_text_are_posted_once(spark):
    from quirebase.llm import versions

    text = " ".join(f"w{k}" for k in range(30))
    table = spark.createDataFrame([("a", text)] * 3_000 + [("b", text + " x")] * 3_000 + [("c", text + " y z")], "chunk_hash string, text string").repartition(3)
    posted = []
    join = versions._join_region(VersionParams(3, 0.6))
    rows = table.selectExpr("xxhash64(chunk_hash) AS id", "text").toArrow().to_batches()

    class Counts:
        value = np.full(versions.COUNTERS, 2)

    for batch in versions._post(Counts, 1, VersionParams(3, 0.6))(iter(rows)):
        posted.append(batch)
    group = pa.Table.from_batches(posted)
    assert len(group) == 3 and len(join(pa.concat_tables([group] * 4))) == 3
    assert {(r.hash_a, r.hash_b) for r in version_pairs(table, VersionParams(3, 0.6)).collect()} == {("a", "b"), ("a", "c"), ("b", "c")}


def test_words_of_many_texts_are_those_of_each():
    from quirebase.llm import versions

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    draw = random.Random(1)
    texts = [None, "", "_", "a_b c", "\u00e9", "\U0001d400", every, *(every[c : c + 997] for c in range(0, len(every), 997))]
    texts += ["".join(draw.choice("abÉ_ \n\tΣσςİıKx数９²½😀𝐀ａ'’-·̈‍\x00\x1c\x85 ") for _ in range(draw.randint(0, 60))) for _ in range(200)]
    for some in (texts, [], [None], ["", "x"], ["plain words", None, "x_y"]):
        index, words, sizes = versions._split(some)
        ends = np.cumsum([0, *sizes]).tolist()
        found = [words[i] for i in index]
        assert [found[a:b] for a, b in zip(ends, ends[1:])] == [WORD.findall(x or "") for x in some]
    for k in (1, 3):
        owner, h = versions.Shingler(VersionParams(k, 0.6))(texts)
        assert np.bincount(owner, minlength=len(texts)).tolist() == [len(set(zip(*(words_of(x)[i:] for i in range(k))))) for x in texts]
        assert ((owner[1:] > owner[:-1]) | (h[1:] > h[:-1])).all()


def test_shingles_of_a_text_cost_less_than_its_words_one_by_one():
    from quirebase.llm import versions

    draw = random.Random(2)
    vocabulary = [f"{draw.choice(['soil', 'Größe', 'naïve', 'tray'])}{k}" for k in range(3_000)]
    texts = [", ".join(draw.choice(vocabulary) for _ in range(120)) for _ in range(1_200)]
    shingle = versions.Shingler(VersionParams(3, 0.6))

    def seconds(work):
        def once():
            start = time.process_time()
            work()
            return time.process_time() - start

        return min(once() for _ in range(5))

    assert seconds(lambda: shingle(texts)) < 1.3 * seconds(lambda: [WORD.findall(x) for x in texts])


def test_a_posting_meets_those_of_a_size_alone_that_may_be_similar(spark, monkeypatch):
    from quirebase.llm import versions

    class Counting:
        longest = 0

        def __getattr__(self, name):
            return getattr(np, name)

        def repeat(self, *args):
            out = np.repeat(*args)
            self.longest += len(out)
            return out

    n = 1_000
    size = np.unique(np.geomspace(10, 1e8, n).astype(np.int64))
    raw = lambda x: pa.array([int(v).to_bytes(4, "little") for v in x], pa.binary())
    group = pa.table({"region": pa.array([0] * len(size), pa.int32()), "id": pa.array(np.arange(len(size))), "size": pa.array(size, pa.int32()), "signature": pa.array([bytes(32)] * len(size), pa.binary()), "tokens": raw([7] * len(size)), "places": raw(size // 10)})
    counting = Counting()
    monkeypatch.setattr(versions, "np", counting)
    pairs = versions._join_region(VersionParams(3, 0.6))(group).to_pydict()
    wanted = {(i, j) for i in range(len(size)) for j in range(i + 1, len(size)) if size[i] >= 0.6 * size[j] and min(size[i] - size[i] // 10, size[j] - size[j] // 10) >= 0.375 * (size[i] + size[j]) - 1e-9}
    assert wanted and set(zip(pairs["a"], pairs["b"])) == wanted and len(pairs["a"]) == len(wanted)
    assert counting.longest <= 3 * len(wanted) + 2 * len(size) < len(size) ** 2 / 4


def test_the_order_of_shingles_leaves_the_executors_disks(spark, monkeypatch):
    given, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: given.append(broadcast(self, value)) or given[-1])
    table = spark.createDataFrame([("a", "w1 w2 w3 w4 w5 w6"), ("b", "w1 w2 w3 w4 w5 w6 w7")], "chunk_hash string, text string")
    found = version_pairs(table, VersionParams(3, 0.6))
    assert given and not any(os.path.exists(x._path) for x in given)
    assert [(r.hash_a, r.hash_b) for r in found.collect()] == [("a", "b")]


def test_a_long_chain_of_versions_is_one_group(spark):
    hashes = [f"h{k:03}" for k in range(300)]
    random.Random(0).shuffle(hashes)
    rows = [(h, " ".join(f"w{2 * k + i}" for i in range(12))) for k, h in enumerate(hashes)]
    out = {r.chunk_hash: (r.group, r.links) for r in version_groups(spark.createDataFrame(rows, "chunk_hash string, text string"), VersionParams(3, 0.6)).collect()}
    assert out == {h: ("h000", 1 if k in (0, 299) else 2) for k, h in enumerate(hashes)}


def test_no_versions(spark):
    assert version_pairs(spark.createDataFrame([], "chunk_hash string, text string")).count() == 0


def brute_history(rows, t=0.5):
    chunks, files, batch = defaultdict(set), {}, {}
    for a, b, f, c in rows:
        batch[a] = b
        files[a] = f or files.get(a)
        if c:
            chunks[a].add(c)
    accepted, out = [], set()
    for b in sorted(set(batch.values())):
        new = []
        for a in sorted(x for x in batch if batch[x] == b):
            twins = [x for x in accepted if files[a] and files[a] == files[x] or chunks[a] and len(chunks[a] & chunks[x]) >= t * len(chunks[a] | chunks[x]) and chunks[a] & chunks[x]]
            out |= {(min(a, x), max(a, x)) for x in twins}
            if not twins:
                new.append(a)
        accepted += new
    return out


def intake(seed):
    random.seed(seed)
    rows, known = [], []
    for a in range(220):
        chunks = {f"c{random.randint(0, 900)}" for _ in range(random.randint(1, 9))} | ({"hot"} if a % 3 == 0 else set())
        if a % 4 == 0 and known:
            chunks = {c for c in random.choice(known) if random.random() < 0.8} | {f"n{a}"}
        known.append(chunks)
        file = f"f{random.randint(0, 150)}" if random.random() < 0.7 else None
        rows += [(a, 0 if a < 90 else 1 + (a - 90) // 15, file, c) for c in chunks | ({None} if a % 11 == 0 else set())]
    return rows + rows[:30] + [(500, 9, None, None), (501, 9, None, None)]


def test_history(spark):
    rows = intake(7)
    table = spark.createDataFrame([(*r, "x", 0) for r in rows], "arrival_id long, batch_no int, file_hash string, chunk_hash string, key string, chunks int")
    wanted = brute_history(rows)
    got = {(r.accepted_id, r.arrival_id) for r in repeated_arrivals(table, HistoryParams(compact_every=3, ranges=4)).collect()}
    assert wanted and got == wanted


def test_history_is_incremental(spark, tmp_path):
    first = spark.createDataFrame([(1, 0, "f", "a"), (2, 0, None, "b")], "arrival_id long, batch_no int, file_hash string, chunk_hash string")
    later = spark.createDataFrame([(3, 1, "f", "z"), (4, 1, None, "b"), (5, 1, None, "new")], first.schema)
    history = History(spark, str(tmp_path / "h"))
    assert history.ingest(arrivals(first).drop("batch_no"), chunk_rows(first)).count() == 0
    found = history.ingest(arrivals(later).drop("batch_no"), chunk_rows(later)).collect()
    assert {tuple(r) for r in found} == {(1, 3), (2, 4)}
    assert repeated_arrivals(first.where("false")).count() == 0


def test_history_goes_on_in_another_session(spark, tmp_path):
    rows = intake(3)
    table = spark.createDataFrame(rows, "arrival_id long, batch_no int, file_hash string, chunk_hash string")
    path, params = str(tmp_path / "h"), HistoryParams(compact_every=2, rows_per_range=50)
    for batch in sorted({r[1] for r in rows}):
        session = spark.newSession()
        history = History(session, path, params) if batch == 0 else History.open(session, path)
        part = table.where(F.col("batch_no") == batch)
        history.ingest(arrivals(part).drop("batch_no"), chunk_rows(part), batch)
    assert History.open(spark, path).params == params and len(history.runs) < len(history.batches)
    again = History.open(spark, path)
    again.ingest(arrivals(part).drop("batch_no"), chunk_rows(part), batch)
    assert again.written == history.written
    assert {(min(r), max(r)) for r in map(tuple, again.pairs().collect())} == brute_history(rows)


def test_a_batch_reads_ranges_of_its_keys_alone(spark, tmp_path):
    def ranges(files):
        stock = spark.range(files).selectExpr("id AS arrival_id", "0 AS batch_no", "cast(null AS string) AS file_hash", "explode(sequence(1, 4)) AS k").selectExpr("*", "concat(arrival_id, '-', k) AS chunk_hash")
        history = History(spark, str(tmp_path / f"h{files}"), HistoryParams(rows_per_range=100))
        history.ingest(arrivals(stock).drop("batch_no"), chunk_rows(stock))
        batch = stock.where("arrival_id in (7, 9)").withColumn("arrival_id", F.col("arrival_id") + 1_000_000)
        found = history.ingest(arrivals(batch).drop("batch_no"), chunk_rows(batch))
        assert {tuple(r) for r in found.collect()} == {(7, 1_000_007), (9, 1_000_009)}
        return history.ranges_read, 2 ** history.runs[0]["bits"]

    few, some = ranges(300)
    still_few, many = ranges(2_400)
    assert many >= 8 * some and still_few <= few + 2 and still_few <= 6


def test_hot_chunks_of_small_files(spark):
    rows = [(a, 0 if a < 60 else 1, None, c) for a in range(90) for c in (["hot"] if a % 30 == 0 else ["hot", f"own{a}"] if a % 2 else ["hot", "warm", f"own{a}"])]
    table = spark.createDataFrame(rows, "arrival_id long, batch_no int, file_hash string, chunk_hash string")
    assert {tuple(r) for r in repeated_arrivals(table).collect()} == brute_history(rows)


def leak_tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    return d, spark.createDataFrame([(i, q, e, "x") for i, q, e in items], "item_id long, question string, explanation string, text string")


def test_leaks(spark):
    random.seed(9)
    word = lambda: random.choice(["the", "of", "a", "Vector", "été", "x2", "数", "plan"])
    items = [(k, " ".join(word() for _ in range(random.choice([4, 12, 30]))), None if k % 3 else " ".join(word() for _ in range(15))) for k in range(40)] + [(40, None, ""), (1, "again but other words", None)]
    docs = []
    for k in range(80):
        text = [word() for _ in range(random.randint(0, 80))]
        if k % 4 == 0:
            w = (random.choice(items)[1] or "").split()
            text[5:5] = w[random.randint(0, 2) :]
        docs.append((k, " - ".join(text).upper() if k % 5 == 0 else "\n".join(text)))
    docs += [(100, None), (101, ""), (3, docs[4][1]), (None, docs[0][1])]
    windows = defaultdict(set)
    for i, *fields in items:
        for f in fields:
            w = words_of(f)
            windows[i] |= {tuple(w[k : k + 10]) for k in range(len(w) - 9)}
    wanted = {(d, i) for d, t in docs if d is not None for i, ws in windows.items() if ws & {tuple(words_of(t)[k : k + 10]) for k in range(len(words_of(t)) - 9)}}
    got = {(r.doc_id, r.item_id) for r in find_leaks(*leak_tables(spark, docs, items)).collect()}
    assert wanted and got == wanted
    assert find_leaks(*leak_tables(spark, docs, [])).count() == 0 and find_leaks(*leak_tables(spark, [], items)).count() == 0


def test_leaks_with_edits(spark):
    random.seed(2)
    items = [(k, " ".join(f"w{random.randint(0, 5000)}" for _ in range(12)), None) for k in range(150)]
    docs = []
    for k, q, _ in items:
        w = q.split()
        w[random.randrange(1, 11)] = "changed"
        docs.append((k, " ".join(f"d{random.randint(0, 5000)}" for _ in range(20)) + " " + " ".join(w) + " tail"))
    got = {(r.doc_id, r.item_id) for r in find_leaks(*leak_tables(spark, docs, items), params=LeakParams(max_edits=1)).collect()}
    assert len(got & {(k, k) for k in range(150)}) >= 0.95 * 150 and all(a == b for a, b in got)


@pytest.mark.parametrize("most", [1, 2])
def test_recall_of_each_kind_of_edit(spark, most):
    random.seed(most)
    fresh = lambda: f"w{random.randint(0, 10**9)}"
    items = [(k, " ".join(fresh() for _ in range(10)), None) for k in range(600)]
    docs, kind_of = [], {}
    for k, q, _ in items:
        w, kind_of[k] = q.split(), ("replace", "insert", "delete")[k % 3]
        for _ in range(most):
            at = random.randrange(len(w))
            w[at : at + (kind_of[k] != "insert")] = [] if kind_of[k] == "delete" else [fresh()]
        docs.append((k, " ".join([fresh() for _ in range(random.randint(0, 5))] + w + [fresh() for _ in range(k % 4)])))
    found = near_leaks(*leak_tables(spark, docs, items), params=LeakParams(max_edits=most)).collect()
    assert all(r.doc_id == r.item_id and r.edits <= most for r in found)
    for kind in ("replace", "insert", "delete"):
        mine = [k for k in kind_of if kind_of[k] == kind]
        assert len({r.doc_id for r in found} & set(mine)) >= 0.93 * len(mine), kind


def test_a_full_filter_changes_no_result(spark):
    items = [(k, " ".join(f"a{k}b{i}" for i in range(12)), None) for k in range(50)]
    tables = leak_tables(spark, [(k, f"x {q} y") for k, q, _ in items], items)
    assert {tuple(r) for r in find_leaks(*tables, params=LeakParams(filter_bits=6)).collect()} == {(k, k) for k in range(50)}


def test_edits_of_a_beginning():
    row = lambda words, width: np.array([[ord(w) for w in words.split()] + [0] * (width - len(words.split()))], np.uint64)
    count = lambda passage: edits_within(row("a b c d e", 5), row(passage, 7))[0]
    assert count("a b c d e x y") == 0
    assert count("a b d e x y") == count("a b x c d e") == count("a x c d e z") == 1
    assert count("") == 5 and count("a b c") == 2
