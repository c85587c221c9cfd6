"""Text decoded in the wrong character encoding (problem 8).

A character model is counted over the whole corpus. From every distinct token
with a character beyond ASCII a best-first search walks the graph of texts
that encode, decode and unescape steps reach; its cost is the implausibility
of the text under the model plus a price for each step, states are kept by
hash, and the cheapest text wins. Tokens are what stands between ASCII white
space, since a stretch of damage can begin and end anywhere.
"""

from __future__ import annotations

import heapq
import html
import math
import re
import urllib.parse
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirebase.llm.words import text_slices
from quirebase.session import materialise, scratch_dir

#: Encodings a text may have been read in, and written in (fixed values).
READ_AS = ("cp1252", "latin-1", "cp1250", "cp1251", "cp437", "cp850", "mac_roman", "koi8_r")
WRITTEN_IN = ("utf-8", "cp1252", "cp1250", "cp1251", "koi8_r", "mac_roman", "cp850", "cp437", "gb18030")
#: Characters that only a failed decoding leaves: the replacement character and C1 controls.
LOST = re.compile("[�\x80-\x9f]")
#: Counters of the character model: its size is fixed, whatever the corpus.
BUCKETS = 1 << 21
_TOKEN = re.compile(r"[^ \t\n\r\f\v]+")
_ESCAPED = re.compile(r"&(#\d+|#x[0-9a-fA-F]+|[A-Za-z]+\d*);|%[0-9A-Fa-f]{2}|\\u[0-9a-fA-F]{4}")
_DIGITS = re.compile(r"\d")
_LOST_COST = 8.0
_MIDDLE_CAPITAL = re.compile("(?<=[a-zß-öø-ÿа-яё])[À-ÖØ-ÞА-ЯЁ]")


@dataclass(frozen=True)
class SearchParams:
    step_cost: float = 1.0  # nats a step must earn
    margin: float = 2.0  # nats by which the restored text must be cheaper
    slack: float = 2.0  # nats by which a state may be dearer than the one before
    strict_slack: float = 60.0  # the same after a step that read UTF-8
    depth: int = 4  # layers of damage
    share: float = 0.02  # of a token's count that its one-byte misreadings may reach, from ``seldom`` on
    seldom: int = 5
    together: int = 3  # distinct tokens of a document that one misreading must explain to show a commoner one


def _shape(token: str) -> str:
    """What the model sees: lower case, digits alike, ends marked."""
    return "\x02\x02" + _DIGITS.sub("0", token.lower()) + "\x03"


def _buckets(gram: str) -> tuple[int, int]:
    """Two counters for each n-gram; the smaller one is the nearer to its count."""
    import xxhash

    h = xxhash.xxh64_intdigest(gram)
    return h % BUCKETS, (h >> 32) % BUCKETS


def _grams(shape: str) -> Iterator[str]:
    for k in range(2, len(shape)):
        yield shape[k - 2 : k + 1]
        yield shape[k - 2 : k] + "\x00"
        yield "1" + shape[k - 1 : k + 1]
        yield "2" + shape[k - 1]
        yield "3" + shape[k]
        yield "4"
    yield "5" + shape


class CharModel:
    """Interpolated trigram costs in nats over hashed counts."""

    def __init__(self, counts: np.ndarray):
        self.counts, self.known = counts, {}

    def count(self, gram: str) -> float:
        i, j = _buckets(gram)
        return float(min(self.counts[i], self.counts[j]))

    def _cost(self, gram: str) -> float:
        n, (a, b, c) = self.count, gram
        one = (n("3" + c) + 0.01) / (n("4") + 1000)
        two = (n("1" + b + c) + 2 * one) / (n("2" + b) + 2)
        three = (n(gram) + 2 * two) / (n(a + b + "\x00") + 2)
        return -math.log(max(three, 1e-12))

    def cost(self, token: str, most: float = math.inf) -> float:
        """Implausibility of a token; infinite as soon as it is seen to exceed ``most``.

        What only a failed decoding leaves costs extra in the end, but may
        stand in a text on the way.
        """
        shape, known = _shape(token), self.known
        total = 8.0 * len(_MIDDLE_CAPITAL.findall(token)) - 0.5 * math.log1p(self.count("5" + shape))
        for k in range(2, len(shape)):
            gram = shape[k - 2 : k + 1]
            c = known.get(gram)
            if c is None:
                if len(known) > 500_000:
                    known.clear()
                c = known[gram] = self._cost(gram)
            total += c
            if total > most:
                return math.inf
        return total


def _byte_table(codec: str) -> dict[str, int]:
    """Characters of a one-byte codec; bytes it leaves undefined stand for the C1 controls they are kept as."""
    table = {}
    for byte in range(256):
        try:
            table[bytes([byte]).decode(codec)] = byte
        except UnicodeDecodeError:
            table.setdefault(chr(byte), byte)
    return table


class Graph:
    """The steps from a text to the texts it may have been misread from."""

    def __init__(self):
        self.tables = {c: _byte_table(c) for c in READ_AS}
        self.runs = {c: re.compile("[" + re.escape("".join(t)) + "]+") for c, t in self.tables.items()}

    def strict(self, text: str) -> bool:
        """Whether the text reads as UTF-8, which ordinary text seldom does by chance."""
        for read_as in READ_AS:
            for run in self.runs[read_as].findall(text):
                if not run.isascii():
                    try:
                        bytes(map(self.tables[read_as].__getitem__, run)).decode()
                        return True
                    except UnicodeDecodeError:
                        pass
        return False

    def neighbours(self, text: str) -> dict[str, bool]:
        """Texts a step away, and whether the step read UTF-8, which few texts allow by chance."""
        found: dict[str, bool] = {}
        tried = set()
        for read_as in READ_AS:
            table, run = self.tables[read_as], self.runs[read_as]
            parts = run.split(text)
            raw = [bytes(map(table.__getitem__, r)) for r in run.findall(text)]
            if all(r.isascii() for r in raw):
                continue
            for written_in in WRITTEN_IN:
                if read_as == written_in or (key := (written_in, *raw)) in tried:
                    continue
                tried.add(key)
                new = [parts[0]]
                for before, r, after in zip(run.findall(text), raw, parts[1:]):
                    try:
                        new.append(r.decode(written_in))
                    except UnicodeDecodeError:
                        new.append(before)
                    new.append(after)
                other = "".join(new)
                found[other] = found.get(other, False) or written_in == "utf-8"
        if _ESCAPED.search(text):
            unicode_escape = re.sub(r"\\u([0-9a-fA-F]{4})", lambda m: chr(int(m.group(1), 16)), text)
            for other in (html.unescape(text), urllib.parse.unquote(text), unicode_escape):
                found.setdefault(other, False)
        found.pop(text, None)
        return found

    def misreadings(self, text: str, original: str) -> list[str]:
        """The pairs of encodings by which ``original`` reads as ``text`` in one step."""
        pairs = []
        for read_as in READ_AS:
            table, run = self.tables[read_as], self.runs[read_as]
            for written_in in WRITTEN_IN:
                if read_as == written_in:
                    continue
                try:
                    other = run.sub(lambda r: bytes(map(table.__getitem__, r.group())).decode(written_in), text)
                except UnicodeDecodeError:
                    continue
                if other == original:
                    pairs.append(f"{read_as} {written_in}")
        return pairs


def restore(token: str, model: CharModel, graph: Graph, params: SearchParams = SearchParams()) -> tuple[str, bool]:
    """The cheapest text reachable from ``token``, itself unless another is cheaper by the margin; and whether that is in doubt.

    Any byte is a letter somewhere, so a common token isn't damage just because
    a more common one is near: other tokens of its document must confirm it.
    """
    plausible = model.cost(token)
    start = plausible + _LOST_COST * len(LOST.findall(token))
    best, best_cost = token, start
    seen = {hash(token)}
    heap = [(plausible, 0, token, plausible)]
    while heap:
        _, depth, text, plain = heapq.heappop(heap)
        if depth == params.depth:
            continue
        for other, strict in graph.neighbours(text).items():
            key = hash(other)
            if key in seen:
                continue
            seen.add(key)
            cost = model.cost(other, plain + (params.strict_slack if strict else params.slack))
            if cost == math.inf:
                continue
            total = cost + params.step_cost * (depth + 1)
            if (whole := total + _LOST_COST * len(LOST.findall(other))) < best_cost:
                best, best_cost = other, whole
            heapq.heappush(heap, (total, depth + 1, other, cost))
    if best_cost >= start - params.margin:
        return token, False
    often = model.count("5" + _shape(token))
    return best, often >= params.seldom and often > params.share * model.count("5" + _shape(best)) and not graph.strict(token)


def _tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for first, texts in text_slices(batch, "text"):
            docs, tokens = [], []
            for k, text in enumerate(texts):
                if text and not (text.isascii() and not _ESCAPED.search(text)):
                    found = {t for t in _TOKEN.findall(text) if not t.isascii() or _ESCAPED.search(t)}
                    if found:
                        docs.append(ids[first + k].as_py())
                        tokens.append(sorted(found))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(tokens, pa.list_(pa.string()))], ["doc_id", "tokens"])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    buckets_of: dict[str, tuple[int, int]] = {}
    for batch in batches:
        for token, n in zip(batch.column("token").to_pylist(), batch.column("documents").to_pylist()):
            for gram in _grams(_shape(token)):
                at = buckets_of.get(gram)
                if at is None:
                    if len(buckets_of) > 500_000:
                        buckets_of.clear()
                    at = buckets_of[gram] = _buckets(gram)
                counts[at[0]] += n
                counts[at[1]] += n
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["bucket", "times"])


def _search(counts, params: SearchParams):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, graph = CharModel(counts.value), Graph()
        for batch in batches:
            tokens = batch.column("token").to_pylist()
            changed = [(t, r, doubt) for t, (r, doubt) in ((t, restore(t, model, graph, params)) for t in tokens) if t != r or LOST.search(t)]
            columns = [[t for t, _, _ in changed], [r for _, r, _ in changed], [d for _, _, d in changed], [bool(LOST.search(t)) for t, _, _ in changed], [graph.misreadings(t, r) if t != r else [] for t, r, _ in changed]]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.list_(pa.string())))], ["token", "restored", "doubt", "lost", "misreadings"])

    return search


@dataclass(frozen=True)
class Damage:
    repairs: DataFrame  # doc_id, token, restored


def find_damage(docs: DataFrame, params: SearchParams = SearchParams()) -> Damage:
    """Damaged tokens of all texts with their cheapest readings.

    ``docs`` needs doc_id and text. Null, empty and pure ASCII texts hold none.
    A token is damaged if another text is cheaper than it by the margin, or if
    it has characters that only a failed decoding leaves. A common token is so
    only in documents where several distinct tokens have the same misreading,
    which doesn't depend on the size of the corpus.
    """
    spark = docs.sparkSession
    base = scratch_dir(spark)
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null and doc_id is not null")
    documents = materialise(source.mapInArrow(_tokens_of, "doc_id bigint, tokens array<string>"), f"{base}/tokens")
    vocabulary = materialise(documents.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("documents")), f"{base}/vocabulary")
    counts = np.zeros(BUCKETS, np.int64)
    grams = vocabulary.mapInArrow(_count_grams, "bucket int, times bigint").groupBy("bucket").agg(F.sum("times").alias("times")).toArrow()
    if grams.num_rows:
        counts[grams.column("bucket").to_numpy()] = grams.column("times").to_numpy()
    shared = spark.sparkContext.broadcast(counts)
    repairs = vocabulary.select("token").repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(_search(shared, params), "token string, restored string, doubt boolean, lost boolean, misreadings array<string>")
    hits = materialise(documents.select("doc_id", F.explode("tokens").alias("token")).join(materialise(repairs, f"{base}/repairs"), "token"), f"{base}/hits")
    doubtful = hits.where("doubt").select("doc_id", "token", F.explode("misreadings").alias("misreading"))
    seen = hits.join(doubtful.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "token", F.explode("misreadings").alias("misreading"))
    shown = seen.groupBy("doc_id", "misreading").agg(F.count_distinct("token").alias("tokens")).where(F.col("tokens") >= params.together)
    proven = doubtful.join(shown, ["doc_id", "misreading"], "left_semi").select("doc_id", "token").distinct().withColumn("proven", F.lit(True))
    held = ~F.col("doubt") | F.coalesce("proven", F.lit(False))
    kept = hits.join(proven, ["doc_id", "token"], "left").where(held | F.col("lost"))
    return Damage(kept.select("doc_id", "token", F.when(held, F.col("restored")).otherwise(F.col("token")).alias("restored")))


def damaged_documents(docs: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """doc_id of every document with a damaged token, once each."""
    damage = find_damage(docs, params)
    return damage.repairs.select("doc_id").distinct()


def restored_documents(docs: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """(doc_id, restored, repaired, lost) of every damaged document.

    ``restored`` is the whole text with each damaged token replaced by its
    cheapest reading, ``repaired`` counts the distinct tokens changed and
    ``lost`` those that still have characters no step brings back.
    """
    damage = find_damage(docs, params)
    lists = damage.repairs.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("token", "restored"))).alias("repairs"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, repaired, lost = [], [], []
            for text, pairs in zip(batch.column("text").to_pylist(), batch.column("repairs").to_pylist()):
                mine = dict(pairs)
                new = _TOKEN.sub(lambda m: mine.get(m.group(), m.group()), text)
                texts.append(new)
                repaired.append(sum(a != b for a, b in mine.items()))
                lost.append(sum(bool(LOST.search(b)) for b in mine.values()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(repaired, pa.int32()), pa.array(lost, pa.int32())], ["doc_id", "restored", "repaired", "lost"])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null")
    return source.join(lists, "doc_id").mapInArrow(apply, "doc_id bigint, restored string, repaired int, lost int")
