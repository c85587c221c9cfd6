"""Evaluation texts inside training text (problem 7).

An item is cut into windows as long as the shortest leak that counts (ten
words), a document into passages that begin at every word and are as much
longer as edits may make them. A random walk (CGK embedding) turns either into
a longer sequence in which few edits give few differing positions: at each
step it writes the word it stands at, and a bit drawn from step and word says
whether it goes on to the next. Samples of early positions are LSH keys;
samples are repeated until windows and passages within the edits share a key
as often as the wanted recall asks for, which is measured on drawn edits of
every kind. The edit distance of what shares a key decides.

Keys of all items pass into one bit filter of fixed size, which goes to every
task; the document passages that it lets through meet the windows in a join by
key. A filter that is too small for the items lets more through and changes no
result. Without edits equal windows walk alike: one repetition finds them all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirebase.llm.words import WORD, text_slices
from quirebase.session import materialise, scratch_dir

_BLOCK = 1 << 16  # bytes of the filter that are merged at a time
_TRIALS = 1_500  # drawn pairs of every kind of edit
_MOST_REPETITIONS = 300


@dataclass(frozen=True)
class LeakParams:
    window: int = 10  # words
    max_edits: int = 0  # words inserted, deleted or replaced
    samples: int = 4  # positions of the embedding in one key
    recall: float = 0.95  # of windows within max_edits
    filter_bits: int = 27  # the filter has 2 to the power of it bits (16 MB)
    seed: int = 7

    @property
    def passage(self) -> int:
        """Words of a document's passage, at most."""
        return self.window + self.max_edits

    @property
    def repetitions(self) -> int:
        """Keys needed to reach the recall for every kind of edit."""
        return _repetitions(self) if self.max_edits else 1

    def positions(self, repetition: int) -> list[int]:
        """Sampled positions in rising order, all before a walk is likely to leave the shortest passage."""
        draw = np.random.default_rng([self.seed, repetition])
        span = max(self.samples + 1, 3 * (self.window - self.max_edits) // 2)
        if not self.max_edits:
            return [0, *sorted(draw.choice(np.arange(1, span), self.samples - 1, replace=False).tolist())]
        first = int(draw.integers(0, max(1, self.window // 2)))
        return [first, *sorted(draw.choice(np.arange(first + 1, max(span, first + self.samples + 1)), self.samples - 1, replace=False).tolist())]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


class _Walk:
    """Stage by stage the keys of many passages over one array of words."""

    def __init__(self, symbols: np.ndarray, bits: np.ndarray, starts: np.ndarray, lengths: np.ndarray, repetition: int):
        self.symbols, self.bits, self.turn = symbols, bits, (7 * repetition) % 64
        self.starts, self.lengths, self.rows = starts, lengths, np.arange(len(starts))
        self.cur, self.at = np.zeros(len(starts), np.int64), 0
        self.key = np.full(len(starts), 1469598103934665603 + repetition, np.uint64)

    def _look(self, array: np.ndarray) -> np.ndarray:
        """What stands at each walk's place; 0 behind the passage."""
        inside = self.cur < self.lengths
        return np.where(inside, array[np.minimum(self.starts + self.cur, len(array) - 1)], np.uint64(0))

    def to(self, position: int) -> None:
        while self.at < position:
            self.cur += ((self._look(self.bits) >> np.uint64((self.at + self.turn) % 64)) & np.uint64(1)).astype(np.int64)
            self.at += 1
        self.key = (self.key ^ self._look(self.symbols)) * np.uint64(1099511628211)
        self.key ^= self.key >> np.uint64(29)

    def keep(self, rows: np.ndarray) -> None:
        for name in ("starts", "lengths", "rows", "cur", "key"):
            setattr(self, name, getattr(self, name)[rows])


@lru_cache(maxsize=16)
def _repetitions(params: LeakParams) -> int:
    """The fewest repetitions in which drawn pairs of each kind of edit share a key as often as wanted.

    Each kind counts with its lower bound of two standard deviations, as the
    drawn pairs are a sample; the same edits meet all repetitions, so that
    their dependence counts too.
    """
    draw = np.random.default_rng(params.seed)
    n, k = params.window, params.max_edits
    kinds = [("replace",), ("insert",), ("delete",), ("replace", "insert", "delete")]
    windows, passages = [], []
    for kind in kinds:
        for trial in range(_TRIALS):
            window = draw.integers(1, 2**62, n).tolist()
            text = list(window)
            for _ in range(k):
                edit, at = kind[int(draw.integers(len(kind)))], int(draw.integers(len(text)))
                text[at : at + (edit != "insert")] = [] if edit == "delete" else [int(draw.integers(1, 2**62))]
            text += draw.integers(1, 2**62, 2 * k).tolist()
            windows += window
            passages += text[: params.passage]
    a, b = np.array(windows, np.uint64), np.array(passages, np.uint64)
    rows = len(kinds) * _TRIALS
    starts_a, starts_b = np.arange(rows) * n, np.arange(rows) * params.passage
    found = np.zeros(rows, bool)
    wanted = params.recall + 2 * np.sqrt(params.recall * (1 - params.recall) / _TRIALS)
    for r in range(_MOST_REPETITIONS):
        left = _Walk(a, _mix(a + np.uint64(1)), starts_a, np.full(rows, n), r)
        right = _Walk(b, _mix(b + np.uint64(1)), starts_b, np.full(rows, params.passage), r)
        for position in params.positions(r):
            left.to(position), right.to(position)
        found |= left.key == right.key
        if found.reshape(len(kinds), -1).mean(axis=1).min() >= wanted:
            return r + 1
    raise ValueError(f"{params} reaches its recall in no {_MOST_REPETITIONS} repetitions")


class _Words:
    """Symbols of words, a 64-bit hash each, and the walk's bits."""

    def __init__(self):
        self.number, self.symbol = {}, [0]

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        import xxhash

        number = self.number
        if len(number) > 2_000_000:
            number.clear()
            del self.symbol[1:]
        out = np.empty(len(words), np.int64)
        for k, w in enumerate(words):
            n = number.get(w)
            if n is None:
                n = number[w] = len(self.symbol)
                self.symbol.append(xxhash.xxh64_intdigest(w.lower()) or 1)
            out[k] = n
        symbols = np.array(self.symbol, np.uint64)
        return symbols[out], _mix(symbols + np.uint64(1))[out]


def edits_within(windows: np.ndarray, passages: np.ndarray) -> np.ndarray:
    """Of each row: the fewest words to insert, delete or replace that make the window of a beginning of the passage.

    Both are arrays of word symbols; a passage that ends early is filled up with 0.
    """
    n, m = windows.shape[1], passages.shape[1]
    row = np.repeat(np.arange(m + 1, dtype=np.int8)[:, None], len(windows), axis=1)
    for i in range(n):
        last, row[0] = row[0].copy(), i + 1
        for j in range(m):
            here = last + (windows[:, i] != passages[:, j])
            last = row[j + 1].copy()
            np.minimum(here, np.minimum(last, row[j]) + 1, out=row[j + 1], casting="unsafe")
    return row.min(axis=0)


def _passages(texts: list[str | None], vocabulary: _Words, shortest: int, longest: int):
    """(symbols, bits, starts, lengths, text of each start) of all passages of several texts."""
    words: list[str] = []
    ends = []
    for text in texts:
        if text:
            words.extend(WORD.findall(text))
        ends.append(len(words))
    bounds = np.array(ends)
    starts = np.arange(max(0, len(words) - shortest + 1))
    owner = np.searchsorted(bounds, starts, side="right")
    room = bounds[owner] - starts if len(starts) else starts
    inside = room >= shortest
    symbols, bits = vocabulary.symbols(words)
    return symbols, bits, starts[inside], np.minimum(room[inside], longest), owner[inside]


def _packed(symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> pa.Array:
    """The symbols of each passage, filled up with 0."""
    at = np.arange(width)
    rows = np.where(at < lengths[:, None], symbols[np.minimum(starts[:, None] + at, max(0, len(symbols) - 1))], np.uint64(0))
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _windows(params: LeakParams):
    """Of every item text: its windows, as the symbols of their words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Words()
        for batch in batches:
            ids = batch.column("item_id").to_numpy()
            for first, texts in text_slices(batch, "text"):
                symbols, _, starts, lengths, owner = _passages(texts, vocabulary, params.window, params.window)
                yield pa.RecordBatch.from_arrays([pa.array(ids[first + owner]), _packed(symbols, starts, lengths, params.window)], ["item_id", "window"])

    return cut


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, width)


def _walks(column: pa.Array, params: LeakParams, repetitions: int) -> Iterator[tuple[int, _Walk]]:
    symbols = _unpacked(column, params.window).reshape(-1)
    starts = np.arange(len(column)) * params.window
    for r in range(repetitions if len(column) else 0):
        yield r, _Walk(symbols, _mix(symbols + np.uint64(1)), starts, np.full(len(column), params.window), r)


def _stages(walk: _Walk, params: LeakParams, repetition: int):
    """The walk at each sampled position, with the filter's bit of each key."""
    mask = np.uint64((1 << params.filter_bits) - 1)
    for k, position in enumerate(params.positions(repetition)):
        walk.to(position)
        yield _mix(walk.key + np.uint64((repetition * params.samples + k) * 0x9E3779B97F4A7C15 % 2**64)) & mask


def _window_keys(params: LeakParams, repetitions: int):
    """Of every window: its keys."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, walk in _walks(batch.column("window"), params, repetitions):
                for _ in _stages(walk, params, r):
                    pass
                yield pa.RecordBatch.from_arrays([pa.array(walk.key.view(np.int64)), batch.column("window")], ["key", "window"])

    return keys


def _window_bits(params: LeakParams, repetitions: int):
    """Blocks of the filter that the windows' keys set bits in."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits_set = np.zeros(1 << params.filter_bits - 3, np.uint8)
        for batch in batches:
            for r, walk in _walks(batch.column("window"), params, repetitions):
                for bit in _stages(walk, params, r):
                    np.bitwise_or.at(bits_set, (bit >> np.uint64(3)).astype(np.int64), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))
        blocks = bits_set.reshape(-1, min(_BLOCK, len(bits_set)))
        for k in np.flatnonzero(blocks.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([blocks[k].tobytes()], pa.binary())], ["block", "bits"])

    return mark


def _either(group: pa.Table) -> pa.Table:
    total = np.zeros(len(group.column("bits")[0].as_py()), np.uint8)
    for b in group.column("bits"):
        total |= np.frombuffer(b.as_py(), np.uint8)
    return pa.table({"block": group.column("block").slice(0, 1), "bits": pa.array([total.tobytes()], pa.binary())})


def _scan(filled, params: LeakParams, repetitions: int):
    """The passages that the filter lets through, with the key it happened by."""
    shortest = params.window - params.max_edits

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, bit_of = _Words(), filled.value
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for first, texts in text_slices(batch, "text"):
                symbols, bits, starts, lengths, owner = _passages(texts, vocabulary, shortest, params.passage)
                for r in range(repetitions if len(starts) else 0):
                    walk = _Walk(symbols, bits, starts, lengths, r)
                    for bit in _stages(walk, params, r):
                        walk.keep(np.flatnonzero(bit_of[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & np.uint8(1)))
                        if not len(walk.rows):
                            break
                    if len(walk.rows):
                        yield pa.RecordBatch.from_arrays([pa.array(ids[first + owner[walk.rows]]), pa.array(walk.key.view(np.int64)), _packed(symbols, walk.starts, walk.lengths, params.passage)], ["doc_id", "key", "passage"])

    return scan


def _verify(params: LeakParams):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits = edits_within(_unpacked(batch.column("window"), params.window), _unpacked(batch.column("passage"), params.passage))
            at = pa.array(np.flatnonzero(edits <= params.max_edits))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("window").take(at), pa.array(edits.astype(np.int32)).take(at)], ["doc_id", "window", "edits"])

    return verify


def near_leaks(docs: DataFrame, items: DataFrame, fields: tuple[str, ...] = ("question", "explanation"), params: LeakParams = LeakParams()) -> DataFrame:
    """(doc_id, item_id, edits) of each document with a passage that few edits make of a window of an item's field.

    ``docs`` needs doc_id and text, ``items`` item_id and the fields; other
    columns are ignored. Null and empty texts, and fields shorter than a
    window, match nothing; repeated rows give a pair once, with the fewest
    edits found. With ``max_edits`` 0 the result is exact, above it each window
    is found with the recall of ``params``.
    """
    spark = docs.sparkSession
    base, repetitions = scratch_dir(spark), params.repetitions
    texts = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.explode(F.array(*[F.col(f) for f in fields])).alias("text")).where("text is not null and item_id is not null").distinct()
    owners = materialise(texts.mapInArrow(_windows(params), "item_id bigint, window binary").distinct(), f"{base}/owners")
    windows = owners.select("window").distinct()
    keys = materialise(windows.mapInArrow(_window_keys(params, repetitions), "key bigint, window binary"), f"{base}/keys")
    blocks = windows.mapInArrow(_window_bits(params, repetitions), "block int, bits binary").groupBy("block").applyInArrow(_either, "block int, bits binary").toArrow()
    filled = np.zeros(1 << params.filter_bits - 3, np.uint8)
    for block, bits in zip(blocks.column("block").to_pylist(), blocks.column("bits").to_pylist()):
        filled[block * len(bits) : (block + 1) * len(bits)] = np.frombuffer(bits, np.uint8)
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null and doc_id is not null")
    passages = source.mapInArrow(_scan(spark.sparkContext.broadcast(filled), params, repetitions), "doc_id bigint, key bigint, passage binary")
    # few passages come through; spread, they are compared by all tasks and not by those that read the documents
    met = passages.repartition("doc_id", "key").join(keys, "key").select("doc_id", "passage", "window")
    alike = met.mapInArrow(_verify(params), "doc_id bigint, window binary, edits int") if params.max_edits else met.where("passage = window").select("doc_id", "window", F.lit(0).alias("edits"))
    return alike.groupBy("doc_id", "window").agg(F.min("edits").alias("edits")).join(owners, "window").groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"))


def find_leaks(docs: DataFrame, items: DataFrame, fields: tuple[str, ...] = ("question", "explanation"), params: LeakParams = LeakParams()) -> DataFrame:
    """(doc_id, item_id) of ``near_leaks``."""
    return near_leaks(docs, items, fields, params).select("doc_id", "item_id")
