"""Tokens per document and per slice under a public tokenizer (problem 1).

The texts are cut into the tokenizer's pieces (words with their leading space,
numbers, punctuation, white space). Distinct pieces are range partitioned, so
that each partition is one contiguous part of the prefix trie of all pieces;
a walk over its pieces in order keeps the state of the byte-pair tokenization
for every prefix (its last token and its number of tokens) and extends it byte
by byte from the longest prefix shared with the piece before. The counts at
the trie's terminals then go back to the documents.
"""

from __future__ import annotations

import base64
import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirebase.llm.words import text_slices
from quirebase.session import materialise, scratch_dir

#: Default vocabulary: of the public ones, the nearest to the billed counts.
VOCABULARY = os.path.join(os.environ.get("QUIREBASE_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_multi_50k.tiktoken")
#: The pieces of byte-level BPE vocabularies (a fixed value of the tokenizer).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A single space between two others than white space always starts a piece, so
#: a text without other contacts of a space can be cut at its spaces.
_UNSAFE = re.compile(r"\s | \s|^ | $")


class PrefixStates:
    """Byte-pair tokenization carried along prefixes.

    ``last[i]`` is the last token of the first i bytes of the current piece and
    ``count[i]`` how many they make. The last token of a prefix is the only one
    that is stable next to the last token of the shorter prefix it leaves.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {n: b for b, n in ranks.items()}
        self.longest = max(map(len, ranks))
        self.piece, self.last, self.count = b"", [-1], [0]
        self.stable: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}

    def merge(self, data: bytes) -> list[bytes]:
        """Plain byte-pair merging, for short strings."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, before: int, token: int) -> bool:
        """Whether the two stay as they are when tokenized together."""
        known = self.stable.get((before, token))
        if known is None:
            a, b = self.bytes_of[before], self.bytes_of[token]
            known = self.stable[before, token] = self.merge(a + b) == [a, b]
        return known

    def reachable(self, token: int) -> bool:
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = len(self.merge(self.bytes_of[token])) == 1
        return known

    def tokens(self, piece: bytes) -> int:
        """Number of tokens of a piece; cheapest when pieces come in order."""
        if piece in self.ranks:
            return 1
        shared, top = 0, min(len(piece), len(self.piece))
        while shared < top and piece[shared] == self.piece[shared]:
            shared += 1
        last, count = self.last, self.count
        del last[shared + 1 :], count[shared + 1 :]
        self.piece = piece[:shared]
        ranks = self.ranks
        for end in range(shared + 1, len(piece) + 1):
            for start in range(max(0, end - self.longest), end):
                token = ranks.get(piece[start:end])
                if token is None or not self.reachable(token):
                    continue
                if start == 0 or self.fits(last[start], token):
                    last.append(token)
                    count.append(count[start] + 1)
                    break
        self.piece = piece
        if len(self.stable) > 2_000_000:
            self.stable.clear()
        return count[-1]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=1)
def _pattern():
    import regex

    return regex.compile(PIECES)


def pieces_of(text: str) -> list[str]:
    return _pattern().findall(text)


def _units(text: str) -> list[str]:
    """Parts of a text that the tokenizer's pieces never straddle."""
    if _UNSAFE.search(text):
        return pieces_of(text)
    first, *rest = text.split(" ")
    return [first, *(" " + x for x in rest)]


_COUNTED = T.StructType([
    T.StructField("block", T.StringType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("piece", T.BinaryType()),
    T.StructField("numbers", T.BinaryType()),
    T.StructField("times", T.BinaryType()),
])


def _count_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block of texts: a row for each text with its pieces by number, one row with the pieces in order of their numbers."""
    import uuid

    schema = pa.schema([("block", pa.string()), ("doc_id", pa.int64()), ("piece", pa.binary()), ("numbers", pa.binary()), ("times", pa.binary())])
    of_unit: dict[str, list[str]] = {}
    for batch in batches:
        ids = batch.column("doc_id")
        for first, texts in text_slices(batch, "text", 2_000_000):
            number: dict[str, int] = {}
            of_here: dict[str, tuple[int, ...]] = {}
            docs, numbers, times = [], [], []
            for k, text in enumerate(texts):
                seen: Counter[int] = Counter()
                for unit, n in Counter(_units(text)).items():
                    mine = of_here.get(unit)
                    if mine is None:
                        parts = of_unit.get(unit)
                        if parts is None:
                            parts = of_unit[unit] = pieces_of(unit)
                        mine = of_here[unit] = tuple(number.setdefault(p, len(number)) for p in parts)
                    for x in mine:
                        seen[x] += n
                docs.append(ids[first + k].as_py())
                numbers.append(np.fromiter(seen.keys(), np.int32, len(seen)).tobytes())
                times.append(np.fromiter(seen.values(), np.int32, len(seen)).tobytes())
            if len(of_unit) > 500_000:
                of_unit.clear()
            block, n, m = uuid.uuid4().hex, len(docs), len(number)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([block] * n), pa.array(docs, pa.int64()), pa.nulls(n, pa.binary()), pa.array(numbers, pa.binary()), pa.array(times, pa.binary())], schema=schema)
            if m:
                at = np.arange(m, dtype="<i4")
                yield pa.RecordBatch.from_arrays([pa.array([block] * m), pa.nulls(m, pa.int64()), pa.array([p.encode() for p in number], pa.binary()), pa.array([x.tobytes() for x in at], pa.binary()), pa.nulls(m, pa.binary())], schema=schema)


def _walk_trie(name: str):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = PrefixStates(vocabulary(SparkFiles.get(name)))
        for batch in batches:
            pieces = batch.column("piece")
            yield pa.RecordBatch.from_arrays([pieces, pa.array([states.tokens(p.as_py()) for p in pieces], pa.int32())], ["piece", "tokens"])

    return walk


def _sum_block(documents: pa.Table, pieces: pa.Table) -> pa.Table:
    tokens = np.zeros(len(pieces) + 1, np.int64)
    if len(pieces):
        at = np.frombuffer(b"".join(pieces.column("numbers").to_pylist()), "<i4")
        tokens[at] = pieces.column("tokens").to_numpy()
    totals = [int(tokens[np.frombuffer(n, "<i4")] @ np.frombuffer(t, "<i4")) if n else 0 for n, t in zip(documents.column("own").to_pylist(), documents.column("times").to_pylist())]
    return pa.table({"doc_id": documents.column("doc_id"), "tokens": pa.array(totals, pa.int64())})


def token_counts(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, tokens) of every document; a null text has null tokens, an empty one none.

    ``docs`` needs doc_id and text; equal rows stay as many rows, other columns
    are ignored. Blocks of about two million characters share one list of
    pieces, so the shuffles carry each piece once a block and not once an
    occurrence; a block's size doesn't depend on the number of documents. The
    vocabulary's file is read by the driver and sent to all executors.
    """
    spark = docs.sparkSession
    base = scratch_dir(spark)
    spark.sparkContext.addFile(path)
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counted = materialise(source.where("text is not null").mapInArrow(_count_pieces, _COUNTED), f"{base}/counted")
    pieces = counted.where("piece is not null").select("block", "piece", "numbers")
    walked = (
        pieces.select("piece").distinct()
        .repartitionByRange(max(2, int(spark.conf.get("spark.sql.shuffle.partitions"))), "piece").sortWithinPartitions("piece")
        .mapInArrow(_walk_trie(os.path.basename(path)), "piece binary, tokens int")
    )
    terminal = pieces.join(walked, "piece").select("block", "numbers", "tokens")
    documents = counted.where("doc_id is not null").select(F.col("block").alias("in_block"), "doc_id", F.col("numbers").alias("own"), "times")
    totals = documents.groupBy("in_block").cogroup(terminal.groupBy("block")).applyInArrow(_sum_block, "doc_id bigint, tokens bigint")
    return totals.unionAll(source.where("text is null").select("doc_id", F.lit(None).cast("bigint").alias("tokens")))


def clean_label(label: F.Column) -> F.Column:
    """One spelling of a label: lower case, words joined by ``_``; 'unknown' for none."""
    plain = F.regexp_replace(F.lower(F.trim(label)), r"[\s_\-]+", "_")
    return F.when(label.isNull() | (plain == ""), "unknown").otherwise(plain)


def clean_language(lang: F.Column) -> F.Column:
    """The primary subtag in lower case; 'unknown' for none, undetermined and private codes."""
    primary = F.split(F.lower(F.trim(lang)), "[-_]")[0]
    return F.when(lang.isNull() | primary.isin("", "und", "xx"), "unknown").otherwise(primary)


def clean_path(path: F.Column) -> F.Column:
    """One notation of a path: forward slashes, none doubled, no drive letter, ``file:`` scheme or ``.`` steps, no blanks around."""
    p = F.regexp_replace(F.trim(path), r"\\", "/")
    p = F.regexp_replace(p, r"^file:/+", "/")
    p = F.regexp_replace(p, r"^/?[A-Za-z]:/", "/")
    return F.regexp_replace(F.regexp_replace(p, r"/(\./)+", "/"), r"/{2,}", "/")


def token_totals(docs: DataFrame, counts: DataFrame, billing: DataFrame) -> DataFrame:
    """Documents, tokens and billed tokens of every slice by source, language and domain, by each two and each one of them, and in all.

    ``counts`` has one row for each document (see ``token_counts``); a document
    id is taken to be unique. Repeated billing rows count once and partial
    second runs add up. In a subtotal the columns summed over read 'all'.
    """
    billed = billing.select(clean_path(F.col("file")).alias("billed_path"), "tokens", "cost", "batches").distinct().groupBy("billed_path").agg(F.sum("tokens").alias("billed_tokens"))
    slices = (
        docs.select("doc_id", clean_label(F.col("source")).alias("source"), clean_language(F.col("lang")).alias("lang"), clean_label(F.col("domain")).alias("domain"), clean_path(F.col("path")).alias("billed_path"))
        .join(counts, "doc_id")
        .join(billed, "billed_path", "left")
    )
    cube = slices.cube("source", "lang", "domain").agg(
        F.count("*").alias("documents"), F.sum(F.coalesce("tokens", F.lit(0))).alias("tokens"), F.sum(F.coalesce("billed_tokens", F.lit(0))).alias("billed_tokens"), F.count("billed_tokens").alias("billed_documents"), F.grouping_id().alias("level")
    )
    names = [F.when(F.col("level").bitwiseAND(bit) > 0, "all").otherwise(F.col(name)).alias(name) for name, bit in (("source", 4), ("lang", 2), ("domain", 1))]
    return cube.select(*names, "documents", "tokens", "billed_documents", "billed_tokens")
