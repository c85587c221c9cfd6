"""Texts that are versions of each other (problem 5).

All pairs of texts whose sets of word shingles have a Jaccard similarity of at
least a threshold, exactly. Document pivots can't divide these texts: unlike
texts lie at nearly the same distance of each other, so the windows of the
triangle inequality take every text into every region (README). The regions
here belong to rare shingles. In one global order of shingles, rarest first,
two texts within the distance share one of their first few; each text is
replicated to the regions of its first ones, which are the windows. In a region the
triangle inequality of the symmetric difference against fixed sets of shingles
(a 256-bit signature holds them) and the positions in the order reject pairs;
what is left is compared shingle by shingle in its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirebase.llm.words import WORD, text_slices
from quirebase.session import materialise, scratch_dir

#: Counters of the order's statistics: its size is fixed, whatever the corpus.
COUNTERS = 1 << 22
_BLOCK = 1 << 16
#: Postings that one region holds on average, at most. More regions take more copies of each text.
POSTINGS_PER_REGION = 2_000_000
#: Texts that a task remembers, to post copies once.
_REMEMBERED = 1_000_000


@dataclass(frozen=True)
class VersionParams:
    words: int = 5
    similarity: float = 0.8
    hot: int = 20_000  # texts with a shingle from which its region is divided into cells
    seed: int = 5


def _word_table() -> np.ndarray:
    """For each code point below U+10000, whether WORD has it in a word."""
    return np.array([chr(c).isalnum() for c in range(1 << 16)])


_IN_WORD = _word_table()


def _split(texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """What WORD finds in many texts, one after another: numbers of words, these words, how many each text has."""
    coded = [x.encode() if x else b"" for x in texts]
    raw = np.frombuffer(b"\n".join(coded), "u1")
    inside = _IN_WORD.take(raw)
    beyond = np.flatnonzero(raw >= 0x80)
    if len(beyond):
        codes = np.frombuffer(raw[beyond].tobytes().decode().encode("utf-32-le"), "<u4")
        letter = _IN_WORD.take(codes, mode="clip")
        high = np.flatnonzero(codes > 0xFFFF)
        letter[high] = [chr(c).isalnum() for c in codes[high].tolist()]
        inside[beyond] = np.repeat(letter, 2 + (codes >= 0x800) + (codes >= 0x10000))
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    begins, sizes = edges[::2], edges[1::2] - edges[::2]
    words = pa.Array.from_buffers(pa.large_string(), len(begins), [None, pa.py_buffer(np.r_[0, np.cumsum(sizes)]), pa.py_buffer(raw[inside])]).dictionary_encode()
    ends = np.cumsum([len(x) + 1 for x in coded])
    return words.indices.to_numpy(), words.dictionary.to_pylist(), np.diff(np.searchsorted(begins, ends), prepend=0)


class _Hashes(dict):
    """The hash of a word in lower case, by the word."""

    def __missing__(self, word: str) -> int:
        import xxhash

        self[word] = h = xxhash.xxh64_intdigest(word.lower())
        return h


class _Numbers(dict):
    """A number for each word, by the word; words that are alike in lower case have one number."""

    def __init__(self):
        super().__init__()
        self.lower: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        self[word] = n = self.lower.setdefault(word.lower(), len(self.lower))
        return n


class Shingler:
    """Distinct shingles of many texts at once, as 64-bit hashes."""

    def __init__(self, params: VersionParams):
        draw = np.random.default_rng(params.seed)
        self.size = params.words
        self.factors = draw.integers(1, 2**63, params.words, dtype=np.int64).astype(np.uint64) | np.uint64(1)
        self.known = _Hashes()

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, shingle), sorted by both, without repeats."""
        if len(self.known) > 2_000_000:
            self.known.clear()
        index, words, owners = _split(texts)
        owner = np.repeat(np.arange(len(texts)), owners)
        k = len(index) - self.size + 1
        if k <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        w = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))[index]
        h = np.zeros(k, np.uint64)
        for i, factor in enumerate(self.factors):
            h = (h ^ (w[i : i + k] * factor)) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        inside = owner[:k] == owner[self.size - 1 :]
        owner, h = owner[:k][inside], h[inside]
        # texts and the upper bits of shingles in one key; what these leave open, which is rare, takes both keys
        bits = np.uint64(len(texts).bit_length())
        order = np.argsort((owner.astype(np.uint64) << (np.uint64(64) - bits)) | (h >> bits))
        if ((owner[1:] == owner[:-1]) & (h[order[1:]] < h[order[:-1]])).any():
            order = np.lexsort((h, owner))
        h = h[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        return owner[fresh], h[fresh]


def _counter(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(42)).astype(np.int64)


def _count(params: VersionParams):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, counts = Shingler(params), np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, texts in text_slices(batch, "text"):
                np.add.at(counts, _counter(shingle(texts)[1]), 1)
        small = np.minimum(counts, 2**31 - 1).astype("<i4").reshape(-1, _BLOCK)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(small)), pa.int32()), pa.array([b.tobytes() for b in small], pa.binary())], ["block", "counts"])

    return count


def _add(group: pa.Table) -> pa.Table:
    total = np.zeros(_BLOCK, np.int64)
    for b in group.column("counts"):
        total += np.frombuffer(b.as_py(), "<i4")
    return pa.table({"block": pa.array([group.column("block")[0].as_py()], pa.int32()), "counts": pa.array([np.minimum(total, 2**31 - 1).astype("<i4").tobytes()], pa.binary())})


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


def _order(owner: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order by owner, which ascends already, and key; equals stay in their order."""
    at, wide = len(owner).bit_length(), int(key.max()).bit_length()
    if int(owner[-1]).bit_length() + wide + at > 64:
        return np.lexsort((key, owner))
    packed = (owner.astype(np.uint64) << np.uint64(wide + at)) | (key.astype(np.uint64) << np.uint64(at)) | np.arange(len(owner), dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << at) - 1)).astype(np.int64)


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of values up to each end, as binary."""
    offsets = np.r_[0, ends * values.itemsize].astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _flat(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The values in a column of binary, and how many each row has."""
    parts, ends = [np.empty(0, kind)], [np.empty(0, np.int64)]
    for chunk in column.chunks:
        _, offsets, data = chunk.cast(pa.large_binary()).buffers()
        cut = np.frombuffer(offsets, "<i8")[: len(chunk) + 1] if len(chunk) else np.zeros(1, np.int64)
        if cut[-1] > cut[0]:
            parts.append(np.frombuffer(data, "u1")[cut[0] : cut[-1]].view(kind))
        ends.append(np.diff(cut) // np.dtype(kind).itemsize)
    return np.concatenate(parts), np.concatenate(ends)


_POSTINGS = "region int, id bigint, size int, signature binary, tokens binary, places binary"


def _post(counts, regions: int, params: VersionParams):
    """Each text once for every region that one of its first shingles lies in."""
    schema = pa.schema([("region", pa.int32()), ("id", pa.int64()), ("size", pa.int32()), ("signature", pa.binary()), ("tokens", pa.binary()), ("places", pa.binary())])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingle, frequency, seen = Shingler(params), counts.value, set()
        # what a counter holds of common shingles stands out from what chance puts into every counter
        noise = int(np.median(frequency))
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for first, texts in text_slices(batch, "text", 500_000):
                for k, text in enumerate(texts):
                    copy = (int(ids[first + k]), xxhash.xxh64_intdigest(text or ""))
                    if copy in seen:
                        texts[k] = None
                    elif len(seen) < _REMEMBERED:
                        seen.add(copy)
                owner, h = shingle(texts)
                if not len(h):
                    continue
                size = np.bincount(owner, minlength=len(texts))
                bits = np.zeros((len(texts), 256), bool)
                bits[owner, (_mix(h) & np.uint64(255)).astype(np.int64)] = True
                signature = np.packbits(bits, axis=1, bitorder="little")
                often = frequency[_counter(h)]
                alone = often <= 1
                often = np.maximum(often - noise, 1)
                # as the shingles of a text ascend, those that are equally frequent do
                order = _order(owner, often)
                place = np.arange(len(h)) - (np.cumsum(size) - size)[owner]
                prefix = size - np.ceil(params.similarity * size - 1e-9).astype(np.int64) + 1
                keep = (place < prefix[owner]) & ~alone[order]
                order, owner, place = order[keep], owner[keep], place[keep]
                h, often = h[order], often[order]
                if not len(h):
                    continue
                cells = -(-often // params.hot)
                if (cells > 1).any():
                    mine = (_mix(ids[first + owner].astype(np.uint64)) % cells.astype(np.uint64)).astype(np.int64)
                    again = np.repeat(np.arange(len(h)), cells)
                    other = np.arange(len(again)) - np.repeat(np.cumsum(cells) - cells, cells)
                    low, high = np.minimum(mine[again], other), np.maximum(mine[again], other)
                    split = cells[again] > 1
                    owner, h, place = owner[again], h[again], place[again]
                    h = np.where(split, _mix(h + np.uint64(1) + low.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + high.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), h)
                region = (_mix(h) >> np.uint64(32)) % np.uint64(regions)
                order = _order(owner, region)
                owner, h, place, region = owner[order], h[order], place[order], region[order]
                cut = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (region[1:] != region[:-1])])
                ends = np.r_[cut[1:], len(h)]
                tokens, places = h.astype("<u4"), place.astype("<u4")
                who = owner[cut]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(region[cut].astype(np.int32)),
                        pa.array(ids[first + who]),
                        pa.array(size[who].astype(np.int32)),
                        _binaries(signature[who], 32 * np.arange(1, len(who) + 1)),
                        _binaries(tokens, ends),
                        _binaries(places, ends),
                    ],
                    schema=schema,
                )

    return post


def _reach(key: np.ndarray, place: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """How many postings after each it meets, and the largest size that may meet it from before.

    ``key``: shingle and size, ascending, so that a posting meets those of its
    size or longer in its list. Texts of together n shingles have at least
    n t / (1 + t) in common, none of them before this one: that and the
    similarity bound the other's size, and the list ends there.
    """
    low = np.uint64(2**32 - 1)
    size = (key & low).astype(np.int64)
    spare = np.floor((size - place) * ((1 + t) / t) + 1e-6).astype(np.int64) - size
    longest = np.minimum(np.floor(size / t + 1e-6).astype(np.int64), spare)
    end = np.searchsorted(key, (key & ~low) | np.clip(longest, 0, 2**31).astype(np.uint64), side="right")
    return np.maximum(end - np.arange(len(key)) - 1, 0), spare


def _join_region(params: VersionParams):
    t = params.similarity

    def join(group: pa.Table) -> pa.Table:
        # copies of one text that different tasks posted are one text here
        copies = group.select(["id", "size", "signature", "tokens"]).append_column("row", pa.array(np.arange(len(group))))
        group = group.take(copies.group_by(["id", "size", "signature", "tokens"], use_threads=False).aggregate([("row", "min")]).column("row_min"))
        ids, size = group.column("id").to_numpy(), group.column("size").to_numpy().astype(np.int64)
        signature = _flat(group.column("signature"), "<u8")[0].reshape(-1, 4)
        token, lists = _flat(group.column("tokens"), "<u4")
        place = _flat(group.column("places"), "<u4")[0].astype(np.int64)
        row = np.repeat(np.arange(len(ids)), lists)
        key = (token.astype(np.uint64) << np.uint64(32)) | size[row].astype(np.uint64)
        order = np.argsort(key)
        key, place, row = key[order], place[order], row[order]
        reach, spare = _reach(key, place, t)
        seats = size[row]
        found: list[np.ndarray] = []
        at, total = 0, np.cumsum(reach)
        while at < len(key):
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + 2_000_000, side="right")))
            near = reach[at:stop]
            i = np.repeat(np.arange(at, stop), near)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(near) - near, near)
            ok = spare[j] >= seats[i]
            i, j = row[i[ok]], row[j[ok]]
            both = size[i] + size[j]
            room = both - 2 * np.ceil(both * (t / (1 + t)) - 1e-9).astype(np.int64)
            ok = np.bitwise_count(signature[i] ^ signature[j]).sum(axis=1) <= room
            i, j = i[ok], j[ok]
            found.append(np.unique(np.minimum(i, j) * len(ids) + np.maximum(i, j)))
            at = stop
        pairs = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        a, b = ids[pairs // max(len(ids), 1)], ids[pairs % max(len(ids), 1)]
        a, b = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return join


def _verify(params: VersionParams):
    k, t = params.words, params.similarity

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = _Numbers()

        def shingles(texts: dict[str, str]) -> dict[str, set]:
            index, words, sizes = _split(list(texts.values()))
            w = np.fromiter(map(number.__getitem__, words), np.int64, len(words))[index].tolist()
            ends = np.cumsum(sizes).tolist()
            return {h: set(zip(*(w[start + i : end] for i in range(k)))) for h, start, end in zip(texts, [0, *ends], ends)}

        for batch in batches:
            if len(number) > 2_000_000:
                number = _Numbers()
            sets: dict[str, set] = {}
            keep, similarity = [], []
            new, chars, first = {}, 0, 0
            hash_a, hash_b, text_a, text_b = (batch.column(c).to_pylist() for c in ("hash_a", "hash_b", "text_a", "text_b"))
            for n in range(batch.num_rows):
                for h, text in ((hash_a[n], text_a[n]), (hash_b[n], text_b[n])):
                    if h not in sets and h not in new:
                        new[h] = text
                        chars += len(text)
                if chars < 1_000_000 and n + 1 < batch.num_rows:
                    continue
                sets |= shingles(new)
                for m in range(first, n + 1):
                    s, u = sets[hash_a[m]], sets[hash_b[m]]
                    both = len(s & u)
                    if both and both >= t * (len(s) + len(u) - both) - 1e-9:
                        keep.append(m)
                        similarity.append(both / (len(s) + len(u) - both))
                new, chars, first = {}, 0, n + 1
                if len(sets) > 20_000:
                    sets = {}
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("hash_a").take(at), batch.column("hash_b").take(at), pa.array(similarity, pa.float64())], ["hash_a", "hash_b", "similarity"])

    return verify


def version_pairs(texts: DataFrame, params: VersionParams = VersionParams()) -> DataFrame:
    """(hash_a, hash_b, similarity), hash_a < hash_b: all pairs of different hashes whose texts reach the similarity.

    ``texts``: chunk_hash and text, repeats allowed. Null hashes and null texts
    are left out, as are texts of fewer words than a shingle. Of several texts
    under one hash the least holds.
    """
    spark = texts.sparkSession
    base = scratch_dir(spark)
    source = texts.select("chunk_hash", "text").where("chunk_hash is not null and text is not null").withColumn("id", F.xxhash64("chunk_hash"))
    sums = source.select("text").mapInArrow(_count(params), "block int, counts binary").groupBy("block").applyInArrow(_add, "block int, counts binary").toArrow()
    counts = np.zeros(COUNTERS, np.int32)
    for block, raw in zip(sums.column("block").to_pylist(), sums.column("counts").to_pylist()):
        counts[block * _BLOCK : (block + 1) * _BLOCK] = np.frombuffer(raw, "<i4")
    regions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(counts.sum() * (1 - params.similarity)) // POSTINGS_PER_REGION)
    shared = spark.sparkContext.broadcast(counts)
    postings = source.select("id", "text").mapInArrow(_post(shared, regions, params), _POSTINGS)
    near = postings.repartition(regions, "region").groupBy("region").applyInArrow(_join_region(params), "a bigint, b bigint")
    near = materialise(near.distinct(), f"{base}/near")
    shared.destroy()  # each executor keeps a copy on disk until then
    wanted = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    needed = materialise(source.join(wanted, "id", "left_semi").groupBy("id", "chunk_hash").agg(F.min("text").alias("text")), f"{base}/texts")
    side = lambda s, i: needed.select(F.col("id").alias(i), F.col("chunk_hash").alias(f"hash_{s}"), F.col("text").alias(f"text_{s}"))
    compared = near.join(side("x", "a"), "a").join(side("y", "b"), "b")
    x_first = F.col("hash_x") < F.col("hash_y")
    pick = lambda what, first: F.when(x_first if first else ~x_first, F.col(f"{what}_x")).otherwise(F.col(f"{what}_y"))
    ordered = compared.select(pick("hash", True).alias("hash_a"), pick("hash", False).alias("hash_b"), pick("text", True).alias("text_a"), pick("text", False).alias("text_b"))
    return ordered.mapInArrow(_verify(params), "hash_a string, hash_b string, similarity double").distinct()


def component_names(both: DataFrame, base: str) -> DataFrame:
    """(node, name): each linked node with the least node of its component.

    ``both``: node and other, each link in both directions. In a round a node
    hears the names of its neighbours, the node it is named by is handed the
    least name that any of its members heard, and each name is replaced by its
    own name. A state that changes ends only in an error, never as a result.
    """
    names = materialise(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("name")), f"{base}/names0")
    for step in range(1, 257):
        heard = materialise(both.join(names.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("name").alias("name")), f"{base}/heard{step}")
        handed = heard.join(names.withColumnRenamed("name", "root"), "node").groupBy(F.col("root").alias("node")).agg(F.min("name").alias("name"))
        told = materialise(names.unionByName(heard).unionByName(handed).groupBy("node").agg(F.min("name").alias("name")), f"{base}/told{step}")
        jumped = told.select("node", F.col("name").alias("via")).join(told.select(F.col("node").alias("via"), "name"), "via").select("node", "name")
        after = materialise(told.unionByName(jumped).groupBy("node").agg(F.min("name").alias("name")), f"{base}/names{step}")
        changed = after.join(names.withColumnRenamed("name", "before"), "node").where("name <> before").limit(1).count()
        names = after
        if not changed:
            return names
    raise RuntimeError("groups of versions still change after 256 rounds")


def version_groups(texts: DataFrame, params: VersionParams = VersionParams()) -> DataFrame:
    """(chunk_hash, group, links): each hash with its group of versions, named by the group's least hash.

    Links join into groups by passing the least known hash along them, as
    ``component_names`` does, until nothing changes. A hash without versions is
    a group of its own with no link.
    """
    spark = texts.sparkSession
    base = scratch_dir(spark)
    pairs = materialise(version_pairs(texts, params), f"{base}/pairs")
    both = materialise(pairs.select(F.col("hash_a").alias("node"), F.col("hash_b").alias("other")).unionByName(pairs.select(F.col("hash_b").alias("node"), F.col("hash_a").alias("other"))), f"{base}/links")
    names = component_names(both, base)
    links = both.groupBy("node").agg(F.count("*").alias("links"))
    every = texts.select("chunk_hash").where("chunk_hash is not null").distinct()
    named = names.join(links, "node").withColumnRenamed("node", "chunk_hash")
    return every.join(named, "chunk_hash", "left").select("chunk_hash", F.coalesce("name", "chunk_hash").alias("group"), F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))
