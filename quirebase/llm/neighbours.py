"""The most similar vectors of every vector (problem 3).

Vectors are dealt to overlapping regions of bounded size, each to those whose
centres are nearest, and both of a pair must stand in one region. As regions
get narrower the more vectors there are, their number for each vector isn't
fixed: neighbours drawn at a known similarity must share one often enough.

In a region, which is a Spark task, a forest of random-projection trees is
fitted on its own vectors, each of which is in one leaf of each tree. As a
query it has one priority queue for the nodes of all trees, whose priority is
the smallest margin to a hyperplane on the way down; it takes the best leaf
from it until it has visited ``probes`` of them. As a child is never better
than its node, these are the ``probes`` leaves of the best priority, which are
found for many queries at once. In a leaf the candidates are ranked by their
cosine, and the best of all leaves and regions remain. A leaf that is far
larger than wanted is divided by a tree of its own.

Vectors travel as 12-bit fixed-point numbers, which moves a cosine by some
5e-5. Wherever that could decide, at the last place or at the wanted
similarity, the original numbers of both vectors decide. Equal vectors are
indexed once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirebase.session import materialise, scratch_dir


@dataclass(frozen=True)
class ForestParams:
    k: int = 10
    dimension: int = 128
    min_similarity: float = -2.0  # neighbours below it aren't wanted
    trees: int = 3
    probes: int = 20  # leaves that a vector visits, over all trees, where there is one region
    leaf_size: int = 1_500  # vectors
    one_region: int = 20_000  # most vectors that aren't divided into regions
    region_size: int = 60_000  # vectors in a region, on average
    drawn: float = 0.75  # similarity of the neighbours that are drawn to find how many regions a vector needs
    shared: float = 0.995  # share of them that must have a region in common
    most_regions: int = 64  # of a vector, should fewer not do
    sample: int = 200_000  # most vectors that regions and trees are fitted on
    per_leaf: int = 10  # sampled vectors that a leaf needs at least
    mutual: bool = True  # what a query finds is a candidate for both
    unsure: float = 5e-4  # similarities that differ by less are compared by the original numbers
    seed: int = 11


#: Fewest regions, so that there are tasks enough, and sampled vectors for each.
REGIONS, PER_REGION = 24, 40
#: Copies of one vector that form a ring; larger groups of copies make several.
RING = 1_000


def decode(codes: list[bytes]) -> np.ndarray:
    """Unit vectors of fixed-point codes."""
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1, 3).astype(np.int32)
    v = np.empty((len(codes), 2 * raw.shape[1]), np.float32)
    v[:, ::2] = (raw[:, :, 0] | (raw[:, :, 1] & 15) << 8) - 2048
    v[:, 1::2] = (raw[:, :, 1] >> 4 | raw[:, :, 2] << 4) - 2048
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def encode(vectors: np.ndarray) -> list[bytes]:
    """Fixed-point codes, 12 bits an element, scaled by each vector's largest; an odd element gets a zero beside it."""
    if vectors.shape[1] % 2:
        vectors = np.pad(vectors, ((0, 0), (0, 1)))
    q = (np.rint(vectors / np.abs(vectors).max(axis=1, keepdims=True) * 2047) + 2048).astype(np.int32)
    raw = np.empty((len(q), q.shape[1] // 2, 3), np.uint8)
    raw[:, :, 0] = q[:, ::2] & 255
    raw[:, :, 1] = q[:, ::2] >> 8 | (q[:, 1::2] & 15) << 4
    raw[:, :, 2] = q[:, 1::2] >> 4
    return [r.tobytes() for r in raw]


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("embedding")
        v = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1 if len(column) else 0)
        yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("copies"), pa.array(encode(v) if len(v) else [], pa.binary())], ["rep", "copies", "code"])


class Tree:
    """A random-projection tree as arrays; leaves have no plane and a number."""

    def __init__(self, sample: np.ndarray, leaves: int, draw: np.random.Generator):
        self.planes: list[np.ndarray | None] = []
        self.at: list[float] = []
        self.low: list[int] = []
        self.high: list[int] = []
        self.leaf: list[int] = []
        self.leaves = 0
        self._most = max(2, -(-len(sample) // max(1, leaves)))
        self._grow(sample, np.arange(len(sample)), draw)

    def _node(self, plane, at, leaf) -> int:
        self.planes.append(plane)
        self.at.append(at)
        self.low.append(-1)
        self.high.append(-1)
        self.leaf.append(leaf)
        return len(self.leaf) - 1

    def _grow(self, sample: np.ndarray, rows: np.ndarray, draw: np.random.Generator) -> int:
        split = self._split(sample[rows], draw) if len(rows) > self._most else None
        if split is None:
            self.leaves += 1
            return self._node(None, 0.0, self.leaves - 1)
        plane, at, high = split
        node = self._node(plane, at, -1)
        self.low[node] = self._grow(sample, rows[~high], draw)
        self.high[node] = self._grow(sample, rows[high], draw)
        return node

    @staticmethod
    def _split(points: np.ndarray, draw: np.random.Generator):
        """A plane between two random points, moved towards the halves it makes, at the median."""
        a, b = points[draw.choice(len(points), 2, replace=False)]
        for _ in range(4):
            high = points @ (a - b) > 0
            if high.all() or not high.any():
                break
            a, b = points[high].mean(axis=0), points[~high].mean(axis=0)
            a, b = a / (np.linalg.norm(a) + 1e-9), b / (np.linalg.norm(b) + 1e-9)
        plane = a - b
        if not (length := np.linalg.norm(plane)):
            return None
        projected = points @ (plane / length)
        at = float(np.median(projected))
        high = projected > at
        return None if high.all() or not high.any() else (plane / length, at, high)

    def visit(self, vectors: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, priority) of each visit with a priority of -bound or more; own leaves have a positive one."""
        out = []
        nodes = [node for node, leaf in enumerate(self.leaf) if leaf < 0]
        plane = dict(zip(nodes, range(len(nodes))))
        margins = np.stack([self.planes[node] for node in nodes]) @ vectors.T - np.array([self.at[node] for node in nodes], np.float32)[:, None] if nodes else None
        stack = [(0, np.arange(len(vectors)), np.full(len(vectors), np.inf, np.float32))]
        while stack:
            node, rows, priority = stack.pop()
            if self.leaf[node] >= 0:
                out.append((rows, np.full(len(rows), self.leaf[node]), priority))
                continue
            margin = margins[plane[node]][rows]
            for child, side in ((self.high[node], margin), (self.low[node], np.where(margin == 0, np.float32(1e-9), -margin))):
                p = np.minimum(priority, side)
                keep = np.flatnonzero(p >= -bound)
                if len(keep):
                    stack.append((child, rows[keep], p[keep]))
        return tuple(np.concatenate(x) for x in zip(*out))


class Forest:
    def __init__(self, sample: np.ndarray, count: int, params: ForestParams):
        draw = np.random.default_rng(params.seed)
        leaves = min(-(-count // params.leaf_size), max(1, len(sample) // params.per_leaf))
        self.probes = params.probes
        self.trees = [Tree(sample, leaves, draw) for _ in range(params.trees if leaves > 1 else 1)]
        self.offsets = np.cumsum([0] + [t.leaves for t in self.trees])
        few = sample[draw.choice(len(sample), min(1_000, len(sample)), replace=False)]
        self.bound = 0.01
        while leaves > 1 and self.bound < 2 and np.median(self._count(few)) < params.probes:
            self.bound *= 1.3

    def _count(self, vectors: np.ndarray) -> np.ndarray:
        return np.bincount(np.concatenate([t.visit(vectors, self.bound)[0] for t in self.trees]), minlength=len(vectors))

    def visit(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, whether the leaf is the row's own): of each row the ``probes`` leaves that its queue gives first."""
        rows, leaves, priority = self._within(vectors, np.arange(len(vectors)), self.bound)
        order = np.lexsort((-priority, rows))
        rows, leaves, priority = rows[order], leaves[order], priority[order]
        first = np.arange(len(rows)) - np.searchsorted(rows, rows) < self.probes
        return rows[first], leaves[first], priority[first] > 0

    def _within(self, vectors: np.ndarray, which: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All leaves of a priority of -bound or more; rows with too few are asked again with a wider bound."""
        each = [t.visit(vectors[which], bound) for t in self.trees]
        rows = np.concatenate([x[0] for x in each])
        leaves = np.concatenate([x[1] + o for x, o in zip(each, self.offsets)])
        priority = np.concatenate([x[2] for x in each])
        short = np.bincount(rows, minlength=len(which)) < min(self.probes, sum(t.leaves for t in self.trees))
        if bound >= 2 or not short.any():
            return which[rows], leaves, priority
        more = self._within(vectors, which[short], bound * 2)
        full = ~short[rows]
        return tuple(np.concatenate(x) for x in zip((which[rows[full]], leaves[full], priority[full]), more))


class Regions:
    """Centres among the vectors; a vector belongs to the ``each`` regions whose centres are nearest."""

    def __init__(self, sample: np.ndarray, count: int, params: ForestParams):
        draw = np.random.default_rng(params.seed)
        self.centres, self.each = sample[:1], 1
        if count <= params.one_region:
            return
        few = sample[draw.choice(len(sample), min(4_000, len(sample)), replace=False)]
        aside = draw.normal(size=few.shape).astype(np.float32)
        aside -= (aside * few).sum(axis=1, keepdims=True) * few
        # where vectors are dense, all that are wanted are nearer: at least as near as those of the sample
        kth = [np.partition(few[i : i + 100] @ sample.T, -min(params.k + 1, len(sample)), axis=1)[:, -min(params.k + 1, len(sample))] for i in range(0, min(1_000, len(few)), 100)]
        drawn = min(0.9999, max(params.drawn, float(np.quantile(np.concatenate(kth), 0.05))))
        near = drawn * few + np.sqrt(1 - drawn**2) * aside / np.linalg.norm(aside, axis=1, keepdims=True)
        each = 3
        while True:
            regions = min(max(REGIONS, -(-count * each // params.region_size)), len(sample))
            self.centres, self.each = self._fit(sample, regions, draw), min(each, regions)
            most = min(2 * each, regions)
            x, y = self._nearest(few, most), self._nearest(near, most)
            # from which length on the two lists have a region in common
            both = np.where(x[:, :, None] == y[:, None, :], np.maximum(np.arange(most)[:, None], np.arange(most)) + 1, most + 1).min(axis=(1, 2))
            if (both <= self.each).mean() >= params.shared or self.each == regions or each >= params.most_regions:
                return
            each = min(params.most_regions, max(each + 1, int(np.quantile(both, params.shared))))

    @staticmethod
    def _fit(sample: np.ndarray, regions: int, draw: np.random.Generator) -> np.ndarray:
        centres = sample[draw.choice(len(sample), regions, replace=False)]
        for _ in range(4):
            own = np.concatenate([np.argmax(sample[i : i + 4_000] @ centres.T, axis=1) for i in range(0, len(sample), 4_000)])
            order = np.argsort(own, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(own[order]) > 0])
            sums = np.add.reduceat(sample[order], first, axis=0)
            centres[own[order][first]] = sums / (np.linalg.norm(sums, axis=1, keepdims=True) + 1e-9)
        return centres

    def _nearest(self, vectors: np.ndarray, most: int) -> np.ndarray:
        out = []
        for start in range(0, len(vectors), 1_000):
            s = vectors[start : start + 1_000] @ self.centres.T
            part = np.argpartition(-s, most - 1, axis=1)[:, :most]
            out.append(np.take_along_axis(part, np.argsort(-np.take_along_axis(s, part, 1), axis=1), 1))
        return np.concatenate(out)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """The regions of each vector, a row each."""
        return self._nearest(vectors, self.each)


def _route(regions):
    """Each vector once for every region that it belongs to."""
    schema = pa.schema([("region", pa.int32()), ("rep", pa.int64()), ("code", pa.binary())])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 4_000):
                part = batch.slice(start, 4_000)
                of = regions.value.of(decode(part.column("code").to_pylist()))
                at = pa.array(np.repeat(np.arange(len(of)), of.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(of.ravel().astype(np.int32)), part.column("rep").take(at), part.column("code").take(at)], schema=schema)

    return route


def _best(s: np.ndarray, params: ForestParams) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the wanted similarities, a few more than ``k`` a row at most."""
    k = min(params.k + 2, s.shape[1])
    wanted = s >= max(params.min_similarity - params.unsure, -2.5)
    many = np.flatnonzero(wanted.sum(axis=1) > k)
    if len(many):
        best = np.argpartition(-s[many], k - 1, axis=1)[:, :k]
        only = np.zeros((len(many), s.shape[1]), bool)
        np.put_along_axis(only, best, True, axis=1)
        wanted[many] &= only
    return np.divmod(np.flatnonzero(wanted), s.shape[1])


def _rank_leaf(vectors: np.ndarray, ids: np.ndarray, own: np.ndarray, params: ForestParams, divide: bool = True) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, neighbour, similarity) of all visitors of a leaf against those whose leaf it is."""
    data = np.flatnonzero(own)
    if len(data) < 1 or len(ids) < 2:
        return []
    if divide and len(data) > 4 * params.leaf_size:
        # divide the leaf where it lies: a tree of its own, whose leaves are searched in the same way
        inner = ForestParams(**{**params.__dict__, "trees": 1, "probes": 3, "sample": 20_000})
        draw = np.random.default_rng(params.seed)
        forest = Forest(vectors[data[draw.choice(len(data), min(len(data), 20_000), replace=False)]], len(data), inner)
        if forest.trees[0].leaves > 1:
            rows, leaves, mine = forest.visit(vectors)
            out = []
            for leaf in range(forest.trees[0].leaves):
                at = np.flatnonzero(leaves == leaf)
                out += _rank_leaf(vectors[rows[at]], ids[rows[at]], mine[at] & own[rows[at]], params, False)
            return out
    out = []
    step = max(1, min(2_000, 8_000_000 // len(data)))
    for start in range(0, len(ids), step):
        s = vectors[start : start + step] @ vectors[data].T
        s[data[(here := (data >= start) & (data < start + step))] - start, np.flatnonzero(here)] = -3
        row, col = _best(s, params)
        out.append((ids[start + row], ids[data[col]], s[row, col]))
    return out


def _search(vectors: np.ndarray, ids: np.ndarray, params: ForestParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, neighbour, similarity) of the best of each vector of a region."""
    draw = np.random.default_rng(params.seed)
    fitted = min(len(vectors), 20_000, max(8_000, params.per_leaf * -(-len(vectors) // params.leaf_size)))
    forest = Forest(vectors[draw.choice(len(vectors), fitted, replace=False)], len(vectors), params)
    step = 20_000
    visits = [(rows + i, leaves, own) for i in range(0, len(vectors), step) for rows, leaves, own in [forest.visit(vectors[i : i + step])]]
    rows, leaves, own = (np.concatenate(x) for x in zip(*visits))
    order = np.argsort(leaves, kind="stable")
    rows, leaves, own = rows[order], leaves[order], own[order]
    found = []
    for at in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(leaves)) + 1):
        found += _rank_leaf(vectors[rows[at]], rows[at], own[at], params)
    join = lambda k, kind: np.concatenate([f[k] for f in found]).astype(kind) if found else np.array([], kind)
    a, b, similarity = join(0, np.int64), join(1, np.int64), join(2, np.float32)
    if params.mutual:
        a, b, similarity = np.r_[a, b], np.r_[b, a], np.r_[similarity, similarity]
    # a pair may meet in several leaves
    _, fresh = np.unique(a * len(ids) + b, return_index=True)
    a, b, similarity = a[fresh], b[fresh], similarity[fresh]
    order = np.lexsort((b, -similarity, a))
    a, b, similarity = a[order], b[order], similarity[order]
    keep = np.arange(len(a)) - np.searchsorted(a, a) < params.k + 2
    return ids[a[keep]], ids[b[keep]], similarity[keep].astype(np.float64)


def _rank_region(params: ForestParams):
    def rank(group: pa.Table) -> pa.Table:
        ids, codes = group.column("rep").to_numpy(), group.column("code").to_pylist()
        vectors = np.concatenate([decode(codes[i : i + 8_000]) for i in range(0, len(codes), 8_000)])
        a, b, similarity = _search(vectors, ids, params)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "similarity": pa.array(similarity)})

    return rank


def in_regions(params: ForestParams, each: int) -> ForestParams:
    """The forest of one of the ``each`` regions of a vector; a pair shares several, so that more and smaller leaves are cheaper than more probes."""
    if each == 1:
        return params
    return ForestParams(**{**params.__dict__, "trees": 2 * params.trees, "probes": max(2, params.probes * 3 // 4), "leaf_size": max(50, params.leaf_size // 3)})


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cosines of pairs by their original numbers."""
    for batch in batches:
        x, y = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), -1 if len(batch) else 0) for c in ("x", "y"))
        value = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1)) if len(batch) else np.array([], np.float64)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(value)], ["a", "b", "exact"])


@dataclass(frozen=True)
class Neighbours:
    pairs: DataFrame  # a, b, similarity, a_copies, b_copies, place: of representatives, place counts from 1
    members: DataFrame  # rep, vec_id, copies: of vectors with copies only


def usable(vectors: DataFrame, dimension: int) -> DataFrame:
    """vec_id and embedding of the rows with an id and as many finite elements, not all zero."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") == dimension) & finite & F.exists("embedding", lambda x: x != 0)
    )


def nearest(vectors: DataFrame, params: ForestParams = ForestParams()) -> Neighbours:
    """The ``k`` most similar of every usable vector, over distinct vectors.

    ``vectors`` needs vec_id and embedding; null, short, long, non-finite and
    all-zero vectors are left out, rows repeated with the same id and vector
    count once, other columns are ignored.
    """
    spark = vectors.sparkSession
    base = scratch_dir(spark)
    keyed = usable(vectors, params.dimension).withColumn("key", F.struct(F.xxhash64("embedding"), F.xxhash64(F.lit(params.seed), "embedding")))
    classes = keyed.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    coded = materialise(classes.select("rep", "copies", "embedding").mapInArrow(_encode, "rep bigint, copies bigint, code binary"), f"{base}/coded")
    several = coded.where("copies > 1").select("rep", "copies")
    members = keyed.select("key", "vec_id").join(keyed.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")).where("copies > 1"), "key").select("rep", "vec_id", "copies").distinct()
    count = coded.count()
    if not count:
        empty = spark.createDataFrame([], "a bigint, b bigint, similarity double, a_copies bigint, b_copies bigint, place int")
        return Neighbours(empty, members)
    wanted = min(params.sample, max(20_000, PER_REGION * 10 * -(-count // params.region_size)))
    share = int(min(1.0, 1.2 * wanted / count) * (1 << 30))
    sample = coded.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < share).select("code").limit(wanted).toArrow().column("code").to_pylist()
    if len(sample) < 2:
        sample = coded.select("code").limit(2).toArrow().column("code").to_pylist()
    grown = Regions(decode(sample), count, params)
    regions = spark.sparkContext.broadcast(grown)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(grown.centres))
    routed = coded.select("rep", "code").mapInArrow(_route(regions), "region int, rep bigint, code binary").repartition(tasks, "region")
    ranked = routed.groupBy("region").applyInArrow(_rank_region(in_regions(params, grown.each)), "a bigint, b bigint, similarity double")
    by_a = Window.partitionBy("a")
    best = by_a.orderBy(F.desc("similarity"), "b")
    placed = ranked.groupBy("a", "b").agg(F.max("similarity").alias("similarity")).withColumn("place", F.row_number().over(best)).where(F.col("place") <= params.k + 2)
    at = lambda n: F.max(F.when(F.col("place") == n, F.col("similarity"))).over(by_a)
    last, next_one = at(params.k), at(params.k + 1)
    close = ((last - next_one < params.unsure) & (F.abs(F.col("similarity") - last) < params.unsure)) | (F.abs(F.col("similarity") - params.min_similarity) < params.unsure)
    candidates = materialise(placed.withColumn("unsure", F.coalesce(close, F.lit(False))), f"{base}/candidates")
    asked = candidates.where("unsure").select("a", "b")
    wanted = materialise(asked.select(F.explode(F.array("a", "b")).alias("vec_id")).distinct(), f"{base}/wanted")
    known = materialise(usable(vectors, params.dimension).join(wanted, "vec_id", "left_semi").groupBy("vec_id").agg(F.first("embedding").alias("embedding")), f"{base}/originals")
    side = lambda i, v: known.select(F.col("vec_id").alias(i), F.col("embedding").alias(v))
    exact = asked.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(_cosines, "a bigint, b bigint, exact double")
    pairs = candidates.join(exact, ["a", "b"], "left").select("a", "b", F.coalesce("exact", "similarity").alias("similarity"))
    pairs = pairs.where(F.col("similarity") >= params.min_similarity).withColumn("place", F.row_number().over(best)).where(F.col("place") <= params.k)
    copies = lambda side: several.select(F.col("rep").alias(side), F.col("copies").alias(f"{side}_copies"))
    pairs = pairs.join(copies("a"), "a", "left").join(copies("b"), "b", "left")
    pairs = pairs.select("a", "b", "similarity", F.coalesce("a_copies", F.lit(1)).cast("bigint").alias("a_copies"), F.coalesce("b_copies", F.lit(1)).cast("bigint").alias("b_copies"), "place")
    return Neighbours(pairs, members)


def neighbour_rows(vectors: DataFrame, params: ForestParams = ForestParams()) -> DataFrame:
    """(vec_id, neighbour, similarity) of every usable vector, at most ``k`` rows each.

    A vector's copies come first; of more copies than fit, each vector gets
    the next in a ring. Of several copies of a neighbour those with the
    smallest ids come first.
    """
    found = nearest(vectors, params)
    pairs, members = materialise(found.pairs, f"{scratch_dir(vectors.sparkSession)}/pairs"), found.members
    k = params.k
    rings = members.withColumn("ring", F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("copies") / RING)))
    in_ring = Window.partitionBy("rep", "ring").orderBy("vec_id")
    placed = rings.withColumn("no", F.row_number().over(in_ring)).withColumn("size", F.count("*").over(Window.partitionBy("rep", "ring")))
    seats = placed.select("rep", "ring", F.col("no").alias("seat"), F.col("vec_id").alias("neighbour"))
    own = (
        placed.select("rep", "ring", "vec_id", F.explode(F.sequence(F.lit(1), F.least(F.lit(k), F.col("size") - 1).cast("int"))).alias("step"), "no", "size").where("size > 1")
        .select("rep", "ring", "vec_id", (F.pmod(F.col("no") - 1 + F.col("step"), F.col("size")) + 1).alias("seat"))
        .join(seats, ["rep", "ring", "seat"])
        .select("vec_id", "neighbour", F.lit(1.0).alias("similarity"))
    )
    in_class = Window.partitionBy("rep").orderBy("vec_id")
    firsts = placed.where(F.col("no") <= k).withColumn("nth", F.row_number().over(in_class)).where(F.col("nth") <= k).select("rep", "vec_id", "nth")
    before = Window.partitionBy("a").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    open_seats = (
        pairs.where(F.col("a_copies") <= k).withColumn("seats", F.lit(k) - (F.col("a_copies") - 1) - F.coalesce(F.sum("b_copies").over(before), F.lit(0)))
        .where("seats > 0")
    )
    each_a = open_seats.join(firsts.select(F.col("rep").alias("a"), F.col("vec_id").alias("a_id")), "a", "left")
    each = each_a.join(firsts.select(F.col("rep").alias("b"), F.col("vec_id").alias("b_id"), "nth"), "b", "left").where("nth is null or nth <= seats")
    other = each.select(F.coalesce("a_id", "a").alias("vec_id"), F.coalesce("b_id", "b").alias("neighbour"), "similarity")
    return own.unionAll(other)


def similar_pairs(vectors: DataFrame, least: float = 0.70, params: ForestParams = ForestParams()) -> DataFrame:
    """(vec_id_a, vec_id_b), a < b: cosine of at least ``least``, and one among the ``k`` most similar of the other."""
    rows = neighbour_rows(vectors, ForestParams(**{**params.__dict__, "min_similarity": least}))
    return rows.where(F.col("similarity") >= least).select(F.least("vec_id", "neighbour").alias("vec_id_a"), F.greatest("vec_id", "neighbour").alias("vec_id_b")).where("vec_id_a <> vec_id_b").distinct()
