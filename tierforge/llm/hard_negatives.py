"""Hard-negative mining by cover trees over norm-augmented vectors.

Every candidate x gets one more component, sqrt(M^2 - |x|^2), so that all have
the same norm M and inner products follow distances: inside a node with centre
c and covering radius r, the product with an anchor q lies within |q| r of q.c.
A shard of candidates becomes one cover tree: level by level, a node's points
are covered by centres of a smaller radius until few points are left. An
anchor descends a tree best-first by its upper bounds, skips nodes that lie
outside its windows or can't beat what it holds, and verifies leaves exactly:
components are integers, so products are exact.

Work is in blocks: a bounded block of anchors is broadcast (BLOCK_BYTES), and
each task walks the trees of its shards with it, carrying what an anchor has
found from tree to tree; so a task returns a few rows per anchor however many
candidates it saw. The first walk finds the positives, the second the
negatives of all their windows. No bound is approximate and nothing is cut.

Defined cases: rows with a null label, a null vector, or a null or non-finite
component take no part, nor do vectors whose squared integer norm reaches 2^62
(their scores need not fit a long); shorter vectors count as filled up with
zeros; repeated rows count once; an anchor's other rows are those of other
ids; a null id is no anchor and comes last among ties; an empty table gives an
empty table; other columns may be null or bear any name.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierforge.llm import blobs
from tierforge.llm.common import ship, written
from tierforge.session import scratch_path

SHARD_ROWS = 8192            # candidates of one tree
BLOCK_BYTES = 16 << 20       # anchors that are broadcast at once
LEAF, POOL = 1024, 128       # points of a leaf; smaller children of a node share one leaf
MISSES = 64                  # after so many of them in a node, all its uncovered points do
SHRINK = 1.1                 # radius of a level over that of the next
SCALE = 256
N_POSITIVES, N_NEGATIVES = 5, 10
LOW, HIGH = 30, 90           # a negative's score in percent of the positive's
EVERY, RELABEL, LABELS = 100, 7, 10
NO_ID = np.iinfo(np.int64).max

_TREE = ("<i8", "<i8", "<i8", "<i8", "<f8", "<i8", "<i8", "<i8")


def prepared(rows: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """The rows that take part: vec_id, label (after relabelling), z (integer components); repeated rows once."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)))
    small = F.aggregate(x, F.lit(0.0), lambda s, v: s + F.floor(v * SCALE).cast("double") * F.floor(v * SCALE).cast("double")) < 2.0 ** 62
    moved = F.when(F.col(vec_id) % RELABEL == 0, (F.col(label) + 1) % LABELS).otherwise(F.col(label)).cast("bigint")
    kept = rows.where(F.col(label).isNotNull() & F.col(vector).isNotNull()).where(finite).where(small)
    return kept.select(F.col(vec_id).cast("bigint").alias("vec_id"), moved.alias("label"),
                       F.transform(x, lambda v: F.floor(v * SCALE)).alias("z")).distinct()


@dataclass
class Tree:
    """Points in the order of the leaves; nodes with centre (a point), radius, range of points and children."""

    ids: np.ndarray
    labels: np.ndarray
    points: np.ndarray          # n x d integers
    centres: np.ndarray
    radii: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    parents: np.ndarray

    def blob(self) -> bytes:
        return blobs.pack([self.ids, self.labels, self.points.ravel(), self.centres, self.radii, self.starts, self.stops, self.parents])

    @staticmethod
    def load(blob: bytes) -> Tree:
        ids, labels, flat, *rest = blobs.unpack(blob, _TREE)
        return Tree(ids, labels, flat.reshape(len(ids), -1), *rest)


def build_tree(ids: np.ndarray, labels: np.ndarray, points: np.ndarray, leaf: int = LEAF, pool: int = POOL) -> Tree:
    """A cover tree over the rows of ``points``, each in exactly one leaf."""
    x = points.astype(np.float64)
    norms = np.einsum("ij,ij->i", x, x)
    x = np.column_stack([x, np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0.0))])

    def distances(members: np.ndarray, centre: int) -> np.ndarray:
        d = x[members] - x[centre]
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    order: list[np.ndarray] = []
    nodes: list[list] = []                    # centre, radius, start, stop, parent
    placed = 0
    everyone = np.arange(len(x))
    middle = int(np.argmin(np.einsum("ij,ij->i", x - x.mean(axis=0), x - x.mean(axis=0)))) if len(x) else 0
    stack = [(everyone, middle, -1)] if len(x) else []
    while stack:
        members, centre, parent = stack.pop()
        away = distances(members, centre)
        radius = float(away.max())
        me = len(nodes)
        nodes.append([centre, radius, placed, placed, parent])
        if len(members) <= leaf or radius == 0.0:
            order.append(members)
            placed += len(members)
            nodes[me][3] = placed
            continue
        # the next level: centres that cover all members within the smaller radius
        cover, left, first = radius / SHRINK, members, centre
        pooled = []
        while len(left):
            away = distances(left, first)
            near = away <= cover
            if near.sum() < pool:
                pooled.append(left[near])
            else:
                stack.append((left[near], first, me))
            left = left[~near]
            if len(pooled) == MISSES:
                pooled.append(left)
                break
            if len(left):
                first = int(left[0])
        if pooled:
            # few points each: one node of the old centre, a leaf if all fit
            rest = np.concatenate(pooled)
            for lo in range(0, len(rest), leaf):
                part = rest[lo:lo + leaf]
                nodes.append([centre, float(distances(part, centre).max()), placed, placed + len(part), me])
                order.append(part)
                placed += len(part)
    # a node above leaves has no points of its own: start == stop
    at = np.concatenate(order) if order else everyone
    back = np.empty(len(at), dtype=np.int64)
    back[at] = np.arange(len(at))
    columns = list(zip(*nodes)) if nodes else [()] * 5
    centres, starts, stops, parents = (np.array(columns[i], dtype=np.int64) for i in (0, 2, 3, 4))
    return Tree(ids[at], labels[at], points[at], back[centres] if len(centres) else centres,
                np.array(columns[1], dtype=np.float64), starts, stops, parents)


class Walk:
    """One tree with the products of a block of anchors and its nodes' centres."""

    def __init__(self, tree: Tree, anchors: np.ndarray) -> None:
        width = max(tree.points.shape[1], anchors.shape[1])

        def wide(m: np.ndarray) -> np.ndarray:
            return np.pad(m, ((0, 0), (0, width - m.shape[1])))

        points, anchors = wide(tree.points), wide(anchors)
        self.tree = tree
        size = np.sqrt(np.einsum("ij,ij->i", *[anchors.astype(np.float64)] * 2))
        largest = math.sqrt(max(np.einsum("ij,ij->i", *[points.astype(np.float64)] * 2).max(initial=0.0), 0.0))
        # float64 holds every partial sum exactly below 2^53; otherwise integers
        kind = np.float64 if largest * size.max(initial=0.0) < 2.0 ** 52 else np.int64
        self.points, self.anchors = points.astype(kind), anchors.astype(kind)
        middle = (self.anchors @ self.points[tree.centres].T).astype(np.float64)
        slack = size[:, None] * tree.radii[None, :] * (1 + 1e-9) + np.abs(middle) * 1e-9 + 0.5
        self.upper, self.lower = middle + slack, middle - slack
        self.children: list[list[int]] = [[] for _ in tree.parents]
        for node, parent in enumerate(tree.parents.tolist()):
            if parent >= 0:
                self.children[parent].append(node)

    def leaves(self, anchor: int, wanted) -> Iterator[tuple[int, int, np.ndarray]]:
        """Best-first: (start, stop, exact scores) of the leaves for which ``wanted(lower, upper)`` still holds."""
        if not len(self.tree.parents):
            return
        upper, lower = self.upper[anchor], self.lower[anchor]
        heap = [(-upper[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if not wanted(lower[node], -bound):
                continue
            start, stop = self.tree.starts[node], self.tree.stops[node]
            if stop > start:
                yield start, stop, (self.points[start:stop] @ self.anchors[anchor]).astype(np.int64)
            for child in self.children[node]:
                heapq.heappush(heap, (-upper[child], child))


class Best:
    """The first ``size`` of the rows offered: higher score first, then smaller id."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.found: list[tuple[int, int]] = []          # (-score, id), sorted

    def least(self) -> float:
        return -self.found[-1][0] if len(self.found) == self.size else -math.inf

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > 4 * self.size:
            bar = np.partition(scores, len(scores) - self.size)[len(scores) - self.size]
            keep = scores >= bar
            scores, ids = scores[keep], ids[keep]
        order = np.lexsort((ids, -scores))[:self.size]
        self.found = sorted(self.found + list(zip((-scores[order]).tolist(), ids[order].tolist())))[:self.size]


def _positives(anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray, size: int):
    """Per anchor the best rows of its label, itself left out, from the trees offered."""
    best = [Best(size) for _ in ids]

    def walk(tree: Tree) -> None:
        step = Walk(tree, anchors)
        for a, held in enumerate(best):
            for start, stop, scores in step.leaves(a, lambda low, high: high >= held.least()):
                at = np.flatnonzero((tree.labels[start:stop] == labels[a]) & (tree.ids[start:stop] != ids[a])
                                    & (scores >= held.least()))
                if len(at):
                    held.offer(scores[at], tree.ids[start:stop][at])

    return walk, lambda: [(a, 0, -s, i, n) for a, held in enumerate(best) for n, (s, i) in enumerate(held.found)]


def _negatives(anchors: np.ndarray, labels: np.ndarray, windows: list[list[int]], size: int):
    """Per anchor and positive score the best rows of other labels inside the score's window."""
    # LOW * p <= 100 * n <= HIGH * p in integers
    best = [[(p, -(-LOW * p // 100), HIGH * p // 100, Best(size)) for p in ps] for ps in windows]

    def walk(tree: Tree) -> None:
        step = Walk(tree, anchors)
        for a, held in enumerate(best):
            if not held:
                continue

            def wanted(low: float, high: float) -> bool:
                return any(low <= hi and high >= max(lo, b.least()) for _, lo, hi, b in held)

            for start, stop, scores in step.leaves(a, wanted):
                least = min(max(lo, b.least()) for _, lo, _, b in held)
                most = max(hi for _, _, hi, _ in held)
                at = np.flatnonzero((scores >= least) & (scores <= most) & (tree.labels[start:stop] != labels[a]))
                if len(at):
                    inside = scores[at]
                    for _, lo, hi, b in held:
                        take = (inside >= max(lo, b.least())) & (inside <= hi)
                        if take.any():
                            b.offer(inside[take], tree.ids[start:stop][at[take]])

    return walk, lambda: [(a, p, -s, i, n) for a, held in enumerate(best) for p, _, _, b in held
                          for n, (s, i) in enumerate(b.found)]


def _matrix(vectors: Sequence[Sequence[int]]) -> np.ndarray:
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)), dtype=np.int64)
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def _searched(spark: SparkSession, trees: DataFrame, block: dict, mode: str) -> DataFrame:
    """Rows (a, window, score, id, n) that the trees' tasks hold for the block's anchors."""
    sent = spark.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, walk = sent.value, None
        for batch in batches:
            for blob in batch.column("tree"):
                if walk is None:
                    walk, rows = (_positives(b["z"], b["ids"], b["labels"], N_POSITIVES) if mode == "positives"
                                  else _negatives(b["z"], b["labels"], b["windows"], N_NEGATIVES))
                walk(Tree.load(blob.as_py()))
        if walk is not None:
            found = np.array(rows(), dtype=np.int64).reshape(-1, 5)
            yield pa.record_batch([pa.array(c) for c in found.T], names=["a", "window", "score", "id", "n"])

    return trees.mapInArrow(run, "a bigint, window bigint, score bigint, id bigint, n bigint")


def _first(found: DataFrame, size: int) -> DataFrame:
    """The first ``size`` rows of each anchor and window over all tasks; ``n`` becomes their place, from 1."""
    order = Window.partitionBy("a", "window").orderBy(F.desc("score"), "id", "n")
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= size)


def build_trees(points: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index: one row ``tree`` (binary) per shard of about ``shard_rows`` rows of prepared(), written."""
    ship(points.sparkSession)
    shards = max(1, math.ceil(points.count() / shard_rows))
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("vec_id", "label", "z"), F.lit(shards)))

    def build(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").fill_null(NO_ID).to_numpy()
        labels = table.column("label").to_numpy()
        tree = build_tree(ids, labels, _matrix(table.column("z").to_pylist()))
        return pa.table({"tree": pa.array([tree.blob()], pa.binary())})

    return written(dealt.groupBy("shard").applyInArrow(build, "tree binary"), "cover-trees")


def mine(rows: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
         shard_rows: int = SHARD_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by EVERY; see the module for the rest.
    """
    spark = rows.sparkSession
    points = written(prepared(rows, vec_id, label, vector), "hard-points")
    trees = build_trees(points, shard_rows)
    anchors = points.where(F.col("vec_id") % EVERY == 0)
    held = anchors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("z")).alias("width")).first()
    blocks = max(1, math.ceil(held["n"] * 8 * ((held["width"] or 0) + 2) / block_bytes))
    anchors = written(anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "z"), F.lit(blocks))), "hard-anchors")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    paths = []
    for number in range(blocks):
        # bounded: about block_bytes of anchors
        table = anchors.where(F.col("block") == number).orderBy("vec_id", "label", "z").toArrow()
        if table.num_rows == 0:
            continue
        block = {"ids": table.column("vec_id").to_numpy(), "labels": table.column("label").to_numpy(),
                 "z": _matrix(table.column("z").to_pylist())}
        positives = written(_first(_searched(spark, trees, block, "positives"), N_POSITIVES), "hard-positives")
        windows: list[set] = [set() for _ in block["ids"]]
        for a, score in zip(*positives.select("a", "score").toArrow().to_pydict().values()):
            windows[a].add(score)
        block["windows"] = [sorted(w) for w in windows]
        negatives = _first(_searched(spark, trees, block, "negatives"), N_NEGATIVES)
        names = spark.createDataFrame(pa.table({"a": np.arange(len(block["ids"])), "anchor_id": block["ids"]}))
        pairs = positives.select("a", F.col("id").alias("positive_id"), F.col("score").alias("window"))
        mined = negatives.join(pairs, ["a", "window"]).join(names, "a").select(
            "anchor_id", F.nullif("positive_id", F.lit(NO_ID)).alias("positive_id"), F.col("n").cast("int").alias("rank"),
            F.nullif("id", F.lit(NO_ID)).alias("negative_id"), F.col("window").alias("positive_score"),
            F.col("score").alias("negative_score"))
        paths.append(scratch_path(spark, "hard-negatives"))
        mined.write.parquet(paths[-1])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
