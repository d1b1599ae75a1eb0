"""Approximate nearest neighbours with a forest of random-projection trees.

Each tree halves a sample of the vectors again and again, by the median of
their projection on the direction between two sampled points, down to leaves
of ``leaf`` sample points.  The sample is the ``sample`` vectors of smallest
hash (a documented bound: fitting happens on the driver and the forests are
broadcast); every vector of the table is then routed to its leaf in each tree.
Vectors of one length have a forest of their own; a length without sampled
vectors, or with no more than a leaf of them, has one cell for all.

A query walks all trees with one priority queue.  A cell's key is the sum of
the squared margins of the wrong turns on the way to it, so the query visits
the ``visits`` most promising leaves of the whole forest.  Only (leaf, query)
pairs are written; vectors join them on the way to the task that holds the
leaf.  A leaf that holds more of the table than it held of the sample is
split on by a tree of the same kind over its own rows, down to ``leaf`` rows,
and a query looks at the best ceil(sqrt(n)) of its n small leaves, in the
order of the priority queue.  So the share of the table that a query is
compared with falls as the table grows.

A leaf of more than ``cell_rows`` rows is dealt to several tasks and the
query goes to each; one that more than ``cell_queries`` queries visit is
copied to several tasks that share the queries.  A task returns at most ``k``
exact distances per query and small leaf; the best ``k`` ids are the result.

Copies: of vectors that are equal only the k + 1 smallest ids can be among
the k nearest (ties go to the smaller id), so only those enter leaves.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, as query or as candidate, and neither do rows with a
null id; vectors of different lengths are no neighbours of each other; rows
that repeat an id and vector count once, an id with several vectors counts by
its nearest; a query of an id that repeats is asked once (the smallest
vector), and rows of its own id are no candidates; with fewer candidates than
k all are returned.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .vectors import groups, is_double, matrix, packed, unpacked, usable

TREES, LEAF, VISITS, SAMPLE = 16, 64, 500, 65_536
HELD = 200_000   # distances a task holds before it reduces them


class Tree:
    """Split directions and thresholds by node; a node below 0 is leaf ``-1 - node``."""

    def __init__(self, points: np.ndarray, leaf: int, rng):
        self.directions, self.cuts, self.children, self.leaves = [], [], [], 0
        self.root = self._grow(points, leaf, rng)
        dim = points.shape[1]
        self.directions = np.array(self.directions, np.float64).reshape(-1, dim)

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _grow(self, points: np.ndarray, leaf: int, rng) -> int:
        if len(points) <= leaf:
            return self._leaf()
        a, b = points[rng.choice(len(points), 2, replace=False)]
        d = a - b
        size = np.linalg.norm(d)
        if not size:
            d = rng.standard_normal(points.shape[1])
            size = np.linalg.norm(d)
        d = d / size
        p = points @ d
        cut = float(np.median(p))
        right = p > cut
        if not right.any() or right.all():
            return self._leaf()
        node = len(self.cuts)
        self.directions.append(d)
        self.cuts.append(cut)
        self.children.append([0, 0])
        self.children[node] = [self._grow(points[~right], leaf, rng), self._grow(points[right], leaf, rng)]
        return node

    def route(self, points: np.ndarray) -> np.ndarray:
        """Leaf number of every row."""
        out = np.zeros(len(points), np.int64)
        stack = [(self.root, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if node < 0:
                out[rows] = -1 - node
                continue
            right = points[rows] @ self.directions[node] > self.cuts[node]
            stack.append((self.children[node][0], rows[~right]))
            stack.append((self.children[node][1], rows[right]))
        return out


def search(trees: list[Tree], point: np.ndarray, visits: int) -> list[tuple[int, int]]:
    """The (tree, leaf) cells a query visits, best first."""
    sides = [(t.directions @ point - t.cuts).tolist() if len(t.cuts) else [] for t in trees]
    heap = [(0.0, i, t.root) for i, t in enumerate(trees)]
    heapq.heapify(heap)
    out = []
    while heap and len(out) < visits:
        wrong, i, node = heapq.heappop(heap)
        if node < 0:
            out.append((i, -1 - node))
            continue
        side = sides[i][node]
        left, right = trees[i].children[node]
        near, far = (right, left) if side > 0 else (left, right)
        heapq.heappush(heap, (wrong, i, near))
        heapq.heappush(heap, (wrong + side * side, i, far))
    return out


def leaf_keys(tree: Tree, points: np.ndarray) -> np.ndarray:
    """The key that ``search`` gives every leaf, for many queries at a time."""
    side = points @ tree.directions.T - tree.cuts
    nodes, leaves = np.zeros((len(points), max(len(tree.cuts), 1))), np.zeros((len(points), tree.leaves))
    for node, pair in enumerate(tree.children):      # parents come before their children
        for child, wrong in zip(pair, (side[:, node] > 0, side[:, node] <= 0)):
            key = nodes[:, node] + np.where(wrong, side[:, node] ** 2, 0.0)
            if child < 0:
                leaves[:, -1 - child] = key
            else:
                nodes[:, child] = key
    return leaves


def best_rows(q: np.ndarray, v: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
    """Indexes of each query's k nearest ids, each id by its nearest row."""
    order = np.lexsort((d, v, q))
    again = np.zeros(len(q), bool)
    again[1:] = (q[order][1:] == q[order][:-1]) & (v[order][1:] == v[order][:-1])
    order = order[~again]
    order = order[np.lexsort((v[order], d[order], q[order]))]
    q = q[order]
    start = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.empty(0, np.int64)
    place = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    return order[place < k]


def compared(ids: np.ndarray, queries: np.ndarray, names: np.ndarray, points: np.ndarray, k: int):
    """Yields (query ids, names, distances) of each query's k nearest names; ``names`` ascend."""
    start = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    step = max(1, 1_000_000 // points.size)
    for i in range(0, len(ids), step):
        mine = ids[i:i + step]
        gap = points[None, :, :] - queries[i:i + step, None, :]
        d = np.sqrt((gap * gap).sum(axis=2))
        if len(start) < len(names):
            d = np.minimum.reduceat(d, start, axis=1)
        some = names[start]
        d[mine[:, None] == some[None, :]] = np.inf
        best = np.argsort(d, axis=1, kind="stable")[:, :k]
        d = np.take_along_axis(d, best, 1)
        real = np.isfinite(d)
        yield np.repeat(mine, best.shape[1])[real.ravel()], some[best][real], d[real]


def in_cell(ids: np.ndarray, queries: np.ndarray, names: np.ndarray, points: np.ndarray, k: int, leaf: int, seed):
    """``compared`` within one leaf of the forest: directly, or in the best small leaves of a tree over its rows."""
    order = np.argsort(names, kind="stable")
    names, points = names[order], points[order]
    if len(names) <= 2 * leaf:
        yield from compared(ids, queries, names, points, k)
        return
    tree = Tree(points, leaf, np.random.default_rng(seed))
    place = tree.route(points)
    by_leaf = np.split(np.argsort(place, kind="stable"), np.cumsum(np.bincount(place, minlength=tree.leaves))[:-1])
    wanted = math.ceil(math.sqrt(tree.leaves))
    step = max(1, 2_000_000 // tree.leaves)
    for i in range(0, len(ids), step):
        keys = leaf_keys(tree, queries[i:i + step])
        chosen = np.argsort(keys, axis=1, kind="stable")[:, :wanted]
        asked = np.repeat(np.arange(i, i + len(keys)), chosen.shape[1])
        sort = np.argsort(chosen.ravel(), kind="stable")
        asked, chosen = asked[sort], chosen.ravel()[sort]
        for part in np.split(np.arange(len(chosen)), np.flatnonzero(np.diff(chosen)) + 1):
            rows = by_leaf[chosen[part[0]]]
            if len(rows):
                mine = asked[part]
                yield from compared(ids[mine], queries[mine], names[rows], points[rows], k)


def fit(points: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 5) -> list[Tree]:
    return [Tree(points, leaf, np.random.default_rng([seed, i])) for i in range(trees)]


def nearest(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
            trees: int = TREES, leaf: int = LEAF, visits: int = VISITS, sample: int = SAMPLE,
            cell_rows: int = 65_536, cell_queries: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found by Euclidean distance, ties to the smaller id."""
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[id_col]
    exact = np.float64 if is_double(vectors, vector_col) else np.float32     # as wide as the input
    v = F.transform(F.col(vector_col), lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.where(usable(vectors, vector_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    drawn = rows.select("v").orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()  # at most ``sample`` rows
    sizes = np.array([len(x) for x in drawn.column("v")], np.int64)
    forests = {}
    for dim in np.unique(sizes).tolist():
        points = matrix(drawn.filter(pa.array(sizes == dim)).column("v"))
        forests[dim] = fit(points, trees if len(points) > leaf else 1, leaf)
    forest = spark.sparkContext.broadcast(forests)

    # of equal vectors the k + 1 smallest ids: few per group and task, then few per group
    same = F.xxhash64("v")
    part = Window.partitionBy("h", "v", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    whole = Window.partitionBy("h", "v").orderBy("id")
    listed = (rows.select("id", "v").distinct().withColumn("h", same)
              .withColumn("r", F.row_number().over(part)).where(F.col("r") <= k + 1)
              .withColumn("r", F.row_number().over(whole)).where(F.col("r") <= k + 1).select("id", "v"))

    def by_length(batches, rows):
        """(length, ids, matrix) of stretches of the batches."""
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                piece = batch.slice(at, rows)
                long = np.array([len(x) for x in piece.column("v")])
                for dim in np.unique(long).tolist():
                    one = piece.filter(pa.array(long == dim))
                    yield dim, one.column("id"), matrix(one.column("v"))

    def route(batches):
        for dim, ids, x in by_length(batches, 2048):
            body = packed(x.astype(exact))
            routed = [t.route(x) for t in forest.value[dim]] if dim in forest.value else [np.zeros(len(x), np.int64)]
            for i, leaves in enumerate(routed):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), n, np.int64)) for n in (dim, i)] + [pa.array(leaves), ids, body],
                    names=["dim", "tree", "leaf", "id", "body"])

    def ask(batches):
        for dim, ids, x in by_length(batches, 64):
            cells = [search(forest.value[dim], p, visits) if dim in forest.value else [(0, 0)] for p in x]
            count = [len(c) for c in cells]
            flat = np.array([c for some in cells for c in some], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(flat), dim, np.int64)), pa.array(flat[:, 0]), pa.array(flat[:, 1]),
                 ids.take(pa.array(np.repeat(np.arange(len(x)), count)))], names=["dim", "tree", "leaf", "id"])

    def bodies(batches):
        for _, ids, x in by_length(batches, 2048):
            yield pa.RecordBatch.from_arrays([ids, packed(x.astype(exact))], names=["id", "body"])

    place = ["dim", "tree", "leaf"]
    keys = "dim bigint, tree bigint, leaf bigint"
    indexed = materialize(listed.mapInArrow(route, f"{keys}, id {kind}, body binary"), "ann-index")
    queries = materialize(rows.where("q").groupBy("id").agg(F.min("v").alias("v")), "ann-queries")
    asked = materialize(queries.mapInArrow(ask, f"{keys}, id {kind}"), "ann-asked")
    # leaves of very many rows are dealt to several tasks, and leaves of very many queries are copied
    cells = (indexed.groupBy(*place).agg(F.ceil(F.count("*") / cell_rows).cast("bigint").alias("cells"))
             .join(asked.groupBy(*place).agg(F.ceil(F.count("*") / cell_queries).cast("bigint").alias("copies")), place))
    cut = materialize(cells.where("cells > 1 OR copies > 1"), "ann-cells")
    one = F.lit(1).cast("bigint")
    n_cells, n_copies = F.coalesce("cells", one), F.coalesce("copies", one)
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), n)
    stored = (indexed.join(cut, place, "left").withColumn("cell", own(n_cells)).withColumn("copy", numbers(n_copies)))
    vector = queries.mapInArrow(bodies, f"id {kind}, body binary")
    asked = (asked.join(cut, place, "left").withColumn("copy", own(n_copies)).withColumn("cell", numbers(n_cells))
             .join(vector, "id"))
    shape = [*place, "cell", "copy", "side", "id", "body"]
    met = (asked.withColumn("side", F.lit(0).cast("bigint")).select(*shape)
           .unionByName(stored.withColumn("side", F.lit(1).cast("bigint")).select(*shape))
           .repartition(*shape[:5]).sortWithinPartitions(*shape[:6]))

    def rank(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count, id_type = 0, None

        def reduced():
            q, v, d = (np.concatenate(x) for x in zip(*held))
            pick = best_rows(q, v, d, k)
            return pa.RecordBatch.from_arrays([pa.array(q[pick], id_type), pa.array(v[pick], id_type),
                                               pa.array(d[pick], pa.float64())], names=["query_id", "vec_id", "score"])

        for key, table in groups(batches, 5):
            n = int((table.column("side").to_numpy() == 0).sum())
            if not n or n == table.num_rows:
                continue
            body = unpacked(table.column("body"), exact).astype(np.float64)
            ids = table.column("id").combine_chunks()
            id_type, number = ids.type, ids.to_numpy(zero_copy_only=False)
            for found in in_cell(number[:n], body[:n], number[n:], body[n:], k, leaf, [5, *key[:4]]):
                held.append(found)
                count += len(found[0])
                if count >= HELD:
                    yield reduced()
                    held, count = [], 0
        if count:
            yield reduced()

    found = met.mapInArrow(rank, f"query_id {kind}, vec_id {kind}, score double")
    # at most k rows a query, visited cell and small leaf
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
