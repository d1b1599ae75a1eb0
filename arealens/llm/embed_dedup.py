"""Near-duplicate embeddings by spherical-cap filters.

A filter is a direction; a vector passes it if its projection is at least
``tau``.  The directions are structured: after a random rotation a vector is
cut into two halves, each half has a codebook of ``codewords`` random unit
words, and every pair of codewords is one direction, whose projection is the
sum of the halves' (normalised) products.  So the list of all filters a
vector passes is decoded from 2 * codewords products: with both halves'
products sorted, partners of a word are a prefix.  ``tau`` makes a random
vector pass ``passed`` filters of each rotation on average.

Vectors of one label that share a filter are compared by exact cosine in
double precision; a pair is counted only in its smallest common filter.  What
leaves a comparison block is one row per vector (its links, and the smallest
vector it hangs together with there), never the pairs.  Buckets of more than
``block`` vectors are cut into blocks, and every two blocks meet in a task of
their own.  Equal vectors are one row from the start.

Links below the threshold cannot occur.  A pair at the threshold is missed with
a chance of at most MISS, closer pairs less: ``tau`` is a quantile of the real
distribution of the projections, and the rotations are simulated for each
number of dimensions and size of the codebooks, which grow with the largest
label; codebooks stop growing where that would take more than MOST rotations.
Up to CELLS dimensions the filters
are grid cells instead, which miss no pair.  If no codebook reaches MISS (thresholds far below 0.9), all vectors of a label
are compared.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without label, are linked with nothing and kept; vectors
of different lengths are never linked; rows with a null id count as copies
but are no one's component; rows that repeat an id count as further vectors.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import connected_components
from .vectors import groups, matrix, packed, unpacked, usable

CODEWORDS, ROTATIONS, PASSED, BLOCK = 64, 6, 8.0, 1024
MISS, MOST = 0.001, 48   # chance to miss a pair at the threshold, rotations of a codebook that may grow
CELLS = 8                # dimensions up to which cells are compared


def projection_quantile(dim: int, share: float) -> float:
    """The value that the projection of a random unit vector on a direction of Filters exceeds with chance ``share``."""
    turns = (np.arange(20_000) + 0.5) * np.pi / 20_000
    value, weight = [], []
    for half in (dim // 2, dim - dim // 2):
        w = np.sin(turns) ** (half - 2)
        value.append(np.cos(turns) * np.sqrt(half / 2))
        weight.append(w / w.sum())
    above = np.cumsum(weight[1])
    low, high = 0.0, float(value[0][0] + value[1][0])
    for _ in range(50):
        tau = (low + high) / 2
        chance = weight[0] @ np.interp(value[0] - tau, -value[1], above, left=0.0, right=1.0)
        low, high = (tau, high) if chance > share else (low, tau)
    return (low + high) / 2


class Filters:
    """The structured directions for one dimension (of at least 4)."""

    def __init__(self, dim: int, codewords: int = CODEWORDS, rotations: int = ROTATIONS, passed: float = PASSED,
                 seed: int = 11):
        rng = np.random.default_rng([seed, dim])
        self.m, self.half = codewords, max(1, dim // 2)
        self.tau = projection_quantile(dim, min(0.5, passed / codewords ** 2))
        self.turns = []
        for _ in range(rotations):
            turn, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
            books = [rng.standard_normal((codewords, max(1, d))) for d in (self.half, dim - self.half)]
            self.turns.append((turn, *[b / np.linalg.norm(b, axis=1, keepdims=True) * np.sqrt(b.shape[1] / 2)
                                       for b in books]))

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Sorted ids of the filters that each row (of length one) passes."""
        n = len(unit)
        found: list[list[np.ndarray]] = [[] for _ in range(n)]
        for r, (turn, left, right) in enumerate(self.turns):
            v = unit @ turn
            a, b = v[:, :self.half], v[:, self.half:]
            if not b.shape[1]:
                b = np.zeros((n, 1))
            with np.errstate(invalid="ignore", divide="ignore"):
                sa = np.nan_to_num(a / np.linalg.norm(a, axis=1, keepdims=True)) @ left.T
                sb = np.nan_to_num(b / np.linalg.norm(b, axis=1, keepdims=True)) @ right.T
            order = np.argsort(-sb, axis=1)
            ranked = np.take_along_axis(sb, order, 1)
            for i in range(n):
                # partners of word k on the left: the right words of product at least tau - sa[k]
                count = np.searchsorted(-ranked[i], sa[i] - self.tau, side="right")
                k = np.repeat(np.arange(self.m), count)
                at = np.arange(len(k)) - np.repeat(np.cumsum(count) - count, count)
                found[i].append((r * self.m + k) * self.m + order[i][at])
        return [np.sort(np.concatenate(f)).astype(np.int32) for f in found]


class Cells:
    """Exact filters: the cells of a grid that meet the ball around a vector which holds the middle of its every
    pair at ``threshold`` or above.  Two such vectors share the cell of their middle.  Where one cell would hold
    most of the space, all vectors pass one filter."""

    def __init__(self, dim: int, threshold: float, seed: int = 11):
        apart = math.sqrt(max(0.0, 2 - 2 * threshold))      # largest distance of a pair
        self.side = max(apart, 1e-3)
        self.radius = apart / 2 + 1e-7
        rng = np.random.default_rng([seed, dim])
        self.shift = rng.random(dim)
        self.odd = rng.integers(1, 1 << 62, dim, dtype=np.int64) * 2 + 1
        self.all = dim > CELLS or self.side > 1

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Sorted ids (hashed) of the cells of each row (of length one)."""
        if self.all:
            return [np.zeros(1, np.int32)] * len(unit)
        x, radius = unit / self.side + self.shift, self.radius / self.side
        row, left, ids = np.arange(len(x)), np.full(len(x), radius ** 2), np.zeros(len(x), np.int64)
        for d, odd in enumerate(self.odd):
            at, home = x[row, d], np.floor(x[row, d])
            parts = []
            for step in (-1, 0, 1):
                gap = {-1: at - home, 0: 0.0 * at, 1: home + 1 - at}[step]
                ok = np.flatnonzero(gap ** 2 <= left)
                with np.errstate(over="ignore"):
                    parts.append((row[ok], left[ok] - gap[ok] ** 2, ids[ok] + (home[ok].astype(np.int64) + step) * odd))
            row, left, ids = (np.concatenate(p) for p in zip(*parts))
        ids = ((ids ^ (ids >> 29)) & 0x7FFFFFFF).astype(np.int32)
        order = np.argsort(row, kind="stable")
        return [np.unique(f) for f in np.split(ids[order], np.cumsum(np.bincount(row, minlength=len(x)))[:-1])]


def _links(rows, cols, lists_rows, lists_cols, this, threshold, same):
    """Which rows link with which columns, of the pairs whose smallest common filter is ``this``."""
    near = rows @ cols.T >= threshold
    if same:
        np.fill_diagonal(near, False)
    if not near.any():
        return None
    # drop pairs that share a smaller filter
    small_r = [f[:np.searchsorted(f, this)] for f in lists_rows]
    small_c = small_r if same else [f[:np.searchsorted(f, this)] for f in lists_cols]
    flat_r, at_r = np.concatenate(small_r), np.repeat(np.arange(len(small_r)), [len(f) for f in small_r])
    flat_c, at_c = np.concatenate(small_c), np.repeat(np.arange(len(small_c)), [len(f) for f in small_c])
    common = np.intersect1d(flat_r, flat_c)
    if len(common):
        incidence_r = np.zeros((len(small_r), len(common)), np.float32)
        incidence_c = np.zeros((len(small_c), len(common)), np.float32)
        for flat, at, inc in ((flat_r, at_r, incidence_r), (flat_c, at_c, incidence_c)):
            pos = np.searchsorted(common, flat)
            pos[pos == len(common)] = 0
            hit = common[pos] == flat
            inc[at[hit], pos[hit]] = 1
        near &= (incidence_r @ incidence_c.T) == 0
    return near


def _roots(n: int, near: np.ndarray, offset: int) -> np.ndarray:
    """Smallest index that each of n members hangs together with (rows 0.., columns from ``offset``)."""
    root = np.arange(n)
    i, j = np.nonzero(near)
    j = j + offset
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def turn_miss(dim: int, codewords: int, passed: float, threshold: float, pairs: int = 4096) -> float:
    """Chance that a pair at cosine ``threshold`` shares no filter of one rotation: simulated on ``pairs`` random
    pairs and eight sets of codebooks, plus two standard errors."""
    rng = np.random.default_rng([17, dim, codewords])
    missed = 0
    for seed in range(8):
        x, z = rng.standard_normal((2, pairs // 8, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        z -= (z * x).sum(1, keepdims=True) * x
        y = threshold * x + np.sqrt(1 - threshold ** 2) * z / np.linalg.norm(z, axis=1, keepdims=True)
        filters = Filters(dim, codewords, 1, passed, 100 + seed)
        missed += sum(not len(np.intersect1d(a, b, True)) for a, b in zip(filters.decode(x), filters.decode(y)))
    share = missed / (pairs // 8 * 8)
    return share + 2 * np.sqrt(max(share, 1 / pairs) * (1 - share) / pairs)


@lru_cache(maxsize=None)
def rotations_for(dim: int, codewords: int, passed: float, threshold: float) -> int:
    """Rotations after which a pair at ``threshold`` is missed with a chance of at most MISS; half of it is aimed
    at, as the codebooks of one seed differ from the mean."""
    share = turn_miss(dim, codewords, passed, max(-1.0, min(threshold, 1 - 1e-9)))
    return math.ceil(math.log(MISS / 2) / math.log(share)) if share < 1 else 1 << 30


def settings_for(dim: int, largest: int, threshold: float, passed: float = PASSED, rotations: int = ROTATIONS,
                 bucket: int = 64) -> tuple[int, int, float] | None:
    """(codewords, rotations, passed) at which a pair at ``threshold`` is missed with a chance of at most MISS: the
    smallest codebook of at least CODEWORDS at which a filter of the largest label holds about ``bucket`` random
    vectors, or the largest one that needs at most MOST rotations.  None (Cells) if no codebook gets there, and up
    to CELLS dimensions."""
    m, found = CODEWORDS, None
    if dim <= CELLS:
        return None
    while passed <= CODEWORDS ** 2 / 4:
        needed = max(rotations, rotations_for(dim, m, passed, threshold))
        if needed > max(rotations, MOST) or needed * m * m >= 1 << 31:   # ids of filters are 32-bit
            if found:
                return found
            passed *= 2
            continue
        found = m, needed, passed
        if largest * passed / m ** 2 <= bucket:
            return found
        m *= 2
    return found


@lru_cache(maxsize=4)
def filters_of(dim: int, threshold: float, chosen: tuple[int, int, float] | None):
    return Cells(dim, threshold) if chosen is None else Filters(dim, *chosen)


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = 0.93, block: int = BLOCK, passed: float = PASSED,
                    rotations: int = ROTATIONS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
                          F.transform(F.col(vector_col), lambda x: x.cast("double") + F.lit(0.0)).alias("v"),
                          (usable(vectors, vector_col) & F.col(label_col).isNotNull()).alias("ok"))
    own = F.xxhash64("label", "v")
    classes = materialize(rows.where("ok").groupBy("label", "v").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("node", F.xxhash64("label", "v")), "vector-classes")
    # one row per length of vectors
    largest = classes.groupBy("label", F.size("v").alias("dim")).count().groupBy("dim").agg(F.max("count")).collect()
    chosen = {dim: settings_for(dim, n, threshold, passed, rotations) for dim, n in largest}

    def decode(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                dims = part.column("dim").to_numpy()
                for dim in np.unique(dims).tolist():
                    pick = part.filter(pa.array(dims == dim))
                    x = matrix(pick.column("v"))
                    scale = np.abs(x).max(axis=1, keepdims=True)
                    x = x / scale
                    x = x / np.linalg.norm(x, axis=1, keepdims=True)
                    yield pa.RecordBatch.from_arrays(
                        [pick.column("node"), pick.column("copies"), pick.column("label"), pick.column("dim"),
                         packed(x), pa.array(filters_of(dim, threshold, chosen[dim]).decode(x), pa.list_(pa.int32()))],
                        names=["node", "copies", "label", "dim", "unit", "filters"])

    kind = vectors.schema[label_col].dataType.simpleString()
    decoded = materialize(classes.select("node", "copies", "label", F.size("v").alias("dim"), "v").mapInArrow(
        decode, f"node bigint, copies bigint, label {kind}, dim int, unit binary, filters array<int>"), "filters")
    # light rows find the buckets; those with more than ``block`` vectors are cut
    bucket = F.xxhash64("label", "dim", "f")
    light = decoded.select("node", F.explode("filters").alias("f"), "label", "dim").select(
        "node", bucket.alias("bucket"), "f")
    sizes = light.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    cut = F.ceil(F.col("n") / block).cast("int")
    met = (light.join(sizes, "bucket").withColumn("cut", cut)
           .withColumn("own", F.pmod(F.col("node"), F.col("cut")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
           .select("node", "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "f"))
    heavy = (met.join(decoded.select("node", "copies", "unit", "filters"), "node")
             .select("bucket", F.col("i").cast("bigint"), F.col("j").cast("bigint"), "own", "f", "node", "copies", "unit",
                     "filters"))

    def compare(batches):
        out: list[tuple] = []
        for (_, i, j), table in groups(batches, 3):
            node = table.column("node").to_numpy()
            own = table.column("own").to_numpy()
            copies = table.column("copies").to_numpy()
            unit = unpacked(table.column("unit"), np.float64)
            lists = [np.asarray(x, np.int32) for x in table.column("filters").to_pylist()]
            this = table.column("f")[0].as_py()
            first = np.flatnonzero(own == i)
            second = first if i == j else np.flatnonzero(own == j)
            if not len(first) or not len(second):
                continue
            near = _links(unit[first], unit[second], [lists[k] for k in first], [lists[k] for k in second], this,
                          threshold, i == j)
            if near is None or not near.any():
                continue
            if i == j:
                links = near @ copies[first]
                root = _roots(len(first), near, 0)
                hit = np.flatnonzero(links)
                out += zip(node[first][hit].tolist(), links[hit].tolist(), node[first][root[hit]].tolist())
            else:
                both = np.concatenate([first, second])
                root = _roots(len(both), near, len(first))
                links = np.concatenate([near @ copies[second], near.T @ copies[first]])
                hit = np.flatnonzero(links)
                out += zip(node[both][hit].tolist(), links[hit].tolist(), node[both][root[hit]].tolist())
            if len(out) > 20_000:
                yield pa.RecordBatch.from_pylist([dict(zip(("node", "links", "root"), x)) for x in out], OUT)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(("node", "links", "root"), x)) for x in out], OUT)

    parts = (heavy.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
             .mapInArrow(compare, "node bigint, links bigint, root bigint"))
    linked = materialize(parts, "vector-links")
    found = connected_components(linked, "node", "root")
    n_links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    comp = classes.select("node", "rep", "copies").join(
        found.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = comp.groupBy("component").agg(F.min("rep").alias("component_id"))
    final = (comp.join(smallest, "component").join(n_links, "node", "left")
             .select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    keyed = rows.select("vec_id", F.when(F.col("ok"), own).alias("node"))
    out = keyed.join(final, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


OUT = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
