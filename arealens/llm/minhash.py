"""Near-duplicate documents by b-bit MinHash.

A document is the set of its word shingles (as 64-bit hashes).  ``hashes``
minima are taken; the first ``bands * rows`` of them form band keys for
candidate generation, and of every minimum only the low ``bits`` bits are
kept, packed as bit planes.  Two signatures agree where no plane differs,
which bit counts find; chance agreement (2**-bits) is taken out of the
estimate.  A candidate pair whose set sizes allow the threshold and whose
estimate is within reach of it is confirmed on the full sets.

Documents with equal sets are one class from the start, so any number of
exact copies is one row.  A band bucket is not expanded into pairs: first
every member is compared with one pivot of the bucket (the member that meets
most others), each member taking the pivot with the best estimate; then the
members of one bucket that are still in different components are compared
with one another.  So every pair that shares a bucket is either confirmed or
refuted on its sets, or already connected.

With the default five rows and thirty bands a pair of similarity 0.8 shares
no band with probability 7e-6, and the estimate (standard error 0.015) is cut
0.06 below the threshold.

Defined cases: a text without words (null, empty, white space) has no set and
is linked with nothing; a text of fewer words than a shingle is one shingle;
rows with a null id are linked with nothing, have a null component and are
kept; rows that repeat an id are one document, linked as any of its rows is.
Other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize
from .base import slices
from .components import connected_components

BANDS, ROWS, HASHES, BITS = 30, 5, 1024, 2
MARGIN = 0.06
PIVOTS = 3
MAX_WORDS = 60_000   # word hashes a worker remembers
CHUNK = 256           # shingles hashed at a time, so that their products stay in the processor's cache


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


_HASHES = _Words()


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.array(list(map(_HASHES.__getitem__, words)), np.uint64)
    n = max(1, len(h) - size + 1)
    acc = h[:n].copy()
    for j in range(1, min(size, len(h))):
        acc = (acc ^ (acc >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n]
    acc = (acc ^ (acc >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(acc ^ (acc >> np.uint64(32)))


class Signer:
    """Band keys and packed b-bit signatures."""

    def __init__(self, bands: int, rows: int, hashes: int, bits: int, seed: int = 7):
        if bands * rows > hashes or hashes % 64:
            raise ValueError("hashes is a multiple of 64 and at least bands * rows")
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 1 << 31, hashes, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, hashes, dtype=np.uint32)
        self.bands, self.rows, self.bits = bands, rows, bits
        self.seeds = rng.integers(0, 1 << 63, bands, dtype=np.uint64)

    def minima(self, keys: np.ndarray) -> np.ndarray:
        x = (keys >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), CHUNK):
            part = self.a[:, None] * x[None, i:i + CHUNK] + self.b[:, None]
            np.minimum(low, part.min(axis=1), out=low)
        return low

    def sign(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = self.minima(keys)
        rows = low[:self.bands * self.rows].reshape(self.bands, self.rows).astype(np.uint64)
        band = self.seeds.copy()
        for j in range(self.rows):
            band = (band ^ (band >> np.uint64(31)) ^ rows[:, j]) * np.uint64(0x9E3779B97F4A7C15)
        band ^= band >> np.uint64(32)
        mixed = low ^ (low >> np.uint32(15))
        planes = [np.packbits((mixed >> np.uint32(p)) & np.uint32(1)).view(np.int64) for p in range(self.bits)]
        return band.view(np.int64), np.concatenate(planes)


def _lists(rows: list[np.ndarray], width: int) -> pa.Array:
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.array(flat))


def sketch(docs: DataFrame, id_col: str, text_col: str, shingle: int, bands: int, rows: int, hashes: int,
           bits: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, sig); the last three are null for a document without a set."""
    key_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        signer = Signer(bands, rows, hashes, bits)
        for part in slices(batches, 1024):
            n, keys, band, sig = [], [], [], []
            for text in part.column(1).to_pylist():
                s = shingles(text, shingle)
                n.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                b, g = signer.sign(s) if len(s) else (np.zeros(bands, np.int64), np.zeros(hashes // 64 * bits, np.int64))
                band.append(b)
                sig.append(g)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 _lists(band, bands), _lists(sig, hashes // 64 * bits)],
                names=["doc_id", "n_shingles", "set_key", "bands", "sig"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"doc_id {key_type}, n_shingles bigint, set_key binary, bands array<bigint>, sig array<bigint>")


def full_sets(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, shingles): the whole sets as arrays of 64-bit hashes."""
    key_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for part in slices(batches, 256):
            sets = [shingles(t, shingle).view(np.int64) for t in part.column(1).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["doc_id", "shingles"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"doc_id {key_type}, shingles array<bigint>")


def estimate(a: Column, b: Column, hashes: int = HASHES, bits: int = BITS) -> Column:
    """Collision-corrected similarity of two packed signatures (bit planes one after another)."""
    words = hashes // 64
    agree = None
    for w in range(words):
        differs = a[w].bitwiseXOR(b[w])
        for p in range(1, bits):
            differs = differs.bitwiseOR(a[p * words + w].bitwiseXOR(b[p * words + w]))
        agree = F.bit_count(differs) if agree is None else agree + F.bit_count(differs)
    chance = 2.0 ** -bits
    return (F.lit(1.0) - agree / F.lit(float(hashes)) - chance) / (1 - chance)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.select("a", "b").join(left, "a").join(right, "b")
            .where(both * (100 + percent) >= percent * (F.size("sa") + F.size("sb"))).select("a", "b"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS, hashes: int = HASHES,
                    bits: int = BITS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; see the module's text."""
    enough = percent / 100 - MARGIN
    sketches = materialize(sketch(docs, id_col, text_col, shingle, bands, rows, hashes, bits), "sketches")
    usable = sketches.where(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull())
    classes = materialize(usable.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "classes")
    signed = (usable.join(classes.withColumnRenamed("rep", "doc_id"), ["set_key", "doc_id"])
              .select(F.col("doc_id").alias("rep"), "n_shingles", "bands", "sig"))

    # buckets that more than one class meets in
    keys = signed.select("rep", F.posexplode("bands").alias("band", "key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = materialize(keys.join(sizes, "key"), "members")
    sigs = materialize(signed.join(members.select("rep").distinct(), "rep", "left_semi"), "sigs")
    wanted = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        sigs.select(F.col("rep").alias("_id")).distinct(), "_id", "left_semi")
    sets = materialize(full_sets(wanted, "_id", "_text", shingle), "sets")
    sig_a = sigs.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("ga"))
    sig_b = sigs.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("gb"))
    # sets of too different sizes cannot reach the threshold
    alike = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent

    # every class with the pivots of its (at most ``bands``) buckets: those of the best estimates
    met = members.groupBy("rep").agg(F.sum("size").alias("met"))
    ranked = members.select("key", "rep").join(met, "rep")
    pivots = ranked.groupBy("key").agg(F.max(F.struct("met", "rep")).alias("p")).select("key", F.col("p.rep").alias("b"))
    stars = (members.select("key", F.col("rep").alias("a")).join(pivots, "key").where("a != b")
             .select("a", "b").distinct()
             .join(sig_a, "a").join(sig_b, "b").where(alike)
             .withColumn("near", estimate(F.col("ga"), F.col("gb"), hashes, bits))
             .where(F.col("near") >= enough).groupBy("a")
             .agg(F.slice(F.sort_array(F.collect_list(F.struct("near", "b")), asc=False), 1, PIVOTS).alias("p"))
             .select("a", F.explode("p.b").alias("b")))
    linked = materialize(_confirmed(stars, sets, percent), "links")
    found = connected_components(linked, "a", "b")

    # buckets whose members are still in different components
    placed = members.join(found, F.col("rep") == F.col("node"), "left").select(
        "key", "band", "rep", F.coalesce("component", "rep").alias("comp"))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    parted = materialize(placed.join(mixed, "key", "left_semi").join(sigs, "rep"), "parted")
    one = parted.select("key", "band", F.col("rep").alias("a"), F.col("comp").alias("ca"),
                        F.col("n_shingles").alias("na"), F.col("sig").alias("ga"), F.col("bands").alias("ba"))
    two = parted.select("key", F.col("rep").alias("b"), F.col("comp").alias("cb"),
                        F.col("n_shingles").alias("nb"), F.col("sig").alias("gb"), F.col("bands").alias("bb"))
    earlier = F.exists(F.zip_with(F.slice("ba", F.lit(1), F.col("band")), F.slice("bb", F.lit(1), F.col("band")),
                                  lambda x, y: x == y), lambda x: x)
    rest = (one.join(two, (one["key"] == two["key"]) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & alike
                     & (estimate(F.col("ga"), F.col("gb"), hashes, bits) >= enough) & ~earlier)
            .select("a", "b").distinct())
    more = _confirmed(rest, sets, percent)
    # an id with rows of different sets ties their classes together
    key = F.xxhash64("set_key")
    repeated = usable.groupBy("doc_id").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).where("lo != hi")
    same_id = (usable.join(repeated.select("doc_id"), "doc_id", "left_semi").join(classes, "set_key")
               .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    whole = connected_components(found.select(F.col("node").alias("a"), F.col("component").alias("b"))
                                 .unionByName(more).unionByName(same_id), "a", "b")
    for copy in (members, sigs, sets, linked, parted):   # the components are written, nothing reads these again
        discard(copy)

    final = classes.join(whole, F.col("rep") == F.col("node"), "left").select(
        "set_key", F.coalesce("component", "rep").alias("class_id"))
    out = sketches.select("doc_id", "n_shingles", "set_key").join(final, "set_key", "left")
    of_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    return out.select("doc_id", "n_shingles", of_id.alias("component_id"),
                      F.coalesce(F.col("doc_id") == of_id, F.lit(True)).alias("kept"))
