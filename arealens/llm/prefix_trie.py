"""Conversation prefix trie, rolled up over subtrees by centroid decomposition.

Every prefix of a conversation's turns is a node; conversations that start
with it are its members.  A prefix is known by the running sum, over its
turns, of a hash of (position, role, text): since the position is part of the
hash, equal sums mean equal sequences.  The sum has five parts of 32 bits of
SHA-256, and the node key is the MD5 of depth and sums, so two prefixes meet
with a probability of about (number of nodes)^2 / 2^129.  Running sums go
over range-partitioned turns, so no conversation is collected anywhere.

Totals of subtrees come from a centroid decomposition of the parent edges.
The weight of a node is its number of members; the weight of a whole subtree
is then the sum of its members' remaining turns, one aggregate.  Each round,
in every component at once:

1. the centroid is the deepest node whose part of the component weighs at
   least half of it (there is just one such node at that depth);
2. the total of what lies at or below it is aggregated, and added to every
   node on the path from it to the component's top; these nodes' weights
   fall by the centroid's;
3. the centroid leaves: each child's part is a component of its own, and so
   is the rest above.  No part weighs more than half.

So the rounds are logarithmic in the number of turns, however deep the trie
is.  A component that weighs ``small`` at most is summed directly, child to
parent, with many such components in one task.  The path of a centroid, and
the child a node lies under, are read from the members' own prefixes
(conversation, depth): two equi-joins a round.  Rounds are written to the
shared folder, and finished nodes are appended to one folder that is read
once at the end.

Defined cases: rows with a null conversation id belong to no conversation and
take no part; turns of equal number are ordered by role, then text, and rows
that repeat are turns of their own; null role and text are empty; an empty
table has no node, not even the root.  Further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import running_sums
from ..session import discard, materialize, scratch_path
from .vectors import groups

SMALL = 4096         # weight up to which a component is summed directly
FOREST = 20_000      # rows of small components that a task sums at a time
SALTS = 64           # tasks that search one component for its centroid
IDS = 65_536         # ids in one chunk of an end list
PARTS = [f"s{i}" for i in range(5)]
ROOT = hashlib.md5(b"").digest()


def ordered(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv_id, i, item, words): the turns of every conversation numbered from 0, with a digest of role and text."""
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        *[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))])
    placed = running_sums(rows, ["conv_id"], ["turn", "role", "text"], {"place": F.lit(1)}, frame="rows")
    item = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return placed.select("conv_id", (F.col("place") - 1).cast("bigint").alias("i"), item.alias("item"),
                         F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"))


def shared_heads(turns: DataFrame, block: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: the head of the block's first conversation, then the own turns behind it.

    ``turns`` comes from ``ordered``.  The head of conversation c has
    crc32(c as text) mod ``heads`` turns of conversation c - c % block (fewer
    if that has fewer) and stands in for as many own ones.  Returns
    (conv_id, len) of every conversation and (conv_id, pos, len, item, words).
    """
    own = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    own = materialize(own, "lengths")
    h = F.crc32(F.col("conv_id").cast("string")) % heads
    first = own.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    convs = (own.withColumn("base", F.col("conv_id") - F.col("conv_id") % block).withColumn("h", h)
             .join(first, "base", "left")
             .withColumn("k", F.least("h", F.coalesce("there", F.lit(0)))))
    convs = materialize(convs.select("conv_id", "base", "h", "k", (
        F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len")), "conversations")
    head = (turns.where(F.col("i") < heads - 1).withColumnRenamed("conv_id", "base")
            .join(convs, "base").where("i < k").select("conv_id", F.col("i").alias("pos"), "len", "item", "words"))
    tail = (turns.join(convs, "conv_id").where("i >= h")
            .select("conv_id", (F.col("i") - F.col("h") + F.col("k")).alias("pos"), "len", "item", "words"))
    return convs.select("conv_id", "len"), head.unionByName(tail)


def _key(depth: Column, parts) -> Column:
    return F.when(depth == 0, F.lit(ROOT)).otherwise(F.unhex(F.md5(F.concat_ws(":", depth, *parts))))


def steps(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, words, len): one row for each turn, at the node its prefix reaches."""
    digest = F.sha2(F.concat_ws(":", "pos", "item"), 256)
    own = {s: F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i, s in enumerate(PARTS)}
    rows = turns.select("conv_id", "pos", "len", "words", *[c.alias(f"own_{s}") for s, c in own.items()])
    summed = running_sums(rows, ["conv_id"], ["pos"], {s: F.col(f"own_{s}") for s in PARTS}, frame="rows")
    depth = F.col("pos") + 1
    return summed.select("conv_id", depth.alias("depth"), _key(depth, PARTS).alias("node"),
                         _key(F.col("pos"), [F.col(s) - F.col(f"own_{s}") for s in PARTS]).alias("parent"), "words", "len")


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): SHA-256 of the ascending ids, comma-joined.

    Ids are sorted over range partitions and joined there to chunks, so the
    task that hashes a node's list reads a chunk for some ten thousand ids
    and holds one of them at a time.
    """
    def chunks(batches):
        held, ids = None, []

        def emit():
            return pa.RecordBatch.from_arrays([pa.array([held], pa.binary()), pa.array([ids[0]], pa.int64()),
                                               pa.array([",".join(map(str, ids))])], names=["node", "first", "ids"])

        for batch in batches:
            nodes, numbers = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for node, number in zip(nodes, numbers):
                if ids and (node != held or len(ids) == IDS):
                    yield emit()
                    ids = []
                held = node
                ids.append(number)
        if ids:
            yield emit()

    def digests(batches):
        held, sha = None, None

        def emit():
            return pa.RecordBatch.from_arrays([pa.array([held], pa.binary()), pa.array([sha.hexdigest()])],
                                              names=["node", "ends_sha256"])

        for batch in batches:
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if node == held:
                    sha.update(b"," + ids.encode())
                    continue
                if held is not None:
                    yield emit()
                held, sha = node, hashlib.sha256(ids.encode())
        if held is not None:
            yield emit()

    cut = (ends.select("node", F.col("conv_id").cast("bigint").alias("conv_id")).repartitionByRange("node", "conv_id")
           .sortWithinPartitions("node", "conv_id").mapInArrow(chunks, "node binary, first bigint, ids string"))
    return (cut.repartition("node").sortWithinPartitions("node", "first")
            .mapInArrow(digests, "node binary, ends_sha256 string"))


def _summed(tables: list[pa.Table], values: list[str]) -> pa.RecordBatch:
    """Totals of whole small components: children are added to their parents, deepest first."""
    table = pa.concat_tables(tables).combine_chunks()
    nodes = table.column("node").to_pylist()
    place = {n: i for i, n in enumerate(nodes)}
    parent = np.array([place.get(p, -1) for p in table.column("parent").to_pylist()], np.int64)
    depth = table.column("depth").to_numpy()
    total = np.column_stack([table.column(v).to_numpy() for v in values])
    order = np.argsort(-depth, kind="stable")
    order = order[parent[order] >= 0]
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        np.add.at(total, parent[level], total[level])
    carried = np.column_stack([table.column(f"a_{v}").to_numpy() for v in values])
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), *map(pa.array, (total + carried).T)],
                                      names=["node", *values])


def subtree_totals(nodes: DataFrame, members: DataFrame, values: list[str], small: int = SMALL) -> DataFrame:
    """(node, *values): the values summed over every node's subtree, the node included.

    ``nodes``: node, parent, depth, conv_id (a member), weight (of the whole
    subtree, where each node has at least one) and bigint ``values``.
    ``members``: ``steps``.
    """
    spark = nodes.sparkSession
    kinds = ", ".join(f"{v} bigint" for v in values)
    done = scratch_path(spark, "totals")
    keep = ["node", "parent", "depth", "conv_id", "comp", "weight", *values, *[f"a_{v}" for v in values]]
    zero = {f"a_{v}": F.lit(0).cast("bigint") for v in values}
    state = materialize(nodes.withColumn("comp", F.lit(ROOT)).withColumns(zero).select(*keep), "component")
    way = members.select("conv_id", F.col("depth").alias("_at"), F.col("node").alias("_node"),
                         F.col("parent").alias("_parent"))

    def direct(batches):
        held, rows = [], 0
        for _, table in groups(batches, 1):
            held.append(table)
            rows += table.num_rows
            if rows >= FOREST:
                yield _summed(held, values)
                held, rows = [], 0
        if held:
            yield _summed(held, values)

    while True:
        large = (state.groupBy("comp").agg(F.max("weight").alias("whole"), F.min("depth").alias("top"))
                 .where(F.col("whole") > small))
        # salted: a component that holds most nodes is searched by many tasks
        salted = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        half = (state.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
                .join(salted, ["comp", "salt"]).where(2 * F.col("weight") >= F.col("whole")))
        centres = materialize(
            half.groupBy("comp").agg(F.max("top").alias("top"), F.max_by(
                F.struct("node", "conv_id", "depth", "weight"), "depth").alias("c"))
            .select("comp", "top", F.col("c.node").alias("c_node"), F.col("c.conv_id").alias("c_conv"),
                    F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight")), "centroids")
        rest = state.join(centres.select("comp"), "comp", "left_anti")
        few = (rest.select(F.xxhash64("comp").alias("key"), "node", "parent", "depth", *keep[6:])
               .repartition("key").sortWithinPartitions("key"))
        few.mapInArrow(direct, f"node binary, {kinds}").write.mode("append").parquet(done)
        if centres.isEmpty():
            break
        # what lies below a centroid, and below which of its children
        met = state.join(centres, "comp").withColumn("_at", F.least(F.col("c_depth") + 1, "depth"))
        met = met.join(way, ["conv_id", "_at"], "left")
        below = (F.col("depth") > F.col("c_depth")) & (F.col("_parent") == F.col("c_node"))
        parted = materialize(met.withColumn("below", F.coalesce(below, F.lit(False))).select(
            *keep, "c_node", F.when(F.col("below"), F.col("_node")).alias("piece")), "parted")
        at = F.col("node") == F.col("c_node")
        totals = (parted.where(at | F.col("piece").isNotNull()).groupBy("comp")
                  .agg(*[F.sum(v).alias(f"t_{v}") for v in values]).join(centres, "comp"))
        path = (way.join(totals.withColumnRenamed("c_conv", "conv_id"), "conv_id")
                .where((F.col("_at") > F.col("top")) & (F.col("_at") <= F.col("c_depth")))
                .select(F.col("_parent").alias("node"), "c_weight", *[f"t_{v}" for v in values]))
        more = {f"a_{v}": F.col(f"a_{v}") + F.coalesce(f"t_{v}", F.lit(0)) for v in values}
        moved = (parted.where(~at).join(path, "node", "left").withColumns(
            more | {"weight": F.col("weight") - F.coalesce("c_weight", F.lit(0)),
                    "comp": F.coalesce("piece", "comp")}))
        then = materialize(moved.select(*keep), "component")
        (parted.where(at).join(totals.select("comp", *[f"t_{v}" for v in values]), "comp")
         .select("node", *[(F.col(f"a_{v}") + F.col(f"t_{v}")).alias(v) for v in values])
         .write.mode("append").parquet(done))
        for old in (state, parted, centres):
            discard(old)
        state = then
    return spark.read.schema(f"node binary, {kinds}").parquet(done)


def trie(convs: DataFrame, turns: DataFrame, small: int = SMALL) -> DataFrame:
    """The nodes of the trie with their subtree totals and end lists.

    ``convs``: (conv_id, len) of all conversations; ``turns``: (conv_id, pos,
    len, item, words), positions from 0.  Returns node, parent (keys),
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.
    """
    members = materialize(steps(turns), "steps")
    nodes = (members.groupBy("node", "parent", "depth", "words")
             .agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"),
                  F.sum(F.col("len") - F.col("depth") + 1).alias("weight")))
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"),
                     F.sum(F.col("len") + 1).alias("weight")).where("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(0).cast("bigint").alias("words"), "n_convs", "conv_id", "weight")
    nodes = materialize(nodes.unionByName(root), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = materialize(nodes.join(children, "node", "left").join(above, "parent", "left")
                        .fillna(0, ["n_children"]), "trie")
    totals = subtree_totals(
        whole.withColumn("n_leaves", (F.col("n_children") == 0).cast("bigint"))
        .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("words")),
        members, ["n_leaves", "saved_tokens"], small)
    ends = (members.where("depth = len").select("node", "conv_id")
            .unionByName(convs.where("len = 0").select(F.lit(ROOT).alias("node"), "conv_id")))
    return (whole.join(totals, "node").join(end_digests(ends), "node", "left")
            .select("node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                    "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def rebuilt_trie(conversations: DataFrame, block: int = 20, heads: int = 4, small: int = SMALL) -> DataFrame:
    """``trie`` of the conversations rebuilt with shared heads."""
    return trie(*shared_heads(materialize(ordered(conversations), "turns"), block, heads), small)
