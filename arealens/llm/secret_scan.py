"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of a file (one row) is addressed by the SHA-256 of its text.
The ledger holds, for each blob, the rule versions it was scanned with and
the findings.  A run scans a blob once, however many paths and versions hold
it, and only with the rule versions the ledger does not have; then it joins
the findings back to all rows.  Only built-in functions are used.

The text of a blob is taken from its row of smallest id: ids and addresses
are aggregated (a hot blob is one pre-aggregated row), and texts are dealt
by id, never by content.

Positions come from two passes of one pattern: the matches and the gaps
between them; a match starts where the gaps and matches before it end.  The
running sum goes in blocks of ``BLOCK`` matches, first over the blocks' sums
and then inside each block, so that the time follows the number of matches.
Patterns match leftmost and without overlap, and a match that fails the
rule's length is dropped afterwards.

The ledger keeps the rule version with every finding, and a run reads the
findings of its own rule versions only: what an older or another version
found stays in the ledger and out of the result.  Rows of a ledger that hold
no findings by rule version (an earlier format) count as not scanned.

Defined cases: a null text is an empty blob without findings; rows with a
null id are joined like others; rows that repeat an id and text share the
blob, rows that repeat an id with other texts have their own blobs; an empty
table gives no rows and leaves the ledger as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

FINDING = "struct<start: bigint, rank: int, kind: string, end: bigint>"
HELD = "struct<rule: string, start: bigint, end: bigint>"     # a finding in the ledger
BLOCK = 512


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0       # the length is checked on this group
    least: int = 0       # fewer characters: not a finding
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three rules that callers rely on come first, in this order.
BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    # for these two the length is part of the pattern: a run that is long enough is found from its start
    Rule("access", r"AKIA[A-Z0-9]{16,}+"),
    Rule("hex", r"[0-9a-f]{24,}+"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a lambda would compute an expression of its outside at every call."""
    return F.transform(F.array(value), body)[0]


def blocks(items: Column) -> Column:
    """An array cut into arrays of ``BLOCK`` items (none for an empty array)."""
    def cut(held):
        starts = F.sequence(F.lit(1), F.greatest(F.size(held), F.lit(1)), F.lit(BLOCK))
        return F.transform(starts, lambda i: F.slice(held, i, BLOCK))

    return F.filter(let(items, cut), lambda b: F.size(b) > 0)


def running(items: Column, first: Column, amount, kind: str) -> Column:
    """``items`` (structs) with ``at``, the running ``amount`` before each, from ``first``; linear in their number.

    ``kind`` is the DDL of ``struct<at: bigint, x: <item>>``.
    """
    empty = F.array().cast(f"array<{kind}>")
    pair = F.struct(first.alias("at"), empty.alias("out"))

    def step(acc, x):
        return F.struct((acc["at"] + amount(x)).alias("at"),
                        F.concat(acc["out"], F.array(F.struct(acc["at"].alias("at"), x.alias("x")))).alias("out"))

    return F.aggregate(items, pair, step)["out"]


def findings(text: Column, rule: Rule) -> Column:
    """Array of HELD of one rule in a text (code points, end exclusive), by start."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    # lengths only: (gap, match, part), the last gap without a match
    pieces = F.transform(F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), matches.alias("match"),
                                      checked.alias("part")), lambda x: F.struct(
        F.length(x["gap"]).cast("bigint").alias("gap"), F.coalesce(F.length(x["match"]), F.lit(0)).cast("bigint").alias("match"),
        F.coalesce(F.length(x["part"]), F.lit(0)).cast("bigint").alias("part")))
    piece = "struct<gap: bigint, match: bigint, part: bigint>"

    def amount(x):
        return x["gap"] + x["match"]

    summed = F.transform(blocks(pieces), lambda b: F.struct(
        F.aggregate(b, F.lit(0).cast("bigint"), lambda acc, x: acc + amount(x)).alias("sum"), b.alias("block")))
    placed = running(summed, F.lit(0).cast("bigint"), lambda x: x["sum"],
                     f"struct<at: bigint, x: struct<sum: bigint, block: array<{piece}>>>")
    inside = F.flatten(F.transform(placed, lambda p: running(
        p["x"]["block"], p["at"], amount, f"struct<at: bigint, x: {piece}>")))
    kept = F.filter(inside, lambda p: p["x"]["part"] >= max(rule.least, 1))
    spans = F.transform(kept, lambda p: F.struct(
        F.lit(rule.key).alias("rule"), (p["at"] + p["x"]["gap"]).alias("start"),
        (p["at"] + amount(p["x"])).alias("end")))
    return F.when(text.rlike(rule.pattern), spans).otherwise(F.array().cast(f"array<{HELD}>"))


def address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan(versions: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES,
         ledger: str | None = None) -> DataFrame:
    """(id, blob, findings) for every row of ``versions``; findings are sorted by start, then rule.

    ``ledger`` is a folder all executors share; new scans are appended to it.
    Without one the ledger starts empty and lives in the scratch folder.
    """
    spark = versions.sparkSession
    rows = versions.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                           address(F.col(text_col)).alias("blob"))
    held = rows.groupBy("blob").agg(F.min("_id").alias("_id"))
    wanted = F.array(*[F.lit(r.key) for r in rules])
    old = _read(spark, ledger)
    if old is not None:
        seen = old.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        todo = (held.join(seen, "blob", "left")
                .withColumn("todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
                .where(F.size("todo") > 0).drop("seen"))
    else:
        todo = held.withColumn("todo", wanted)
    todo = todo.withColumnsRenamed({"blob": "_blob", "_id": "_rep"})
    texts = rows.join(todo, F.col("_id").eqNullSafe(F.col("_rep")) & (F.col("blob") == F.col("_blob")))
    text = F.coalesce("_text", F.lit(""))
    none = F.array().cast(f"array<{HELD}>")
    found = [F.when(F.array_contains("todo", r.key), findings(text, r)) for r in rules]
    scanned = texts.select("blob", F.col("todo").alias("rules"),
                           F.concat(*[F.coalesce(f, none) for f in found]).alias("found"))
    if ledger is None:
        book = materialize(scanned, "blob-ledger")
    else:
        scanned.write.mode("append").parquet(ledger)
        book = _read(spark, ledger)
    # findings of the wanted rule versions, once however often the ledger has them
    wanted_now = F.filter("found", lambda x: x["rule"].isin([r.key for r in rules]))
    known = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.key, i)])
    kinds = F.create_map(*[F.lit(x) for r in rules for x in (r.key, r.kind)])
    current = (book.withColumn("found", wanted_now).where(F.size("found") > 0).groupBy("blob")
               .agg(F.flatten(F.collect_list("found")).alias("found"))
               .withColumn("findings", F.array_sort(F.transform("found", lambda x: F.struct(
                   x["start"].alias("start"), known[x["rule"]].alias("rank"), kinds[x["rule"]].alias("kind"),
                   x["end"].alias("end"))))))
    # two runs at a time may both have scanned a blob: what is found twice lies side by side now
    current = current.withColumn("findings", let(F.col("findings"), lambda all_: F.filter(
        all_, lambda x, i: (i == 0) | (x != F.get(all_, i - 1)))))
    return (rows.select("_id", "blob").join(current, "blob", "left")
            .select(F.col("_id").alias(id_col), "blob",
                    F.coalesce("findings", F.array().cast(f"array<{FINDING}>")).alias("findings")))


def _read(spark, ledger: str | None) -> DataFrame | None:
    if ledger is None:
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    there = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)
    return spark.read.schema(f"blob string, rules array<string>, found array<{HELD}>").parquet(ledger).where(
        "found IS NOT NULL") if there else None


def spans(found: Column, kinds=None) -> Column:
    """``kind:start:end`` of the findings (of some kinds), comma-joined."""
    if kinds is not None:
        found = F.filter(found, lambda x: x["kind"].isin(list(kinds)))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(text: Column, found: Column) -> Column:
    """The text with every finding replaced by ``[kind]`` (overlapping ones by the first).

    Findings are taken in blocks: a block's stretch of the text is cut out
    once, and its pieces are cut from that stretch.
    """
    size = F.length(text).cast("bigint")
    # of a block: the end of the last finding before it, and of all findings up to its last
    listed = F.transform(blocks(found), lambda b: F.struct(
        F.array_max(F.transform(b, lambda x: x["end"])).alias("end"), b.alias("block")))
    shape = f"struct<at: bigint, x: struct<end: bigint, block: array<{FINDING}>>>"
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{shape}>").alias("out"))
    spread = F.aggregate(listed, start, lambda acc, x: F.struct(
        F.greatest(acc["at"], x["end"]).alias("at"),
        F.concat(acc["out"], F.array(F.struct(acc["at"].alias("at"), x.alias("x")))).alias("out")))

    def block_text(p):
        stretch = F.substr(text, (p["at"] + 1).cast("int"), F.greatest(p["x"]["end"] - p["at"], F.lit(0)).cast("int"))
        begin = F.struct(p["at"].alias("at"), F.lit("").alias("out"))

        def put(held):
            def step(acc, x):
                between = F.substr(held, (acc["at"] - p["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int"))
                longer = F.concat(acc["out"], between, F.lit("["), x["kind"], F.lit("]"))
                return F.struct(F.greatest(acc["at"], x["end"]).alias("at"),
                                F.when(x["start"] >= acc["at"], longer).otherwise(acc["out"]).alias("out"))

            return F.aggregate(p["x"]["block"], begin, step)["out"]

        return let(stretch, put)

    rest = F.substr(text, (spread["at"] + 1).cast("int"), size.cast("int"))
    return F.when(F.size(found) > 0, F.concat(F.array_join(F.transform(spread["out"], block_text), ""), rest)).otherwise(text)
