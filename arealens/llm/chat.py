"""Chat formatting: tool calls linked to their results.

Calls and results of a conversation meet in an equi-join on conversation and
call id, so a conversation with very many messages can be split over tasks.
Calls are ordered topologically: a call that needs other calls' results
(``after``) gets a level above theirs, found by jumping over calls in rounds
that are logarithmic in the length of a chain.  (conv_id, level, turn, idx) is then an
order in which every call stands after what it needs; no conversation is
collected into one row or task.  Arguments are checked against the tool's
JSON schema and everything is serialised as canonical JSON: sorted keys, no
spaces, shortest numbers, text as it is.

Defined cases: of calls that repeat an id in one conversation the first (by
turn, idx) is linked and the others are ``repeated``; a result goes to the
call of its id if it stands later, the earliest such result counts, any other
is ``orphan``; a call without a result is ``open``; a need that no call of the
conversation has is ignored; calls on a cycle have a null level and are
``cyclic``.  A null conversation or call id links with nothing.  Arguments
that are null or no JSON object are invalid, and so are NaN, infinite numbers,
lone surrogates and nesting of more than ``DEEPEST`` levels; invalid JSON is
kept as the text it came as.  Further columns are not read.
"""

from __future__ import annotations

import json
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize, scratch_path

DEEPEST = 200                # levels of nesting that arguments may have
FEW, WIDE = 4, 8             # needs of a call that is jumped over, and of one that jumps over several
FARTHEST = 1 << 60           # distances on a cycle stop here
TYPES = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def is_a(value, kind: str) -> bool:
    if kind in ("integer", "number"):
        return isinstance(value, int if kind == "integer" else (int, float)) and not isinstance(value, bool)
    return isinstance(value, TYPES[kind])


def loaded(text: str):
    """JSON as the standard has it: ValueError for NaN and infinities, lone surrogates and deep nesting."""
    def refused(number):
        raise ValueError(f"{number} is no JSON number")

    def finite(number):
        value = float(number)
        return value if math.isfinite(value) else refused(number)

    try:
        value = json.loads(text, parse_constant=refused, parse_float=finite)
    except RecursionError:
        raise ValueError("nested too deep") from None
    level, depth = [value], 0
    while level:
        if depth > DEEPEST:
            raise ValueError("nested too deep")
        level = [y for x in level if isinstance(x, (dict, list)) for y in (x.values() if isinstance(x, dict) else x)]
        depth += 1
    canonical(value).encode()    # UnicodeEncodeError, a ValueError, for a lone surrogate
    return value


def problems(value, schema: dict, at: str = "$") -> list[str]:
    """Where a value breaks a JSON schema (type, enum, required, properties, items and bounds)."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(is_a(value, k) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{at}: too short")
        if len(value) > schema.get("maxLength", len(value)):
            out.append(f"{at}: too long")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            out.append(f"{at}: too small")
        if value > schema.get("maximum", value):
            out.append(f"{at}: too large")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += problems(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += problems(x, schema["items"], f"{at}[{i}]")
    return out


def checked(name: str | None, arguments: str | None, schemas: dict) -> tuple[dict | None, str]:
    """Parsed arguments and what is wrong with them (empty: nothing)."""
    try:
        value = loaded(arguments) if arguments is not None else None
    except ValueError:
        return None, "$: not JSON"
    if not isinstance(value, dict):
        return None, "$: not object"
    if name not in schemas:
        return value, "$: unknown tool"
    return value, "; ".join(problems(value, schemas[name]))


def levels(nodes: DataFrame, needs: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): 0 without needs, else one more than the highest of what it needs.

    ``needs`` holds (conv_id, call_id, need) with both ends in ``nodes``.
    Nodes on or behind a cycle are missing.

    A node keeps the level it reaches through needs that are settled (``base``)
    and the others with their distances.  Each round, first what was settled
    goes into the ``base`` of all that need it.  Then a need is jumped over:
    its own needs take its place, at the sum of the distances.  A jump over a
    single need never widens a node, so a chain halves each round; jumps over
    up to ``FEW`` needs are made by nodes that have no more than ``WIDE``.
    Any jump keeps the levels exact.  What is settled is appended to one folder
    that is read once, and only the rest goes on, so no plan holds more than a
    round.  A round that settles nothing leaves the cycles.
    """
    spark = nodes.sparkSession
    key = ["conv_id", "call_id"]
    done = scratch_path(spark, "levels")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.select(*key).schema)
    edge = f"array<struct<need: {nodes.schema['call_id'].dataType.simpleString()}, far: bigint>>"
    none = F.array().cast(edge)
    start = needs.distinct().groupBy(*key).agg(
        F.collect_list(F.struct("need", F.lit(1).cast("bigint").alias("far"))).cast(edge).alias("needs"))
    state = materialize(nodes.select(*key).join(start, key, "left").select(
        *key, F.lit(0).cast("bigint").alias("base"), F.coalesce("needs", none).alias("needs"),
        F.lit(False).alias("cyclic")), "level")

    def onward(rows, targets, jump):
        """The nodes of ``rows`` after a look at ``targets``; ``jump`` says which needs to replace by theirs."""
        targets = targets.select("conv_id", F.col("call_id").alias("need"), F.col("base").alias("t_base"),
                                 F.col("needs").alias("t_needs"), F.col("cyclic").alias("t_cyclic"))
        edges = (rows.withColumn("wide", F.size("needs")).withColumn("e", F.explode("needs"))
                 .select(*key, "base", "wide", "e.need", "e.far").join(targets, ["conv_id", "need"], "left"))
        known = F.col("t_needs").isNotNull()
        met = known & (F.size("t_needs") == 0)
        over = F.transform("t_needs", lambda x: F.struct(
            x["need"].alias("need"), F.least(x["far"] + F.col("far"), F.lit(FARTHEST)).alias("far")))
        here = F.array(F.struct(F.col("need").alias("need"), F.col("far").alias("far")))
        taken = F.greatest("base", F.least(F.col("t_base") + F.col("far"), F.lit(FARTHEST)))
        seen = edges.select(
            *key, F.when(met | (known & jump), taken).otherwise(F.col("base")).alias("base"),
            F.coalesce("t_cyclic", F.lit(False)).alias("cyclic"),
            F.explode_outer(F.when(known & (met | jump), over).otherwise(here)).alias("e"))
        each = seen.groupBy(*key, F.col("e.need").alias("need")).agg(
            F.max("e.far").alias("far"), F.max("base").alias("base"), F.max("cyclic").alias("cyclic"))
        whole = each.groupBy(*key).agg(
            F.max("base").alias("base"), F.max(F.col("cyclic") | F.coalesce(F.col("need") == F.col("call_id"), F.lit(False)))
            .alias("cyclic"), F.collect_list(F.when(F.col("need").isNotNull(), F.struct("need", "far"))).cast(edge).alias("needs"))
        # what is on a cycle, or behind one, is settled without a level
        return whole.select(*key, "base", F.when(F.col("cyclic"), none).otherwise(F.col("needs")).alias("needs"), "cyclic")

    count = F.size("t_needs")
    few = (count == 1) | ((count <= FEW) & (F.col("wide") <= WIDE))
    while True:
        settled, waiting = state.where(F.size("needs") == 0), state.where(F.size("needs") > 0)
        settled.where(~F.col("cyclic")).select(*key, F.col("base").alias("level")).write.mode("append").parquet(done)
        if settled.isEmpty():
            break
        rest = materialize(onward(waiting, settled, F.lit(False)), "level")
        discard(state)
        jumped = onward(rest.where(F.size("needs") > 0), rest, few)
        state = materialize(jumped.unionByName(rest.where(F.size("needs") == 0)), "level")
        discard(rest)
    discard(state)
    return spark.read.schema(f"{kinds}, level bigint").parquet(done).withColumn("level", F.col("level").cast("int"))


def link(messages: DataFrame, schemas: dict) -> DataFrame:
    """Linked calls and orphan results.

    ``messages``: conv_id, turn, text, calls array<struct<id, name, arguments, after array<string>>>,
    result_of.  Returns conv_id, turn, idx, call_id, name, level, result_turn, status, valid, errors and
    ``json``: the canonical JSON of the call with its result.
    """
    calls = messages.select("conv_id", "turn", F.posexplode("calls").alias("idx", "c")).select(
        "conv_id", "turn", "idx", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"),
        F.col("c.arguments").alias("arguments"), F.col("c.after").alias("after"))
    results = messages.where(F.col("result_of").isNotNull()).select(
        "conv_id", F.col("turn").alias("result_turn"), F.col("result_of").alias("call_id"), F.col("text").alias("result"))
    key = ["conv_id", "call_id"]

    first = calls.where(F.col("call_id").isNotNull() & F.col("conv_id").isNotNull()).groupBy(*key).agg(
        F.min(F.struct("turn", "idx")).alias("f"))
    first = materialize(first.select(*key, F.col("f.turn").alias("turn"), F.col("f.idx").alias("idx")), "calls")
    later = results.join(first, key).where(F.col("result_turn") > F.col("turn"))
    taken = later.groupBy(*key).agg(F.min("result_turn").alias("result_turn"))
    nodes = first.select(*key)
    needs = (calls.join(first, [*key, "turn", "idx"], "left_semi")
             .select("conv_id", "call_id", F.explode("after").alias("need"))
             .join(nodes.withColumnRenamed("call_id", "need"), ["conv_id", "need"], "left_semi"))
    placed = (first.join(levels(nodes, needs), key, "left").join(taken, key, "left")
              .withColumn("main", F.lit(True)))
    texts = later.join(taken, [*key, "result_turn"], "left_semi").groupBy(*key).agg(F.min("result").alias("result"))
    rows = calls.join(placed, [*key, "turn", "idx"], "left").join(texts, key, "left")
    rows = rows.withColumn("result", F.when(F.col("main"), F.col("result"))).withColumn("status", F.expr(
        "CASE WHEN conv_id IS NULL OR call_id IS NULL THEN 'open' WHEN main IS NULL THEN 'repeated' "
        "WHEN level IS NULL THEN 'cyclic' WHEN result_turn IS NULL THEN 'open' ELSE 'linked' END"))
    orphans = (results.join(taken, [*key, "result_turn"], "left_anti")
               .select("conv_id", F.col("result_turn").alias("turn"), F.lit(None).cast("int").alias("idx"), "call_id",
                       F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"),
                       F.lit(None).cast("int").alias("level"), "result_turn", "result",
                       F.lit("orphan").alias("status")))
    whole = rows.select(*orphans.columns).unionByName(orphans)

    @F.arrow_udf("struct<errors: string, json: string>")
    def formatted(ids: pa.Array, names: pa.Array, arguments: pa.Array, results: pa.Array, statuses: pa.Array) -> pa.Array:
        errors, out = [], []
        for i, n, a, r, s in zip(*(x.to_pylist() for x in (ids, names, arguments, results, statuses))):
            value, wrong = (None, "") if s == "orphan" else checked(n, a, schemas)
            errors.append(wrong)
            call = None if s == "orphan" else {"name": n, "arguments": a if value is None else value}
            out.append(canonical({"id": i, "call": call, "result": r}))
        return pa.StructArray.from_arrays([pa.array(errors, pa.string()), pa.array(out, pa.string())],
                                          names=["errors", "json"])

    return (whole.withColumn("f", formatted("call_id", "name", "arguments", "result", "status"))
            .select("conv_id", "turn", "idx", "call_id", "name", "level", "result_turn", "status",
                    F.when(F.col("status") != "orphan", F.col("f.errors") == "").alias("valid"),
                    F.col("f.errors").alias("errors"), F.col("f.json").alias("json")))
