"""Levels of tool calls against a plain version, and arguments that are not what they should be."""

import json
import random

import pytest
from pyspark.sql import functions as F

from arealens.llm import chat

SHAPE = ("conv_id bigint, turn bigint, text string, "
         "calls array<struct<id: string, name: string, arguments: string, after: array<string>>>, result_of string")


def plain_levels(needs):
    """needs: {node: set of nodes}; None for nodes on or behind a cycle."""
    level, left = {}, dict(needs)
    while True:
        ready = [n for n, after in left.items() if all(a in level for a in after)]
        if not ready:
            return {n: level.get(n) for n in needs}
        for n in ready:
            level[n] = 1 + max((level[a] for a in left[n]), default=-1)
            del left[n]


def levels(spark, needs):
    nodes = spark.createDataFrame([(n % 2, str(n)) for n in needs], "conv_id bigint, call_id string")
    edges = spark.createDataFrame([(n % 2, str(n), str(a)) for n, after in needs.items() for a in after],
                                  "conv_id bigint, call_id string, need string")
    got = {int(r.call_id): r.level for r in chat.levels(nodes, edges).collect()}
    return {n: got.get(n) for n in needs}


def test_a_chain_of_5000_calls_takes_logarithmic_rounds(spark, monkeypatch):
    written, real = [], chat.materialize
    monkeypatch.setattr(chat, "materialize", lambda df, name: written.append(name) or real(df, name))
    needs = {2 * i: {2 * i - 2} if i else set() for i in range(5000)}
    assert levels(spark, needs) == {2 * i: i for i in range(5000)}
    assert len(written) < 40


@pytest.mark.parametrize("seed,nodes,wide,back", [(1, 150, 3, 0), (2, 120, 14, 0), (3, 90, 3, 0.03)])
def test_branching_graphs(spark, seed, nodes, wide, back):
    rng = random.Random(seed)
    needs = {}
    for n in range(nodes):
        same = [m for m in range(n % 2, n, 2)][-2 * wide:]
        needs[n] = set(rng.sample(same, min(len(same), rng.randrange(wide + 1))))
        if rng.random() < back:
            needs[n].add(rng.randrange(n % 2, nodes, 2))
    assert levels(spark, needs) == plain_levels(needs)


def test_cycles_and_a_ladder(spark):
    ladder = {0: set(), 2: set()} | {2 * i: {2 * i - 2, 2 * i - 4} for i in range(2, 40)}
    cycles = {101: {103}, 103: {101}, 105: {103}, 107: {107}, 109: set(), 111: {109, 107}, 113: {109},
              115: {117}, 117: {119}, 119: {115, 113}}
    assert levels(spark, ladder | cycles) == plain_levels(ladder | cycles)


def test_arguments_that_are_no_json_or_break_a_schema():
    schemas = {"t": {"type": "object", "properties": {"a": {"type": ["string", "null"]}, "n": {"type": "number"}}}}

    def wrong(text):
        return chat.checked("t", text, schemas)

    for text in ('{"a": "\\ud800"}', '{"a": NaN}', '{"n": -Infinity}', '{"n": 1e999}', '{"a": ' * 300 + "1" + "}" * 300,
                 "[" * 200_000, '{"n": ' + "9" * 5000 + "}", "{", ""):
        assert wrong(text) == (None, "$: not JSON"), text[:20]
    assert wrong('{"a": null, "n": 1.5}') == ({"a": None, "n": 1.5}, "")
    assert wrong('{"a": 1}')[1] == "$.a: not string or null"
    assert wrong('{"a": "\\ud83d\\ude00"}') == ({"a": "😀"}, "")
    assert wrong("[]") == wrong(None) == (None, "$: not object")


def test_invalid_arguments_stay_as_text(spark):
    texts = ['{"a": "\\ud800"}', '{"a": NaN}', "[" * 5000, '{"b": {"c": [1, 2]}}']
    rows = [(1, i, "", [(str(i), "t", text, None)], None) for i, text in enumerate(texts)]
    got = {r.turn: r for r in chat.link(spark.createDataFrame(rows, SHAPE), {"t": {"type": "object"}}).collect()}
    assert [got[i].valid for i in range(4)] == [False, False, False, True]
    assert [json.loads(got[i].json)["call"]["arguments"] for i in range(3)] == texts[:3]


def test_a_hot_need(spark):
    needs = {0: set()} | {2 * i: {0} for i in range(1, 3000)}
    nodes = spark.range(3000).select(F.lit(0).cast("bigint").alias("conv_id"), (2 * F.col("id")).cast("string").alias("call_id"))
    edges = nodes.where("call_id != '0'").withColumn("need", F.lit("0"))
    assert {int(r.call_id): r.level for r in chat.levels(nodes, edges).collect()} == plain_levels(needs)
