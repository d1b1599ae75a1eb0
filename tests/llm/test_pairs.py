"""Near duplicates, neighbours, components and linked calls against brute force."""

import json
import math
import random

import numpy as np
from pyspark.sql import functions as F

from arealens.llm import ann, chat, embed_dedup, minhash
from arealens.llm.components import connected_components


def _components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 20)] + [(100, 100 + i) for i in range(1, 9)] + [(7, 7), (50, 60), (60, 50)]
    df = spark.createDataFrame(links + [(None, 3)], "src bigint, dst bigint")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    want = _components({x for p in links for x in p}, links)
    assert got == {n: c for n, c in want.items() if n != c}
    assert connected_components(df.limit(0)).count() == 0


def _sets(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_minhash_equals_brute_force(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghijklmnop") + str(rng.randint(0, 60)) for _ in range(60)) for _ in range(12)]
    texts = []
    for b in base:
        for _ in range(6):
            w = b.split()
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = "edit" + str(rng.randint(0, 9))
            texts.append(" ".join(w))
    texts += [None, "", " \n", "one", "ONE", "one two", "\u00c9tude x", base[0].upper(), base[0]]
    df = spark.createDataFrame([(i * 3, t, "s") for i, t in enumerate(texts)], "doc_id bigint, text string, key string")
    for k in (2, 5):
        sets = [_sets(t, k) for t in texts]
        links = [(i * 3, j * 3) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j]
                 and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
        want = _components([i * 3 for i in range(len(texts))], links)
        got = minhash.near_duplicates(df, shingle=k).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want
        assert all(r["n_shingles"] == len(sets[r["doc_id"] // 3]) and r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_minhash_edges(nasty, nothing):
    got = minhash.near_duplicates(nasty).collect()
    assert len(got) == nasty.count()
    assert [r["kept"] for r in got if r["doc_id"] is None] == [True]
    assert {r["component_id"] for r in got if r["doc_id"] == 5} == {5}
    assert minhash.near_duplicates(nothing).count() == 0


def test_estimate_is_collision_corrected(spark):
    signer = minhash.Signer(minhash.BANDS, minhash.ROWS, minhash.HASHES, minhash.BITS)
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    b = np.unique(np.concatenate([a[:800], rng.integers(0, 1 << 63, 200).astype(np.uint64) * np.uint64(2) + np.uint64(1)]))
    row = [(signer.sign(a)[1].tolist(), signer.sign(b)[1].tolist())]
    got = spark.createDataFrame(row, "a array<bigint>, b array<bigint>").select(
        minhash.estimate(F.col("a"), F.col("b")).alias("e")).collect()[0]["e"]
    assert abs(got - 800 / 1200) < 0.08


BAD = [(900, None, 1), (901, [0.0] * 64, 1), (902, [math.nan] + [1.0] * 63, 1), (903, [math.inf] + [1.0] * 63, 1),
       (904, [None] + [1.0] * 63, 1), (905, [], 1)]


def _vectors(n=160, groups=20, dim=64):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((groups, dim))
    rows = [(i, (centres[i % groups] + 0.1 * rng.standard_normal(dim)).tolist(), i % 3) for i in range(n)]
    return rows + [(700, rows[0][1], rows[0][2]), (701, [2 * x for x in rows[0][1]], rows[0][2]), (702, rows[0][1], None)]


def test_embedding_dedup_equals_brute_force(spark):
    rows = _vectors()
    df = spark.createDataFrame(rows + BAD, "vec_id bigint, embedding array<double>, label int").withColumn("node", F.lit(1))
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    label = {i: x for i, _, x in rows}
    links = [(a, b) for a in unit for b in unit if a < b and label[a] is not None and label[a] == label[b]
             and unit[a] @ unit[b] >= 0.93]
    want = _components([r[0] for r in rows + BAD], links)
    got = embed_dedup.near_duplicates(df, block=7).collect()
    assert {r["vec_id"]: r["component_id"] for r in got} == want
    assert {r["vec_id"]: r["n_links"] for r in got} == {i: sum(i in x for x in links) for i in want}
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def _pairs_at(dim, n, cosine):
    rng = np.random.default_rng(5)
    x, z = rng.standard_normal((2, n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    return x, cosine * x + np.sqrt(1 - cosine ** 2) * z / np.linalg.norm(z, axis=1, keepdims=True)


def test_filters_miss_no_more_pairs_as_labels_grow():
    x, y = _pairs_at(64, 4000, 0.93)
    for largest, codewords in ((1000, 64), (100_000, 128), (1_000_000, 512), (4_000_000, 1024)):
        chosen = embed_dedup.settings_for(64, largest, 0.93)
        filters = embed_dedup.filters_of(64, 0.93, chosen)
        missed = sum(not set(a.tolist()) & set(b.tolist()) for a, b in zip(filters.decode(x), filters.decode(y)))
        assert chosen[0] == codewords and missed <= 0.001 * len(x)


def test_embedding_dedup_in_few_dimensions(spark):
    rng = np.random.default_rng(4)
    rows, links = [], set()
    for dim in range(1, 17):
        centres = rng.standard_normal((20, dim))
        spread = 0.25 * np.linalg.norm(centres, axis=1, keepdims=True) / math.sqrt(dim)
        x = np.concatenate([centres, centres + spread * rng.standard_normal((20, dim)), 2 * centres[:3]])
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        links |= {(100 * dim + i, 100 * dim + j) for i, j in zip(*np.nonzero(unit @ unit.T >= 0.93)) if i < j}
        rows += [(100 * dim + i, v.tolist(), 1) for i, v in enumerate(x)]
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()
    want = _components([r[0] for r in rows], links)
    assert {r["vec_id"]: r["component_id"] for r in got} == want
    assert {r["vec_id"]: r["n_links"] for r in got} == {i: sum(i in x for x in links) for i in want}


def test_cells_hold_every_pair():
    for dim, threshold in ((1, 0.93), (2, 0.93), (5, 0.6), (8, 0.93), (8, 0.999)):
        cells = embed_dedup.Cells(dim, threshold)
        x, y = _pairs_at(dim, 500, threshold) if dim > 1 else (np.ones((2, 1)), np.ones((2, 1)))
        assert all(set(a.tolist()) & set(b.tolist()) for a, b in zip(cells.decode(x), cells.decode(y)))


def test_nearest_recall_and_exact_scores(spark):
    rows = [r for r in _vectors(600, 40)]
    df = spark.createDataFrame(rows + BAD, "vec_id bigint, embedding array<double>, label int")
    got = ann.nearest(df, F.col("vec_id") % 100 == 0, k=10, cell_rows=16).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q, v, _ in rows:
        if q % 100:
            continue
        d = sorted((float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum())), i) for i, x, _ in rows if i != q)[:10]
        mine = sorted(found[q])
        assert [r for r, _, _ in mine] == list(range(1, 11))
        hits += len({i for _, i in d} & {i for _, i, _ in mine})
        total += 10
        by_id = {i: x for i, x, _ in rows}
        assert all(s == np.sqrt(((np.array(by_id[i]) - np.array(v)) ** 2).sum()) for _, i, s in mine)
        assert [(s, i) for _, i, s in mine] == sorted((s, i) for _, i, s in mine)
    assert hits / total >= 0.9 and not any(q >= 900 for q in found)
    assert ann.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


CALL = "id string, name string, arguments string, after array<string>"
SHAPE = f"conv_id bigint, turn int, text string, calls array<struct<{CALL}>>, result_of string, key int"


def test_chat_links_orders_validates(spark):
    schemas = {"add": {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}}}}
    call = lambda i, args='{"b":1,"a":2}', after=(), name="add": (i, name, args, list(after))
    rows = [(1, 0, None, [call("x"), call("y", after=["x"]), call("z", after=["y", "nowhere"])], None, 1),
            (1, 1, "r-x", None, "x", 1), (1, 2, "r-x again", None, "x", 1), (1, 3, "r-q", None, "q", 1),
            (1, 4, None, [call("x"), call(None), call("bad", "[]"), call("neg", '{"a":-1}'), call("un", name="no")], None, 1),
            (2, 0, None, [call("p", after=["q"]), call("q", after=["p"])], None, 1), (2, 1, "early", None, "late", 1),
            (2, 2, None, [call("late", None)], None, 1), (None, 0, "t", [call("x")], "x", 1)]
    got = chat.link(spark.createDataFrame(rows, SHAPE), schemas).collect()
    by = {(r["conv_id"], r["turn"], r["idx"], r["status"]): r for r in got}
    assert len(by) == len(got) == 16   # 12 calls, 4 orphan results
    assert [by[1, 0, i, s]["level"] for i, s in ((0, "linked"), (1, "open"), (2, "open"))] == [0, 1, 2]
    assert by[1, 0, 0, "linked"]["json"] == '{"call":{"arguments":{"a":2,"b":1},"name":"add"},"id":"x","result":"r-x"}'
    assert {k[3] for k in by if k[0] == 2 and k[1] == 0} == {"cyclic"}
    assert (1, 2, None, "orphan") in by and (1, 3, None, "orphan") in by and (2, 1, None, "orphan") in by
    assert (1, 4, 0, "repeated") in by
    assert by[1, 4, 2, "open"]["errors"] == "$: not object" and by[1, 4, 3, "open"]["errors"] == "$.a: too small"
    assert by[1, 4, 4, "open"]["errors"] == "$: unknown tool" and by[2, 2, 0, "open"]["valid"] is False
    assert json.loads(by[1, 3, None, "orphan"]["json"]) == {"call": None, "id": "q", "result": "r-q"}
    assert chat.link(spark.createDataFrame([], SHAPE), schemas).count() == 0


def test_canonical_json():
    assert chat.canonical({"b": [1, 2.5, None], "a": "é\n"}) == '{"a":"é\\n","b":[1,2.5,null]}'
