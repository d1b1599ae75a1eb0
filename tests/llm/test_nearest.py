"""Nearest neighbours where leaves, copies, lengths and repeated ids make a search go wrong."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealens.llm import ann

SHAPE = "vec_id bigint, embedding array<float>"


def brute(rows, k=10):
    rows = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in rows if v]
    out = {}
    for q in sorted({i for i, _ in rows if i % 100 == 0}):
        mine = min((tuple(v) for i, v in rows if i == q))
        best = {}
        for i, v in rows:
            if i != q and len(v) == len(mine):
                d = float(np.sqrt(((v - np.array(mine)) ** 2).sum()))
                best[i] = min(d, best.get(i, d))
        out[q] = [i for _, i in sorted((d, i) for i, d in best.items())[:k]]
    return out


def found(df, **options):
    got = ann.nearest(df, F.col("vec_id") % 100 == 0, **options).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append(r.vec_id)
        assert r["rank"] == len(out[r.query_id])
    return out


def test_rarer_lengths_are_searched_too(spark):
    rng = np.random.default_rng(1)
    rows = ([(i, rng.standard_normal(8).tolist()) for i in range(50)]
            + [(100 + i, rng.standard_normal(4).tolist()) for i in range(20)] + [(300, [1.0, 2.0, 3.0]), (401, [0.5] * 5)])
    df = spark.createDataFrame(rows, SHAPE)
    want = {q: v for q, v in brute(rows).items() if v}
    assert found(df) == want and len(want[100]) == 10 and 300 not in want
    assert found(df, sample=3) == want          # lengths of which the sample holds nothing


def test_repeated_rows_and_ids_count_once(spark):
    same = [1.0, 2.0, 3.0, 4.0]
    rows = [(i, same) for i in range(12) for _ in range(4)] + [(100, same)]
    rows += [(200, [9.0] * 4)] + [(201, [9.0, 9.0, 9.0, 9.0 + j / 64]) for j in range(40)] + [
        (210 + j, [9.0, 9.0, 9.0, 11.0 + j]) for j in range(12)] + [(7, [9.0, 9.0, 9.0, 10.0])]
    got = found(spark.createDataFrame(rows, SHAPE).repartition(3))
    assert got == brute(rows)
    assert got[100] == list(range(10)) and got[200][:2] == [201, 7]


def points(n, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, dim)) + 3 * rng.standard_normal((200, dim))[rng.integers(0, 200, n)]).astype(np.float32)


def recall(spark, x, **options):
    ids = np.arange(len(x))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], SHAPE).repartition(4)
    got, hits, total = found(df, **options), 0, 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x.astype(np.float64) - x[q].astype(np.float64)) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.argsort(d, kind="stable")[:10].tolist()
        hits, total = hits + len(set(best) & set(got[q])), total + 10
    return hits / total


def test_recall_with_ten_times_as_many_leaves_as_visits(spark):
    x = points(8000)
    trees = ann.fit(x.astype(np.float64), trees=16, leaf=16)
    assert sum(t.leaves for t in trees) >= 10 * 500
    assert recall(spark, x, leaf=16, visits=500) >= 0.9


def test_recall_when_leaves_are_split_and_dealt(spark):
    x = points(6000, seed=5)
    # a sample of a tenth: leaves of some 160 rows, split on to 16; then leaves dealt and copied as well
    assert recall(spark, x, leaf=16, visits=300, sample=600) >= 0.9
    assert recall(spark, x, leaf=16, visits=300, sample=600, cell_rows=50, cell_queries=7) >= 0.9


def test_the_share_that_is_looked_at_falls():
    looked, real = [], ann.compared

    def counted(ids, queries, names, points, k):
        looked[-1] += len(ids) * len(names)
        return real(ids, queries, names, points, k)

    ann.compared = counted
    try:
        for n in (1000, 4000, 16_000):
            looked.append(0)
            x = points(n).astype(np.float64)
            list(ann.in_cell(np.arange(50), x[:50], np.arange(n), x, 10, 64, 1))
            looked[-1] /= 50 * n
    finally:
        ann.compared = real
    assert looked[0] > 1.5 * looked[1] > 2.25 * looked[2] and looked[2] < 0.1


def test_leaf_keys_are_those_of_the_priority_queue():
    x = points(700).astype(np.float64)
    tree = ann.Tree(x, 16, np.random.default_rng(1))
    keys = ann.leaf_keys(tree, x[:9])
    for q in range(9):
        order = [leaf for _, leaf in ann.search([tree], x[q], tree.leaves)]
        assert np.allclose(np.sort(keys[q]), keys[q][order]) and sorted(order) == list(range(tree.leaves))


@pytest.mark.parametrize("rows", [[], [(None, [1.0])], [(100, None), (200, []), (300, [0.0, 0.0]), (400, [float("nan"), 1.0])],
                                  [(100, [1.0, 2.0])]])
def test_no_candidates(spark, rows):
    assert found(spark.createDataFrame(rows, SHAPE)) == {}
