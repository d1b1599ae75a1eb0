"""The prefix trie against a plain version, with components small enough that centroids do the work."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from arealens.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_version(rows, block=20, heads=4):
    own = defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (c % block if c >= 0 else -(-c % block))
        made[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for n in members:
        if n:
            children[n[:-1]] += 1
    for n, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in children
            saved[n[:d]] += (len(m) - 1) * words
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), children[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if made[c] == n))).encode()).hexdigest())
                  for n, m in members.items())


def collected(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*COLUMNS).collect())


def corpus(seed, convs, longest, kinds):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        same = rng.random() < 0.3
        for t in range(rng.randrange(longest) if not same else 6):
            text = f"turn {t}" if same else rng.choice(["", "a", "a b", "a\x0bb  c", None, "é x", "\xa0y"][:kinds])
            rows.append((c * 3, t, rng.choice(["user", None]) if kinds > 4 else "user", text))
    return rows


@pytest.mark.parametrize("seed,convs,longest,kinds,small", [(1, 60, 9, 7, 16), (3, 25, 30, 2, 60)])
def test_like_the_plain_version(spark, seed, convs, longest, kinds, small):
    rows = corpus(seed, convs, longest, kinds)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    assert collected(prefix_trie.rebuilt_trie(df, small=small)) == plain_version(rows)


def test_a_chain_takes_logarithmic_rounds(spark, monkeypatch):
    rows = [(0, t, "user", f"t{t}") for t in range(700)] + [(c, 0, "user", "t0") for c in range(1, 9)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    written, real = [], prefix_trie.materialize
    monkeypatch.setattr(prefix_trie, "materialize", lambda d, name: written.append(name) or real(d, name))
    assert collected(prefix_trie.rebuilt_trie(df, small=50)) == plain_version(rows)
    assert 3 <= written.count("centroids") <= 7


def test_defined_cases(spark, monkeypatch):
    rows = [(None, 0, "user", "lost", 1), (1, None, "a", "first", 1), (1, 0, "a", "second", 1), (1, 0, "a", "second", 1),
            (1, 0, None, None, 1), (-7, 2, "u", "w " * 20_000, 1), (-7, 2, "u", "other", 1), (40, 0, "u", "x", 1),
            (41, 0, "u", "x", 1), (42, 0, "u", "x", 1), (43, 0, "u", "x", 1), (2, 0, "u", "only one", 1), (9, 1, "", "", 1)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, depth int")
    assert collected(prefix_trie.rebuilt_trie(df)) == plain_version(rows)
    assert prefix_trie.rebuilt_trie(df.limit(0)).count() == 0


def test_end_lists_span_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 7)
    ends = spark.createDataFrame([(b"a", i * 37 % 101) for i in range(101)] + [(b"b", 5)], "node binary, conv_id bigint")
    got = {bytes(r.node): r.ends_sha256 for r in prefix_trie.end_digests(ends).collect()}
    assert got[b"a"] == hashlib.sha256(",".join(map(str, range(101))).encode()).hexdigest()
    assert got[b"b"] == hashlib.sha256(b"5").hexdigest()
