"""Fill-in-the-middle against a plain Python version, word by word and on whole texts."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealens.llm import fim


def plain_version(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    key = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * i:8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(1)
    out = [None, "", "\n", "\n\n", "a", "a\n", "\na", "é\n日本\n😀", "x<P>y\nz", "<\nP>", "<S", "a\r\nb\rc", "\0\n\0",
           "\n" * 5000, "ab\n" * 20_000, "é" * 70_000, "<\n" * 9, ">\n<" * 8]
    return out + ["".join(rng.choice("ab\n\n\té日😀<>PSM\x89\x8a\x0b") for _ in range(rng.randrange(80))) for _ in range(400)]


def test_marks_agree_with_the_bytes():
    rng = np.random.default_rng(2)
    data = rng.choice(np.array([0, 1, 9, 10, 11, 0x0A ^ 0x80, 127, 128, 138, 191, 192, 255], np.uint8), 4003)
    words = fim.as_words(data)
    for mark, is_marked in ((fim.line_ends, data == 10), (fim.starts, (data & 0xC0) != 0x80)):
        marks = fim.Marks(words, mark)
        at = np.arange(len(data) + 1)
        assert (marks.rank(at) == np.concatenate([[0], np.cumsum(is_marked)])).all()
        places = np.flatnonzero(is_marked)
        assert (marks.select(np.arange(len(places))) == places).all()


@pytest.mark.parametrize("seed,rate,spm", [(7, 100, 50), (3, 60, 100), (4, 100, 0)])
def test_like_the_plain_version(spark, seed, rate, spm):
    rows = [(i % 300 if i else None, t, 1) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, output int").repartition(3)
    made = fim.transform(docs, seed=seed, rate=rate, spm=spm)
    got = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    want = sorted((repr((i, *plain_version(i, t, seed, rate, spm), t or "")) for i, t, _ in rows))
    assert sorted(repr(tuple(r)) for r in got) == want


def test_flush_and_an_empty_table(spark, nothing, monkeypatch):
    assert fim.transform(nothing).count() == 0
    docs = spark.createDataFrame([(i, "line\n" * (i % 7)) for i in range(500)], "doc_id bigint, text string").coalesce(1)
    monkeypatch.setattr(fim, "FLUSH", 40)
    got = {r.doc_id: r.output for r in fim.transform(docs).collect()}
    assert got == {i: plain_version(i, "line\n" * (i % 7))[-1] for i in range(500)}


def test_nasty_rows(nasty):
    got = fim.transform(nasty).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    want = nasty.select("doc_id", F.coalesce("text", F.lit("")).alias("back"))
    assert got.select("doc_id", "back").exceptAll(want).isEmpty() and got.count() == nasty.count()
