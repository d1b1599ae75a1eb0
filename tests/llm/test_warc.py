"""WARC archives and their index: round trips, look-ups against a scan, defined cases."""

import gzip
import hashlib
import os
import random

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from arealens.llm import warc


def plain_version(rows, least=1000):
    best, count = {}, {}
    for i, _, html in rows:
        p = (html or "").encode()
        count[p] = count.get(p, 0) + 1
        if i is not None:
            best[p] = max(best.get(p, i), i)
    out = []
    for i, _, html in rows:
        p = (html or "").encode()
        first = best.get(p) if len(p) >= least and count[p] > 1 else None
        again = first is not None and first != i
        out.append((i, "revisit" if again else "response", first if again else None, len(p), hashlib.sha1(p).hexdigest()))
    return sorted(out, key=repr)


def pages():
    rng = random.Random(4)
    same = "<p>" + "é" * 600 + "\r\n\r\nWARC/1.1\r\n</p>"
    rows = [(i, f"https://h{rng.randrange(9)}.Example.org/p/{rng.randrange(40)}?q={i % 3}",
             same if i % 3 == 0 else "short" if i % 3 == 1 else f"page {i} " * rng.randrange(300)) for i in range(400)]
    return rows + [(None, "http://x.com/", same), (7, None, None), (8, "no scheme", ""), (398, "http://x.com/a b\r\nc", same),
                   (399, "http://x.com/", same), (399, "http://x.com/", same), (None, None, "z" * 2000), (5, "", "w" * 999),
                   (6, "://", "w" * 999), (500, "http://a.org/long", "long " * 400_000)]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    folder = f"file://{tmp_path_factory.mktemp('warc')}"
    df = spark.createDataFrame(pages(), "page_id bigint, url string, html string").repartition(5)
    captures = warc.write(df, f"{folder}/archive", archive=20_000)
    return folder, df, captures, warc.index(captures, f"{folder}/index", lines=16, files=3)


def test_round_trip(spark):
    rows = pages()
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "page_id bigint, url string, html string, key string, id int")
    got = warc.round_trip(df.repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_version(rows)


def test_archives_are_gzip_members_of_whole_records(written):
    folder, df, captures, _ = written
    fs, root = pafs.FileSystem.from_uri(f"{folder}/archive")
    names = {r.path for r in captures.collect()}
    assert len(names) > 5 and names == set(os.listdir(root))
    records = b"".join(gzip.decompress(open(f"{root}/{n}", "rb").read()) for n in names)
    assert records.count(b"WARC/1.1\r\nWARC-Type: ") == df.count()


def test_lookups_equal_a_scan(spark, written):
    folder, _, captures, parts = written
    assert parts.agg(F.sum("n")).collect()[0][0] == captures.count()
    keys = [(k,) for k in ("org,example,h1)/p/3?q=0", "com,x)/", "", "absent", "org,example,h1)/p/3", "zz)")]
    wanted = spark.createDataFrame(keys + keys, "key string")
    got = warc.lookup(wanted, parts, f"{folder}/index", by_id=False)
    scan = captures.join(wanted.distinct(), "key")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, scan.select(*got.columns).collect()))
    pairs = spark.createDataFrame([("com,x)/", 399), ("com,x)/", None), ("com,x)/", 4), ("", 7)], "key string, id bigint")
    got = warc.lookup(pairs, parts, f"{folder}/index").groupBy("key", "id").count().collect()
    assert sorted(map(tuple, got), key=repr) == [("", 7, 1), ("com,x)/", 399, 2), ("com,x)/", None, 1)]


def test_a_hot_url_spans_files_and_blocks(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("http://hot.example.com/").alias("url"),
                                  F.lit("x").alias("html"))
    captures = warc.write(df, f"file://{tmp_path}/a")
    parts = warc.index(captures, f"file://{tmp_path}/i", lines=50, files=4)
    assert parts.count() == 4
    wanted = df.select(warc.url_key(F.col("url")).alias("key")).distinct()
    assert warc.lookup(wanted, parts, f"file://{tmp_path}/i", by_id=False).distinct().count() == 3000


def test_a_changed_payload_is_an_error(spark):
    data = warc.record(1, "http://a/", b"abc", hashlib.sha1(b"abc").hexdigest(), 3, False, "2000-01-01T00:00:00Z")
    assert warc.parsed(data)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parsed(data[:-1])


def test_an_empty_table(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.round_trip(empty).count() == 0


def test_keys(spark):
    urls = ["https://a.Example.org/x?y#z", "http://a.b", None, "no scheme", "http://H/é", "://"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [r[0] for r in df.select(warc.url_key(F.col("url"))).collect()]
    assert got == ["org,example,a)/x?y#z", "b,a)", "", ")no scheme", "h)/é", ")"]
