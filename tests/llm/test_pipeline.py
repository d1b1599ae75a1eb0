"""The pipeline's stages on a small corpus with planted cases, and the queries' SQL on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = [], []
    for i in range(300):
        words = " ".join(f"w{(i * 31 + j * 7) % 997}x{j}" for j in range(40))
        toxic = int(i % 6 == 0)
        rows.append((i, words + (" vile creature" if toxic else " fine day"), "en", "s", 0))
        labels.append((i, 1, toxic))
    rows += [(1000, rows[1][1], "en", "s", 0), (1001, rows[1][1] + " extra", "en", "s", 0), (1001, rows[1][1] + " extra", "en", "s", 0),
             (1002, "my password=abcdef123 is here with other words around it", "en", "s", 9), (1003, None, "en", "s", None),
             (None, "null id row", "en", "s", 3)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, corpus)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in clean.collect()} == {i for i in range(300) if i % 6 == 0}
    kept = corpus_pipeline.drop_near_duplicates(spark, clean, corpus)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        str(r["doc_id"]) for r in clean.collect() if r["doc_id"] not in (1000, 1001))
    safe = corpus_pipeline.redact_secrets(spark, kept, corpus)
    row = safe.where("doc_id = 1002").collect()[0]
    assert safe.columns == docs.columns and safe.count() == kept.count()
    assert row["text"] == "my [assign] is here with other words around it" and row["n_chars"] == len(row["text"])
    packed = corpus_pipeline.pack_sequences(spark, safe, corpus)
    assert packed.select("doc_id").distinct().count() == safe.select("doc_id").distinct().count()


def test_rows_of_one_id_with_unlike_texts_stay(spark):
    text = lambda i: " ".join(f"t{i}w{j}" for j in range(30))
    rows = [(5, text("a"), 1), (5, text("b"), 2), (9, text("b"), 3), (7, text("c"), 5), (7, text("c"), 4), (8, text("c"), 6),
            (6, None, 8), (6, " ", 7), (None, text("a"), 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    rest = sorted((tuple(r) for r in got.collect() if r["doc_id"] is not None and r["doc_id"] != 6))
    assert rest == sorted([(5, text("a"), 1), (5, text("b"), 2), (7, text("c"), 4)])
    assert got.where("doc_id = 6").count() == 1 and got.where("doc_id IS NULL").count() == 1


def test_run_equals_its_stages(spark, corpus):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "secrets", "packing"]
    out = corpus_pipeline.run(spark, corpus)
    per_doc = out.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert all(r["n"] == r["t"] for r in per_doc) and 1002 in {r["doc_id"] for r in per_doc}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", ["op2_license_scan", "op4_embedding_dedup", "op7_url_filter", "op10_chat"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from arealens.llm.queries import ORACLES, QUERIES
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLES[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(map(str, res.fetchall()))
    assert sorted(str(tuple(r)) for r in df.select(*cols).collect()) == want


def test_an_empty_corpus_and_clashing_columns(spark, corpus):
    more = "document string, same_text string, component_id bigint, salt int, id string, blob string, found int, _id int, _text int"
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    names = [c.split()[0] for c in more.split(", ")]
    odd = docs.withColumns({n: F.lit(7).cast(t.split()[1]) for n, t in zip(names, more.split(", "))})
    for start in (docs.limit(0), odd):
        now, plain = start, docs.limit(0) if start is not odd else docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now, plain = stage(spark, now, corpus), stage(spark, plain, corpus)
            assert now.columns == start.columns, name
            assert sorted(map(repr, now.select(*docs.columns).collect())) == sorted(map(repr, plain.collect())), name
        if start is odd:
            assert now.select(*names).distinct().collect() == odd.select(*names).distinct().collect()
    assert corpus_pipeline.pack_sequences(spark, docs.limit(0), corpus).count() == 0
