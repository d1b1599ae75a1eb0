"""Secrets: all kinds against plain regular expressions, rule versions on one ledger, very many findings."""

import random
import re
import time

from pyspark.sql import functions as F

from arealens.llm import secret_scan as ss

# (kind, pattern, least length of the checked group, group), for Python's re; possessive runs as greedy ones
PLAIN = [("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 1),
         ("access", r"AKIA[A-Z0-9]{16,}", 1, 0), ("hex", r"[0-9a-f]{24,}", 1, 0), ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 1, 0),
         ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 1, 0),
         ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 1, 0),
         ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 0)]
BITS = ["password=", "API_KEY: '", "token\" = \"", "abcdef", "AKIA", "A" * 16, "0" * 24, "ghp_", "k" * 36, "xoxb-", "1-2" * 5,
        "eyJ" + "a" * 8, ".", "b" * 9, "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN ", "PRIVATE KEY-----", " ", "\n", "é😀", "="]


def plain_version(text):
    out = []
    for rank, (kind, pattern, least, group) in enumerate(PLAIN):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
    return sorted(out)


def plain_redaction(text, found):
    out, at = [], 0
    for start, _, kind, end in found:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def texts():
    rng = random.Random(6)
    out = ["".join(rng.choice(BITS) for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    many = "".join(rng.choice(BITS) for _ in range(9000))
    return [*out, many, "", None]


def test_all_kinds_and_redaction_equal_the_plain_version(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    joined = df.join(ss.scan(df), "doc_id").withColumn("clean", ss.redact(F.col("text"), F.col("findings")))
    got = {r.doc_id: r for r in joined.collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        want = plain_version(text)
        assert [tuple(x) for x in got[i].findings] == want, text
        assert got[i].clean == (plain_redaction(text, want) if text is not None else None)
    assert {k for i, t in rows for _, _, k, _ in plain_version(t)} == {k for k, *_ in PLAIN}


def test_an_upgraded_rule_on_an_old_ledger(spark, tmp_path):
    df = spark.createDataFrame([(1, "kkkkk and " + "k" * 60)], "doc_id bigint, text string")
    old, new = ss.Rule("k", "k{5}"), ss.Rule("k", "k{50}", version=2)
    ledger = str(tmp_path / "ledger")

    def spans(*rules):
        return [(x.kind, x.start, x.end) for x in ss.scan(df, rules=rules, ledger=ledger).collect()[0].findings]

    fives = [("k", 0, 5)] + [("k", 10 + 5 * i, 15 + 5 * i) for i in range(12)]
    assert spans(old) == fives
    assert spans(new) == [("k", 10, 60)]
    assert spans(old) == fives and spans(new) == [("k", 10, 60)]      # nothing is scanned again
    assert spark.read.parquet(ledger).count() == 2
    assert sorted(spans(old, new)) == sorted([*fives, ("k", 10, 60)])


def test_a_ledger_of_the_earlier_format_is_scanned_again(spark, tmp_path):
    df = spark.createDataFrame([(1, "password=abcdef1")], "doc_id bigint, text string")
    address = df.select(ss.address(F.col("text"))).collect()[0][0]
    spark.createDataFrame([(address, [r.key for r in ss.RULES], [(0, 0, "assign", 16)])], "blob string, rules array<string>, "
                          f"findings array<{ss.FINDING}>").write.parquet(str(tmp_path / "l"))
    assert len(ss.scan(df, ledger=str(tmp_path / "l")).collect()[0].findings) == 1


def test_what_two_runs_found_counts_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "password=abcdef1 " + "0" * 24)], "doc_id bigint, text string")
    ss.scan(df, ledger=str(tmp_path / "l")).count()
    spark.read.parquet(str(tmp_path / "l")).cache().write.mode("append").parquet(str(tmp_path / "l"))
    assert len(ss.scan(df, ledger=str(tmp_path / "l")).collect()[0].findings) == 2


def test_very_many_findings_take_linear_time(spark):
    n = 32_000
    text = " ".join(f"{i:024x}" for i in range(n))
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string").cache()
    df.count()
    began = time.time()
    found = ss.scan(df).select(F.size("findings"), F.sha2(ss.spans(F.col("findings")), 256)).collect()[0][0]
    clean = df.join(ss.scan(df), "doc_id").select(F.length(ss.redact(F.col("text"), F.col("findings")))).collect()[0][0]
    assert found == n and clean == 6 * n - 1
    assert time.time() - began < 20      # two scans and a redaction
