"""Text operators against brute force, and their edge cases."""

import json
import re
import zlib
from collections import defaultdict
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from arealens.llm import bpe, license_scan, packing, secret_scan, toxicity, url_filter
from arealens.llm.base import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def reference():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


TEXTS = ["", " ", "Hello, world!", "it's  two  spaces\n\n and\ttabs ", "naïve café 漢字 🙂", "1234 56.78 don't",
         "<|endoftext|> in the <|endoftext|>text", "x" * 300, "\x1c\x85 a\u2003b", " lead and trail "]


# ---- toxicity ------------------------------------------------------------------------------

def test_folding_meets_obfuscated_spellings():
    assert toxicity.fold("M0r\u200bоn") == toxicity.fold("moron")
    model = toxicity.ToxicityModel({toxicity.fold("trash"): 3.0, toxicity.fold("moron"): 2.0}, bias=-3.0, coef=(4.0, 1.0))
    assert model.features("tr@sh, MORON; trashes")[:2] == (5.0, 2)
    assert model.features("the trash can")[1] == 0                     # exception phrase
    assert model.features(None) == (0.0, 0, 0) and model.features("")[1] == 0


def test_fit_learns_words_and_keeps_clean_documents(spark):
    rows = [(i, f"plain words number w{i} here " + ("you vile creature" if i % 5 == 0 else "a nice day"), int(i % 5 == 0))
            for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"), min_z=4.0)
    got = toxicity.score(docs, model).collect()
    assert all((r["score"] >= 0.5) == bool(r["toxic"]) for r in got) and toxicity.fold("vile") in model.lexicon
    empty = toxicity.fit(docs, docs.select("doc_id", "toxic").where("toxic = 0"))
    assert not empty.lexicon and max(r["score"] for r in toxicity.score(docs, empty).collect()) < 0.5


def _features_brute(text, lexicon, exceptions):
    """Every lexicon term looked for at every position."""
    folded = toxicity.fold(text)
    best = {}
    for at in range(len(folded)):
        weights = [w for t, w in lexicon.items() if folded.startswith(t, at) and w > 0]
        if weights:
            best[at] = max(weights)
    for phrase in map(toxicity.fold, exceptions):
        for at in range(len(folded)):
            if phrase not in lexicon and folded.startswith(phrase, at):
                best = {s: w for s, w in best.items() if not at <= s < at + len(phrase) - 1}
    return sum(best.values()), len(best), len(folded.split())


def test_matches_equal_a_plain_search():
    import random
    rng = random.Random(3)
    words = ["trash", "tr@5h", "can", "class", "clown", "clowning", "m0r\u200bon", "idiot", "id", "fish", "a", "ТRASH", "b1n", "-"]
    lexicon = {" trash ": 1.5, " tras": 0.7, " clow": 2.0, " clown ": 1.0, " ldlot ": 3.0, " can ": -1.0, " trash can ": 9.0}
    for terms in (lexicon, {k: v for k, v in lexicon.items() if k != " trash can "}, {" a ": 0.25}, {}):
        model = toxicity.ToxicityModel({toxicity.fold(k.strip()) if k.endswith(" ") else k: v for k, v in terms.items()})
        for _ in range(400):
            text = rng.choice([" ", "  ", ", "]).join(rng.choice(words) for _ in range(rng.randrange(30)))
            got, want = model.features(text), _features_brute(text, model.lexicon, model.exceptions)
            assert got[1:] == want[1:] or not model.lexicon
            assert abs(got[0] - want[0]) < 1e-9


def test_a_labelled_id_that_repeats_is_one_row(spark):
    rows = [(i, f"plain words w{i} " + ("vile creature" if i % 5 == 0 else "nice day")) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)], "doc_id bigint, toxic int")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    copies = docs.unionByName(docs.where("doc_id = 5").withColumn("text", F.explode(F.array(*[F.lit(f"z copy {j}") for j in range(50)]))))
    assert toxicity.fit(copies, labels, min_z=4.0) == toxicity.fit(docs, labels, min_z=4.0)


def test_toxicity_edges(nasty, nothing):
    model = toxicity.ToxicityModel({" word ": 1.0})
    out = toxicity.score(nasty, model)
    assert out.columns == [*nasty.columns, "_score", "_places"] and out.count() == nasty.count()
    assert toxicity.score(nothing, model).count() == 0


# ---- license scans -------------------------------------------------------------------------

def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _license_brute(text, threshold=license_scan.THRESHOLD):
    w, out = _words(text), set()
    for base, group in ((True, license_scan.BASE), (False, license_scan.MORE)):
        for label, phrase in group:
            p = license_scan.tokens(phrase)
            for s in range(len(w)):
                block = w[s:s + len(p)]
                if len(set(block) & set(p)) >= threshold * len(set(p)) - 1e-9:
                    out.add((s, s + len(block), label, base, block == p))
    return out


def test_license_scan_equals_brute_force(spark):
    texts = ["Released under the MIT License.", "license mit the under", "CC-BY-NC 4.0, cc by nc cc by nc", None, "",
             "under the the MIT License", "Apache License, Version 2.0; apache license version 2",
             "GNU Lesser General Public License vs GNU General Public License", "mit mit license under the",
             "Permission is granted free of charge to any person obtaining a copy of this software",
             "\u212aelvin under the mit license", "under the mit"]
    docs = spark.createDataFrame([(i % 9, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = license_scan.scan(docs).collect()
    flat = lambda ms: {(m["start"], m["end"], m["label"], m["base"], m["exact"]) for m in ms}
    a = sorted((r["doc_id"], r["n_words"], sorted(flat(r["matches"]))) for r in got)
    b = sorted((i % 9, len(_words(t)), sorted(_license_brute(t))) for i, t in enumerate(texts))
    assert a == b and all(len(r["matches"]) == len(flat(r["matches"])) for r in got)


def test_license_edges(nasty, nothing):
    assert license_scan.scan(nasty).count() == nasty.count()
    assert license_scan.scan(nothing).count() == 0


# ---- URLs ----------------------------------------------------------------------------------

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"), ("block", "a.b.com/"), ("allow", "a.b.com/x")]


def _url_brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for verdict, rule in RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(h.split(".")), len(p), rule, verdict))
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_urls_equal_brute_force(spark, nasty):
    urls = [None, "", "no scheme", "http://", "http://ORG/", "http://org", "https://m.Example.org/es/1?q#f", "x://example.org/es",
            "http://example.org/en/12345", "http://example.org/en/2", "http://b.com/fr/x", "http://a.b.com/xy", "http://a.b.com/",
            "http://com/de/", "http://xexample.org/es/", "http://h?x://org/", "a://b://org/", "http://example.org//es/"]
    df = spark.createDataFrame(list(enumerate(urls)) + [(0, "http://org/")], "page_id bigint, url string").withColumn("host", F.lit(1))
    out = url_filter.judge(df, RULES)
    assert out.columns == ["page_id", "url", "host", "_host", "path", "rule", "verdict"]
    for r in out.collect():
        assert (r["_host"], r["path"], r["rule"], r["verdict"]) == _url_brute(r["url"]), r["url"]
    assert url_filter.judge(df.limit(0), []).count() == 0


def test_the_longest_rule_wins_over_the_longer_host():
    trie = url_filter.build([("block", "org/abcdefghijkl"), ("allow", "x.org/abc"), ("block", "y.x.org/"), ("allow", "org/abcde")])
    assert url_filter.match(trie, "y.x.org", "/abcdefghijkl") == ("block", "org/abcdefghijkl")
    assert url_filter.match(trie, "y.x.org", "/abcde") == ("allow", "x.org/abc")       # nine characters as org/abcde
    assert url_filter.match(trie, "z.org", "/abcde/" + "f" * 100_000) == ("allow", "org/abcde")


# ---- secrets -------------------------------------------------------------------------------

def _secret_brute(text):
    out = []
    for i, (kind, pattern, group, least) in enumerate((
            ("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
            ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))):
        flags = re.I | re.A if kind == "assign" else 0
        for m in re.finditer(pattern, text or "", flags):
            if len(m.group(group)) >= least:
                out.append((m.start(), i, kind, m.end()))
    return sorted(out)


SECRETS = ["", None, "🙂 password=abcdef1 x", "secret: token: abcdef12", "AKIA" + "A" * 16 + " AKIAX", "0" * 24, "f" * 23,
           "API_KEY = 'zzzzzzzzzz' apikey:" + "ab" * 20, "Password=\"AKIA" + "B" * 18 + "\" tail", "token=abcde"]


def test_secrets_equal_brute_force(spark, nasty, nothing):
    df = spark.createDataFrame([(i % 4, t) for i, t in enumerate(SECRETS * 2)], "doc_id bigint, text string")
    got = secret_scan.scan(df, rules=secret_scan.BASE_RULES).collect()
    a = sorted((r["doc_id"], [tuple(x) for x in r["findings"]]) for r in got)
    assert a == sorted((i % 4, _secret_brute(t)) for i, t in enumerate(SECRETS * 2))
    assert secret_scan.scan(nasty).count() == nasty.count() and secret_scan.scan(nothing).count() == 0


def test_ledger_scans_only_unseen_blobs_and_rules(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    one = spark.createDataFrame([(1, "password=abcdef1"), (2, "plain")], "doc_id bigint, text string")
    rules = secret_scan.BASE_RULES
    secret_scan.scan(one, rules=rules, ledger=ledger).count()
    assert spark.read.parquet(ledger).count() == 2
    two = one.unionByName(spark.createDataFrame([(3, "plain"), (4, "password=abcdef1"), (5, "0" * 30)], one.schema))
    got = {r["doc_id"]: len(r["findings"]) for r in secret_scan.scan(two, rules=rules, ledger=ledger).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 1, 5: 1} and spark.read.parquet(ledger).count() == 3
    newer = (*rules, secret_scan.Rule("plain", "plain"))
    got = {r["doc_id"]: len(r["findings"]) for r in secret_scan.scan(two, rules=newer, ledger=ledger).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1}
    last = spark.read.parquet(ledger).where("array_contains(rules, 'plain@1')")
    assert last.count() == 3 and last.where("size(rules) > 1").count() == 0


def test_redaction(spark):
    df = spark.createDataFrame([(1, "a password=abcdef1 b")], "doc_id bigint, text string")
    x = df.join(secret_scan.scan(df), "doc_id").select(secret_scan.redact(F.col("text"), F.col("findings")).alias("t"))
    assert x.collect()[0]["t"] == "a [assign] b"


# ---- BPE and packing -----------------------------------------------------------------------

def test_bpe_equals_the_tokenizers_library(spark, reference):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None])], "doc_id bigint, text string")
    got = bpe.decode(bpe.encode(df)).collect()
    for r in got:
        text = ([*TEXTS, None])[r["doc_id"]] or ""
        assert r["ids"] == reference.encode(text, add_special_tokens=False).ids, text
        assert r["decoded"] == reference.decode(r["ids"], skip_special_tokens=False)


def test_bpe_edges(nasty, nothing):
    out = bpe.encode(nasty)
    assert out.columns == [c for c in nasty.columns if c != "text"] + ["ids"] and out.count() == nasty.count()
    assert bpe.decode(bpe.encode(nothing)).count() == 0


def test_packing_holds_every_id_once_without_padding(spark, reference, nasty, nothing):
    rows = [(i, ("word " * (i * 37 % 900) + f"end{i}")) for i in range(120)] + [(500, None), (501, "y " * 5000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3, "doc_id")
    got = packing.pack(df).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        docs[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
        raw = b"".join(i.to_bytes(4, "little") for i in r["ids"])
        assert zlib.crc32(raw) == r["ids_crc32"] and len(r["ids"]) == r["length"]
    for i, text in rows:
        pieces = sorted(docs[i], key=lambda r: r["start"])
        ids = reference.encode(text or "", add_special_tokens=False).ids + [0]
        assert [x for p in pieces for x in p["ids"]] == ids and {p["doc_tokens"] for p in pieces} == {len(ids)}
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r["offset"])
        total = 0
        for p in pieces:
            assert p["offset"] == total
            total += p["length"]
        assert total <= 1024 and total & (total - 1) == 0
    assert packing.pack(nothing).count() == 0
    assert packing.pack(nasty).select("doc_id").distinct().count() == 7


def _packed(lengths, tiers):
    packer = packing.Packer(tiers)
    for i, n in enumerate(lengths):
        packer.add(i, i.to_bytes(4, "little") * n)
    sequences, groups = defaultdict(list), defaultdict(set)
    for key, start, n, _, _, sequence, _, tier, group in packer.drain(last=True):
        sequences[sequence].append((key, start, n, tier))
        groups[tier, group].add(sequence)
    return list(sequences.values()), groups


def test_packing_takes_a_file_whose_merges_are_out_of_id_order():
    with open(tokenizer_path(), encoding="utf-8") as f:
        spec = json.load(f)
    vocab, fixed = spec["model"]["vocab"], {t["id"] for t in spec["added_tokens"]}
    ids = sorted(i for i in vocab.values() if i not in fixed)
    swapped = dict(zip(ids, reversed(ids)))
    spec["model"]["vocab"] = {t: swapped.get(i, i) for t, i in vocab.items()}
    text = json.dumps(spec)
    assert packing.fast_words(text) is None
    encoder = packing.encoder_of(SimpleNamespace(value=text))
    library = tokenizers.Tokenizer.from_str(text)
    for t in TEXTS:
        want = library.encode(t, add_special_tokens=False).ids
        assert encoder.encode(t) == b"".join(i.to_bytes(4, "little") for i in want), t


def test_packing_tiers_pack_their_own_windows():
    lengths = [(i * 37) % 100 + 1 for i in range(600)] + [(i * 53) % 300 + 1 for i in range(200)] + [900] * 20
    sequences, groups = _packed(lengths, (1024, 512, 256, 128))
    tier_of = lambda n: next(t for t in (128, 256, 512, 1024) if n <= t)
    sizes = defaultdict(list)
    for pieces in sequences:
        sizes[pieces[0][3]].append(sum(n for _, _, n, _ in pieces))
        assert all(tier_of(n) <= tier for _, _, n, tier in pieces)
    assert sum(map(sum, sizes.values())) == sum(lengths)
    assert all(sum(x != tier for x in got) <= 9 for tier, got in sizes.items())      # one leftover of the task
    assert all(len(sizes[tier]) >= 10 for tier in (128, 512, 1024))
    assert sorted(map(sorted, sequences)) != sorted(map(sorted, _packed(lengths, (1024, 256))[0]))


def test_packing_groups_are_full_and_balanced():
    lengths = [1024 * (1 + i % 3) + 5 + i % 200 for i in range(1000)]
    sequences, groups = _packed(lengths, (1024, 512, 256, 128))
    by_tier = defaultdict(list)
    for (tier, _), members in groups.items():
        by_tier[tier].append(len(members))
    for counts in by_tier.values():
        assert max(counts) <= 8 and sum(c != 8 for c in counts) <= 1
    assert len({g for _, g in groups}) == len(groups)      # no group holds two tiers
