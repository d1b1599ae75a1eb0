"""The registered query of each operator, and its DuckDB SQL where SQL can express it.

Every query applies its operator with production parameters to the whole
table and derives the digest columns from the operator's own results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import (ann, bpe, chat, embed_dedup, fim, license_scan, minhash, packing, prefix_trie, secret_scan, toxicity,
               url_filter, warc)
from .base import is_held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/"))


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def toxicity_model(docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    """Fitted on the labelled documents that are not held out."""
    labels = read_table(docs.sparkSession, sf_dir, "labels").where(~is_held_out(F.col("doc_id")))
    return toxicity.fit(docs, labels)


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    scored = toxicity.score(docs, toxicity_model(docs, sf_dir))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "places")


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    base = F.filter("matches", lambda m: m["base"] & m["exact"])
    first = F.transform("b", lambda m: m["start"])

    def joined(c):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda m: m["label"]))), ",")

    return found.withColumn("b", base).select(
        "doc_id", "n_words", F.size("b").cast("bigint").alias("n_base"), F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"), joined("b").alias("base_labels"), joined("matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)).alias("score"))


@query
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return minhash.near_duplicates(docs, shingle=2, percent=80)


@query
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"), threshold=0.93)


@query
def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), keep_ids=False)


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    kinds = [r.kind for r in secret_scan.BASE_RULES]

    def count(kind):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in kinds],
                        F.sha2(secret_scan.spans(F.col("findings"), kinds), 256).alias("base_sha256"),
                        secret_scan.spans(F.col("findings")).alias("spans"))


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return bpe.decode(encoded).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


CHAT_SCHEMAS = {"reply": {"type": "object", "required": ["text", "turn"], "additionalProperties": False, "properties": {
    "text": {"type": "string", "minLength": 1, "maxLength": 400}, "turn": {"type": "integer", "minimum": 0}}}}


def as_tool_messages(turns: DataFrame) -> DataFrame:
    """Conversations as tool traffic: an assistant turn calls ``reply`` with its text, and needs the result of
    the call two turns before it; the user turn that follows a call is its result."""
    call = F.struct(F.concat(F.lit("call_"), F.col("turn")).alias("id"), F.lit("reply").alias("name"),
                    F.to_json(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("arguments"),
                    F.array(F.concat(F.lit("call_"), F.col("turn") - 2)).alias("after"))
    return turns.select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"),
                        F.when(F.col("role") == "assistant", F.array(call)).alias("calls"),
                        F.when((F.col("role") == "user") & (F.col("turn") > 0),
                               F.concat(F.lit("call_"), F.col("turn") - 1)).alias("result_of"))


@query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    linked = chat.link(as_tool_messages(turns), CHAT_SCHEMAS)
    return linked.select("conv_id", "turn", "call_id", "name", F.col("level").cast("bigint").alias("level"),
                         "result_turn", "status", "valid", F.md5("json").alias("json_md5"))


@query
def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.rebuilt_trie(read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        "ends_sha256")


@query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py, one after another."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline

ORACLES["op2_license_scan"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_transform(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x) AS w FROM documents),
t(label, base, phrase) AS (VALUES
  ('mit', true, ['under','the','mit','license']), ('apache-2', true, ['apache','license','version','2']),
  ('cc-by-nc', true, ['cc','by','nc']), ('gpl', false, ['gnu','general','public','license']),
  ('lgpl', false, ['gnu','lesser','general','public','license']),
  ('agpl', false, ['gnu','affero','general','public','license']),
  ('mpl-2', false, ['mozilla','public','license','version','2']),
  ('mit', false, string_split('permission is hereby granted free of charge to any person obtaining a copy of this software', ' ')),
  ('bsd', false, string_split('redistribution and use in source and binary forms with or without modification are permitted', ' ')),
  ('cc-by', false, ['creative','commons','attribution']),
  ('apache-2', false, string_split('licensed under the apache license version 2 0 the license you may not use this file except', ' '))),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM d),
near AS (SELECT DISTINCT w.r, t.label, t.base, t.phrase, w.pos - k.k AS s FROM words w JOIN t ON list_contains(t.phrase, w.word)
  AND w.word NOT IN ('the', 'is', 'of', 'to', 'a', 'and', 'in', 'by', 'with', 'or', 'are', 'this', 'under'),
  LATERAL (SELECT unnest(range(len(t.phrase))) AS k) k WHERE w.pos >= k.k),
blocks AS (SELECT n.*, list_slice(d.w, n.s + 1, n.s + len(n.phrase)) AS b FROM near n JOIN d USING (r)),
hits AS (SELECT r, label, base, s, b = phrase AS exact,
    len(list_intersect(list_distinct(phrase), b)) / len(list_distinct(phrase)) AS c FROM blocks
  WHERE len(list_intersect(list_distinct(phrase), b)) >= ceil(0.85 * len(list_distinct(phrase)) - 1e-9)),
got AS (SELECT r, count(*) FILTER (base AND exact) AS n_base, min(s) FILTER (base AND exact) AS first_word,
  max(s) FILTER (base AND exact) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND exact) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(c) AS score FROM hits GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN got USING (r)
"""

ORACLES["op3_minhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS sh FROM w),
x AS (SELECT doc_id, unnest(sh) AS g, len(sh) AS n FROM s),
f AS (SELECT g, count(*) AS df FROM x GROUP BY g),
o AS (SELECT doc_id, n, g, row_number() OVER (PARTITION BY doc_id ORDER BY df, g) AS p FROM x JOIN f USING (g)),
pre AS (SELECT doc_id, n, g FROM o WHERE p <= n - ceil(0.8 * n - 1e-9) + 1),
c AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM pre a JOIN pre b USING (g)
  WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
links AS (SELECT c.a, c.b FROM c JOIN s p ON p.doc_id = c.a JOIN s q ON q.doc_id = c.b
  WHERE 180 * len(list_intersect(p.sh, q.sh)) >= 80 * (len(p.sh) + len(q.sh))),
e AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM s UNION SELECT r.doc_id, e.b FROM reach r JOIN e ON e.a = r.other)
SELECT s.doc_id, len(any_value(s.sh))::BIGINT AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id
"""

ORACLES["op4_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT vec_id, vec_id AS other FROM v UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT r.vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(r.other)::BIGINT AS component_id,
  r.vec_id = min(r.other) AS kept
FROM reach r LEFT JOIN n ON n.a = r.vec_id GROUP BY r.vec_id
"""

ORACLES["op7_url_filter"] = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS x FROM pages),
p AS (SELECT page_id, translate(regexp_extract(x, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(x, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(verdict, h, t) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))
SELECT page_id, host, path, max_by(h || t, length(h || t)) AS rule,
  coalesce(max_by(verdict, length(h || t)), 'allow') AS verdict
FROM p LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, t) GROUP BY page_id, host, path
"""

ORACLES["op10_chat"] = r"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
calls AS (SELECT * FROM m WHERE role = 'assistant'),
lv AS (SELECT c.conv_id, c.turn, 0 AS level FROM calls c
    WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
  UNION ALL SELECT c.conv_id, c.turn, lv.level + 1 FROM lv JOIN calls c ON c.conv_id = lv.conv_id AND c.turn = lv.turn + 2),
res AS (SELECT * FROM m WHERE role = 'user' AND turn > 0)
SELECT conv_id, turn, call_id, name, level::BIGINT AS level, result_turn, status, valid, md5(js) AS json_md5 FROM (
  SELECT c.conv_id, c.turn, 'call_' || c.turn AS call_id, 'reply' AS name, lv.level, r.turn AS result_turn,
    CASE WHEN r.turn IS NULL THEN 'open' ELSE 'linked' END AS status, length(c.text) BETWEEN 1 AND 400 AS valid,
    '{"call":{"arguments":{"text":' || to_json(c.text)::VARCHAR || ',"turn":' || c.turn
      || '},"name":"reply"},"id":"call_' || c.turn || '","result":'
      || CASE WHEN r.turn IS NULL THEN 'null' ELSE to_json(r.text)::VARCHAR END || '}' AS js
  FROM calls c JOIN lv USING (conv_id, turn) LEFT JOIN res r ON r.conv_id = c.conv_id AND r.turn = c.turn + 1
  UNION ALL
  SELECT r.conv_id, r.turn, 'call_' || (r.turn - 1), NULL, NULL, r.turn, 'orphan', NULL,
    '{"call":null,"id":"call_' || (r.turn - 1) || '","result":' || to_json(r.text)::VARCHAR || '}'
  FROM res r WHERE NOT EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = r.conv_id AND c.turn = r.turn - 1))
"""

ORACLES["op11_fim"] = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS u,
    [CAST('0x' || substr(s, 1, 8) AS BIGINT), CAST('0x' || substr(s, 9, 8) AS BIGINT),
     CAST('0x' || substr(s, 17, 8) AS BIGINT), CAST('0x' || substr(s, 25, 8) AS BIGINT)] AS h FROM t),
c AS (SELECT *, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
    greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b FROM u),
p AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
    array_to_string(u[b + 1:], '') AS s3,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100
      THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s3 || '<M>' || m
    ELSE '<S>' || s3 || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""

ORACLES["op12_prefix_trie"] = r"""
WITH o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i,
    length(role) || ':' || role || text AS item, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    WHERE conv_id IS NOT NULL)),
n AS (SELECT conv_id, count(*) AS own, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(conv_id::VARCHAR) + 1),
      lambda k: [ascii(substr(conv_id::VARCHAR, k::INT, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1)))) % 4 AS h FROM o GROUP BY conv_id),
c AS (SELECT n.conv_id, n.base, n.h, least(n.h, coalesce(b.own, 0)) AS k FROM n LEFT JOIN n b ON b.conv_id = n.base),
r AS (SELECT c.conv_id, o.i AS p, o.item, o.words FROM c JOIN o ON o.conv_id = c.base AND o.i < c.k
  UNION ALL SELECT c.conv_id, o.i - c.h + c.k, o.item, o.words FROM c JOIN o ON o.conv_id = c.conv_id AND o.i >= c.h),
q AS (SELECT c.conv_id, coalesce(list(r.item ORDER BY r.p) FILTER (r.p IS NOT NULL), []) AS items,
    coalesce(list(r.words ORDER BY r.p) FILTER (r.p IS NOT NULL), []) AS words FROM c LEFT JOIN r USING (conv_id)
  GROUP BY c.conv_id),
m AS (SELECT conv_id, d, items[1:d] AS key, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, d = len(items) AS ends
  FROM (SELECT *, unnest(range(0, len(items) + 1)) AS d FROM q)),
g AS (SELECT key, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ends FROM m GROUP BY key),
k AS (SELECT key[1:d - 1] AS key, count(*) AS n FROM g WHERE d > 0 GROUP BY 1),
f AS (SELECT g.*, coalesce(k.n, 0) AS n_children FROM g LEFT JOIN k USING (key)),
s AS (SELECT key[1:a] AS key, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * words) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM f) GROUP BY 1)
SELECT f.conv_id, f.d::BIGINT AS depth, up.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs,
  f.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
  sha256(f.ends) AS ends_sha256
FROM f JOIN s USING (key) LEFT JOIN g up ON f.d > 0 AND up.key = f.key[1:f.d - 1]
"""

ORACLES["op13_warc"] = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha1(coalesce(html, '')) AS s FROM pages),
g AS (SELECT s, n, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY s, n)
SELECT page_id, n AS payload_bytes, s AS payload_digest,
  CASE WHEN first <> page_id OR (page_id IS NULL AND first IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id OR (page_id IS NULL AND first IS NOT NULL) THEN first END AS refers_to
FROM p LEFT JOIN g USING (s, n)
"""
