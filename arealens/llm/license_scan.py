"""License scans as an exact set-similarity join of text blocks and templates.

A template is a phrase; a block is any run of as many words as the phrase
has.  A block meets a template if it holds at least ``threshold`` of the
template's distinct words (containment).  Words are ordered by their
frequency in the whole corpus, rarest first.  A block that meets a template
of n words at an overlap of o must hold one of its n - o + 1 rarest, so only
blocks around such words are looked at (prefix filter); blocks cut off by a
text's end below o words fall to the length filter; and of the occurrences
in one block only the first of the rarest shared word counts, which must
leave room for o shared words (positional filter) and names each block once.
The candidates are joined with the templates on the word and confirmed.

Only the template words are counted and ordered, since no other word can be
shared.  One row of counts for each of them reaches the driver.

Defined cases: a null or empty text has no words and no labels, and score 0;
repeated rows and null ids each give their own row; without templates nothing
is labelled.  Only built-in functions are used.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import ascii_lower

# The three phrases callers rely on, and their labels.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
MORE = (
    ("gpl", "gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2", "mozilla public license version 2"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "creative commons attribution"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except"),
)
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
THRESHOLD = 0.85


def tokens(phrase: str) -> list[str]:
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(WORD, phrase)]


def _plain(word):
    """A-Z lowered (the words kept here are compared with ASCII or equal words only)."""
    return ascii_lower(word)


def prefixes(templates, counts: dict[str, int], threshold: float) -> list[tuple]:
    """(word, label, phrase words, overlap needed, order of the word, base flag) for every prefix word."""
    out = []
    for base, label, phrase in templates:
        words = tokens(phrase)
        ordered = sorted(set(words), key=lambda w: (counts.get(w, 0), w))
        need = math.ceil(threshold * len(ordered) - 1e-9)
        for k, w in enumerate(ordered[:len(ordered) - need + 1]):
            out.append((w, label, words, ordered, need, k, base))
    return out


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", base=BASE, more=MORE,
         threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, n_words, matches (start, end, label, base, exact, containment), sorted."""
    spark = docs.sparkSession
    templates = [(True, *t) for t in base] + [(False, *t) for t in more]
    vocabulary = sorted({w for _, _, p in templates for w in tokens(p)})
    longest = max((len(tokens(p)) for _, _, p in templates), default=1)
    words = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), F.lit(0))

    counted = (docs.select(F.explode(words).alias("w")).select(F.lower("w").alias("w"))
               .where(F.col("w").isin(vocabulary)).groupBy("w").count().collect())  # one row per template word
    rows = prefixes(templates, {r["w"]: r["count"] for r in counted}, threshold)
    table = spark.createDataFrame(rows, "word string, label string, phrase array<string>, ordered array<string>, "
                                        "need int, place int, base boolean")
    rare = sorted({r[0] for r in rows})

    each = docs.select(F.col(id_col).alias("_id"), words.alias("w"))
    at = F.array_compact(F.transform("w", lambda x, i: F.when(F.lower(x).isin(rare), i)))
    around = F.transform(at, lambda i: F.struct(
        i.alias("i"), F.greatest(i - (longest - 1), F.lit(0)).alias("lo"),
        F.transform(F.slice("w", F.greatest(i - (longest - 1), F.lit(0)) + 1, F.lit(2 * longest - 1)), _plain)
        .alias("near")))
    # one task-local number per row keeps repeated ids apart; it is made before the only shuffle
    each = each.select(F.monotonically_increasing_id().alias("_row"), "_id", F.size("w").cast("bigint").alias("n_words"),
                       around.alias("around"))
    hits = each.select("_row", "_id", "n_words", F.explode_outer("around").alias("c")).select(
        "_row", "_id", "n_words", "c.i", "c.lo", "c.near", F.col("c.near")[F.col("c.i") - F.col("c.lo")].alias("word"))
    joined = hits.join(table, "word", "left")
    size = F.size("phrase")
    starts = F.when(F.col("label").isNotNull(),
                    F.sequence(F.greatest(F.col("i") - size + 1, F.lit(0)), F.col("i")))
    blocks = joined.select("_row", "_id", "n_words", "i", "lo", "near", "word", "label", "phrase", "ordered", "need",
                           "place", "base", F.explode_outer(starts).alias("s"))
    block = F.slice("near", F.col("s") - F.col("lo") + 1, size)
    blocks = blocks.withColumn("block", block)
    shared = F.size(F.array_intersect("ordered", "block"))
    rarer = F.exists(F.slice("ordered", F.lit(1), F.col("place")), lambda x: F.array_contains("block", x))
    holds = (F.col("label").isNotNull() & (F.size("block") >= F.col("need"))
             & (F.array_position("block", F.col("word")) == F.col("i") - F.col("s") + 1)
             & ~rarer & (shared >= F.col("need")))
    match = F.when(holds, F.struct(
        F.col("s").cast("bigint").alias("start"), (F.col("s") + F.size("block")).cast("bigint").alias("end"), "label",
        "base", (F.col("block") == F.col("phrase")).alias("exact"),
        (shared / F.size("ordered")).alias("containment")))
    return (blocks.select("_row", "_id", "n_words", match.alias("m")).groupBy("_row", "_id", "n_words")
            .agg(F.array_sort(F.collect_list("m")).alias("matches"))
            .select(F.col("_id").alias(id_col), "n_words", "matches"))
