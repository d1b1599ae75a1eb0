"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding maps look-alike letters, digits and symbols to one letter, deletes
zero-width characters and turns everything else that is not a letter into a
space, so an obfuscated spelling meets its lexicon entry.  The lexicon holds
whole words (both borders must be spaces) and word stems (left border only),
each with a log-odds weight.  Every place counts its heaviest entry once;
places inside an exception phrase do not count.  The score is a logistic
function of the summed weight and of the weight per word.

The lexicon and the logistic coefficients are learned from labelled rows:
counting terms is a Spark aggregate, and only the selected terms (at most
``max_terms``) reach the driver.  Labelled rows are a sample bounded by
``max_train_rows`` (20,000 ids by default, one row each: the smallest text);
scoring reads every row.  Bounds of the lexicon, which hold for learning only:
of more than ``max_terms`` selected terms (4,000) those of the smallest z are
left out, and words of fewer than ``SHORTEST`` or more than ``LONGEST`` folded
letters are no terms of their own, so a text whose only toxic words are of two
letters, or are runs of over 40, is not caught by them.

Defined cases: a null or empty text has no places and gets the score of an
unmarked text; a null id is scored like any other (and never held out); rows
that repeat an id are scored one by one; without usable labels, or with one
label only, the lexicon is empty and every score is 0.  Columns of the input
other than the text pass through untouched and are never read.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import SLICE_ROWS, fresh_name, slices

# Letters of other scripts that look like a Latin letter.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "α": "a", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ɡ": "g", "ℓ": "l",
}
# Digits and symbols written for letters.
SUBSTITUTES = {"0": "o", "1": "l", "|": "l", "2": "z", "3": "e", "€": "e", "4": "a", "@": "a", "5": "s",
               "$": "s", "7": "t", "8": "b", "9": "g"}
# i, l and 1 stand for one another, so they fold to one letter.
SAME = {"i": "l"}
ZERO_WIDTH = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
SEPARATORS = "\u00a0\u2009\u202f\u3000«»“”‘’„‚…–—¿¡·•"
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "class clown")

STEMS = (4, 5, 6)
SHORTEST, LONGEST = 3, 40
TERM = "term string, half int, n bigint, toxic bigint"


def fold_table() -> dict[int, str | None]:
    table: dict[int, str | None] = {c: " " for c in range(128) if not chr(c).isalnum()}
    table |= {ord(c): " " for c in SEPARATORS}
    table |= {0xFF41 + i: chr(97 + i) for i in range(26)}
    table |= {ord(k): v for k, v in (HOMOGLYPHS | SUBSTITUTES).items()}
    table |= {k: SAME[v] for k, v in table.items() if v in SAME} | {ord(k): v for k, v in SAME.items()}
    return table | {ord(c): None for c in ZERO_WIDTH}


TABLE = fold_table()


def fold(text: str | None) -> str:
    """The folded text between two spaces."""
    return f" {(text or '').lower().translate(TABLE)} "


@dataclass
class ToxicityModel:
    """Lexicon (``" word "`` or ``" stem"`` -> weight), exception phrases and logistic coefficients."""

    lexicon: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    bias: float = -30.0
    coef: tuple[float, float] = (0.0, 0.0)
    _machine: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"lexicon": self.lexicon, "exceptions": self.exceptions, "bias": self.bias, "coef": self.coef}

    def __setstate__(self, state):
        self.__dict__.update(state, _machine=None)

    @property
    def machine(self):
        if self._machine is None:
            a = ahocorasick.Automaton()
            for term, w in self.lexicon.items():
                a.add_word(term, (len(term), w))
            for phrase in self.exceptions:
                key = fold(phrase)
                if key not in self.lexicon:
                    a.add_word(key, (len(key), None))
            if len(a):
                a.make_automaton()
            self._machine = a
        return self._machine

    def features(self, text: str | None) -> tuple[float, int, int]:
        """Summed weight, counted places and words of one text."""
        folded = fold(text)
        words = len(folded.split())
        if not self.lexicon:
            return 0.0, 0, words
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, w) in self.machine.iter(folded):
            start = end + 1 - size
            if w is None:
                spared.append((start, end))
            elif w > best.get(start, 0.0):
                best[start] = w
        for a, b in spared:
            for start in [s for s in best if a <= s < b]:
                del best[start]
        return sum(best.values()), len(best), words

    def score(self, total: float, words: int) -> float:
        z = self.bias + self.coef[0] * math.log1p(total) + self.coef[1] * math.log1p(100 * total / max(words, 1))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def _terms(folded: str) -> set[str]:
    out = set()
    for w in set(folded.split()):
        if SHORTEST <= len(w) <= LONGEST:
            out.add(f" {w} ")
        for k in STEMS:
            if k < len(w) <= LONGEST:
                out.add(f" {w[:k]}")
    return out


def _count_terms(batches):
    for part in slices(batches, 512):
        seen: Counter = Counter()
        bad: Counter = Counter()
        for text, toxic, half in zip(*(part.column(c).to_pylist() for c in ("text", "toxic", "half"))):
            terms = [(t, half) for t in _terms(fold(text))]
            seen.update(terms)
            if toxic:
                bad.update(terms)
        keys = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([seen[k] for k in keys], pa.int64()), pa.array([bad[k] for k in keys], pa.int64())],
            names=["term", "half", "n", "toxic"])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps (the first column is the constant)."""
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty),
                               x.T @ (y - p) - penalty * beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_train_rows: int = 20_000, max_terms: int = 4_000, min_docs: int = 10,
        min_z: float = 8.0, min_rate: float = 0.5, exceptions: tuple[str, ...] = EXCEPTIONS) -> ToxicityModel:
    """Learn lexicon and coefficients from at most ``max_train_rows`` labelled rows.

    The sample is the labelled ids of smallest hash, so it is the same at
    every run; being bounded it is broadcast to the documents, and only
    labelled texts are shuffled.  One half selects and weighs the terms; a term stays if the
    other half bears it out, and that half fits the coefficients.
    """
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("toxic"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_train_rows))
    rows = (docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "_id").groupBy("_id", "toxic").agg(F.min("text").alias("text"))
            .select("text", "toxic", F.pmod(F.xxhash64(F.col("_id"), F.lit(1)), F.lit(2)).cast("int").alias("half")))
    counts = rows.groupBy("half").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).collect()
    total, bad = sum(r["n"] for r in counts), sum(r["t"] or 0 for r in counts)
    if not 0 < bad < total:
        return ToxicityModel({}, exceptions)
    base = bad / total
    by_term = rows.mapInArrow(_count_terms, TERM).groupBy("term").agg(
        *[F.sum(F.when(F.col("half") == h, F.col(c)).otherwise(0)).alias(f"{c}{h}")
          for h in (0, 1) for c in ("n", "toxic")])
    n, t = F.col("n0") + F.col("n1"), F.col("toxic0") + F.col("toxic1")
    z = (t - n * base) / F.sqrt(n * base * (1 - base))
    kept = (by_term.where((n >= min_docs) & (z >= min_z) & (t >= n * min_rate)
                          & (F.col("n0") >= 3) & (F.col("n1") >= 3)
                          & (F.col("toxic0") >= F.col("n0") * min_rate) & (F.col("toxic1") >= F.col("n1") * min_rate))
            .select("term", n.alias("n"), t.alias("t"), z.alias("z"))
            .orderBy(F.desc("z"), "term").limit(max_terms).collect())
    odds = math.log(base / (1 - base))
    model = ToxicityModel({r["term"]: round(math.log((r["t"] + 0.5) / (r["n"] - r["t"] + 0.5)) - odds, 6)
                           for r in kept}, exceptions)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def features(batches):
        for part in slices(batches):
            got = [shared.value.features(x) for x in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.int64()),
                 part.column("toxic")], names=["total", "words", "toxic"])

    # at most max_train_rows rows of three numbers
    got = rows.select("text", "toxic").mapInArrow(features, "total double, words bigint, toxic int").collect()
    tot, words, y = (np.array([float(r[k]) for r in got]) for k in range(3))
    x = np.column_stack([np.ones_like(tot), np.log1p(tot), np.log1p(100 * tot / np.maximum(words, 1))])
    beta = _logistic(x, y)
    model.bias, model.coef = float(beta[0]), (float(beta[1]), float(beta[2]))
    return model


def score(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text") -> DataFrame:
    """Every input column plus ``score`` and ``places`` (names that clash get an underscore in front)."""
    names = [fresh_name(docs, c) for c in ("score", "places")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<score: double, places: bigint>")
    def judged(texts: pa.Array) -> pa.Array:
        m = shared.value
        scores, places = [], []
        for i in range(0, len(texts), SLICE_ROWS):
            for text in texts.slice(i, SLICE_ROWS).to_pylist():
                total, hits, words = m.features(text)
                scores.append(m.score(total, words))
                places.append(hits)
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(places, pa.int64())],
                                          names=["score", "places"])

    got = fresh_name(docs, "_judged")
    return (docs.withColumn(got, judged(F.col(text_col)))
            .withColumns({names[0]: F.col(got)["score"], names[1]: F.col(got)["places"]}).drop(got))
