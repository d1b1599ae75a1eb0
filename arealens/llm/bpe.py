"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For a byte sequence every prefix has exactly one last token in its encoding.
It is found left to right: an Aho-Corasick automaton over the vocabulary
lists the tokens that end at a position; the right one is the token that is
compatible with the (already known) last token of the prefix before it.  Two
tokens are compatible if encoding their joint bytes gives the two back.
``Vocabulary._fits`` tests that without encoding: it undoes the two tokens'
merges from the latest to the earliest and looks for a merge across the
border that would have come first.  The back-pointers then spell the ids.

Words repeat, so every worker keeps a bounded table of pieces already
encoded.  A piece is the text between two spaces that stand alone: no token
of a byte-level vocabulary spans such a border.

Defined cases: a null text is encoded as an empty one, with no ids; ids are
null only where ``decode`` is given null; the strings of special tokens in a
text become their ids, as the tokenizers library does; unknown ids in
``decode`` raise.  Columns that come along keep their names and values.
"""

from __future__ import annotations

import json
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import SLICE_ROWS, slices, tokenizer_path

# Fixed value: the split of the public byte-level vocabulary (its README gives it).
# White space is spelled out: libraries differ on U+001C to U+001F.
WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WS}\p{{L}}\p{{N}}]+|[{WS}]+(?![^{WS}])|[{WS}]+")
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
MIXED_SPACE = re.compile(r"\s\s")
MAX_PIECES = 300_000     # pieces an encoder remembers, once more as many older ones
MAX_PAIRS = 500_000      # token pairs a worker remembers


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    return letters | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}


def token_bytes(spec: dict) -> dict[int, bytes]:
    """The bytes of every token of a parsed tokenizers file, special tokens included."""
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    plain = {i: bytes(letters[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in special}
    return plain | {i: t.encode() for t, i in special.items()}


class Vocabulary:
    """Vocabulary, merges and special tokens of a tokenizers JSON file of byte-level BPE."""

    def __init__(self, text: str):
        spec = json.loads(text)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = token_bytes(spec)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        # merge of (left, right) -> its rank, rank + 1 for comparisons with "no merge" (0)
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}
        for k, (a, b) in enumerate(pairs, 1):
            ids = vocab[a], vocab[b]
            self.rank.setdefault(ids, k)
            whole = vocab[a + b]
            if whole not in self.halves:
                self.halves[whole], self.born[whole] = ids, k
        self.machine = ahocorasick.Automaton()
        for i, b in ((i, b) for i, b in self.bytes_of.items() if i not in self.special.values()):
            self.machine.add_word(b.decode("latin-1"), (i, len(b)))
        self.machine.make_automaton()
        special = sorted(self.special, key=len, reverse=True)
        self.special_re = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.size = max(self.bytes_of) + 1
        self.packed = [i.to_bytes(4, "little") for i in range(self.size)]
        self._pairs: dict[int, bool] = {}   # left * pair_base + right -> compatible
        self.pair_base = self.size
        self.complete = self._complete()

    def _fits(self, left: int, right: int) -> bool:
        born, halves, rank = self.born, self.halves, self.rank
        # The border tokens as they stood just before each merge, latest first.  On equal ranks the
        # left one is merged first, so it is undone last.
        now = 1 << 60
        while True:
            across = rank.get((left, right))
            if across is not None and across < now:
                return False
            a, b = born.get(left, 0), born.get(right, 0)
            if not a and not b:
                return True
            if a > b:
                # a merge across the border of the same rank would stand to the right of this one
                now, left = a, halves[left][1]
            else:
                # ... and to the left of this one, where it comes first
                now, right = b + 1, halves[right][0]

    def encode_word(self, word: str) -> bytes:
        """Little-endian 32-bit ids of one word (a piece the pre-tokenizer never splits)."""
        raw = word if word.isascii() else word.encode().decode("latin-1")
        n = len(raw)
        last, start_of = [-1] * (n + 1), [0] * (n + 1)
        pairs, size_of = self._pairs, self.pair_base
        for end, (token, size) in self.machine.iter(raw):
            end += 1
            if last[end] < 0:
                start = end - size
                if start:
                    left = last[start]
                    ok = pairs.get(left * size_of + token)
                    if ok is None:
                        if len(pairs) >= MAX_PAIRS:
                            pairs.clear()
                        ok = pairs[left * size_of + token] = self._fits(left, token)
                    if ok:
                        last[end], start_of[end] = token, start
                elif self.complete[token]:
                    last[end] = token
        out = []
        packed = self.packed
        while n:
            out.append(packed[last[n]])
            n = start_of[n]
        out.reverse()
        return b"".join(out)

    def _complete(self) -> list[bool]:
        """Whether a token's own bytes encode to it: single bytes do, a merge if its halves get that far."""
        done = [False] * self.size
        for token in sorted(self.bytes_of, key=lambda i: self.born.get(i, 0)):
            if token in self.halves:
                a, b = self.halves[token]
                done[token] = done[a] and done[b] and self._reaches(a, b)
            else:
                done[token] = len(self.bytes_of[token]) == 1
        return done

    def _reaches(self, left: int, right: int) -> bool:
        """No merge crosses the border of ``left`` and ``right`` before their own."""
        whole = self.rank.pop((left, right))
        try:
            return self._fits(left, right)
        finally:
            self.rank[(left, right)] = whole


class Encoder(dict):
    """Texts to little-endian 32-bit ids.

    The dict holds pieces already encoded, without the space before them.
    When it is full it becomes the older generation, whose pieces come back
    as they are met again; so frequent pieces stay and memory is bounded.
    """

    def __init__(self, vocabulary: Vocabulary, encode_word=None, pieces: int = MAX_PIECES):
        super().__init__()
        self.pieces = pieces
        self.v = vocabulary
        self.encode_word = encode_word or vocabulary.encode_word
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        got = self.older.get(piece)
        if got is None:
            if piece.isalpha():
                got = self.encode_word(" " + piece)
            elif piece[:-1].isalpha() and piece[-1] in ".,;:!?":
                got = self[piece[:-1]] + (self.marks.get(piece[-1]) or self._words(piece[-1]))
            else:
                got = self._words(" " + piece)
        if len(self) >= self.pieces:
            self.older = dict(self)
            self.clear()
        if len(piece) < 100:
            self[piece] = got
        return got

    def _words(self, text: str) -> bytes:
        marks, out = self.marks, []
        for w in WORDS.findall(text):
            if w[0] == " " and w[1:].isalpha():
                out.append(self[w[1:]])
                continue
            got = marks.get(w)
            if got is None:
                if len(marks) >= self.pieces // 4:
                    marks.clear()
                got = self.encode_word(w)
                if len(w) < 100:
                    marks[w] = got
            out.append(got)
        return b"".join(out)

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        parts = text.split(" ")
        if MIXED_SPACE.search(text) or not parts[0] or not parts[-1] or text[0].isspace() or text[-1].isspace():
            parts = LONE_SPACE.split(text)
        first = self._words(parts[0])
        return first + b"".join(map(self.__getitem__, parts[1:])) if len(parts) > 1 else first

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if self.v.special_re is None or not self.v.special_re.search(text):
            return self._plain(text)
        return b"".join(np.array([self.v.special[x]], "<u4").tobytes() if x in self.v.special else self._plain(x)
                        for x in self.v.special_re.split(text))


class Decoder:
    """Id arrays to text: the tokens' bytes, gathered from one buffer."""

    def __init__(self, bytes_of: dict[int, bytes]):
        size = max(bytes_of) + 1
        parts = [bytes_of.get(i, b"") for i in range(size)]
        self.known = np.array([i in bytes_of for i in range(size)])
        self.size = np.array([len(p) for p in parts], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        self.buffer = np.frombuffer(b"".join(parts), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        if ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all():
            raise ValueError("an id that the vocabulary does not have")
        size = self.size[ids]
        ends = np.cumsum(size)
        shift = np.repeat(self.at[ids] - (ends - size), size)
        return self.buffer[shift + np.arange(ends[-1])].tobytes().decode("utf-8", "replace")


_ENCODERS: dict[int, Encoder] = {}
_DECODERS: dict[int, Decoder] = {}


def encoder_of(shared) -> Encoder:
    """The encoder of a broadcast file, built once per worker process.

    A task that encodes and decodes has two workers, and any worker may come to encode: it remembers half as much.
    """
    key = hash(shared.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(Vocabulary(shared.value), pieces=MAX_PIECES // 2)
    return _ENCODERS[key]


def decoder_of(shared) -> Decoder:
    """The decoder of a broadcast file, built once per worker process from the tokens' bytes alone."""
    key = hash(shared.value)
    if key not in _DECODERS:
        _DECODERS.clear()
        _DECODERS[key] = Decoder(token_bytes(json.loads(shared.value)))
    return _DECODERS[key]


def _share(df: DataFrame, path: str | None):
    """The vocabulary file (a few MB, whatever the input's size), read by the driver and broadcast."""
    with open(path or tokenizer_path(), encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, *, text_col: str = "text", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``df`` with the array of token ids in place of ``text_col``.

    One pass over Arrow batches: as an expression, ids that are used twice would be computed twice.
    """
    shared = _share(df, path)
    others = [c for c in df.columns if c != text_col]

    def run(batches):
        encoder = encoder_of(shared)
        for part in slices(batches):
            got = [encoder.encode(t) for t in part.column(len(others)).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(g) // 4 for g in got])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(got), np.int32)))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids], names=[*others, ids_col])

    schema = T.StructType([*[df.schema[c] for c in others], T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    return df.select(*others, text_col).mapInArrow(run, schema)


def decode(df: DataFrame, *, ids_col: str = "ids", text_col: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the text that an array of token ids stands for (special tokens written out)."""
    shared = _share(df, path)

    @F.arrow_udf("string")
    def text(ids: pa.Array) -> pa.Array:
        decoder = decoder_of(shared)
        values, done = ids.values.to_numpy(zero_copy_only=False), []
        for i in range(0, len(ids), SLICE_ROWS):   # only a few texts are Python objects at a time
            part = ids.slice(i, SLICE_ROWS)
            offsets = part.offsets.to_numpy()
            done.append(pa.array([decoder.decode(values[a:b]) if ok else None
                                  for a, b, ok in zip(offsets, offsets[1:], part.is_valid().to_pylist())], pa.string()))
        return pa.concat_arrays(done) if done else pa.array([], pa.string())

    return df.withColumn(text_col, text(F.col(ids_col)))
