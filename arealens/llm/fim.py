"""Fill-in-the-middle: documents cut into prefix, middle and suffix at unit ends.

Units are lines (a line feed ends one; text after the last is one more).
The UTF-8 bytes of many texts, as they lie in the Arrow buffer, are viewed as
64-bit words.  A few arithmetic steps mark the unit-ending bytes of a word in
the high bits of those bytes, ``bitwise_count`` counts them per word, and a
running count over the words answers both questions asked of it: how many
ends lie before a byte (rank), and where the k-th end lies (select: binary
search for its word, then clear the lower marks of that word).  Code points
are counted the same way, by marking the bytes that start one.

The two cuts and the form of a document follow from the SHA-256 of
``seed:id``, so they are the same in every run and partitioning.

Defined cases: a null text is empty; an empty text, and one that holds a
sentinel, is ``plain`` (the text as it is); a null id is hashed as the empty
string; rows that repeat an id are cut alike if their texts are equal.
Every row is treated by itself, so ties and an empty table need no rule;
further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FLUSH = 32 << 20     # bytes of output per Arrow batch, about

HIGH = np.uint64(0x8080808080808080)
LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
FEEDS = np.uint64(0x0A0A0A0A0A0A0A0A)
ONE = np.uint64(1)


def line_ends(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a line feed (no carry crosses a byte)."""
    other = words ^ FEEDS
    return ~(((other & LOW) + LOW) | other | LOW)


def starts(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that starts a code point, that is, whose top bits are not 10."""
    return (~words | (words << ONE)) & HIGH


class Marks:
    """Rank and select over the marked bytes of a buffer."""

    def __init__(self, words: np.ndarray, mark):
        self.marks = mark(words)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before each byte offset."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        below = (ONE << (byte << np.uint64(3))) - ONE
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte offset of the k-th marked byte, from 0."""
        word = np.searchsorted(self.before, k, side="right") - 1
        left, mark = k - self.before[word], self.marks[word]
        for _ in range(7):
            mark = np.where(left > 0, mark & (mark - ONE), mark)
            left = left - 1
        lowest = mark & (~mark + ONE)
        return (word << 3) + (np.bitwise_count(lowest - ONE) >> 3)


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; the offsets of a null are equal."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def as_words(data: np.ndarray) -> np.ndarray:
    """The bytes as little-endian words, with a word of zeros behind."""
    whole = np.zeros((len(data) // 8 + 2) * 8, np.uint8)
    whole[:len(data)] = data
    return whole.view("<u8")


def cut(data: np.ndarray, offsets: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(units, end of prefix, end of middle, code points of both) of every text; ``low`` and ``high`` are hashes."""
    words = as_words(data)
    ends, points = Marks(words, line_ends), Marks(words, starts)
    start, stop = offsets[:-1], offsets[1:]
    first = ends.rank(start)
    feeds = ends.rank(stop) - first
    open_end = (stop > start) & (data[np.maximum(stop - 1, 0)] != 10) if len(data) else np.zeros(len(start), bool)
    units = feeds + open_end

    def end_of(unit):      # byte offset behind so many units
        found = (unit > 0) & (unit <= feeds)
        at = np.where(unit > feeds, stop, start)
        at[found] = ends.select((first + unit - 1)[found]) + 1
        return at

    one, two = low % (units + 1), high % (units + 1)
    a, b = end_of(np.minimum(one, two)), end_of(np.maximum(one, two))
    return units, a, b, points.rank(a) - points.rank(start), points.rank(b) - points.rank(a)


def transform(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, rate: int = 100,
              spm: int = 50) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row.

    ``rate`` per cent of the documents are cut, ``spm`` per cent of them in
    the form suffix, prefix, middle and the others as prefix, suffix, middle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]
    plain = (text == "") | text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE) | (h[2] % 100 >= rate)
    form = F.when(plain, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), h[0].alias("low"), h[1].alias("high"),
                       form.alias("form"))

    def run(batches):
        for batch in slices(batches):
            data, offsets = buffer(batch.column("text"))
            units, a, b, in_prefix, in_middle = cut(data, offsets, batch.column("low").to_numpy(),
                                                    batch.column("high").to_numpy())
            raw, forms = memoryview(data), batch.column("form").to_pylist()
            out, size, at = [], 0, 0
            for i, (f, p, m, s, e) in enumerate(zip(forms, offsets[:-1].tolist(), a.tolist(), b.tolist(),
                                                    offsets[1:].tolist())):
                if f == "psm":
                    out.append(b"".join([b"<P>", raw[p:m], b"<S>", raw[s:e], b"<M>", raw[m:s]]))
                elif f == "spm":
                    out.append(b"".join([b"<S>", raw[s:e], b"<P>", raw[p:m], b"<M>", raw[m:s]]))
                else:
                    out.append(bytes(raw[p:e]))
                size += len(out[-1])
                if size >= FLUSH or i == batch.num_rows - 1:
                    whole = np.array([x == "plain" for x in forms[at:i + 1]])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id")[at:i + 1], pa.array(units[at:i + 1]), batch.column("form")[at:i + 1],
                         pa.array(in_prefix[at:i + 1], mask=whole), pa.array(in_middle[at:i + 1], mask=whole),
                         pa.array(out, pa.binary()).cast(pa.string())],
                        names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])
                    out, size, at = [], 0, i + 1

    made = rows.mapInArrow(run, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
                                "output string")
    return made.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text behind an output: a cut text holds no sentinel, so the first of each kind is the one set here."""
    def split(first: str, second: str):
        rest = F.substr(output, F.lit(len(first) + 1))
        one = F.substring_index(rest, second, 1)
        rest = F.substr(rest, F.length(one) + len(second) + 1)
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substr(rest, F.length(two) + len(MIDDLE) + 1)

    prefix, suffix, middle = split(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = split(SUFFIX, PREFIX)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)
