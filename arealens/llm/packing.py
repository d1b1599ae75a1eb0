"""Hierarchical multi-length packing of token sequences.

Tiers are context sizes, each a power of two.  A document (its ids and one
end id) is routed whole: every full window of the largest tier leaves at
once, and the rest goes to the pool of the smallest tier that holds it.  When
enough rests wait, every tier, the largest first, packs its pool into windows
of its own size: the longest rest opens a window, and the gap is filled from
the same and the shorter tiers, each time by the longest rest that fits.  If
none fits, the shortest longer one of these is cut at the gap and its
remainder is routed again.  What is left at the end of a task is cut into
sequences whose lengths are powers of two, so no sequence needs padding.
Full windows are gathered by tier, across documents, and dealt to step groups
of ``step_size`` sequences of one tier in serpentine order of their attention
cost (the sum of squared piece lengths), so the steps of a training run cost
about the same.  Only the last group of a tier in a task may hold fewer.

Every task packs the rows of its own partition: nothing is shuffled, a hot
source or a very long document is only more rows or more windows, and memory
is bounded by ``pool`` rests and GATHER step groups a tier.  Sequence and group ids carry the partition
number, so a task that is run again gives the same rows.

Defined cases: a null text is an empty one (its sequence is the end id
alone); null ids and repeated rows are packed like any other row; an empty
table gives no piece.  Only the id and the text column are read.
"""

from __future__ import annotations

import json
import struct
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import slices
from .bpe import WORDS, Encoder, Vocabulary, _share

TIERS = (1024, 512, 256, 128)
END_ID = 0
POOL = 8192
STEP_SIZE = 8
GATHER = 32   # step groups of a tier that are dealt together


class Pool:
    """The waiting rests of one tier."""

    def __init__(self):
        self.rests: dict[int, list] = {}   # length -> rests of that length
        self.lengths = 0                   # bit n is set if a rest of length n waits

    def put(self, piece) -> None:
        n = len(piece[2]) // 4
        self.rests.setdefault(n, []).append(piece)
        self.lengths |= 1 << n

    def take(self, n: int):
        rests = self.rests[n]
        piece = rests.pop()
        if not rests:
            self.lengths &= ~(1 << n)
        return piece


class Packer:
    """Packs ``(key, start, ids, total)`` pieces of one task; ``ids`` are little-endian 32-bit."""

    def __init__(self, tiers=TIERS, pool: int = POOL, step_size: int = STEP_SIZE, task: int = 0):
        self.tiers = sorted(set(tiers))
        if any(t & (t - 1) for t in self.tiers):
            raise ValueError("tiers are powers of two")
        self.top, self.pool_size, self.step_size = self.tiers[-1], pool, step_size
        self.base = task << 32
        self.next_sequence = 0
        self.next_group = 0
        self.pools = [Pool() for _ in self.tiers]
        self.full: list[list] = [[] for _ in self.tiers]   # windows that wait for their step group
        self.count = 0
        self.out: list = []

    def _tier(self, n: int) -> int:
        """The smallest tier that holds n ids (n is at most the largest)."""
        return bisect_left(self.tiers, n)

    def _put(self, piece) -> None:
        self.pools[self._tier(len(piece[2]) // 4)].put(piece)
        self.count += 1

    def _take(self, n: int):
        self.count -= 1
        return self.pools[self._tier(n)].take(n)

    def add(self, key, ids: bytes) -> None:
        total, size = len(ids) // 4, 4 * self.top
        whole = len(ids) // size * size
        for i in range(0, whole, size):
            self._window(len(self.tiers) - 1, [(key, i // 4, ids[i:i + size], total)])
        if whole < len(ids):
            self._put((key, whole // 4, ids[whole:], total))
        if self.count >= self.pool_size:
            self._pack()

    def _longest(self, tier: int, most: int) -> int:
        """The length of the longest rest of ``tier`` and the shorter ones that has at most ``most`` ids, or 0."""
        mask = (1 << (most + 1)) - 1
        for pool in self.pools[tier::-1]:
            if pool.lengths & mask:
                return (pool.lengths & mask).bit_length() - 1
        return 0

    def _next_longer(self, tier: int, gap: int) -> int:
        """The length of the shortest rest of ``tier`` and the shorter ones that has more than ``gap`` ids, or 0."""
        for pool in self.pools[:tier + 1]:
            longer = pool.lengths >> (gap + 1)
            if longer:
                return gap + (longer & -longer).bit_length()
        return 0

    def _pack(self, last: bool = False) -> None:
        for tier in range(len(self.tiers) - 1, -1, -1):
            while self.pools[tier].lengths:
                n = self.pools[tier].lengths.bit_length() - 1
                window, gap = [self._take(n)], self.tiers[tier] - n
                while gap:
                    if n := self._longest(tier, gap):
                        window.append(self._take(n))
                        gap -= n
                    elif n := self._next_longer(tier, gap):
                        key, start, ids, total = self._take(n)
                        window.append((key, start, ids[:4 * gap], total))
                        self._put((key, start + gap, ids[4 * gap:], total))
                        gap = 0
                    else:
                        break
                if gap:   # nothing else waits in this tier and the shorter ones
                    if last:
                        self._powers(window)
                    else:
                        for piece in window:
                            self._put(piece)
                    return
                self._window(tier, window)

    def _powers(self, pieces: list) -> None:
        """Sequences of power-of-two lengths, largest first, from pieces laid end to end."""
        left = sum(len(p[2]) // 4 for p in pieces)
        pieces = pieces[::-1]
        while left:
            size = room = 1 << (left.bit_length() - 1)
            window = []
            while room:
                key, start, ids, total = pieces.pop()
                n = len(ids) // 4
                if n > room:
                    pieces.append((key, start + room, ids[4 * room:], total))
                    ids, n = ids[:4 * room], room
                window.append((key, start, ids, total))
                room -= n
            self._window(self._tier(size), window)
            left -= size

    def _window(self, tier: int, window: list) -> None:
        full = self.full[tier]
        full.append(window)
        if len(full) >= GATHER * self.step_size:
            self._emit(full, tier)
            self.full[tier] = []

    def _emit(self, windows: list, tier: int) -> None:
        """Step groups of ``step_size`` windows, and one of the windows that remain."""
        groups = len(windows) // self.step_size
        whole = groups * self.step_size
        cost = sorted(range(whole), key=lambda i: -sum(len(p[2]) ** 2 for p in windows[i]))
        group = dict.fromkeys(range(whole, len(windows)), groups)
        for k, i in enumerate(cost):
            turn, at = divmod(k, groups)
            group[i] = at if turn % 2 == 0 else groups - 1 - at
        for i, window in enumerate(windows):
            offset = 0
            for key, start, ids, total in window:
                n = len(ids) // 4
                self.out.append((key, start, n, ids, total, self.base + self.next_sequence, offset, self.tiers[tier],
                                 self.base + self.next_group + group[i]))
                offset += n
            self.next_sequence += 1
        self.next_group += groups + (whole < len(windows))

    def drain(self, last: bool = False) -> list:
        if last:
            self._pack(last=True)
            for tier, windows in enumerate(self.full):
                self._emit(windows, tier)
            self.full = [[] for _ in self.tiers]
        out, self.out = self.out, []
        return out


def fast_words(text: str):
    """The tokenizers file's merges as a compiled encoder of single words.

    It takes ids for merge ranks, so None if the merges are not in the order of the ids they make.
    """
    model = json.loads(text)["model"]
    v = model["vocab"]
    made_ids = [v["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if any(a >= b for a, b in zip(made_ids, made_ids[1:])):
        return None
    from .bpe import byte_letters

    letters = byte_letters()
    ranks = {bytes(letters[c] for c in t): i for t, i in v.items() if all(c in letters for c in t)}
    made = tiktoken.Encoding("file", pat_str=WORDS.pattern, mergeable_ranks=ranks, special_tokens={})
    single = made.encode_single_token
    known = set(ranks)

    def encode(word: str) -> bytes:
        raw = word.encode()
        if raw in known:
            return single(raw).to_bytes(4, "little")
        got = made.encode_ordinary(word)
        return struct.pack(f"<{len(got)}I", *got)

    return encode


_ENCODERS: dict[int, Encoder] = {}


def encoder_of(shared) -> Encoder:
    key = hash(shared.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(Vocabulary(shared.value), fast_words(shared.value))
    return _ENCODERS[key]


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         tiers: tuple[int, ...] = TIERS, end_id: int = END_ID, pool: int = POOL,
         step_size: int = STEP_SIZE, keep_ids: bool = True) -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset, tier, step_group, ids_crc32
    and, with ``keep_ids``, the piece's ids."""
    shared = _share(docs, path)
    end = end_id.to_bytes(4, "little")
    key_type = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "tier", "step_group", "ids_crc32"]

    def run(batches):
        encoder = encoder_of(shared)
        packer = Packer(tiers, pool, step_size, TaskContext.get().partitionId())
        kind = None

        def rows(got):
            cols = list(zip(*got)) if got else [[]] * 9
            arrays = [pa.array(cols[0], kind), *(pa.array(cols[i], pa.int64()) for i in (1, 2, 4, 5, 6, 7, 8)),
                      pa.array([zlib.crc32(b) for b in cols[3]], pa.int64())]
            if keep_ids:
                arrays.append(pa.array([np.frombuffer(b, np.int32) for b in cols[3]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names=names + ["ids"] * keep_ids)

        for part in slices(batches):
            kind = part.column(0).type
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                packer.add(key, encoder.encode(text) + end)
            if len(packer.out) >= 1000:
                yield rows(packer.drain())
        if kind is not None:
            yield rows(packer.drain(last=True))

    schema = f"doc_id {key_type}, " + ", ".join(f"{n} bigint" for n in names[1:]) + ", ids array<int>" * keep_ids
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
