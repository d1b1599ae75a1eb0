"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_ROWS = 128


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of Arrow batches, so only a few texts are Python objects at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower()`` would also change other scripts)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def is_held_out(doc_id: Column) -> Column:
    """The rows labels may not be learned from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer file; ``PUBLIC_TOKENIZERS`` names another folder."""
    folder = os.environ.get("PUBLIC_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no input column clashes with it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
