"""Helpers for operators on embeddings: usable vectors, packed rows, groups of a sorted stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def usable(df: DataFrame, vector_col: str) -> Column:
    """True for vectors of finite components that are not all zero (null and empty ones are not usable)."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def is_double(df: DataFrame, vector_col: str) -> bool:
    kind = df.schema[vector_col].dataType
    return not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one length, as doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def packed(rows: np.ndarray) -> pa.Array:
    """One binary value per row."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def unpacked(column, dtype) -> np.ndarray:
    """The matrix behind a binary column whose values have one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def groups(batches, n_keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal keys (the first ``n_keys`` long columns) in a stream sorted by them."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)])
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(keys[a].tolist())
            if held and key != held_key:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(a, b - a))
    if held:
        yield held_key, pa.Table.from_batches(held)
