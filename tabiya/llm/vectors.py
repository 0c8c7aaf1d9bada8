"""Integer vectors out of embedding columns, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components become floor(SCALE * component).
SCALE = 256


def usable(vector: Column) -> Column:
    """Not null, and no null, NaN or infinite component."""
    c = vector.cast("array<double>")
    return F.coalesce(c.isNotNull() & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def dimension(rows: DataFrame, vector_col: str) -> int:
    """Components of the longest vector; a shorter one counts as filled up with zeros."""
    return rows.agg(F.max(F.size(vector_col))).first()[0] or 0


def integers(column: pa.Array, width: int) -> np.ndarray:
    """floor(256 * component) of an Arrow list column as 64-bit integers, one row a vector."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_list(column.type) and not pa.types.is_large_list(column.type):
        column = column.cast(pa.list_(pa.float64()))
    at = column.offsets.to_numpy(zero_copy_only=False)
    flat = np.floor(column.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]].astype(np.float64) * SCALE)
    if len(flat) and np.abs(flat).max() >= 2.0 ** 63:
        raise ValueError("a component times 256 does not fit a 64-bit integer")
    size = np.diff(at)
    if (size == width).all():
        return flat.astype(np.int64).reshape(-1, width)
    out = np.zeros((len(size), width), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(at[:-1] - at[0], size)] = flat
    return out
