"""Whole-number vectors for the vector operators."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Below this, sums of products of whole numbers are exact in double precision, in any order.
EXACT = float(1 << 53)


def floored(df: DataFrame, scale: int, vector: str = "embedding") -> tuple[Column, Column]:
    """(condition that a vector is whole: not null, all components finite; floor(scale * x) of each component).

    A component beyond a long becomes the nearest long.
    """
    v = F.col(f"`{vector}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(v, lambda x: F.floor(x.cast("double") * scale))


def matrix(column: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """A list column as rows of equal length; shorter ones are filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    width = int(sizes.max(initial=0)) if width is None else width
    if len(flat) == len(column) * width and (sizes == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), flat.dtype)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two whole-number matrices: doubles, or Python numbers where
    doubles would not be exact."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    longest = [np.sqrt(np.einsum("ij,ij->i", m, m).max(initial=0)) for m in (x, y)]
    if longest[0] * longest[1] < EXACT / 2:
        return x @ y.T
    return a.astype(object) @ b.T.astype(object)
