"""Arrow columns of vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite() -> Column:
    """Whether ``embedding`` is there and holds neither null nor non-finite entries."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd, F.lit(False))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones are padded with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out
