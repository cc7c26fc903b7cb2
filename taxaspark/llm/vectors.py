"""What the operators on vectors share: integer components, and matrices of Arrow lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Integer components lie within plus and minus this number, so that squares and products of 8,192 of them stay within 64 bits.
LIMIT = 1 << 24


def finite(vector: Column) -> Column:
    """Whether a vector is neither null nor holds a null or non-finite component."""
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as double, an array of int; beyond LIMIT it is LIMIT."""
    number = lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))
    return F.transform(vector, lambda x: F.greatest(F.least(number(x), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """A row of int64 for each list; shorter ones are followed by zeros."""
    sizes = lists.value_lengths().to_numpy()
    values = lists.flatten().to_numpy()
    if len(values) == len(lists) * width:
        return values.reshape(len(lists), width).astype(np.int64)
    out = np.zeros((len(lists), width), np.int64)
    out[np.repeat(np.arange(len(lists)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out
