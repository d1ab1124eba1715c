"""What vector operators share: which vectors take part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, and every component a finite number."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(array: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of a list column whose lists all have ``dims`` numbers, in double precision."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    return np.asarray(array.flatten(), np.float64).reshape(-1, dims)
