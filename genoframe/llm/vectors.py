"""Rows of ``embeddings`` that the vector operators work on."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sound(limit: float) -> str:
    """SQL: the vector is there, has entries, and all of them are numbers below ``limit`` in magnitude (``inf``: finite ones)."""
    bound = "double('Infinity')" if limit == float("inf") else f"double({limit!r})"
    return f"coalesce(size(embedding) > 0 and forall(embedding, c -> c is not null and abs(double(c)) < {bound}), false)"


def usual_length(rows: DataFrame) -> int:
    """The number of entries that most vectors have (the larger of two equally common ones; 0 without vectors)."""
    found = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("k")).orderBy(F.desc("k"), F.desc("d")).first()
    return found["d"] if found else 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column without nulls as an array with ``width`` columns."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
