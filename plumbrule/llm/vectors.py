"""What the operators on embeddings share: usable vectors, one length, matrices from Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(v: Column) -> Column:
    """Whether an array of doubles is not NULL and has neither NULL nor non-finite entries."""
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~odd


def of_common_length(rows: DataFrame, column: str) -> tuple[DataFrame, int]:
    """The rows whose array has the most frequent length above 0 (of equals the greatest), and that length; 0 if there is none."""
    length = F.size(column)
    found = rows.groupBy(length.alias("length")).count().filter("length > 0").orderBy(F.desc("count"), F.desc("length")).first()
    dims = found["length"] if found else 0
    return rows.filter(length == dims), dims


def matrix(batch: pa.RecordBatch, column: str, dims: int) -> np.ndarray:
    """The arrays of a column, all of length `dims` and without NULL, as the rows of a matrix."""
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
