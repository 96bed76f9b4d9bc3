"""What the operators on whole-number vectors share: which rows count, and their matrices inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite_rows(vectors: DataFrame, vector_col: str, **columns: str) -> DataFrame:
    """The named columns and v, the vector as doubles, of rows whose vector is not null and holds neither nulls nor non-finite entries."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(v.isNotNull() & finite).select(*(F.col(c).alias(name) for name, c in columns.items()), v.cast("array<double>").alias("v"))


def widest(rows: DataFrame) -> int:
    """The length of the longest vector."""
    return rows.agg(F.max(F.size("v"))).first()[0] or 0


def whole(column: pa.ListArray, width: int, bound: int) -> np.ndarray:
    """floor(256 * c) of every entry, as whole numbers within +-bound; shorter vectors end in zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        x = values.reshape(len(column), width)
    else:
        x = np.zeros((len(column), width))
        x[np.arange(width) < sizes[:, None]] = values
    with np.errstate(over="ignore"):
        return np.clip(np.floor(256 * x), -bound, bound).astype(np.int64)


def batches_of(rows: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Tables of so many rows, the last one shorter."""
    held, n = [], 0
    for batch in rows:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, size - n)
            held.append(part)
            at, n = at + part.num_rows, n + part.num_rows
            if n == size:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
