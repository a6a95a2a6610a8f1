"""Expressions on ``array<double>`` columns, and Arrow <-> matrix conversion."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def row_zscore(a: Column) -> Column:
    """Each row scaled by its own mean and sample deviation (ddof 1); zeros for a row without spread."""
    dev = let(F.try_divide(total(a), F.size(a)), lambda m: F.transform(a, lambda x: x - m))
    return let(
        dev,
        lambda v: let(
            F.sqrt(F.try_divide(dot(v, v), F.size(v) - 1)),
            lambda sd: F.transform(v, lambda x: F.coalesce(F.try_divide(x, sd), F.lit(0.0))),
        ),
    )


def pack(cols: Sequence[str], name: str = "features") -> Column:
    return F.array(*[F.col(c).cast("double") for c in cols]).alias(name)


def to_matrix(column) -> np.ndarray:
    """An Arrow list column without nulls as an (n, m) float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.zeros((0, 0))
    if column.null_count:
        raise ValueError("null vector")
    flat = column.flatten()
    if flat.null_count or len(flat) % n:
        raise ValueError("vectors must have one length and no null elements")
    lengths = np.diff(np.asarray(column.offsets))
    if (lengths != len(flat) // n).any():
        raise ValueError("vectors must have one length")
    return np.asarray(flat.to_numpy(zero_copy_only=False), dtype=np.float64).reshape(n, -1)


def from_matrix(m: np.ndarray) -> pa.Array:
    m = np.ascontiguousarray(m, dtype=np.float64)
    offsets = np.arange(0, m.size + 1, m.shape[1] if m.shape[1] else 1, dtype=np.int32)
    if m.shape[0] == 0:
        offsets = np.zeros(1, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(m.ravel()))


def batches_to_matrices(batches: Iterator[pa.RecordBatch], vec_col: str):
    for b in batches:
        if b.num_rows:
            yield b, to_matrix(b.column(vec_col))


def sum_by_slot(
    df: DataFrame,
    kernel: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, np.ndarray]]],
) -> dict[int, np.ndarray]:
    """Add up vectors that ``kernel`` yields as ``(slot, vector)`` per partition.

    One row per partition and slot leaves Python; ``Summarizer.sum`` combines
    them map-side before the shuffle, and one vector per slot reaches the driver.
    """

    def run(batches):
        slots, vecs = [], []
        for slot, v in kernel(batches):
            slots.append(slot)
            vecs.append(np.asarray(v, dtype=np.float64).ravel())
        for s, v in zip(slots, vecs):
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), from_matrix(v.reshape(1, -1))], names=["slot", "v"]
            )

    parts = df.mapInArrow(run, "slot int, v array<double>")
    rows = (
        parts.groupBy("slot")
        .agg(vector_to_array(Summarizer.sum(array_to_vector(F.col("v")))).alias("v"))
        .collect()
    )
    return {r["slot"]: np.asarray(r["v"]) for r in rows}
