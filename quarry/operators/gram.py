"""Gram statistics per slice in one scan: (n, sums, cross products) of [1, X, y].

Everything quadratic in the data (covariance, correlation, components, least
squares, ridge, cross-validation over folds and penalties, feature selection)
is read off these matrices without another pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.vectors import sum_by_slot, to_matrix

MAX_WIDTH = 4_000


@dataclass
class Gram:
    """Cross products of ``[1, X - shift]``; the last column is y when one was given."""

    names: list[str]
    shift: np.ndarray
    g: np.ndarray

    @property
    def n(self) -> float:
        return float(self.g[0, 0])

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.names, self.shift, self.g + other.g)

    def __sub__(self, other: Gram) -> Gram:
        return Gram(self.names, self.shift, self.g - other.g)

    def pick(self, cols: Sequence[int]) -> Gram:
        idx = [0] + [c + 1 for c in cols]
        return Gram([self.names[c] for c in cols], self.shift[list(cols)], self.g[np.ix_(idx, idx)])

    def mean(self) -> np.ndarray:
        return self.shift + self.g[0, 1:] / self.n

    def scatter(self) -> np.ndarray:
        """Centred cross products."""
        s = self.g[0, 1:]
        return self.g[1:, 1:] - np.outer(s, s) / self.n

    def cov(self, ddof: int = 1) -> np.ndarray:
        return self.scatter() / (self.n - ddof)

    def raw(self) -> np.ndarray:
        """Cross products of [1, X] without the shift."""
        t = np.eye(len(self.shift) + 1)
        t[0, 1:] = self.shift
        return t.T @ self.g @ t


def gram(
    df: DataFrame,
    cols: Sequence[str],
    by: str | None = None,
    vec_col: str | None = None,
) -> dict[int, Gram]:
    """Gram statistics per value of the integer column ``by`` (one slice 0 without it).

    ``vec_col`` puts the elements of a vector column in front of ``cols``.
    """
    cols = list(cols)
    picked = ([F.col(vec_col)] if vec_col else []) + [F.col(c).cast("double").alias(c) for c in cols]
    slim = df.select(*picked, (F.col(by).cast("int") if by else F.lit(0)).alias("__slot"))

    def matrix(b):
        parts = [to_matrix(b.column(vec_col))] if vec_col else []
        if cols:
            if any(b.column(c).null_count for c in cols):
                raise ValueError("null feature value")
            parts.append(np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in cols]))
        return np.hstack(parts)

    # the mean as a constant keeps the cross products small and the subtraction safe
    means = [Summarizer.mean(array_to_vector(F.col(vec_col).cast("array<double>"))).alias("__m")] if vec_col else []
    row = slim.agg(F.count("*").alias("__n"), *means, *[F.avg(c).alias(c) for c in cols]).first()
    if not row["__n"]:
        raise ValueError("empty table")
    shift = np.concatenate([row["__m"].toArray() if vec_col else [], [np.nan if row[c] is None else row[c] for c in cols]])
    shift = np.where(np.isfinite(shift), shift, 0.0)
    width = len(shift)
    if width > MAX_WIDTH:
        raise ValueError(f"{width} columns; Gram matrices are meant for at most {MAX_WIDTH}")

    def kernel(batches):
        acc: dict[int, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            z = np.hstack([np.ones((b.num_rows, 1)), matrix(b) - shift])
            slot = b.column("__slot").to_numpy()
            for s in np.unique(slot):
                part = z if (slot == s).all() else z[slot == s]
                acc[int(s)] = acc.get(int(s), 0) + part.T @ part
        yield from acc.items()

    sums = sum_by_slot(slim, kernel)
    names = ([f"{vec_col}_{i}" for i in range(width - len(cols))] if vec_col else []) + cols
    return {s: Gram(names, shift, v.reshape(width + 1, width + 1)) for s, v in sorted(sums.items())}


def pooled(parts: dict[int, Gram]) -> Gram:
    items = list(parts.values())
    out = items[0]
    for p in items[1:]:
        out = out + p
    return out


def _long(spark, names, m):
    rows = [(a, b, float(m[i, j])) for i, a in enumerate(names) for j, b in enumerate(names)]
    return spark.createDataFrame(rows, "a string, b string, value double")


def covariance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    g = pooled(gram(df, cols))
    return _long(df.sparkSession, g.names, g.cov())


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    g = pooled(gram(df, cols))
    c = g.cov()
    sd = np.sqrt(np.diag(c))
    return _long(df.sparkSession, g.names, c / np.outer(sd, sd))
