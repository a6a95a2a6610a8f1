"""Similarity of two sets of rows, by name of the measure."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.vectors import batches_to_matrices, from_matrix
from quarry.operators import topk
from quarry.operators.encode import binarize
from quarry.operators.pairs import nearest_neighbours, similarity_matrix, squared_distances, within_radius


def _ratio(a, b):
    with np.errstate(divide="ignore", invalid="ignore"):
        return a / b


def smc(x, y):
    return (x @ y.T + (1 - x) @ (1 - y).T) / x.shape[1]


def jaccard(x, y):
    return _ratio(x @ y.T, x.shape[1] - (1 - x) @ (1 - y).T)


def extended_jaccard(x, y):
    xy = x @ y.T
    return _ratio(xy, (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - xy)


def cosine(x, y):
    return _ratio(x @ y.T, np.sqrt((x * x).sum(1))[:, None] * np.sqrt((y * y).sum(1))[None, :])


def correlation(x, y):
    x, y = x - x.mean(1, keepdims=True), y - y.mean(1, keepdims=True)
    return cosine(x, y)


MEASURES = {"smc": smc, "jac": jaccard, "ext": extended_jaccard, "cos": cosine, "cor": correlation, "sqe": squared_distances}


def similarity(xs: DataFrame, ys: DataFrame, method: str, id_col: str = "id", vec_col: str = "features") -> DataFrame:
    """Measure named by its first three letters, any case; SMC and Jaccard binarize each side first."""
    key = method[:3].lower()
    if key not in MEASURES:
        raise ValueError(f"unknown similarity {method!r}")
    if key in ("smc", "jac"):
        both = []
        for df in (xs, ys):
            one = df.limit(2).count() == 1
            both.append(binarize(df.select(id_col, vec_col), vec_col, single_row=one))
        xs, ys = both
    return similarity_matrix(xs, ys, MEASURES[key], id_col, vec_col)


def to_one(df: DataFrame, query_id: int, method: str, id_col: str = "id", vec_col: str = "features") -> DataFrame:
    """One object against all others: the query row alone is copied to the tasks."""
    query = df.filter(F.col(id_col) == query_id)
    others = df.filter(F.col(id_col) != query_id)
    return similarity(others, query, method, id_col, vec_col)


def most_and_least_similar(df: DataFrame, query_id: int, k: int, method: str, id_col: str = "id", vec_col: str = "features") -> DataFrame:
    return topk.most_and_least(to_one(df, query_id, method, id_col, vec_col), "sim", k, "x_id")


def _directions(df: DataFrame, method: str, id_col: str, vec_col: str) -> DataFrame:
    """Rows of length 1 (id, features), centred first for correlation; rows without a direction go."""
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))

    def scale(batches):
        for b, v in batches_to_matrices(batches, "v"):
            if method == "cor":
                v = v - v.mean(1, keepdims=True)
            norm = np.sqrt((v * v).sum(1))
            some = norm > 0
            ids = b.column("id").filter(pa.array(some))
            yield pa.RecordBatch.from_arrays([ids, from_matrix(v[some] / norm[some, None])], names=["id", "features"])

    return rows.mapInArrow(scale, f"id {kind}, features array<double>")


def _method(method: str) -> str:
    key = method[:3].lower()
    if key not in ("cos", "cor"):
        raise ValueError(f"{method!r} is not an angle; use similarity()")
    return key


def similar_pairs(
    xs: DataFrame, ys: DataFrame, threshold: float, method: str = "cos", id_col: str = "id", vec_col: str = "features"
) -> DataFrame:
    """Pairs (x_id, y_id, sim) whose cosine or correlation is at least ``threshold``; no others leave a task.

    Between rows of length 1 a similarity s is a distance of sqrt(2 - 2 s), so the join is one
    within a radius and skips what the triangle inequality rules out. Rows without a direction
    (zero, or constant for correlation) are similar to none. Two rows of one table and their
    mirror image are two pairs.
    """
    key = _method(method)
    x, y = (_directions(df, key, id_col, vec_col) for df in (xs, ys))
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-7)
    near = within_radius(x, y, radius, "id", "features")
    sim = 1 - F.col("distance") * F.col("distance") / 2
    found = near.select(F.col("query_id").alias("x_id"), F.col("neighbor_id").alias("y_id"), sim.alias("sim"))
    return found.filter(F.col("sim") >= threshold)


def most_similar(
    xs: DataFrame, ys: DataFrame, k: int, method: str = "cos", id_col: str = "id", vec_col: str = "features"
) -> DataFrame:
    """The ``k`` rows of ``ys`` of highest cosine or correlation for each of ``xs``: (x_id, rank, y_id, sim)."""
    key = _method(method)
    x, y = (_directions(df, key, id_col, vec_col) for df in (xs, ys))
    near = nearest_neighbours(x, y, k, "id", "features")
    sim = 1 - F.col("distance") * F.col("distance") / 2
    return near.select(F.col("query_id").alias("x_id"), "rank", F.col("neighbor_id").alias("y_id"), sim.alias("sim"))
