"""Kernel and neighbour densities, bandwidth choice and outlier scores."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.vectors import sum_by_slot
from quarry.operators.pairs import kernel_sums, nearest_neighbours
from quarry.operators.topk import best_row
from quarry.session import cut_lineage


def kernel_density(
    df: DataFrame, widths: Sequence[float], id_col: str = "id", vec_col: str = "features", leave_one_out: bool = True
) -> DataFrame:
    """(id, width, density, log_density) of a Gaussian kernel with variance ``width``."""
    sums, n, m = kernel_sums(df, widths, id_col, vec_col, skip_self=leave_one_out)
    others = n - 1 if leave_one_out else n
    spec = F.array(*[F.struct(F.lit(float(w)).alias("width"), F.lit(i).alias("i")) for i, w in enumerate(widths)])
    x = sums.withColumn("w", F.explode(spec)).select(
        F.col("id").alias(id_col),
        "w.width",
        F.get("shift", F.col("w.i")).alias("shift"),
        F.get("total", F.col("w.i")).alias("total"),
    )
    log_norm = F.lit(-math.log(others) if others else None) - F.lit(m / 2) * F.log(F.lit(2 * math.pi) * F.col("width"))
    log_density = log_norm + F.col("shift") + F.log("total")
    return x.select(id_col, "width", F.exp(log_density).alias("density"), log_density.alias("log_density"))


def candidate_widths(df: DataFrame, vec_col: str = "features", powers: Sequence[int] = range(-10, 3)) -> list[float]:
    """Largest population variance of a column times powers of two."""
    r = df.select(F.col(vec_col).cast("array<double>").alias("v")).agg(
        Summarizer.variance(array_to_vector(F.col("v"))).alias("v"), F.count("*").alias("n")
    ).first()
    top = float(r["v"].toArray().max()) * (r["n"] - 1) / r["n"]
    return [top * 2.0**p for p in powers]


def bandwidth_scores(df: DataFrame, widths: Sequence[float], id_col: str = "id", vec_col: str = "features") -> DataFrame:
    """Leave-one-out log-likelihood per width."""
    return kernel_density(df, widths, id_col, vec_col).groupBy("width").agg(F.sum("log_density").alias("log_likelihood"))


def best_bandwidth(scores: DataFrame) -> DataFrame:
    return best_row(scores, "log_likelihood", "width", largest=True)


def scott_bandwidth(df: DataFrame, col: str) -> float:
    n, sd = df.agg(F.count(col), F.stddev_samp(col)).first()
    return n ** (-0.2) * sd


def density_on_grid(df: DataFrame, col: str, grid: Sequence[float]) -> DataFrame:
    """One-dimensional Gaussian density at given points, Scott's bandwidth; one pass of partial sums."""
    h = scott_bandwidth(df, col)
    g = np.asarray(list(grid), dtype=float)

    def kernel(batches):
        acc, n = np.zeros(len(g)), 0
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False)
            for a in range(0, len(x), 10_000):
                z = (g[None, :] - x[a : a + 10_000, None]) / h
                acc += np.exp(-0.5 * z * z).sum(0)
            n += len(x)
        yield 0, np.concatenate([[n], acc])

    v = sum_by_slot(df.select(F.col(col).cast("double")).filter(F.col(col).isNotNull()), kernel)[0]
    dens = v[1:] / (v[0] * h * math.sqrt(2 * math.pi))
    return df.sparkSession.createDataFrame([(float(p), float(y)) for p, y in zip(g, dens)], "x double, density double")


def density_at_points(df: DataFrame, col: str, id_col: str) -> DataFrame:
    """The same density at the data points themselves, each point included."""
    h = scott_bandwidth(df, col)
    x = df.select(id_col, F.array(F.col(col).cast("double")).alias("features"))
    return kernel_density(x, [h * h], id_col, leave_one_out=False).select(id_col, "density")


def neighbour_density(nn: DataFrame, k: int) -> DataFrame:
    """1 / mean distance to the k neighbours, or to all where there are fewer."""
    d = nn.filter(F.col("rank") <= k).groupBy("query_id").agg(F.sum("distance").alias("s"), F.count("*").alias("n"))
    return d.select(
        F.col("query_id").alias("id"),
        F.when(F.col("s") > 0, F.col("n") / F.col("s")).otherwise(F.lit(math.inf)).alias("density"),
    )


def relative_density(nn: DataFrame, k: int, divisor: int | None = None, reference: DataFrame | None = None) -> DataFrame:
    """Density over the mean density of neighbours 2..k; the sum is divided by ``divisor`` (default k).

    Null where no such neighbour exists, as for k = 1. The neighbour table is read several
    times: a lazy one is written first.
    """
    nn = cut_lineage(nn, "neighbours")
    own = neighbour_density(nn, k)
    ref = own if reference is None else reference
    around = (
        nn.filter((F.col("rank") >= 2) & (F.col("rank") <= k))
        .select("query_id", F.col("neighbor_id").alias("id"))
        .join(ref, "id")
        .groupBy("query_id")
        .agg(F.sum("density").alias("around"))
    )
    ratio = F.try_divide("density", F.col("around") / F.lit(float(divisor or k)))
    return own.join(around.withColumnRenamed("query_id", "id"), "id", "left").select(
        "id", "density", ratio.alias("relative_density")
    )


def kth_distance(nn: DataFrame, k: int) -> DataFrame:
    return nn.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("distance").alias("score"))


def self_neighbours(df: DataFrame, k: int, id_col: str = "id", vec_col: str = "features") -> DataFrame:
    return nearest_neighbours(df, df, k, id_col, vec_col)
