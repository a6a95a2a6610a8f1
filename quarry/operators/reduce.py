"""Principal components from Gram statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.vectors import batches_to_matrices, dot, from_matrix, let, sum_by_slot
from quarry.operators.describe import cumulative
from quarry.operators.gram import gram, pooled
from quarry.operators.neighbours import classify_sweep
from quarry.session import cut_lineage, spread


WIDE = 512  # columns beyond which rows are projected by a matrix product


def _array(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


@dataclass(frozen=True)
class Components:
    """Column mean, loadings (one column per component) and variances, largest first."""

    mean: np.ndarray
    loadings: np.ndarray
    variance: np.ndarray
    total: float | None = None  # of all components, where only the first are kept

    def ratio(self, spark) -> DataFrame:
        """(pc, ratio, cumulative)."""
        r = self.variance / (self.variance.sum() if self.total is None else self.total)
        df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(r)], "pc int, ratio double")
        return cumulative(df, "pc", "ratio", "cumulative")

    def table(self, spark, names: Sequence[str]) -> DataFrame:
        rows = [(n, k, float(self.loadings[i, k])) for i, n in enumerate(names) for k in range(self.loadings.shape[1])]
        return spark.createDataFrame(rows, "feature string, pc int, loading double")

    def project(self, df: DataFrame, k: int, vec_col: str = "features", out: str = "scores") -> DataFrame:
        """Centre by the fitted mean, then the first k coordinates; for training or new rows."""
        if len(self.mean) > WIDE:
            return self.project_wide(df, k, vec_col, out)
        return df.withColumn(out, let(self._centred(vec_col), lambda x: self._scores(x, k)))

    def project_wide(self, df: DataFrame, k: int, vec_col: str = "features", out: str = "scores") -> DataFrame:
        """The loadings as one matrix per task rather than as expressions."""
        shared = df.sparkSession.sparkContext.broadcast((self.mean, self.loadings[:, :k]))
        rest = df.drop(out).withColumn(vec_col, F.col(vec_col).cast("array<double>"))
        schema = T.StructType([*rest.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])

        def scores(batches):
            mean, loadings = shared.value
            for b, v in batches_to_matrices(batches, vec_col):
                yield pa.RecordBatch.from_arrays([*b.columns, from_matrix((v - mean) @ loadings)], names=schema.names)

        return rest.mapInArrow(scores, schema)

    def _centred(self, vec_col: str) -> Column:
        return F.zip_with(F.col(vec_col).cast("array<double>"), _array(self.mean), lambda x, m: x - m)

    def _scores(self, centred: Column, k: int) -> Column:
        return F.array(*[dot(centred, _array(self.loadings[:, j])) for j in range(k)])

    def reconstruct(self, df: DataFrame, k: int, vec_col: str = "features", out: str = "rebuilt") -> DataFrame:
        def rebuilt(s: Column) -> Column:
            return F.array(*[dot(s, _array(self.loadings[i, :k])) + F.lit(float(m)) for i, m in enumerate(self.mean)])

        scores = let(self._centred(vec_col), lambda x: self._scores(x, k))
        return df.withColumn(out, let(scores, rebuilt))


def fit_components(df: DataFrame, cols: Sequence[str] = (), vec_col: str | None = None) -> Components:
    """All components of the centred matrix; each one's largest loading is positive."""
    g = pooled(gram(df, cols, vec_col=vec_col))
    values, vectors = np.linalg.eigh(g.scatter())
    order = np.argsort(values)[::-1]
    v = vectors[:, order]
    sign = np.sign(v[np.abs(v).argmax(0), np.arange(v.shape[1])])
    return Components(g.mean(), v * sign, np.maximum(values[order], 0))


def fit_leading(
    df: DataFrame, k: int, vec_col: str = "features", oversample: int = 10, passes: int = 6, seed: int = 0
) -> Components:
    """The first ``k`` components of a matrix of any width, by randomised subspace iteration.

    A block of k + ``oversample`` random directions is multiplied by the scatter matrix
    ``passes`` times, each time made orthogonal, and the scatter inside the block is solved at
    the end. The scatter matrix itself is never formed: a task holds one batch of rows and two
    blocks (columns times k + oversample), the driver a block and its decomposition. With as
    many directions as columns the result is exact; otherwise a component's error falls with
    the power 2 * ``passes`` of the ratio of the variances left out to its own.
    """
    x = df.select(F.col(vec_col).cast("array<double>").alias("v"))
    row = x.agg(F.count("*").alias("n"), Summarizer.mean(array_to_vector("v")).alias("m")).first()
    if not row["n"]:
        raise ValueError("empty table")
    mean = row["m"].toArray()
    width = len(mean)
    size = min(width, k + oversample)
    block, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, size)))

    def multiplied(block: np.ndarray) -> tuple[np.ndarray, float]:
        shared = df.sparkSession.sparkContext.broadcast((mean, block))

        def kernel(batches):
            mean, block = shared.value
            held = None
            for b, v in batches_to_matrices(batches, "v"):
                if len(v):
                    v = v - mean
                    part = np.append((v.T @ (v @ block)).ravel(), (v * v).sum())
                    held = part if held is None else held + part
            if held is not None:
                yield 0, held

        flat = sum_by_slot(x, kernel)[0]
        shared.unpersist()
        return flat[:-1].reshape(width, size), float(flat[-1])

    for _ in range(passes):
        image, total = multiplied(block)
        block, _ = np.linalg.qr(image)
    image, total = multiplied(block)
    inner = block.T @ image
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    order = np.argsort(values)[::-1][:k]
    v = block @ vectors[:, order]
    sign = np.sign(v[np.abs(v).argmax(0), np.arange(v.shape[1])])
    return Components(mean, v * sign, np.maximum(values[order], 0), total)


def class_on_component(df: DataFrame, pca: Components, label: str, value, pc: int, vec_col: str = "features") -> DataFrame:
    one = pca.project(df.filter(F.col(label) == value), pc + 1, vec_col)
    return one.withColumn("score", F.get("scores", F.lit(pc))).drop("scores", vec_col)


def reconstruction_error(df: DataFrame, pca: Components, ks: Sequence[int], vec_col: str = "features") -> DataFrame:
    """Mean squared residual per k, all k in one pass over the rows.

    The residual of an orthogonal projection is what the kept scores leave of the
    centred row's squared length.
    """
    full = pca.project(df, pca.loadings.shape[1], vec_col, "__s")
    left = [
        F.avg(F.aggregate(F.slice("__s", k + 1, pca.loadings.shape[1]), F.lit(0.0), lambda a, s: a + s * s)).alias(f"k{k}")
        for k in ks
    ]
    wide = full.agg(*left)
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("mse")) for k in ks]))
    return wide.select(rows.alias("r")).select("r.*")


def sweep_components(
    train: DataFrame, test: DataFrame, ks: Sequence[int], label: str, id_col: str, vec_col: str = "features"
) -> DataFrame:
    """Test error of 1-nearest-neighbour on the first k components: one fit, one projection."""
    pca = fit_components(train.select(vec_col), vec_col=vec_col)
    top = max(ks)
    # projected once, by matrix products, searched once per k
    a, b = (cut_lineage(pca.project_wide(spread(x), top, vec_col).drop(vec_col), "scores") for x in (train, test))
    out = None
    for k in ks:
        cut = F.slice("scores", 1, k)
        err = classify_sweep(
            a.withColumn("features", cut), b.withColumn("features", cut), [1], label, id_col
        ).select(F.lit(k).alias("k"), "error")
        out = err if out is None else out.unionByName(err)
    return out
