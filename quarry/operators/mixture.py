"""Gaussian mixtures by EM on sufficient statistics.

Models of every component count, fold and restart are updated in the same pass:
a task returns, per model, responsibilities' sums, weighted sums and weighted
cross products, which add up over partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.vectors import batches_to_matrices, sum_by_slot
from quarry.operators.pairs import extent, squared_distances
from quarry.session import cut_lineage, spread_small

RIDGE = 1e-6  # added to every variance, so that no component collapses


@dataclass
class Mixture:
    weights: np.ndarray
    means: np.ndarray
    covs: np.ndarray  # (k, m, m) full, (k, m) diagonal
    diagonal: bool
    fold: int = -1
    restart: int = 0
    loglik: float = -np.inf
    rows: int = 0
    passes: int = 0

    @property
    def k(self) -> int:
        return len(self.weights)

    @property
    def parameters(self) -> int:
        m = self.means.shape[1]
        spread = m if self.diagonal else m * (m + 1) // 2
        return self.k * spread + self.k * m + self.k - 1

    @cached_property
    def prepared(self) -> tuple[np.ndarray, list]:
        """Log weights and, per full covariance, the inverse of its root and its log determinant."""
        with np.errstate(divide="ignore"):
            lw = np.log(self.weights)
        if self.diagonal:
            return lw, []
        lows = [np.linalg.cholesky(c) for c in self.covs]
        return lw, [(np.linalg.inv(low), 2 * np.log(np.diag(low)).sum()) for low in lows]

    def joint(self, x: np.ndarray) -> np.ndarray:
        """log(weight) + log density, per row and component."""
        m = x.shape[1]
        out = np.empty((len(x), self.k))
        lw, factors = self.prepared
        for j in range(self.k):
            d = x - self.means[j]
            if self.diagonal:
                quad = (d * d / self.covs[j]).sum(1)
                logdet = np.log(self.covs[j]).sum()
            else:
                inverse, logdet = factors[j]
                z = d @ inverse.T
                quad = (z * z).sum(1)
            out[:, j] = lw[j] - 0.5 * (m * np.log(2 * np.pi) + logdet + quad)
        return out

    def loglik_rows(self, x: np.ndarray) -> np.ndarray:
        j = self.joint(x)
        top = j.max(1)
        return top + np.log(np.exp(j - top[:, None]).sum(1))

    def table(self, spark) -> DataFrame:
        """(component, weight, mean, covariance): the sink's form; covariances row by row."""
        rows = [
            (j, float(self.weights[j]), [float(v) for v in self.means[j]], [float(v) for v in np.ravel(self.covs[j])])
            for j in range(self.k)
        ]
        return spark.createDataFrame(rows, "component int, weight double, mean array<double>, covariance array<double>")

    def score(self, df: DataFrame, id_col: str = "id", vec_col: str = "features") -> DataFrame:
        """(id, cluster, log_density, responsibilities) of every row."""
        model = self

        def run(batches):
            for b, v in batches_to_matrices(batches, "v"):
                j = model.joint(v)
                top = j.max(1)
                ll = top + np.log(np.exp(j - top[:, None]).sum(1))
                r = np.exp(j - ll[:, None])
                off = np.arange(0, r.size + 1, r.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(j.argmax(1).astype(np.int32)), pa.array(ll), pa.ListArray.from_arrays(pa.array(off), pa.array(r.ravel()))],
                    names=["id", "cluster", "log_density", "responsibilities"],
                )

        slim = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
        return slim.mapInArrow(run, "id long, cluster int, log_density double, responsibilities array<double>").withColumnRenamed("id", id_col)


def _uniform(ids: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) per id: the finaliser of splitmix64 as a hash."""
    with np.errstate(over="ignore"):
        z = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)


def _spread_seeds(slim: DataFrame, starts: Sequence[tuple[int, int]], most: int, seed: int) -> dict[tuple[int, int], np.ndarray]:
    """``most`` rows per (fold, restart), each drawn with odds as its squared distance from those before.

    All rows take part. Among exponential times with the distances as rates the earliest is
    such a draw, so a pass needs one row per task and start, and one pass adds a seed to
    every start. The first k seeds serve every model of k components.
    """
    seeds: dict[tuple[int, int], list[np.ndarray]] = {s: [] for s in starts}
    for step in range(most):
        held = {s: np.array(v) for s, v in seeds.items()}

        def draw(batches, held=held, step=step):
            best: dict[int, tuple] = {}
            for b, v in batches_to_matrices(batches, "v"):
                ids, at = b.column("id").to_numpy(), b.column("f").to_numpy()
                for slot, (f, r) in enumerate(starts):
                    rows = np.flatnonzero(at != f)
                    if not len(rows):
                        continue
                    u = _uniform(ids[rows], hash((seed, f + 1, r, step)))
                    with np.errstate(divide="ignore"):
                        far = squared_distances(v[rows], held[f, r]).min(1) if step else 1.0
                        time = -np.log(u) / far
                    i = int(np.lexsort((ids[rows], time))[0])
                    found = (float(time[i]), int(ids[rows][i]), v[rows][i])
                    if slot not in best or found[:2] < best[slot][:2]:
                        best[slot] = found
            for slot, (t, i, x) in best.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([slot], pa.int32()), pa.array([t]), pa.array([i], pa.int64()), pa.array([x.tolist()], pa.list_(pa.float64()))],
                    names=["slot", "t", "id", "v"],
                )

        found = slim.mapInArrow(draw, "slot int, t double, id long, v array<double>")
        for row in found.groupBy("slot").agg(F.min(F.struct("t", "id", "v")).alias("b")).collect():
            seeds[starts[row["slot"]]].append(np.array(row["b"]["v"]))
    return {s: np.array(v) for s, v in seeds.items()}


def _step(model: Mixture, stats: np.ndarray, m: int) -> Mixture:
    k = model.k
    n, ll = stats[0], stats[1]
    nk = stats[2 : 2 + k]
    s1 = stats[2 + k : 2 + k + k * m].reshape(k, m)
    s2 = stats[2 + k + k * m :]
    safe = np.maximum(nk, 1e-10)
    means = s1 / safe[:, None]
    # sums are taken around the current means, which keeps the subtraction small
    if model.diagonal:
        covs = np.maximum(s2.reshape(k, m) / safe[:, None] - means**2, 0) + RIDGE
    else:
        covs = s2.reshape(k, m, m) / safe[:, None, None] - means[:, :, None] * means[:, None, :]
        covs = covs + RIDGE * np.eye(m)
    return Mixture(
        nk / n, model.means + means, covs, model.diagonal, model.fold, model.restart, ll / n, int(n), model.passes + 1
    )


def fit_mixtures(
    df: DataFrame,
    ks: Sequence[int],
    id_col: str = "id",
    vec_col: str = "features",
    diagonal: bool = False,
    restarts: int = 1,
    folds: Sequence[int] = (-1,),
    fold: str | None = None,
    tol: float = 1e-3,
    max_iter: int = 100,
    seed: int = 0,
) -> dict[tuple[int, int], Mixture]:
    """Best restart per (k, fold); fold -1 means all rows, fold f the rows outside f."""
    cols = [F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")]
    slim = df.select(*cols, (F.col(fold).cast("int") if fold else F.lit(0)).alias("f"))
    rows, m = extent(slim)
    work = 4 * m * (2 if diagonal else m) * sum(ks) * len(folds) * restarts
    # read once per pass: the short plan of written rows, cached where memory allows
    slim = cut_lineage(spread_small(slim, rows, m, work), "mixture").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        starts = [(f, r) for f in folds for r in range(restarts)]
        seeds = _spread_seeds(slim, starts, max(ks), seed)
        spread = slim.agg(Summarizer.variance(array_to_vector(F.col("v")))).first()[0].toArray()
        var = spread * max(rows - 1, 0) / max(rows, 1) + RIDGE
        models = []
        for k in ks:
            covs = np.tile(var, (k, 1)) if diagonal else np.tile(np.diag(var), (k, 1, 1))
            models += [Mixture(np.full(k, 1 / k), seeds[f, r][:k], covs, diagonal, f, r) for f, r in starts]
        live = list(range(len(models)))
        for _ in range(max_iter):
            points = [(i, models[i]) for i in live]

            def kernel(batches, points=points):
                acc = {}
                for b, v in batches_to_matrices(batches, "v"):
                    at = b.column("f").to_numpy()
                    for i, g in points:
                        x = v[at != g.fold]
                        if not len(x):
                            continue
                        j = g.joint(x)
                        top = j.max(1)
                        ll = top + np.log(np.exp(j - top[:, None]).sum(1))
                        r = np.exp(j - ll[:, None])
                        s1, s2 = [], []
                        for c in range(g.k):
                            d = x - g.means[c]
                            s1.append(r[:, c] @ d)
                            s2.append(r[:, c] @ (d * d) if g.diagonal else (d * r[:, c : c + 1]).T @ d)
                        part = np.concatenate([[len(x), ll.sum()], r.sum(0), np.ravel(s1), np.ravel(s2)])
                        acc[i] = acc.get(i, 0) + part
                yield from acc.items()

            sums = sum_by_slot(slim, kernel)
            still = []
            for i in live:
                before = models[i].loglik
                models[i] = _step(models[i], sums[i], m)
                if abs(models[i].loglik - before) >= tol:
                    still.append(i)
            live = still
            if not live:
                break
    finally:
        slim.unpersist()
    best: dict[tuple[int, int], Mixture] = {}
    for g in models:
        key = (g.k, g.fold)
        if key not in best or g.loglik > best[key].loglik:
            best[key] = g
    return best


def log_likelihoods(
    df: DataFrame, models: Sequence[Mixture], vec_col: str = "features", fold: str | None = None
) -> list[tuple[int, float]]:
    """(rows, summed log-likelihood) per model in one pass; model f is scored on fold f only."""
    models = list(models)
    slim = df.select(F.col(vec_col).cast("array<double>").alias("v"), (F.col(fold).cast("int") if fold else F.lit(-1)).alias("f"))

    def kernel(batches):
        acc = np.zeros((len(models), 2))
        for b, v in batches_to_matrices(batches, "v"):
            at = b.column("f").to_numpy()
            for i, g in enumerate(models):
                x = v if g.fold == -1 else v[at == g.fold]
                if len(x):
                    acc[i] += [len(x), g.loglik_rows(x).sum()]
        yield 0, acc.ravel()

    out = sum_by_slot(slim, kernel)[0].reshape(-1, 2)
    return [(int(n), float(ll)) for n, ll in out]


def select_components(
    df: DataFrame,
    ks: Sequence[int],
    folds: int,
    id_col: str = "id",
    vec_col: str = "features",
    fold: str = "fold",
    diagonal: bool = False,
    restarts: int = 1,
    seed: int = 0,
    max_iter: int = 100,
) -> DataFrame:
    """(k, bic, aic, cve): information criteria and held-out negative log-likelihood times 2."""
    models = fit_mixtures(
        df, ks, id_col, vec_col, diagonal, restarts, [-1, *range(folds)], fold, max_iter=max_iter, seed=seed
    )
    order = list(models.values())
    scored = dict(zip(models, log_likelihoods(df, order, vec_col, fold)))
    rows = []
    for k in ks:
        n, ll = scored[(k, -1)]
        p = models[(k, -1)].parameters
        held = -sum(scored[(k, f)][1] for f in range(folds))
        rows.append((k, float(p * np.log(n) - 2 * ll), float(2 * p - 2 * ll), float(2 * held)))
    return df.sparkSession.createDataFrame(rows, "k int, bic double, aic double, cve double")


def out_of_fold_clusters(
    df: DataFrame, k: int, folds: int, id_col: str = "id", vec_col: str = "features", fold: str = "fold",
    diagonal: bool = False, restarts: int = 1, seed: int = 0, max_iter: int = 100,
) -> DataFrame:
    """(id, cluster): each row assigned by the fit that left its fold out.

    Component numbers of different fits are brought in line with the fit on all
    rows by matching nearest means.
    """
    models = fit_mixtures(df, [k], id_col, vec_col, diagonal, restarts, [-1, *range(folds)], fold, max_iter=max_iter, seed=seed)
    whole = models[(k, -1)]
    names = {}
    for f in range(folds):
        d = squared_distances(models[(k, f)].means, whole.means)
        names[f] = np.zeros(k, int)
        for _ in range(k):
            i, j = divmod(int(d.argmin()), k)
            names[f][i] = j
            d[i, :] = d[:, j] = np.inf
    slim = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), F.col(fold).cast("int").alias("f"))

    def run(batches):
        for b, v in batches_to_matrices(batches, "v"):
            at = b.column("f").to_numpy()
            out = np.zeros(len(v), np.int32)
            for f in range(folds):
                rows = at == f
                if rows.any():
                    out[rows] = names[f][models[(k, f)].joint(v[rows]).argmax(1)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(out)], names=["id", "cluster"])

    return slim.mapInArrow(run, "id long, cluster int").withColumnRenamed("id", id_col)
