"""Logistic, forest and naive Bayes classifiers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.vectors import sum_by_slot, to_matrix
from quarry.operators.trees import bins_for, vectors


@dataclass
class Fitted:
    """A pyspark.ml classifier behind the (features array, label) convention."""

    model: object
    vec_col: str

    def transform(self, df: DataFrame) -> DataFrame:
        x = df.withColumn("__x", array_to_vector(F.col(self.vec_col).cast("array<double>")))
        out = self.model.transform(x)
        return out.withColumn("probability", vector_to_array("probability")).drop("__x", "rawPrediction")


def logistic(
    df: DataFrame,
    label: str = "label",
    vec_col: str = "features",
    c: float = 1.0,
    multinomial: bool = False,
    weight: str | None = None,
    max_iter: int = 100,
    n: int | None = None,
) -> Fitted:
    """Ridge-penalised logistic regression; ``c`` is the inverse penalty on the summed loss."""
    rows = n or df.count()
    lr = LogisticRegression(
        featuresCol="__x",
        labelCol="__y",
        regParam=1.0 / (c * rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=1e-8,
        family="multinomial" if multinomial else "auto",
    )
    if weight:
        lr = lr.setWeightCol(weight)
    return Fitted(lr.fit(vectors(df, vec_col, label)), vec_col)


def forest(
    df: DataFrame, label: str = "label", vec_col: str = "features", trees: int = 10, depth: int = 10, seed: int = 0, max_bins: int = 1_024
) -> Fitted:
    """Random forest; splits as exact as those of :func:`quarry.operators.trees.fit_tree`."""
    bins = bins_for(df, vec_col, max_bins)
    rf = RandomForestClassifier(featuresCol="__x", labelCol="__y", numTrees=trees, maxDepth=depth, seed=seed, maxBins=bins)
    return Fitted(rf.fit(vectors(df, vec_col, label)), vec_col)


@dataclass(frozen=True)
class ClassSums:
    """Per class: number of rows and feature sums. Everything multinomial naive Bayes needs."""

    labels: np.ndarray
    count: np.ndarray
    sums: np.ndarray

    def __sub__(self, other: ClassSums) -> ClassSums:
        return ClassSums(self.labels, self.count - other.count, self.sums - other.sums)


def class_sums(df: DataFrame, label: str, vec_col: str = "features", fold: str | None = None) -> dict[int, ClassSums]:
    """Class sums per fold in one aggregation (a single fold 0 without ``fold``)."""
    x = df.select(
        F.col(label).cast("double").alias("y"),
        (F.col(fold) if fold else F.lit(0)).alias("k"),
        array_to_vector(F.col(vec_col).cast("array<double>")).alias("x"),
    )
    rows = x.groupBy("k", "y").agg(F.count("*").alias("n"), Summarizer.sum(F.col("x")).alias("s")).collect()
    labels = np.array(sorted({r["y"] for r in rows}))
    where = {y: i for i, y in enumerate(labels)}
    m = len(rows[0]["s"])
    out = {}
    for r in rows:
        c = out.setdefault(r["k"], ClassSums(labels, np.zeros(len(labels)), np.zeros((len(labels), m))))
        c.count[where[r["y"]]] = r["n"]
        c.sums[where[r["y"]]] = r["s"].toArray()
    return out


@dataclass(frozen=True)
class MultinomialBayes:
    labels: np.ndarray
    log_prior: np.ndarray
    log_share: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return x @ self.log_share.T + self.log_prior

    def transform(self, df: DataFrame, vec_col: str = "features") -> DataFrame:
        model = self

        @F.pandas_udf("array<double>")
        def proba(v: pd.Series) -> pd.Series:
            if not len(v):
                return pd.Series([], dtype=object)
            s = model.scores(np.stack(v.to_numpy()).astype(float))
            p = np.exp(s - s.max(1, keepdims=True))
            return pd.Series(list(p / p.sum(1, keepdims=True)))

        top = F.array_position("probability", F.array_max("probability"))
        labels = F.array(*[F.lit(float(y)) for y in self.labels])
        out = df.withColumn("probability", proba(F.col(vec_col).cast("array<double>")))
        return out.withColumn("prediction", F.get(labels, (top - 1).cast("int")))


FLOOR = 1e-10  # smallest smoothing: keeps log(0) out when alpha is 0


def bayes_from(sums: ClassSums, alpha: float = 1.0, priors: Sequence[float] | None = None, uniform: bool = False) -> MultinomialBayes:
    """Class priors are estimated, uniform, or given (in label order)."""
    a = max(alpha, FLOOR)
    share = sums.sums + a
    share = share / share.sum(1, keepdims=True)
    if priors is not None:
        p = np.asarray(priors, float)
    elif uniform:
        p = np.full(len(sums.labels), 1 / len(sums.labels))
    else:
        p = sums.count / sums.count.sum()
    with np.errstate(divide="ignore"):
        return MultinomialBayes(sums.labels, np.log(p), np.log(share))


def naive_bayes(
    df: DataFrame, label: str = "label", vec_col: str = "features", alpha: float = 1.0, priors: Sequence[float] | None = None
) -> MultinomialBayes:
    return bayes_from(class_sums(df, label, vec_col)[0], alpha, priors)


def bayes_sweep(
    df: DataFrame,
    alphas: Sequence[float],
    label: str = "label",
    vec_col: str = "features",
    fold: str = "fold",
    priors: Sequence[float] | None = None,
) -> DataFrame:
    """(alpha, fold, split, error, n) for all folds and smoothings: one scan to fit, one to score.

    ``priors``, in label order, replace the shares of the training part.
    """
    per = class_sums(df, label, vec_col, fold)
    labels = next(iter(per.values())).labels
    every = ClassSums(labels, sum(c.count for c in per.values()), sum(c.sums for c in per.values()))
    folds = sorted(per)
    models = []
    for k in folds:
        tr = every - per[k]
        for a in alphas:
            models.append(bayes_from(tr, a, priors))
    slim = df.select(F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("k"), F.col(vec_col).cast("array<double>").alias("x"))

    def kernel(batches):
        wrong = np.zeros((len(models), 2))
        rows = np.zeros((len(folds), 2))
        for b in batches:
            if not b.num_rows:
                continue
            x, y, k = to_matrix(b.column("x")), b.column("y").to_numpy(), b.column("k").to_numpy()
            for i, f in enumerate(folds):
                rows[i] += [(k != f).sum(), (k == f).sum()]
                for j in range(len(alphas)):
                    m = models[i * len(alphas) + j]
                    miss = m.labels[m.scores(x).argmax(1)] != y
                    wrong[i * len(alphas) + j] += [miss[k != f].sum(), miss[k == f].sum()]
        yield 0, np.concatenate([wrong.ravel(), rows.ravel()])

    v = sum_by_slot(slim, kernel)[0]
    wrong = v[: 2 * len(models)].reshape(len(folds), len(alphas), 2)
    rows = v[2 * len(models) :].reshape(len(folds), 2)
    out = [
        (float(a), int(f), s, float(wrong[i, j, t] / rows[i, t]), int(rows[i, t]))
        for i, f in enumerate(folds)
        for j, a in enumerate(alphas)
        for t, s in enumerate(("train", "test"))
        if rows[i, t]
    ]
    return df.sparkSession.createDataFrame(out, "alpha double, fold int, split string, error double, n long")
