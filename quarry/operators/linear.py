"""Least squares, ridge and forward selection on Gram statistics; mean baselines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.gram import Gram, gram, pooled


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum-norm solution: one-hot groups make collinear columns."""
    return np.linalg.lstsq(a, b, rcond=1e-12)[0]


@dataclass(frozen=True)
class LinearFit:
    features: tuple[str, ...]
    coef: np.ndarray
    intercept: float

    def table(self, spark) -> DataFrame:
        rows = [("intercept", float(self.intercept))]
        rows += [(f, float(c)) for f, c in zip(self.features, self.coef)]
        return spark.createDataFrame(rows, "feature string, coef double")

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        est = F.lit(float(self.intercept))
        for f, c in zip(self.features, self.coef):
            est = est + F.col(f) * F.lit(float(c))
        return df.withColumn(out, est)


def _ols(g: Gram) -> np.ndarray:
    """Coefficient vector v with v . [1, X, y] = y - estimate, in shifted coordinates."""
    s = g.scatter()
    w = _solve(s[:-1, :-1], s[:-1, -1]) if len(s) > 1 else np.zeros(0)
    m = g.g[0, 1:] / g.n
    b = m[-1] - w @ m[:-1]
    return np.concatenate([[-b], -w, [1.0]])


def _mse(v: np.ndarray, g: Gram) -> float:
    return max(0.0, float(v @ g.g @ v)) / g.n


def ols(df: DataFrame, features: Sequence[str], target: str) -> LinearFit:
    g = pooled(gram(df, [*features, target]))
    s = g.scatter()
    w = _solve(s[:-1, :-1], s[:-1, -1])
    m = g.mean()
    return LinearFit(tuple(features), w, float(m[-1] - w @ m[:-1]))


def residuals(df: DataFrame, fit: LinearFit, target: str, keep: Sequence[str] = ()) -> DataFrame:
    """Residual (observed minus estimated) against each attribute, in long form."""
    r = fit.transform(df).withColumn("residual", F.col(target) - F.col("prediction"))
    wide = r.select(*keep, "residual", *[F.col(f).cast("double").alias(f) for f in fit.features])
    return wide.unpivot([*keep, "residual"], list(fit.features), "attribute", "value")


def cv_error(folds: dict[int, Gram], cols: Sequence[int]) -> float:
    """Mean over folds of the test MSE of least squares on ``cols``; y is the last column."""
    y = len(pooled(folds).names) - 1
    parts = {k: g.pick([*cols, y]) for k, g in folds.items()}
    every = pooled(parts)
    return float(np.mean([_mse(_ols(every - g), g) for g in parts.values()]))


def validate_ols(df: DataFrame, features: Sequence[str], target: str, fold: str = "fold") -> float:
    return cv_error(gram(df, [*features, target], fold), range(len(features)))


@dataclass
class Selection:
    selected: list[int]
    steps: list[int]
    loss: list[float]


def select_forward(folds: dict[int, Gram]) -> Selection:
    """Add the feature with the smallest cross-validated loss while it strictly falls."""
    every = pooled(folds)
    m = len(every.names) - 1
    loss = [float(every.scatter()[-1, -1] / every.n)]
    steps: list[int] = []
    while True:
        trials = [(cv_error(folds, [*steps, f]), f) for f in range(m) if f not in steps]
        best = min(trials, default=(np.inf, -1))
        if not best[0] < loss[-1]:
            return Selection(sorted(steps), steps, loss)
        steps.append(best[1])
        loss.append(best[0])


def forward_selection(
    df: DataFrame, features: Sequence[str], target: str, outer: str, inner: str, inner_folds: int
) -> DataFrame:
    """Nested selection from one scan: (fold, model, selected features and errors).

    The scan groups by the pair (outer, inner); training sets are sums of cells.
    """
    cells = gram(df.withColumn("__cell", F.col(outer) * inner_folds + F.col(inner)), [*features, target], "__cell")
    rows = []
    for k in sorted({c // inner_folds for c in cells}):
        train = {c: g for c, g in cells.items() if c // inner_folds != k}
        inside: dict[int, Gram] = {}
        for c, g in train.items():
            i = c % inner_folds
            inside[i] = inside[i] + g if i in inside else g
        tr = pooled(train)
        te = pooled({c: g for c, g in cells.items() if c // inner_folds == k})
        sel = select_forward(inside)
        y = len(features)
        for model, cols in (("none", []), ("all", list(range(y))), ("selected", sel.steps)):
            a, b = tr.pick([*cols, y]), te.pick([*cols, y])
            if model == "none":
                # the no-feature error of each part is taken around that part's own mean
                e_tr, e_te = (float(p.scatter()[-1, -1] / p.n) for p in (a, b))
            else:
                v = _ols(a)
                e_tr, e_te = _mse(v, a), _mse(v, b)
            rows.append((k, model, [features[c] for c in cols], e_tr, e_te))
    return df.sparkSession.createDataFrame(
        rows, "fold int, model string, features array<string>, train_mse double, test_mse double"
    )


def selection_matrix(result: DataFrame, features: Sequence[str]) -> DataFrame:
    """Attribute x fold matrix of selected features in long form, with the step."""
    chosen = result.filter("model = 'selected'").select("fold", "features")
    every = chosen.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features])))
    step = F.array_position("features", F.col("feature")).cast("int")
    return every.select("fold", "feature", (step > 0).alias("selected"), step.alias("step"))


def _ridge(raw: np.ndarray, lam: float) -> np.ndarray:
    a = raw[:-1, :-1]
    return _solve(a + lam * np.eye(len(a)), raw[:-1, -1])


def ridge(df: DataFrame, features: Sequence[str], target: str, lam: float) -> LinearFit:
    """Normal equations on [1, X]; the offset is penalised like every other weight."""
    raw = pooled(gram(df, [*features, target])).raw()
    w = _ridge(raw, lam)
    return LinearFit(tuple(features), w[1:], float(w[0]))


@dataclass
class RidgePath:
    best_lambda: float
    best_error: float
    errors: DataFrame
    weights: DataFrame


def ridge_path(
    df: DataFrame, features: Sequence[str], target: str, lambdas: Sequence[float], fold: str = "fold"
) -> RidgePath:
    """Train and test error per (lambda, fold) and mean weights, from one scan."""
    spark = df.sparkSession
    folds = {k: g.raw() for k, g in gram(df, [*features, target], fold).items()}
    every = sum(folds.values())
    errs, weights, mean_test = [], [], []
    for lam in lambdas:
        ws, tests = [], []
        for k, te in folds.items():
            tr = every - te
            w = _ridge(tr, lam)
            v = np.concatenate([-w, [1.0]])
            e = [max(0.0, float(v @ m @ v)) / float(m[0, 0]) for m in (tr, te)]
            ws.append(w)
            tests.append(e[1])
            errs.append((float(lam), int(k), e[0], e[1]))
        mean_test.append(float(np.mean(tests)))
        for name, x in zip(["offset", *features], np.mean(ws, axis=0)):
            weights.append((float(lam), name, float(x)))
    i = int(np.argmin(mean_test))
    return RidgePath(
        float(lambdas[i]),
        mean_test[i],
        spark.createDataFrame(errs, "lambda double, fold int, train_mse double, test_mse double"),
        spark.createDataFrame(weights, "lambda double, feature string, weight double"),
    )


def mean_baseline(df: DataFrame, target: str, fold: str = "fold") -> DataFrame:
    """Per fold: error of the training mean on the test part, and each part's own no-feature error."""
    g = gram(df, [target], fold)
    every = pooled(g)
    rows = []
    for k, te in g.items():
        tr = every - te
        gap = tr.mean()[0] - te.mean()[0]
        own = te.scatter()[0, 0] / te.n
        rows.append((k, float(tr.mean()[0]), float(own + gap * gap), float(tr.scatter()[0, 0] / tr.n), float(own)))
    return df.sparkSession.createDataFrame(
        rows, "fold int, train_mean double, mse_of_train_mean double, train_var double, test_var double"
    )
