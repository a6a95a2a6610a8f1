"""Voting ensembles: bagging and boosting of logistic regressions."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.vectors import dot
from quarry.operators.classify import Fitted, logistic
from quarry.operators.folds import poisson_copies, poisson_weights
from quarry.session import cut_lineage

WRITE_EVERY = 5


class VotingEnsemble:
    """Members are anything with ``transform`` that adds ``prediction``; weights default to 1/n.

    Estimates above 1 count as 1. ``prediction`` = weighted votes above one half;
    ``probability`` = 1 - weighted votes, the share of class 0.
    """

    def __init__(self, members: Sequence, alpha: Sequence[float] | None = None):
        self.members = list(members)
        self.alpha = [1 / len(self.members)] * len(self.members) if alpha is None else [float(a) for a in alpha]

    def votes(self, df: DataFrame) -> DataFrame:
        if all(isinstance(m, Fitted) and hasattr(m.model, "coefficientMatrix") and m.model.numClasses == 2 for m in self.members):
            return self._linear_votes(df)
        keep = df.columns
        total = F.lit(0.0)
        for i, (m, a) in enumerate(zip(self.members, self.alpha)):
            df = m.transform(df).withColumnRenamed("prediction", f"__p{i}")
            df = df.select(*keep, *[f"__p{j}" for j in range(i + 1)])
            total = total + F.lit(a) * F.least(F.col(f"__p{i}"), F.lit(1.0))
        return df.withColumn("votes", total).select(*keep, "votes")

    def _linear_votes(self, df: DataFrame) -> DataFrame:
        """All linear members at once: one expression, no chain of one projection per member."""
        vec = F.col(self.members[0].vec_col).cast("array<double>")
        total = F.lit(0.0)
        for m, a in zip(self.members, self.alpha):
            w = F.array(*[F.lit(float(c)) for c in m.model.coefficients])
            yes = (dot(vec, w) + F.lit(float(m.model.intercept))) > 0
            total = total + F.when(yes, F.lit(a)).otherwise(F.lit(0.0))
        return df.withColumn("votes", total)

    def transform(self, df: DataFrame) -> DataFrame:
        v = self.votes(df)
        return v.withColumns(
            {"prediction": (F.col("votes") > 0.5).cast("double"), "probability": 1 - F.col("votes")}
        ).drop("votes")


@dataclass
class Boosted:
    ensemble: VotingEnsemble
    rounds: DataFrame


def bagging(
    df: DataFrame, rounds: int, label: str = "label", vec_col: str = "features", id_col: str = "id", c: float = 1.0, seed: int = 0, threads: int = 4
) -> Boosted:
    """Logistic regressions on bootstrap samples, drawn as Poisson(1) copies used as row weights."""
    cached = df.select(id_col, vec_col, label).persist(StorageLevel.MEMORY_AND_DISK)
    n = cached.count()

    def one(r):
        w = cached.withColumn("__w", poisson_copies(id_col, seed * 100_003 + r).cast("double")).filter("__w > 0")
        model = logistic(w, label, vec_col, c, weight="__w", n=n)
        wrong = model.transform(cached).agg(F.avg((F.col("prediction") != F.col(label)).cast("double"))).first()[0]
        return model, float(wrong)

    try:
        with ThreadPoolExecutor(threads) as pool:
            done = list(pool.map(one, range(rounds)))
        ens = VotingEnsemble([m for m, _ in done])
        joint = ens.transform(cached).agg(F.avg((F.col("prediction") != F.col(label)).cast("double"))).first()[0]
    finally:
        cached.unpersist()
    rows = [(r, e, None) for r, (_, e) in enumerate(done)] + [(-1, float(joint), None)]
    return Boosted(ens, df.sparkSession.createDataFrame(rows, "round int, error double, alpha double"))


def adaboost(
    df: DataFrame,
    rounds: int,
    label: str = "label",
    vec_col: str = "features",
    c: float = 1000.0,
    redraw: str | None = None,
    seed: int = 0,
) -> Boosted:
    """Boosting rounds: alpha = ln((1 - e) / e) / 2, weights times exp(+-alpha), renormalised.

    A member is fitted to the weighted rows or, with ``redraw`` (an id column), to a
    bootstrap sample drawn by weight; a sample of a single class is drawn again, up to ten
    times, then the weighted rows are used. The weights are carried as a column and written
    every ``WRITE_EVERY`` rounds, so that neither work per round nor lineage grows. Rounds
    stop when a member errs on nothing or on half.
    """
    ids = [redraw] if redraw and redraw not in (vec_col, label) else []
    now = cut_lineage(df.select(*ids, vec_col, label).withColumn("__w", F.lit(1.0)), "boost")
    members, alphas, rows = [], [], []
    vec = F.col(vec_col).cast("array<double>")
    n = now.count()
    for r in range(rounds):
        total = now.agg(F.sum("__w")).first()[0]
        weighted = now.withColumn("__w", F.col("__w") / F.lit(total))
        # mean weight 1 keeps the penalty on the scale of n rows
        sample = weighted.withColumn("__w", F.col("__w") * n)
        for attempt in range(10 if redraw else 0):
            try:
                drawn = poisson_weights(weighted, n, redraw, seed * 100_003 + r * 10 + attempt, "__w", "__copies")
            except ValueError:  # a row holds so much of the weight that drawing adds nothing
                break
            drawn = drawn.withColumn("__w", F.col("__copies").cast("double")).filter("__w > 0")
            if drawn.agg(F.count_distinct(label)).first()[0] > 1:
                sample = drawn
                break
        model = logistic(sample, label, vec_col, c, weight="__w", n=n)
        wrong = model.transform(weighted).agg(
            F.sum(F.when(F.col("prediction") != F.col(label).cast("double"), F.col("__w")).otherwise(0.0))
        ).first()[0]
        eps = min(max(float(wrong), 1e-12), 1 - 1e-12)
        alpha = float(0.5 * np.log((1 - eps) / eps))
        members.append(model)
        alphas.append(float(alpha))
        rows.append((r, float(wrong), float(alpha)))
        yes = (dot(vec, F.array(*[F.lit(float(x)) for x in model.model.coefficients])) + F.lit(float(model.model.intercept))) > 0
        now = weighted.withColumn("__w", F.col("__w") * n * F.exp(F.when(yes == (F.col(label) > 0.5), F.lit(-alpha)).otherwise(F.lit(alpha))))
        if (r + 1) % WRITE_EVERY == 0:
            now = cut_lineage(now, "boost")
        if wrong <= 1e-12 or wrong >= 0.5 - 1e-12:
            break
    # no member better than chance: plain majority
    scale = sum(alphas)
    ens = VotingEnsemble(members, [a / scale for a in alphas] if scale > 0 else None)
    joint = ens.transform(now).agg(F.avg((F.col("prediction") != F.col(label).cast("double")).cast("double"))).first()[0]
    rows.append((-1, float(joint), None))
    return Boosted(ens, df.sparkSession.createDataFrame(rows, "round int, error double, alpha double"))
