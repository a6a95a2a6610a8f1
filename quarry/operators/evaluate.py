"""Error measures, reports, ROC and Student-t model comparison."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions.ranking import running_before
from quarry.functions.stats import t_quantile


def miss(label: str, pred: str) -> Column:
    return (F.col(label) != F.col(pred)).cast("double")


def error_rate(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    g = df.groupBy(*by) if by else df
    return g.agg(F.avg(miss(label, pred)).alias("error"), F.count("*").alias("n"))


def weighted_error(df: DataFrame, label: str, pred: str, priors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum over classes of (errors of that class / N) times the class prior."""
    per = df.groupBy(*by, label).agg(F.sum(miss(label, pred)).alias("wrong"), F.count("*").alias("cnt"))
    j = per.join(priors.select(label, "prior"), label, "left")
    g = j.groupBy(*by) if by else j
    return g.agg(
        F.try_divide(F.sum(F.col("wrong") * F.coalesce("prior", F.lit(0.0))), F.sum("cnt")).alias("weighted_error")
    )


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("predicted")).agg(F.count("*").alias("cnt"))


def confusion_wide(df: DataFrame, label: str, pred: str, classes: Sequence) -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).pivot(pred, list(classes)).count().na.fill(0)


def accuracy(cm: DataFrame) -> DataFrame:
    """Accuracy and error rate in per cent from a long confusion matrix."""
    hit = F.sum(F.when(F.col("label") == F.col("predicted"), F.col("cnt")).otherwise(0))
    acc = hit * 100.0 / F.sum("cnt")
    return cm.agg(acc.alias("accuracy"), (100 - acc).alias("error_rate"))


def class_report(cm: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, and their support-weighted average.

    Works on the confusion matrix only, at most classes^2 rows.
    """
    tagged = cm.select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("cls"), F.col("cnt").alias("actual"), F.lit(0).cast("long").alias("claimed"),
                         F.when(F.col("label") == F.col("predicted"), F.col("cnt")).otherwise(0).alias("hit")),
                F.struct(F.col("predicted").alias("cls"), F.lit(0).cast("long").alias("actual"), F.col("cnt").alias("claimed"),
                         F.lit(0).cast("long").alias("hit")),
            )
        ).alias("s")
    ).select("s.*")
    per = tagged.groupBy("cls").agg(F.sum("actual").alias("support"), F.sum("claimed").alias("claimed"), F.sum("hit").alias("hit"))
    zero = F.lit(0.0)
    per = per.withColumns(
        {
            "precision": F.when(F.col("claimed") > 0, F.col("hit") / F.col("claimed")).otherwise(zero),
            "recall": F.when(F.col("support") > 0, F.col("hit") / F.col("support")).otherwise(zero),
        }
    )
    pr = F.col("precision") + F.col("recall")
    per = per.withColumn("f1", F.when(pr > 0, 2 * F.col("precision") * F.col("recall") / pr).otherwise(zero))
    cols = ["precision", "recall", "f1"]
    avg = per.agg(
        F.lit("weighted average").alias("cls"),
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in cols],
        F.sum("support").alias("support"),
    )
    return per.select(F.col("cls").cast("string").alias("cls"), *cols, "support").unionByName(avg)


def _score_groups(df: DataFrame, score: str, label: str) -> DataFrame:
    pos = F.col(label).cast("double")
    g = df.groupBy(F.col(score).alias("score")).agg(F.sum(pos).alias("pos"), F.sum(1 - pos).alias("neg"))
    return running_before(
        g.withColumn("down", -F.col("score")), ["down"], {"tp": F.col("pos"), "fp": F.col("neg")}
    )


def roc_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """(score, fpr, tpr) per distinct score, the score itself included; ties form one point.

    A rate of an absent class is null.
    """
    g = _score_groups(df, score, label)
    return g.select(
        "score",
        F.try_divide(F.col("fp") + F.col("neg"), F.col("fp_total")).alias("fpr"),
        F.try_divide(F.col("tp") + F.col("pos"), F.col("tp_total")).alias("tpr"),
    )


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve by trapezoids, each closed inside its own score group.

    Null if one class is absent.
    """
    g = _score_groups(df, score, label)
    area = F.col("neg") * (F.col("tp") + F.col("pos") / 2)
    return g.agg(F.try_divide(F.sum(area), F.max("tp_total") * F.max("fp_total")).alias("auc"))


def regression_scores(metrics: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean error and pooled R2 = (sum of baseline errors - sum of errors) / sum of baseline errors."""
    return metrics.groupBy(*by).agg(
        F.avg("error").alias("mse"), ((F.sum("base") - F.sum("error")) / F.sum("base")).alias("r2")
    )


def mean_over_folds(metrics: DataFrame, by: Sequence[str], value: str = "error") -> DataFrame:
    return metrics.groupBy(*by).agg(F.avg(value).alias(f"mean_{value}"))


def _interval(df: DataFrame, value: str, by: Sequence[str], folds: int, alpha: float) -> DataFrame:
    t = t_quantile(1 - alpha / 2, folds - 1)
    g = df.groupBy(*by) if by else df
    out = g.agg(
        F.avg(value).alias("mean"), (F.stddev_pop(value) / F.sqrt(F.lit(folds - 1.0))).alias("sigma")
    )
    return out.withColumns(
        {"lower": F.col("mean") - F.col("sigma") * F.lit(t), "upper": F.col("mean") + F.col("sigma") * F.lit(t)}
    )


def accuracy_interval(
    metrics: DataFrame, folds: int, model: str = "model", inner: str = "inner", outer: str = "outer", alpha: float = 0.05
) -> DataFrame:
    """Credibility interval of accuracy: average over ``outer`` first, then over ``inner`` rows."""
    rows = metrics.groupBy(model, inner).agg(F.avg(1 - F.col("error")).alias("accuracy"))
    return _interval(rows, "accuracy", [model], folds, alpha)


def compare_models(metrics: DataFrame, a: str, b: str, folds: int, value: str = "error", alpha: float = 0.05) -> DataFrame:
    """Interval of the per-fold difference (b minus a in ``value``); different unless it covers 0."""
    both = metrics.groupBy("fold").agg(
        F.avg(F.when(F.col("model") == b, F.col(value))).alias("vb"),
        F.avg(F.when(F.col("model") == a, F.col(value))).alias("va"),
    )
    z = _interval(both.select((F.col("vb") - F.col("va")).alias("z")), "z", [], folds, alpha)
    return z.withColumn("different", ~((F.col("lower") <= 0) & (F.col("upper") >= 0)))


def exact_match_error(df: DataFrame, target: str, estimate: str, exact: bool = False) -> DataFrame:
    """Share of estimates that miss the class after rounding; ``exact`` compares the raw reals."""
    est = F.col(estimate) if exact else F.round(F.col(estimate))
    return df.agg(F.avg((est != F.col(target)).cast("double")).alias("error"))


def sweep(
    df: DataFrame,
    fit: Callable[[DataFrame, object], Callable[[DataFrame], DataFrame]],
    params: Sequence,
    folds: int,
    label: str = "label",
    fold: str = "fold",
    threads: int = 4,
) -> DataFrame:
    """Fit per (fold, parameter), score train and test; tidy (param, fold, split, error, n).

    ``fit(train, param)`` returns a function that adds ``prediction``. Fits run in
    a bounded thread pool; each contributes one small aggregate to the result.
    """
    from pyspark import StorageLevel

    cached = df.persist(StorageLevel.MEMORY_AND_DISK)

    def one(job):
        k, p = job
        scored = fit(cached.filter(F.col(fold) != k), p)(cached)
        split = F.when(F.col(fold) == k, "test").otherwise("train")
        rows = scored.groupBy(split.alias("split")).agg(F.avg(miss(label, "prediction")).alias("e"), F.count("*").alias("n")).collect()
        return [(float(p), int(k), r["split"], float(r["e"]), int(r["n"])) for r in rows]

    try:
        with ThreadPoolExecutor(threads) as pool:
            done = list(pool.map(one, [(k, p) for k in range(folds) for p in params]))
    finally:
        cached.unpersist()
    return df.sparkSession.createDataFrame(
        [r for part in done for r in part], "param double, fold int, split string, error double, n long"
    )


def fold_report(df: DataFrame, label: str, pred: str, by: Sequence[str], priors: DataFrame | None = None) -> DataFrame:
    """Per fold: confusion counts with both error measures, ready for a report sink.

    ``error`` is the share of misses; with ``priors`` (label, prior) also ``weighted_error``
    as in :func:`weighted_error`, and each row carries the fold's ``precision`` of its
    predicted class and ``recall`` of its label.
    """
    cm = df.groupBy(*by, F.col(label).alias("label"), F.col(pred).alias("predicted")).agg(F.count("*").alias("cnt"))
    w = W.partitionBy(*by)
    wrong = F.when(F.col("label") != F.col("predicted"), F.col("cnt")).otherwise(0)
    out = cm.withColumn("error", F.sum(wrong).over(w) / F.sum("cnt").over(w))
    if priors is None:
        return out
    hit = F.when(F.col("label") == F.col("predicted"), F.col("cnt")).otherwise(0)
    prior = priors.select(F.col(priors.columns[0]).alias("label"), "prior")
    out = out.join(prior, "label", "left").withColumns(
        {
            "weighted_error": F.sum(wrong * F.coalesce("prior", F.lit(0.0))).over(w) / F.sum("cnt").over(w),
            "recall": F.sum(hit).over(W.partitionBy(*by, "label")) / F.sum("cnt").over(W.partitionBy(*by, "label")),
            "precision": F.sum(hit).over(W.partitionBy(*by, "predicted")) / F.sum("cnt").over(W.partitionBy(*by, "predicted")),
        }
    )
    return out.select(*cm.columns, "error", "weighted_error", "precision", "recall")
