"""Least squares, baselines, error measures and model comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import evaluate, folds, linear
from quarry.operators.describe import class_priors
from quarry.plans.registry import query, rounded
from quarry.session import table


def _priced(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_quantity", "l_discount", "l_tax", (F.col("l_extendedprice") / 1000).alias("price")
    )


_PRICED = "(SELECT l_orderkey, l_quantity, l_discount, l_tax, l_extendedprice / 1000 AS price FROM lineitem)"


@query(
    "l4_least_squares",
    f"""SELECT 'intercept' AS feature, round(regr_intercept(price, l_quantity), 5) AS coef FROM {_PRICED}
    UNION ALL SELECT 'l_quantity', round(regr_slope(price, l_quantity), 5) FROM {_PRICED}""",
)
def l4(spark, d):
    return rounded(linear.ols(_priced(spark, d), ["l_quantity"], "price").table(spark), 5)


@query(
    "l4_least_squares_two",
    f"""WITH s AS (SELECT covar_pop(l_quantity, l_quantity) a, covar_pop(l_quantity, l_discount) b, covar_pop(l_discount, l_discount) c,
      covar_pop(l_quantity, price) y1, covar_pop(l_discount, price) y2, avg(l_quantity) m1, avg(l_discount) m2, avg(price) my FROM {_PRICED}),
    w AS (SELECT *, (c * y1 - b * y2) / (a * c - b * b) AS w1, (a * y2 - b * y1) / (a * c - b * b) AS w2 FROM s)
    SELECT 'intercept' AS feature, round(my - w1 * m1 - w2 * m2, 4) AS coef FROM w UNION ALL SELECT 'l_quantity', round(w1, 4) + 0.0 FROM w
    UNION ALL SELECT 'l_discount', round(w2, 4) + 0.0 FROM w""",
)
def l4b(spark, d):
    return rounded(linear.ols(_priced(spark, d), ["l_quantity", "l_discount"], "price").table(spark), 4)


@query(
    "l5_residuals",
    f"""WITH c AS (SELECT regr_intercept(price, l_quantity) b, regr_slope(price, l_quantity) w FROM {_PRICED})
    SELECT l_orderkey, round(price - (b + w * l_quantity), 5) + 0.0 AS residual, 'l_quantity' AS attribute, l_quantity AS value
    FROM {_PRICED} p, c""",
)
def l5(spark, d):
    x = _priced(spark, d)
    fit = linear.ols(x, ["l_quantity"], "price")
    return rounded(linear.residuals(x, fit, "price", ["l_orderkey"]), 5)


_EV = "(SELECT event_id, user_id::DOUBLE AS u, value AS y, ntile(10) OVER (ORDER BY event_id) - 1 AS fold FROM events)"


def _events(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("user_id").cast("double").alias("u"), F.col("value").alias("y"))
    return folds.kfold(e, 10, "event_id")


@query(
    "l6_cross_validated_mse",
    f"""WITH e AS {_EV}, f AS (SELECT k, regr_intercept(y, u) b, regr_slope(y, u) w FROM e JOIN range(10) t(k) ON fold <> k GROUP BY k),
    m AS (SELECT k, avg(pow(y - b - w * u, 2)) AS mse FROM e JOIN f ON fold = k GROUP BY k)
    SELECT round(avg(mse), 5) AS mse FROM m""",
)
def l6(spark, d):
    mse = linear.validate_ols(_events(spark, d), ["u"], "y")
    return rounded(spark.createDataFrame([(mse,)], "mse double"), 5)


def _selection(spark, d):
    from quarry.sources.tables import read_matrix

    e = read_matrix(spark, f"{d}/embeddings.parquet", "embedding")
    names = [f"x{i}" for i in range(e.select(F.max(F.size("features"))).first()[0])]
    wide = e.select("vec_id", F.col("label").cast("double").alias("y"), *[F.get("features", F.lit(i)).alias(n) for i, n in enumerate(names)])
    wide = folds.kfold_shuffled(wide, 3, "vec_id", 5, out="outer")
    wide = folds.kfold_shuffled(wide, 10, "vec_id", 6, out="inner")
    return linear.forward_selection(wide, names, "y", "outer", "inner", 10), names


@query("l7_forward_selection")
def l7(spark, d):
    return _selection(spark, d)[0]


@query("e12_selection_matrix")
def e12(spark, d):
    return linear.selection_matrix(*_selection(spark, d))


@query(
    "l8_ridge",
    f"""WITH s AS (SELECT count(*) n, sum(l_quantity) sx, sum(l_quantity * l_quantity) sxx, sum(price) sy, sum(l_quantity * price) sxy FROM {_PRICED}),
    k AS (SELECT n + 1000.0::DOUBLE AS a, sx AS b, sxx + 1000.0::DOUBLE AS c, sy, sxy FROM s)
    SELECT 'intercept' AS feature, round((c * sy - b * sxy) / (a * c - b * b), 5) AS coef FROM k
    UNION ALL SELECT 'l_quantity', round((a * sxy - b * sy) / (a * c - b * b), 5) FROM k""",
)
def l8(spark, d):
    return rounded(linear.ridge(_priced(spark, d), ["l_quantity"], "price", 1000.0).table(spark), 5)


_LAMBDAS = [10.0**p for p in range(-5, 9)]
_U = "floor(CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || ':4'), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE * 5)"


@query(
    "l9_ridge_path",
    f"""WITH p AS (SELECT *, CAST({_U} AS INT) AS fold FROM {_PRICED}),
    t AS (SELECT k, l.lam, count(*) + l.lam a, sum(l_quantity) b, sum(l_quantity * l_quantity) + l.lam c, sum(price) sy, sum(l_quantity * price) sxy
      FROM p JOIN range(5) r(k) ON fold <> k CROSS JOIN (VALUES {', '.join(f'({x}::DOUBLE)' for x in _LAMBDAS)}) l(lam) GROUP BY 1, 2),
    w AS (SELECT k, lam, (c * sy - b * sxy) / (a * c - b * b) w0, (a * sxy - b * sy) / (a * c - b * b) w1 FROM t)
    SELECT lam AS lambda, CAST(k AS INT) AS fold,
      round(avg(CASE WHEN fold <> k THEN pow(price - w0 - w1 * l_quantity, 2) END), 4) AS train_mse,
      round(avg(CASE WHEN fold = k THEN pow(price - w0 - w1 * l_quantity, 2) END), 4) AS test_mse
    FROM p CROSS JOIN w GROUP BY 1, 2""",
)
def l9(spark, d):
    x = folds.kfold_shuffled(_priced(spark, d), 5, "l_orderkey", 4)
    return rounded(linear.ridge_path(x, ["l_quantity"], "price", _LAMBDAS).errors, 4, **{"lambda": 9})


@query(
    "l22_mean_baseline",
    f"""WITH e AS {_EV} SELECT CAST(k AS INT) AS fold, round(m, 6) AS train_mean, round(avg(CASE WHEN fold = k THEN pow(y - m, 2) END), 5) AS mse_of_train_mean,
      round(var_pop(CASE WHEN fold <> k THEN y END), 5) AS train_var, round(var_pop(CASE WHEN fold = k THEN y END), 5) AS test_var
    FROM e JOIN (SELECT k, avg(y) AS m FROM e JOIN range(10) t(k) ON fold <> k GROUP BY k) f ON true GROUP BY k, m""",
)
def l22(spark, d):
    return rounded(linear.mean_baseline(_events(spark, d), "y"), 5, train_mean=6)


# --- evaluation ------------------------------------------------------------------
def _rule(spark, d):
    q = F.col("l_quantity")
    pred = F.when(q < 17, "A").when(q < 34, "N").otherwise("R")
    return table(spark, d, "lineitem").select(F.col("l_returnflag").alias("label"), pred.alias("pred"), "l_linestatus")


_RULE = """(SELECT l_returnflag AS label, CASE WHEN l_quantity < 17 THEN 'A' WHEN l_quantity < 34 THEN 'N' ELSE 'R' END AS pred,
    l_linestatus FROM lineitem)"""


@query(
    "e1_error_rate",
    f"SELECT l_linestatus, round(avg(CASE WHEN label <> pred THEN 1.0 ELSE 0.0 END), 6) AS error, count(*) AS n FROM {_RULE} GROUP BY 1",
)
def e1(spark, d):
    return rounded(evaluate.error_rate(_rule(spark, d), "label", "pred", ["l_linestatus"]))


@query(
    "e2_prior_weighted_error",
    f"""WITH r AS {_RULE}, c AS (SELECT label, count(*) AS n, sum(CASE WHEN label <> pred THEN 1 ELSE 0 END) AS wrong FROM r GROUP BY 1)
    SELECT round(sum(wrong / (SELECT sum(n) FROM c) * (n / (SELECT sum(n) FROM c))), 8) AS weighted_error FROM c""",
)
def e2(spark, d):
    r = _rule(spark, d)
    return rounded(evaluate.weighted_error(r, "label", "pred", class_priors(r, "label")), 8)


@query("e3_confusion_matrix", f"SELECT label, pred AS predicted, count(*) AS cnt FROM {_RULE} GROUP BY 1, 2")
def e3(spark, d):
    return evaluate.confusion(_rule(spark, d), "label", "pred")


@query(
    "e3_confusion_wide",
    f"""SELECT label, count(*) FILTER (pred = 'A') AS "A", count(*) FILTER (pred = 'N') AS "N", count(*) FILTER (pred = 'R') AS "R"
    FROM {_RULE} GROUP BY 1""",
)
def e3w(spark, d):
    return evaluate.confusion_wide(_rule(spark, d), "label", "pred", ["A", "N", "R"])


@query(
    "e3_accuracy",
    f"""SELECT round(100 * avg(CASE WHEN label = pred THEN 1.0 ELSE 0 END), 5)::DOUBLE AS accuracy,
    round(100 - 100 * avg(CASE WHEN label = pred THEN 1.0 ELSE 0 END), 5)::DOUBLE AS error_rate FROM {_RULE}""",
)
def e3a(spark, d):
    return rounded(evaluate.accuracy(evaluate.confusion(_rule(spark, d), "label", "pred")), 5)


@query(
    "e4_class_report",
    f"""WITH r AS {_RULE}, p AS (SELECT c AS cls, count(*) FILTER (label = c) AS support, count(*) FILTER (pred = c) AS claimed,
      count(*) FILTER (label = c AND pred = c) AS hit FROM r CROSS JOIN (VALUES ('A'), ('N'), ('R')) v(c) GROUP BY 1),
    q AS (SELECT cls, hit / claimed AS precision, hit / support AS recall, support FROM p),
    s AS (SELECT cls, precision, recall, 2 * precision * recall / (precision + recall) AS f1, support FROM q)
    SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM s
    UNION ALL SELECT 'weighted average', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
      round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM s""",
)
def e4(spark, d):
    return rounded(evaluate.class_report(evaluate.confusion(_rule(spark, d), "label", "pred")))


def _scored(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    return docs.join(table(spark, d, "labels"), "doc_id")


_SCORED = "(SELECT doc_id, n_chars::DOUBLE AS score, quality, toxic FROM documents JOIN labels USING (doc_id))"


@query(
    "e5_roc_points",
    f"""WITH s AS {_SCORED}, g AS (SELECT score, sum(quality) AS p, sum(1 - quality) AS n FROM s GROUP BY 1)
    SELECT score, round(sum(n) OVER (ORDER BY score DESC) / sum(n) OVER (), 6) AS fpr, round(sum(p) OVER (ORDER BY score DESC) / sum(p) OVER (), 6) AS tpr FROM g""",
)
def e5(spark, d):
    return rounded(evaluate.roc_points(_scored(spark, d), "score", "quality"))


@query(
    "e5_auc",
    f"""WITH s AS {_SCORED} SELECT round(avg(CASE WHEN a.score > b.score THEN 1.0::DOUBLE WHEN a.score = b.score THEN 0.5 ELSE 0 END), 6) AS auc
    FROM s a JOIN s b ON a.quality = 1 AND b.quality = 0""",
)
def e5a(spark, d):
    return rounded(evaluate.auc(_scored(spark, d), "score", "quality"))


@query(
    "e6_regression_scores",
    f"""WITH e AS {_EV}, f AS (SELECT k, avg(y) AS my, regr_intercept(y, u) b, regr_slope(y, u) w FROM e JOIN range(10) t(k) ON fold <> k GROUP BY k),
    m AS (SELECT k, avg(pow(y - b - w * u, 2)) AS err, var_pop(y) AS base FROM e JOIN f ON fold = k GROUP BY k)
    SELECT 'linear' AS model, round(avg(err), 5) AS mse, round((sum(base) - sum(err)) / sum(base), 7) AS r2 FROM m""",
)
def e6(spark, d):
    x = _events(spark, d)
    cells = linear.gram(x, ["u", "y"], "fold")
    every = linear.pooled(cells)
    rows = [
        ("linear", float(linear._mse(linear._ols(every - g), g)), float(g.scatter()[-1, -1] / g.n)) for g in cells.values()
    ]
    m = spark.createDataFrame(rows, "model string, error double, base double")
    return rounded(evaluate.regression_scores(m, ["model"]), 5, r2=7)


def _sweep_metrics(spark, d):
    """Per (param, fold): error of the rule value > param against event_type = 'error'."""
    e = folds.kfold(table(spark, d, "events").select("event_id", "value", "event_type"), 5, "event_id")
    e = e.withColumn("param", F.explode(F.array(*[F.lit(float(p)) for p in (5, 10, 20, 40)])))
    hit = (F.col("value") > F.col("param")) == (F.col("event_type") == "error")
    return e.groupBy("param", "fold").agg(F.avg((~hit).cast("double")).alias("error"))


@query(
    "e7_mean_error_by_parameter",
    """WITH e AS (SELECT value, event_type, ntile(5) OVER (ORDER BY event_id) - 1 AS fold FROM events),
    m AS (SELECT p AS param, fold, avg(CASE WHEN (value > p) = (event_type = 'error') THEN 0.0::DOUBLE ELSE 1 END) AS error
      FROM e CROSS JOIN (VALUES (5.0::DOUBLE), (10), (20), (40)) v(p) GROUP BY 1, 2)
    SELECT param, round(avg(error), 6) AS mean_error FROM m GROUP BY 1""",
)
def e7(spark, d):
    return rounded(evaluate.mean_over_folds(_sweep_metrics(spark, d), ["param"]))


def _nested_metrics(spark, d):
    """Two fixed rules for quality, scored on every inner test part of nested 5 x 5 folds."""
    x = folds.nested_folds(_scored(spark, d), 5, 5, "doc_id").filter("NOT is_test")
    rules = F.array(
        F.struct(F.lit("length").alias("model"), (F.col("score") > 1000).cast("int").alias("pred")),
        F.struct(F.lit("clean").alias("model"), (F.col("toxic") == 0).cast("int").alias("pred")),
    )
    x = x.withColumn("r", F.explode(rules)).select("outer_fold", "inner_fold", "quality", "r.*")
    return x.groupBy("model", F.col("outer_fold").alias("outer"), F.col("inner_fold").alias("inner")).agg(
        F.avg(evaluate.miss("quality", "pred")).alias("error")
    )


_NESTED = f"""WITH s AS {_SCORED}, o AS (SELECT *, ntile(5) OVER (ORDER BY doc_id) - 1 AS own FROM s),
    r AS (SELECT o.*, k AS outer_, ntile(5) OVER (PARTITION BY k ORDER BY doc_id) - 1 AS inner_ FROM o JOIN range(5) t(k) ON own <> k),
    m AS (SELECT model, outer_, inner_, avg(CASE WHEN quality <> pred THEN 1.0::DOUBLE ELSE 0 END) AS error FROM (
      SELECT 'length' AS model, outer_, inner_, quality, CASE WHEN score > 1000 THEN 1 ELSE 0 END AS pred FROM r
      UNION ALL SELECT 'clean', outer_, inner_, quality, CASE WHEN toxic = 0 THEN 1 ELSE 0 END FROM r) GROUP BY 1, 2, 3)"""


@query(
    "e8_accuracy_interval",
    _NESTED
    + """, a AS (SELECT model, inner_, avg(1 - error) AS acc FROM m GROUP BY 1, 2),
    i AS (SELECT model, avg(acc) AS mean, stddev_pop(acc) / 2 AS sigma FROM a GROUP BY 1)
    SELECT model, round(mean, 5) AS mean, round(sigma, 5) AS sigma, round(mean - 2.7764451051977934 * sigma, 5) AS lower,
      round(mean + 2.7764451051977934 * sigma, 5) AS upper FROM i""",
)
def e8(spark, d):
    return rounded(evaluate.accuracy_interval(_nested_metrics(spark, d), 5), 5)


@query(
    "e9_paired_comparison",
    _NESTED
    + """, z AS (SELECT inner_, avg(error) FILTER (model = 'clean') - avg(error) FILTER (model = 'length') AS z FROM m GROUP BY 1),
    i AS (SELECT avg(z) AS mean, stddev_pop(z) / 2 AS sigma FROM z)
    SELECT round(mean, 5) AS mean, round(sigma, 5) AS sigma, round(mean - 2.7764451051977934 * sigma, 5) AS lower,
      round(mean + 2.7764451051977934 * sigma, 5) AS upper,
      NOT (mean - 2.7764451051977934 * sigma <= 0 AND mean + 2.7764451051977934 * sigma >= 0) AS different FROM i""",
)
def e9(spark, d):
    m = _nested_metrics(spark, d).withColumn("fold", F.col("inner"))
    return rounded(evaluate.compare_models(m, "length", "clean", 5), 5)


@query(
    "e11_exact_match_error",
    f"""SELECT round(avg(CASE WHEN round(price) <> l_quantity THEN 1.0::DOUBLE ELSE 0 END), 6) AS error FROM {_PRICED}""",
)
def e11(spark, d):
    return rounded(evaluate.exact_match_error(_priced(spark, d), "l_quantity", "price"))


@query(
    "s7_fold_report",
    f"""WITH r AS {_RULE}, c AS (SELECT l_linestatus, label, pred AS predicted, count(*) AS cnt FROM r GROUP BY 1, 2, 3)
    SELECT l_linestatus, label, predicted, cnt, round(sum(CASE WHEN label <> predicted THEN cnt ELSE 0 END) OVER (PARTITION BY l_linestatus)
      / sum(cnt) OVER (PARTITION BY l_linestatus), 6) AS error,
      round(sum(CASE WHEN label <> predicted THEN cnt * prior ELSE 0 END) OVER (PARTITION BY l_linestatus) / sum(cnt) OVER (PARTITION BY l_linestatus), 6) AS weighted_error,
      round(sum(CASE WHEN label = predicted THEN cnt ELSE 0 END) OVER (PARTITION BY l_linestatus, predicted) / sum(cnt) OVER (PARTITION BY l_linestatus, predicted), 6) AS precision,
      round(sum(CASE WHEN label = predicted THEN cnt ELSE 0 END) OVER (PARTITION BY l_linestatus, label) / sum(cnt) OVER (PARTITION BY l_linestatus, label), 6) AS recall
    FROM c JOIN (SELECT l_returnflag, count(*)::DOUBLE / sum(count(*)) OVER () AS prior FROM lineitem GROUP BY 1) p ON l_returnflag = label""",
)
def s7(spark, d):
    x = _rule(spark, d)
    return rounded(evaluate.fold_report(x, "label", "pred", ["l_linestatus"], class_priors(x, "label")))
