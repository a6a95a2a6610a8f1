import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.vectors import pack
from quarry.operators import (
    classify,
    cluster,
    ensemble,
    hierarchy,
    linear,
    mixture,
    neighbours,
    networks,
    pairs,
    reduce,
    trees,
)
from quarry.operators.gram import gram, pooled


def frame(spark, x, y, extra=None):
    rows = [(i, [float(v) for v in r], float(t), int(i % 4)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, features array<double>, label double, fold int").repartition(3)


def wide(spark, x, y):
    m = x.shape[1]
    df = frame(spark, x, y)
    return df.select("id", "label", "fold", *[F.get("features", F.lit(i)).alias(f"x{i}") for i in range(m)]), [f"x{i}" for i in range(m)]


def regression_data(n=120, m=5, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, m)) + 100
    return x, 3 * x[:, 1] - 2 * x[:, 3] + rng.normal(0, 0.5, n)


def blobs(n=160, seed=1, gap=4.0):
    rng = np.random.default_rng(seed)
    y = np.arange(n) % 2
    return rng.normal(0, 1, (n, 2)) + gap * y[:, None], y


def lstsq_mse(tr, te, ytr, yte):
    a = np.c_[np.ones(len(tr)), tr]
    w = np.linalg.lstsq(a, ytr, rcond=None)[0]
    return ((yte - np.c_[np.ones(len(te)), te] @ w) ** 2).mean()


def test_gram_does_not_depend_on_partitions(spark):
    x, y = regression_data()
    df, names = wide(spark, x, y)
    for p in (1, 7):
        g = pooled(gram(df.repartition(p), names))
        np.testing.assert_allclose(g.cov(), np.cov(x.T), rtol=1e-9)
        np.testing.assert_allclose(g.mean(), x.mean(0))


def test_least_squares_normal_equations(spark):
    x, y = regression_data()
    df, names = wide(spark, x, y)
    fit = linear.ols(df, names, "label")
    r = y - fit.intercept - x @ fit.coef
    np.testing.assert_allclose(x.T @ r, 0, atol=1e-6)
    np.testing.assert_allclose(linear.ridge(df, names, "label", 1e-9).coef, fit.coef, atol=1e-3)


def test_cross_validated_error_and_selection_equal_refits(spark):
    x, y = regression_data()
    df, names = wide(spark, x, y)
    f = np.arange(len(y)) % 4

    def cv(cols):
        return np.mean([lstsq_mse(x[f != k][:, cols], x[f == k][:, cols], y[f != k], y[f == k]) for k in range(4)])

    folds = gram(df, [*names, "label"], "fold")
    assert linear.cv_error(folds, [0, 2]) == pytest.approx(cv([0, 2]))
    sel = linear.select_forward(folds)
    steps, loss = [], [y.var()]
    while True:
        t = [(cv([*steps, c]), c) for c in range(5) if c not in steps]
        if not t or min(t)[0] >= loss[-1]:
            break
        steps.append(min(t)[1])
        loss.append(min(t)[0])
    assert sel.steps == steps and {1, 3} <= set(steps)
    np.testing.assert_allclose(sel.loss, loss)


def test_ridge_path(spark):
    x, y = regression_data()
    df, names = wide(spark, x - 100, y - y.mean())
    path = linear.ridge_path(df, names, "label", [1e-5, 1.0, 1e4])
    a, t, f = np.c_[np.ones(len(y)), x - 100], y - y.mean(), np.arange(len(y)) % 4
    for r in path.errors.collect():
        tr, te = f != r["fold"], f == r["fold"]
        w = np.linalg.solve(a[tr].T @ a[tr] + r["lambda"] * np.eye(6), a[tr].T @ t[tr])
        assert r["test_mse"] == pytest.approx(((t[te] - a[te] @ w) ** 2).mean())
        assert r["train_mse"] == pytest.approx(((t[tr] - a[tr] @ w) ** 2).mean())
    assert path.best_lambda in (1e-5, 1.0)


def test_components(spark):
    x, y = regression_data()
    df = frame(spark, x, y)
    pca = reduce.fit_components(df, vec_col="features")
    np.testing.assert_allclose(pca.loadings.T @ pca.loadings, np.eye(5), atol=1e-10)
    np.testing.assert_allclose(pca.variance, np.linalg.svd(x - x.mean(0))[1] ** 2, rtol=1e-8)
    assert pca.ratio(spark).orderBy("pc").collect()[-1]["cumulative"] == pytest.approx(1)
    full = pca.reconstruct(df, 5).select("id", "rebuilt").collect()
    np.testing.assert_allclose(np.array([r["rebuilt"] for r in sorted(full, key=lambda r: r["id"])]), x, atol=1e-8)
    errs = {r["k"]: r["mse"] for r in reduce.reconstruction_error(df, pca, [1, 5]).collect()}
    z = (x - x.mean(0)) @ pca.loadings[:, :1] @ pca.loadings[:, :1].T
    assert errs[1] == pytest.approx((((x - x.mean(0)) - z) ** 2).sum(1).mean()) and errs[5] == pytest.approx(0, abs=1e-9)


ANIMALS = [
    [1, 1, 1, 0, 0, 1, 0], [0, 2, 0, 0, 0, 0, 1], [0, 2, 0, 1, 0, 0, 0], [1, 1, 1, 1, 0, 0, 0], [0, 0, 0, 2, 0, 1, 1],
    [0, 2, 0, 0, 0, 1, 0], [1, 1, 1, 0, 1, 1, 1], [1, 3, 0, 0, 1, 1, 0], [1, 4, 1, 0, 0, 1, 0], [0, 2, 1, 1, 0, 0, 0],
    [0, 2, 0, 2, 0, 1, 0], [1, 3, 0, 2, 0, 1, 0], [1, 5, 1, 0, 0, 1, 1], [0, 2, 0, 1, 0, 0, 0], [0, 0, 0, 2, 0, 1, 1],
]
KINDS = [3, 4, 2, 3, 0, 4, 3, 1, 3, 2, 4, 1, 3, 2, 0]


def test_animal_tree(spark):
    """Root impurity of the recorded drawing, a pure fit and a new object."""
    df = frame(spark, np.array(ANIMALS), KINDS)
    tree = trees.fit_tree(df, max_depth=8)
    root = tree.nodes(spark).filter("node_id = 0").first()
    assert root["impurity"] == pytest.approx(0.773333333333) and root["n"] == 15
    p = tree.transform(df)
    assert p.filter("prediction <> label").count() == 0
    dragon = spark.createDataFrame([([0.0, 2.0, 1.0, 2.0, 1.0, 1.0, 1.0],)], "features array<double>")
    assert tree.transform(dragon).first()["prediction"] in (2.0, 4.0)
    g = lambda counts: 1 - sum((c / sum(counts)) ** 2 for c in counts)
    for r in tree.nodes(spark).collect():
        assert r["impurity"] == pytest.approx(g(r["class_counts"]))


def test_recorded_root_gini():
    counts = [12494, 10599, 1206, 513, 93, 54, 36, 6, 5, 5]
    assert round(1 - sum((c / 25011) ** 2 for c in counts), 3) == 0.568


def test_depth_limit_equals_refit_and_collapse(spark):
    x, y = blobs(200, gap=1.0)
    df = frame(spark, x, y)
    deep = trees.fit_tree(df, max_depth=7)
    cut = deep.at_depths(df, [1, 3, 7]).collect()
    for i, d in enumerate((1, 3, 7)):
        again = {r["id"]: r["prediction"] for r in trees.fit_tree(df, max_depth=d).transform(df).collect()}
        assert again == {r["id"]: r["predictions"][i] for r in cut}
    small = deep.collapse(30)
    inner = small.left >= 0
    assert (small.n[inner] >= 30).all() and len(small.n) < len(deep.n)
    with pytest.warns(UserWarning):
        assert trees.clamp_depths([5, 195]) == [5, 30]


def test_knn_votes(spark):
    x, y = blobs(60, gap=1.5)
    df = frame(spark, x, y)
    got = {r["k"]: r["error"] for r in neighbours.leave_one_out_sweep(df, [1, 2, 5], "label").collect()}
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    for k in (1, 2, 5):
        near = np.argsort(d, 1)[:, :k]
        vote = np.array([np.bincount(y[r], minlength=2).argmax() for r in near])
        assert got[k] == pytest.approx((vote != y).mean())


def test_logistic_optimum(spark):
    """The gradient of C * loss + |w|^2 / 2 vanishes at the fit."""
    x, y = blobs(120, gap=1.0)
    fit = classify.logistic(frame(spark, x, y), c=0.7).model
    w, b = fit.coefficients.toArray(), fit.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    np.testing.assert_allclose(0.7 * x.T @ (p - y) + w, 0, atol=1e-3)
    assert (p - y).sum() == pytest.approx(0, abs=1e-3)


def test_naive_bayes(spark):
    rng = np.random.default_rng(2)
    y = np.arange(80) % 3
    x = rng.poisson(np.array([[5, 1, 1], [1, 5, 1], [2, 2, 4]])[y])
    df = frame(spark, x, y)
    m = classify.naive_bayes(df, priors=[0.2, 0.3, 0.5])
    np.testing.assert_allclose(np.exp(m.log_share).sum(1), 1)
    np.testing.assert_allclose(np.exp(m.log_prior), [0.2, 0.3, 0.5])
    pred = {r["id"]: r for r in m.transform(df).collect()}
    want = m.scores(x.astype(float)).argmax(1)
    assert all(pred[i]["prediction"] == want[i] for i in range(80))
    assert sum(pred[0]["probability"]) == pytest.approx(1)


def test_network_gradient():
    rng = np.random.default_rng(0)
    for shape, y in ((networks.Shape((3, 4, 2, 1)), rng.normal(size=9)), (networks.Shape((3, 5, 3), True), rng.integers(0, 3, 9))):
        w, x = shape.start(rng), rng.normal(size=(9, 3))
        _, g = shape.loss_and_gradient(w, x, y)
        for i in range(0, len(w), 5):
            e = np.zeros_like(w)
            e[i] = 1e-6
            num = (shape.loss_and_gradient(w + e, x, y)[0] - shape.loss_and_gradient(w - e, x, y)[0]) / 2e-6
            assert g[i] == pytest.approx(num, rel=1e-4, abs=1e-6)


def test_network_learns_xor_by_fold(spark):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (80, 2)) + rng.normal(0, 0.05, (80, 2))
    y = (x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)
    df = frame(spark, x, y)
    t = networks.train_networks(df, [4], fold="fold", restarts=3, epochs=40, goal=0.005)
    p = networks.predict_by_fold(df, t)
    assert p.filter((F.col("prediction") > 0.5).cast("double") != F.col("label")).count() <= 2
    curve = t.curve.filter("fold = 0 AND restart = 0").orderBy("epoch").collect()
    losses = [r["loss"] for r in curve]
    assert all(b <= a for a, b in zip(losses, losses[1:])) and len(losses) <= 41


def test_ensembles(spark):
    x, y = blobs(120, gap=1.5)
    df = frame(spark, x, y)
    bag = ensemble.bagging(df, 5)
    rows = bag.rounds.collect()
    assert len(rows) == 6 and rows[-1]["round"] == -1 and rows[-1]["error"] < 0.25
    boost = ensemble.adaboost(df, 4)
    r = [r for r in boost.rounds.collect() if r["round"] >= 0]
    for row in r:
        assert row["alpha"] == pytest.approx(0.5 * math.log((1 - row["error"]) / row["error"]), rel=1e-6)
    assert sum(boost.ensemble.alpha) == pytest.approx(1)
    # the linear shortcut and the member-by-member form agree
    slow = df
    total = F.lit(0.0)
    for i, (m, a) in enumerate(zip(bag.ensemble.members, bag.ensemble.alpha)):
        slow = m.transform(slow).withColumnRenamed("prediction", f"p{i}").drop("probability")
        total = total + F.col(f"p{i}") * a
    both = slow.withColumn("want", total).select("id", "want").join(bag.ensemble.votes(df).select("id", "votes"), "id")
    assert both.filter("abs(want - votes) > 1e-9").count() == 0


def test_votes_are_cut_to_one(spark):
    class Two:
        def transform(self, df):
            return df.withColumn("prediction", F.lit(2.0))

    df = spark.range(1)
    out = ensemble.VotingEnsemble([Two(), Two()]).transform(df).first()
    assert out["prediction"] == 1.0 and out["probability"] == pytest.approx(0)


@pytest.mark.parametrize("diagonal", [False, True])
def test_mixture_likelihood_rises(spark, diagonal):
    x, y = blobs(200, gap=5)
    df = frame(spark, x, y)
    runs = [mixture.fit_mixtures(df, [2], diagonal=diagonal, max_iter=i, tol=0)[(2, -1)].loglik for i in (2, 4, 8)]
    assert runs == sorted(runs)
    g = mixture.fit_mixtures(df, [2], diagonal=diagonal, restarts=2)[(2, -1)]
    assert g.weights.sum() == pytest.approx(1)
    s = g.score(df).collect()
    assert all(sum(r["responsibilities"]) == pytest.approx(1) for r in s)
    far = {c: {int(r["id"]) % 2 for r in s if r["cluster"] == c} for c in (0, 1)}
    assert sorted(map(len, far.values())) == [1, 1]
    assert g.parameters == (9 if diagonal else 11)
    assert g.table(spark).agg(F.sum("weight")).first()[0] == pytest.approx(1)


def test_mixture_choice_and_out_of_fold(spark):
    x, y = blobs(240, gap=8)
    df = frame(spark, x, y)
    sel = {r["k"]: r for r in mixture.select_components(df, [1, 2, 3], 4, restarts=2).collect()}
    assert min(sel, key=lambda k: sel[k]["bic"]) == 2
    one = mixture.fit_mixtures(df, [1])[(1, -1)]
    np.testing.assert_allclose(one.covs[0], np.cov(x.T, ddof=0) + 1e-6 * np.eye(2), rtol=1e-8)
    oof = mixture.out_of_fold_clusters(df, 2, 4, restarts=2).collect()
    seen = {c: {int(r["id"]) % 2 for r in oof if r["cluster"] == c} for c in (0, 1)}
    assert sorted(map(len, seen.values())) == [1, 1]


def test_cluster_validity_against_pairs(spark):
    rng = np.random.default_rng(5)
    c, y = rng.integers(0, 4, 60), rng.integers(0, 3, 60)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(c, y)], "c int, y int")
    r = cluster.cluster_validity(df, "c", "y").first()
    f = {k: 0 for k in ("00", "01", "10", "11")}
    for i in range(60):
        for j in range(i):
            f[f"{int(y[i] == y[j])}{int(c[i] == c[j])}"] += 1
    assert r["rand"] == pytest.approx((f["00"] + f["11"]) / sum(f.values()))
    assert r["jaccard"] == pytest.approx(f["11"] / (f["01"] + f["10"] + f["11"]))
    same = cluster.cluster_validity(df.withColumn("y", F.col("c") + 5), "c", "y").first()
    assert same["nmi"] == pytest.approx(1) and same["purity"] == 1 and same["entropy"] == pytest.approx(0)


def test_kmeans(spark):
    x, y = blobs(100, gap=20)
    df = frame(spark, x, y)
    km = cluster.kmeans(df, 2, n_init=2)
    inertia = sum(((x[y == c] - x[y == c].mean(0)) ** 2).sum() for c in (0, 1))
    assert km.inertia == pytest.approx(inertia)
    assert cluster.kmeans(df, 1).inertia == pytest.approx(((x - x.mean(0)) ** 2).sum())
    sweep = {r["k"]: r for r in cluster.validity_sweep(df, [1, 2, 3], "label").collect()}
    assert sweep[2]["rand"] == pytest.approx(1) and sweep[1]["rand"] < 0.6


def test_ward(spark):
    x, y = blobs(60, gap=20)
    df = frame(spark, x, y)
    a, merges = hierarchy.ward(df, 2, 40)
    seen = {}
    for r in a.collect():
        seen.setdefault(r["cluster"], set()).add(r["id"] % 2)
    assert sorted(map(len, seen.values())) == [1, 1]
    h = [r["height"] for r in merges.orderBy("merge").collect()]
    assert h == sorted(h)
    # two points: the height is their distance
    assert hierarchy.ward_merges(np.array([1, 1]), np.array([[0.0, 0.0], [3.0, 4.0]]))[0][2] == pytest.approx(5)


def _greedy_ward(x):
    """Every merge by the least rise of scatter over all pairs: heights and the members of each merge."""
    groups, heights, made = [[i] for i in range(len(x))], [], []
    while len(groups) > 1:
        mean = np.array([x[g].mean(0) for g in groups])
        n = np.array([len(g) for g in groups], float)
        d = ((mean[:, None] - mean[None]) ** 2).sum(2) * (n[:, None] * n) / (n[:, None] + n)
        np.fill_diagonal(d, np.inf)
        i, j = sorted(divmod(int(d.argmin()), len(groups)))
        heights.append(float(np.sqrt(2 * d[i, j])))
        groups[i] = sorted(groups[i] + groups.pop(j))
        made.append(tuple(groups[i]))
    return heights, made


def _members(tree):
    """Members of each merge of a table of (a, b, height, size)."""
    groups, made = {}, []
    for r in sorted(tree, key=lambda r: (r["height"], r["size"])):
        left, right = groups.pop(r["a"], [r["a"]]), groups.pop(r["b"], [r["b"]])
        groups[r["a"]] = sorted(left + right)
        assert len(groups[r["a"]]) == r["size"]
        made.append(tuple(groups[r["a"]]))
    return made


@pytest.mark.parametrize("block", [150, 4096])
def test_ward_tree_equals_greedy_merging(spark, block):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(200, 3)), rng.normal(6, 0.3, (120, 3)), rng.uniform(-9, 9, (80, 3))])
    heights, made = _greedy_ward(x)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, features array<double>")
    got = hierarchy.ward_tree(df, block=block)
    tree = got.collect()
    assert sorted(r["height"] for r in tree) == pytest.approx(heights, abs=1e-9)
    assert set(_members(tree)) == set(made)
    cut = {}
    for r in hierarchy.cut_tree(df, got, 5).collect():
        cut.setdefault(r["cluster"], []).append(r["id"])
    groups = {(i,) for i in range(len(x))}
    for g in made[:-4]:
        groups = {h for h in groups if not set(h) <= set(g)} | {g}
    assert {tuple(sorted(g)) for g in cut.values()} == groups


@pytest.mark.parametrize("limit, most", [(None, 0), (6_000, 2), (1_000, 99)])
def test_ward_tree_sends_vectors_only_where_no_copy_fits(spark, monkeypatch, limit, most):
    """All clusters, else those that look for a partner, are copied; only beyond that vectors go to blocks."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 3))
    heights, made = _greedy_ward(x)
    sent, visit = [], pairs.visit_blocks
    monkeypatch.setattr(pairs, "visit_blocks", lambda q, *a, **k: sent.append(q.count()) or visit(q, *a, **k))
    if limit:
        spark.conf.set("quarry.broadcast.bytes", limit)
    try:
        df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, features array<double>")
        tree = hierarchy.ward_tree(df, block=60).collect()
    finally:
        spark.conf.unset("quarry.broadcast.bytes")
    assert sorted(r["height"] for r in tree) == pytest.approx(heights, abs=1e-9)
    assert set(_members(tree)) == set(made)
    assert len(sent) <= most


def test_ward_tree_of_equal_rows_even_steps_and_odd_ids(spark):
    schema = "id long, features array<double>"
    rows = [(i, [0.0, 1.0]) for i in range(60)] + [(60 + i, [float(i + 5), 1.0]) for i in range(64)]
    tree = hierarchy.ward_tree(spark.createDataFrame(rows, schema), block=32).collect()
    assert len(tree) == 123 and sum(r["height"] == 0 for r in tree) == 59
    assert _members(tree)[-1] == tuple(range(124))
    total = ((np.array([r[1] for r in rows]) - np.mean([r[1] for r in rows], 0)) ** 2).sum()
    assert sum(r["height"] ** 2 / 2 for r in tree) == pytest.approx(total)
    assert hierarchy.ward_tree(spark.createDataFrame([], schema)).count() == 0
    assert hierarchy.ward_tree(spark.createDataFrame([(7, [1.0])], schema)).count() == 0
    named = spark.createDataFrame([("x", [0.0]), ("y", [3.0]), ("z", [3.5])], "id string, features array<double>")
    assert [(r["a"], r["b"], r["size"]) for r in hierarchy.ward_tree(named).orderBy("height").collect()] == [("y", "z", 2), ("x", "y", 3)]


def test_null_features_are_refused(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "a double")
    with pytest.raises(Exception, match="null feature value"):
        gram(df, ["a"])
    assert pack(["a"]) is not None


def test_adam_reaches_the_optimum(spark):
    """Without hidden layers the optimum is unique: L-BFGS and Adam agree on it; stopping is its own."""
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (240, 3))
    y = (x[:, 0] + x[:, 1] * 0.5 + rng.normal(0, 0.8, 240) > 0).astype(float)
    df = frame(spark, x, y)
    want = networks.train_networks(df, [], classes=2, epochs=60, l2=1.0).networks[-1].loss
    got = networks.train_adam(df.coalesce(1), [(), (3, 2)], classes=2, batch_rows=60, rate=0.1, patience=3, l2=1.0, epochs=150)
    assert got[()].networks[-1].loss == pytest.approx(want, rel=0.01)
    assert got[(3, 2)].networks[-1].loss < 1.05 * want
    curve = [r["loss"] for r in got[()].curve.orderBy("epoch").collect()]
    assert len(curve) < 150 and curve[-1] < curve[0]
    again = networks.train_adam(df.coalesce(1), [()], classes=2, batch_rows=60, rate=0.1, epochs=3, fold="fold")
    assert sorted(again[()].networks) == [0, 1, 2, 3] and again[()].curve.count() == 12


def test_leading_components(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (150, 64)) * np.linspace(3, 0.1, 64) + 5
    df = frame(spark, x, np.zeros(150)).select("id", "features")
    whole = reduce.fit_components(df.select("features"), vec_col="features")
    some = reduce.fit_leading(df, 4, passes=15)
    assert np.allclose(some.variance, whole.variance[:4], rtol=1e-6)
    assert np.allclose(some.loadings, whole.loadings[:, :4], atol=1e-3)
    assert some.total == pytest.approx(whole.variance.sum())
    a = [r["ratio"] for r in some.ratio(spark).orderBy("pc").collect()]
    assert np.allclose(a, whole.variance[:4] / whole.variance.sum(), rtol=1e-6)


def test_components_of_wide_rows(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (60, 3)) @ rng.normal(0, 1, (3, 5_000)) + rng.normal(0, 0.01, (60, 5_000))
    df = frame(spark, x, np.zeros(60)).select("id", "features")
    pca = reduce.fit_leading(df, 3)
    _, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert np.allclose(pca.variance, s[:3] ** 2, rtol=1e-6)
    got = {r["id"]: r["scores"] for r in pca.project(df, 2).select("id", "scores").collect()}
    want = (x - x.mean(0)) @ pca.loadings[:, :2]
    assert np.allclose([got[i] for i in range(60)], want)
    assert np.allclose(np.abs((vt[:3] * pca.loadings.T).sum(1)), 1, atol=1e-6)


def test_exact_tree_against_all_cuts(spark, monkeypatch):
    """Every node of the tree is the best of all cuts, also with values dealt into many ranges."""
    from quarry.functions import ranking

    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 150)
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.normal(0, 1, 300), rng.integers(0, 6, 300)])
    y = ((x[:, 0] > 0.3).astype(int) + (x[:, 1] > 3) + (rng.random(300) < 0.1)) % 3
    df = frame(spark, x, y)
    for kind in ("gini", "entropy"):
        tree = trees.fit_exact_tree(df, impurity=kind, max_depth=2, min_samples_split=10)
        at = {0: np.arange(300)}
        for i in range(len(tree.n)):
            rows = at[i]
            assert tree.n[i] == len(rows) and (tree.counts[i] == np.bincount(y[rows], minlength=3)).all()
            cost = lambda r: trees._impurity(np.bincount(y[r], minlength=3).astype(float), kind) * len(r)
            assert tree.impurity[i] * len(rows) == pytest.approx(cost(rows))
            if tree.left[i] < 0:
                continue
            goes = x[rows, tree.feature[i]] <= tree.threshold[i]
            at[tree.left[i]], at[tree.right[i]] = rows[goes], rows[~goes]
            cuts = [cost(rows[x[rows, j] <= v]) + cost(rows[x[rows, j] > v]) for j in (0, 1) for v in np.unique(x[rows, j])[:-1]]
            assert cost(rows[goes]) + cost(rows[~goes]) == pytest.approx(min(cuts))
    got = {r["id"]: r["prediction"] for r in tree.transform(df).collect()}
    leaf = tree._walk(x, [2])[2]
    assert [got[i] for i in range(300)] == tree.prediction[leaf].tolist()
