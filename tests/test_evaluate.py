import numpy as np
import pytest

from quarry.functions.stats import t_quantile
from quarry.operators import evaluate

# fixed values: recorded test errors of nested 5 x 5 cross-validation (rows inner, columns outer)
TREE = [
    [0.33714223, 0.30376459, 0.40980598, 0.32374605, 0.30830112],
    [0.39223302, 0.3192705, 0.41889733, 0.33933123, 0.36933086],
    [0.31874611, 0.41101328, 0.31266692, 0.30036219, 0.40504994],
    [0.36823556, 0.40747922, 0.30054695, 0.3326809, 0.40744264],
    [0.3252907, 0.38508912, 0.29611405, 0.33349187, 0.39372321],
]
NETWORK = [
    [0.0, 0.0, 1.21949732e-05, 7.25600907e-04, 2.43899465e-05],
    [4.87798929e-05, 0.0, 3.04874331e-05, 1.82924598e-05, 1.21949732e-05],
    [3.65849197e-05, 1.82924598e-05, 6.09748662e-06, 0.0, 7.92673260e-05],
    [2.43900952e-05, 1.21950476e-05, 1.07926171e-03, 1.21950476e-05, 0.0],
    [5.48777142e-05, 4.26826666e-05, 1.82925714e-05, 0.0, 1.64633142e-04],
]


def nested(spark):
    rows = [
        (m, i, o, float(e))
        for m, t in (("tree", TREE), ("network", NETWORK))
        for i, r in enumerate(t)
        for o, e in enumerate(r)
    ]
    return spark.createDataFrame(rows, "model string, inner int, outer int, error double")


def test_recorded_intervals(spark):
    got = {r["model"]: r for r in evaluate.accuracy_interval(nested(spark), 5).collect()}
    t = got["tree"]
    assert [t[c] for c in ("mean", "sigma", "lower", "upper")] == pytest.approx(
        [0.6472097779, 0.0056845996, 0.6314267992, 0.6629927566], abs=2e-8
    )
    n = got["network"]
    assert [n[c] for c in ("mean", "sigma", "lower", "upper")] == pytest.approx(
        [0.9999031716, 3.97950767e-05, 0.9997926827, 1.0000136604], abs=2e-8
    )


def test_recorded_comparison(spark):
    m = nested(spark).withColumnRenamed("inner", "fold")
    r = evaluate.compare_models(m, "network", "tree", 5).first()
    assert [r[c] for c in ("mean", "sigma", "lower", "upper")] == pytest.approx(
        [0.3526933937, 0.0056865797, 0.3369049173, 0.3684818700], abs=2e-8
    )
    assert r["different"] is True
    same = evaluate.compare_models(m.filter("model = 'tree'"), "tree", "tree", 5).first()
    assert same["different"] is False


def test_t_quantiles():
    table = {(0.975, 1): 12.7062, (0.975, 2): 4.30265, (0.975, 9): 2.26216, (0.95, 10): 1.81246, (0.995, 30): 2.75000}
    for (p, df), v in table.items():
        assert t_quantile(p, df) == pytest.approx(v, abs=2e-4)
    assert t_quantile(0.025, 4) == -t_quantile(0.975, 4)


@pytest.mark.parametrize("buckets", [None, 7])
def test_auc_is_the_rank_statistic(spark, buckets, monkeypatch):
    from quarry.functions import ranking

    if buckets:
        monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 5)
    rng = np.random.default_rng(1)
    score, y = rng.integers(0, 25, 200) / 25, rng.integers(0, 2, 200)
    df = spark.createDataFrame([(float(s), int(v)) for s, v in zip(score, y)], "score double, y int")
    pos, neg = score[y == 1], score[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert evaluate.auc(df, "score", "y").first()["auc"] == pytest.approx(want)
    pts = evaluate.roc_points(df, "score", "y").orderBy("fpr", "tpr").collect()
    x = np.array([0] + [p["fpr"] for p in pts])
    t = np.array([0] + [p["tpr"] for p in pts])
    assert ((x[1:] - x[:-1]) * (t[1:] + t[:-1]) / 2).sum() == pytest.approx(want)


def test_weighted_error_and_report(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)], "y int, p int")
    priors = spark.createDataFrame([(0, 0.5), (1, 0.25), (2, 0.25)], "y int, prior double")
    assert evaluate.weighted_error(df, "y", "p", priors).first()[0] == pytest.approx(0.2 * 0.5 + 0.2 * 0.25)
    rep = {r["cls"]: r for r in evaluate.class_report(evaluate.confusion(df, "y", "p")).collect()}
    assert rep["2"]["precision"] == 0 and rep["2"]["support"] == 1
    assert rep["1"]["precision"] == pytest.approx(2 / 3)
    assert rep["weighted average"]["recall"] == pytest.approx(3 / 5)
    acc = evaluate.accuracy(evaluate.confusion(df, "y", "p")).first()
    assert acc["accuracy"] == pytest.approx(60) and acc["error_rate"] == pytest.approx(40)
