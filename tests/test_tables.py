import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import ranking
from quarry.operators import describe, encode, folds, rules, topk
from quarry.sources import tables
from quarry.sources import text as sources


@pytest.fixture()
def small_buckets(monkeypatch):
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 7)


def numbers(spark, n=200, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(int(i), int(i) // 3 % 3, float(v)) for i, v in zip(rng.permutation(n) * 3, rng.integers(0, 40, n))]
    return spark.createDataFrame(rows, "id long, g int, v double").repartition(6)


def test_row_index_is_the_sorted_position(spark, small_buckets):
    rows = ranking.with_row_index(numbers(spark), ["id"]).collect()
    assert [r["row_index"] for r in sorted(rows, key=lambda r: r["id"])] == list(range(200))


def test_quantiles_with_a_crowded_value(spark, small_buckets):
    df = numbers(spark).unionByName(spark.range(100).select(F.col("id"), F.lit(1).alias("g"), F.lit(7.0).alias("v")))
    got = {r["g"]: r for r in ranking.exact_quantiles(df, "v", [0.1, 0.5, 0.9], ["g"]).collect()}
    for g in (0, 1, 2):
        v = np.array([r["v"] for r in df.filter(F.col("g") == g).collect()])
        np.testing.assert_allclose(got[g]["q"], np.quantile(v, [0.1, 0.5, 0.9]))
        assert got[g]["n"] == len(v)


@pytest.mark.parametrize("n, k", [(10, 3), (200, 7), (5, 5), (3, 5)])
def test_kfold_sizes(spark, small_buckets, n, k):
    df = spark.range(n)
    got = [r["fold"] for r in folds.kfold(df, k, "id").orderBy("id").collect()]
    want = np.concatenate([np.full(len(p), i) for i, p in enumerate(np.array_split(np.arange(n), k))])
    assert got == want.tolist()


def test_folds_do_not_depend_on_partitions(spark, small_buckets):
    df = numbers(spark)
    for f in (
        lambda x: folds.kfold_shuffled(x, 4, "id", 9, exact=True),
        lambda x: folds.stratified_kfold(x, 4, "g", "id"),
        lambda x: folds.kfold_shuffled(x, 4, "id", 9),
    ):
        a = {r["id"]: r["fold"] for r in f(df.repartition(1)).collect()}
        b = {r["id"]: r["fold"] for r in f(df.orderBy(F.rand(3)).repartition(8)).collect()}
        assert a == b and set(a.values()) == {0, 1, 2, 3}


def test_nested_folds_partition_the_training_part(spark, small_buckets):
    x = folds.nested_folds(spark.range(23), 4, 3, "id").collect()
    for o in range(4):
        train = [r for r in x if r["outer_fold"] == o and not r["is_test"]]
        test = [r for r in x if r["outer_fold"] == o and r["is_test"]]
        assert len(train) + len(test) == 23 and all(r["inner_fold"] is None for r in test)
        sizes = np.bincount([r["inner_fold"] for r in train])
        assert sizes.max() - sizes.min() <= 1 and len(sizes) == 3


def test_bootstrap(spark, small_buckets):
    df = spark.createDataFrame([(i, 100.0 if i == 5 else (0.0 if i == 6 else 1.0)) for i in range(50)], "id long, w double")
    got = {r["id"]: r["copies"] for r in folds.bootstrap(df, 1000, "id", 3, "w").collect()}
    assert sum(got.values()) == 1000 and 6 not in got
    assert 600 < got[5] < 750  # expected 676
    even = folds.bootstrap(df, 5000, "id", 4).collect()
    assert sum(r["copies"] for r in even) == 5000 and len(even) == 50


def test_poisson_copies(spark):
    c = spark.range(20_000).select(folds.poisson_copies("id", 1).alias("c")).agg(F.avg("c"), F.var_samp("c"), F.min("c")).first()
    assert c[0] == pytest.approx(1, abs=0.03) and c[1] == pytest.approx(1, abs=0.05) and c[2] == 0


def test_histograms_close_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 4, 10)], "v double")
    assert [r["cnt"] for r in describe.histogram(df, "v", 5).orderBy("bin").collect()] == [2, 2, 1, 0, 1]
    d = describe.density_histogram(df, "v", [0, 5, 10]).orderBy("bin").collect()
    assert [r["density"] for r in d] == pytest.approx([5 / 30, 1 / 30])
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert sum(r["cnt"] for r in describe.histogram(flat, "v", 4).collect()) == 2


def test_summary_of_ten_numbers(spark):
    x = [-0.68, -2.11, 2.39, 0.26, 1.46, 1.33, 1.03, -0.41, -0.33, 0.47]
    r = describe.summary(spark.createDataFrame([(v,) for v in x], "x double"), ["x"]).first()
    assert [r[c] for c in ("mean", "std", "median", "range", "variance")] == pytest.approx(
        [np.mean(x), np.std(x, ddof=1), np.median(x), np.ptp(x), np.var(x, ddof=1)]
    )


def test_zero_rows_and_columns(spark):
    df = spark.createDataFrame([(1, 0, 0, 0), (2, 3, 0, -1), (3, 0, 0, 4)], "id int, a int, b int, c int")
    out = encode.drop_zero_rows_and_columns(df, ["a", "b", "c"])
    assert out.columns == ["id", "a", "c"] and {r["id"] for r in out.collect()} == {2, 3}


def test_one_hot_order(spark):
    df = spark.createDataFrame([(1, "b", 2), (2, "a", 1)], "id int, s string, r int")
    out = encode.one_hot(df, ["s", "r"])
    assert out.columns == ["id", "s_a", "s_b", "r_1", "r_2"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 0, 1, 0, 1), (2, 1, 0, 1, 0)]
    with pytest.raises(ValueError):
        encode.levels(spark.range(50), "id", limit=10)


def test_binarize(spark):
    df = spark.createDataFrame([(1, [1.0, 5.0]), (2, [2.0, 6.0]), (3, [3.0, 1.0])], "id int, features array<double>")
    got = {r["id"]: r["features"] for r in encode.binarize(df).collect()}
    assert got == {1: [0, 0], 2: [0, 1], 3: [1, 0]}
    one = encode.binarize(spark.createDataFrame([([1.0, 2.0, 4.0, 9.0],)], "features array<double>"), single_row=True)
    assert one.first()[0] == [0, 0, 1, 1]


def test_letters(spark):
    df = spark.createDataFrame([(" Anna ",), ("Bob",)], "name string")
    assert [r[1:] for r in encode.letter_features(df, "name").collect()] == [(1, 14, 14, 1)]


def test_best_row_takes_the_first_of_ties(spark):
    df = spark.createDataFrame([("m", 3, 1.0), ("m", 2, 1.0), ("m", 9, 5.0)], "model string, p int, e double")
    assert topk.best_row(df, "e", "p", ["model"]).first()["p"] == 2
    assert topk.best_row(df, "e", "p", largest=True).first()["p"] == 9


# --- baskets ---------------------------------------------------------------------
COURSES = "2,5,6,7,8\n1,2,3,6,7,8\n2,4,6,8\n3,6,7\n2,6,7\n2,3,6,7,8\n"


def test_courses(spark, tmp_path):
    (tmp_path / "courses.txt").write_text(COURSES)
    mined = rules.Mined(sources.read_baskets(spark, str(tmp_path / "courses.txt")), 0.8)
    sets = {tuple(r["items"]): r["freq"] for r in mined.itemsets().collect()}
    assert sets == {("2",): 5, ("6",): 6, ("7",): 5, ("2", "6"): 5, ("6", "7"): 5}
    got = {(tuple(r["antecedent"]), tuple(r["consequent"])) for r in mined.rules(1.0, 4).collect()}
    assert got == {((), ("6",)), (("2",), ("6",)), (("7",), ("6",))}
    body = {tuple(r["antecedent"]): r["support"] for r in mined.rules(1.0, support_mode="body").collect()}
    assert body[()] == 1 and body[("2",)] == pytest.approx(5 / 6)
    only = mined.rules(0.02, 1).collect()
    assert len(only) == 3 and all(r["confidence"] == r["support"] and not r["antecedent"] for r in only)


def test_supports_shrink_with_size(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [str(j) for j in range(8) if rng.random() < 0.5]) for i in range(80)]
    b = spark.createDataFrame(rows, "basket_id long, items array<string>")
    got = {frozenset(r["items"]): r["freq"] for r in rules.Mined(b, 0.1).itemsets().collect()}
    for s, f in got.items():
        assert f == sum(s <= set(items) for _, items in rows)
        for i in s:
            if len(s) > 1:
                assert got[s - {i}] >= f


BINARY = ["01001111", "11100111", "01010101", "00100110", "01000110", "01100111"]


@pytest.mark.parametrize("titles, first", [(None, "1,4,5,6,7"), (list("abcdefgh"), "b,e,f,g,h")])
def test_basket_sink(spark, tmp_path, titles, first):
    cols = [f"c{i}" for i in range(8)]
    rows = [(i, *map(int, r)) for i, r in enumerate([*BINARY, "00000000"])]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} int" for c in cols))
    lines = [r["line"] for r in sources.basket_lines(df, cols, titles).orderBy("id").collect()]
    assert lines[0] == first and lines[-1] == "" and len(lines) == 7
    sources.write_baskets(df.coalesce(1), str(tmp_path / "out"), cols, titles, rows_per_file=3)
    assert len(list((tmp_path / "out").glob("part-*"))) == 3
    assert spark.read.text(str(tmp_path / "out")).count() == 7


def test_recorded_lines(spark):
    lines = spark.createDataFrame([("82 86[Sup. 3]",), ("54[Sup. 8]",)], "text string")
    assert [(r[0], r[1]) for r in sources.parse_itemsets(lines).collect()] == [(["82", "86"], 3.0), (["54"], 8.0)]
    got = sources.parse_rules(spark.createDataFrame([("87 <- [Conf. 5,Sup. 5]",), ("6 <- 2 7[Conf. 100,Sup. 66.7]",)], "text string"))
    assert [tuple(r) for r in got.collect()] == [(["87"], [], 5.0, 5.0), (["6"], ["2", "7"], 100.0, 66.7)]
    named = rules.readable_itemsets(sources.parse_itemsets(lines), [f"n{i}" for i in range(95)])
    assert named.first()["items"] == ["n82", "n86"]


def test_readers(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2,y\n")
    df = tables.read_table(spark, str(tmp_path / "t.csv"), "a int, b string")
    assert [tuple(r) for r in df.orderBy("a").collect()] == [(1, "x"), (2, "y")]
    (tmp_path / "n.txt").write_text("3.6  79\n1.8 54\n\n")
    assert tables.read_numbers(spark, str(tmp_path / "n.txt"), ["e", "w"]).agg(F.sum("w")).first()[0] == 133
    tables.write_metrics(df, str(tmp_path / "m"), "json")
    assert spark.read.json(str(tmp_path / "m")).count() == 2


def test_working_tables_are_released(spark):
    import os

    from quarry.session import cut_lineage, release, shared_dir

    release(spark)
    root = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    assert cut_lineage(spark.range(5)).count() == 5
    assert set(os.listdir(root)) - before
    assert release(spark) == 1 and set(os.listdir(root)) == before


def test_any_id_type_and_many_ranges(spark, monkeypatch):
    from quarry.functions import ranking
    from quarry.operators import folds

    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 1)
    df = spark.range(1500).select(F.format_string("id-%05d", "id").alias("name"))
    got = [r["fold"] for r in folds.kfold(df, 3, "name").orderBy("name").collect()]
    assert got == [i // 500 for i in range(1500)]
    tied = spark.range(40).select(F.lit(0.0).alias("h"), "id")
    assert sorted(r["i"] for r in ranking.with_row_index(tied, ["h", "id"], index="i").collect()) == list(range(40))
    assert ranking.bucketed(tied, ["h", "id"]).select("__bucket").distinct().count() > 10


def test_brackets_give_exact_quantiles(spark, monkeypatch):
    import numpy as np

    from quarry.functions import ranking

    monkeypatch.setattr(ranking, "SKETCH", 200)
    monkeypatch.setattr(ranking, "MARGIN", 0.02)
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(size=3000), np.zeros(1500), rng.exponential(size=2000)])
    g = [None if i % 3 == 0 else "hot" for i in range(len(v))]
    df = spark.createDataFrame([(a, float(b)) for a, b in zip(g, v)], "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    for r in ranking.exact_quantiles(df, "v", probs, ["g"]).collect():
        own = [b for a, b in zip(g, v) if a == r["g"]]
        assert r["n"] == len(own) and np.allclose(r["q"], np.quantile(own, probs))


def test_degenerate_tables_have_defined_results(spark):
    from quarry.functions.vectors import row_zscore
    from quarry.operators import cluster, density, describe, encode, evaluate

    one = spark.createDataFrame([(1, 2.0, "a")], "id long, x double, g string")
    flat = spark.createDataFrame([(1, 2.0, None), (2, 2.0, "a")], "id long, x double, g string")
    none = one.filter("false")
    assert [r["x"] for r in encode.standardize(flat, ["x"]).collect()] == [0.0, 0.0]
    assert encode.standardize(one, ["x"]).first()["x"] == 0.0
    assert one.select(row_zscore(F.array("x", "x")).alias("z")).first()["z"] == [0.0, 0.0]
    scores = spark.createDataFrame([(0.1, 1), (0.7, 1)], "s double, y int")
    assert evaluate.auc(scores, "s", "y").first()["auc"] is None
    assert evaluate.roc_points(scores, "s", "y").count() == 2
    assert describe.histogram(none, "x", 3).count() == 0
    assert {r["density"] for r in describe.density_histogram(one, "x", [5.0, 6.0, 7.0]).collect()} == {0.0}
    assert describe.class_priors(none, "g").count() == 0
    assert describe.class_priors(none, "g", ["a"]).first()["prior"] == 0.0
    assert {r["g"] for r in describe.boxplot(flat, ["x"], ["g"]).collect()} == {None, "a"}
    valid = cluster.cluster_validity(one, "id", "g").first()
    assert (valid["rand"], valid["jaccard"], valid["purity"]) == (1.0, 1.0, 1.0)
    pts = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [3.0])], "id long, features array<double>")
    nn = density.self_neighbours(pts, 5)
    assert {r["id"]: r["density"] for r in density.neighbour_density(nn, 5).collect()}[1] == 0.75
    assert density.relative_density(density.self_neighbours(pts, 1), 1).count() == 3
