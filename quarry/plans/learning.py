"""Trees, classifiers, networks, ensembles, clustering and mixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.vectors import pack
from quarry.operators import (
    classify,
    cluster,
    describe,
    encode,
    ensemble,
    evaluate,
    folds,
    hierarchy,
    mixture,
    networks,
    trees,
)
from quarry.plans import models
from quarry.plans.registry import SQL, query, rounded
from quarry.session import cut_lineage, spread, table
from quarry.sources.tables import read_matrix, write_metrics


def _emb(spark, d):
    return read_matrix(spark, f"{d}/embeddings.parquet", "embedding")


def _quality(spark, d):
    """Labelled documents: four figures of the text, quality as the class."""
    t = F.col("text")
    n = F.length(t)
    without = lambda chars: F.length(F.translate(t, chars, ""))
    figures = {
        "log_chars": F.log1p(n.cast("double")),
        "lines": F.log1p((n - without("\n") + 1).cast("double")),
        "digits": F.log1p((n - without("0123456789")).cast("double")),
        "capitals": F.log1p((n - without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("double")),
    }
    docs = spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", *[c.alias(n) for n, c in figures.items()])
    x = docs.join(table(spark, d, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")
    return x.select("doc_id", pack(list(figures)), "label")


def _flag_counts(spark, d):
    """Parts with their line counts per flag and size classes as multinomial features."""
    li = table(spark, d, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus")
    hot = encode.one_hot(li, ["l_returnflag", "l_linestatus"], {"l_returnflag": ["A", "N", "R"], "l_linestatus": ["F", "O"]})
    names = hot.columns[1:]
    sums = hot.groupBy("l_partkey").agg(*[F.sum(c).cast("double").alias(c) for c in names])
    p = table(spark, d, "part").select("p_partkey", (F.col("p_size") > 25).cast("int").alias("label"))
    x = p.join(sums, p.p_partkey == sums.l_partkey)
    return x.select("p_partkey", pack(names), "label")


# --- trees -------------------------------------------------------------------------
@query("l1_tree_depth_sweep")
def l1(spark, d):
    x = folds.kfold_shuffled(_quality(spark, d), 3, "doc_id", 2)
    return rounded(trees.depth_sweep(x, [2, 4, 6, 8, 10, 12], 3))


@query("l2_tree_min_samples_split")
def l2(spark, d):
    x = _quality(spark, d)
    tree = trees.fit_tree(x, max_depth=10, min_samples_split=40, impurity="entropy")
    p = tree.transform(x).select("label", F.col("prediction").cast("int").alias("pred"))
    return evaluate.confusion(p, "label", "pred")


@query("l3_classify_new_object")
def l3(spark, d):
    """The average object of each class, classified by the tree."""
    x = _quality(spark, d)
    tree = trees.fit_tree(x, max_depth=5)
    long = x.select("label", F.posexplode("features").alias("pos", "v")).groupBy("label", "pos").agg(F.avg("v").alias("v"))
    packed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"])
    new = long.groupBy("label").agg(packed.alias("features"))
    return rounded(tree.probabilities(tree.transform(new)).select("label", "prediction", F.get("probability", F.lit(1)).alias("share_of_1")))


@query("s11_tree_nodes")
def s11(spark, d):
    return trees.fit_tree(_quality(spark, d), max_depth=6, names=["log_chars", "lines", "digits", "capitals"]).nodes(spark)


# --- classifiers -------------------------------------------------------------------
@query("l10_logistic")
def l10(spark, d):
    x = _quality(spark, d)
    p = classify.logistic(x, c=1.0).transform(x)
    return rounded(p.select("doc_id", "label", "prediction", F.get("probability", F.lit(1)).alias("p1")), 4)


@query("l11_multinomial_logistic")
def l11(spark, d):
    x = _emb(spark, d)
    p = classify.logistic(x, "label", multinomial=True).transform(x)
    return evaluate.error_rate(p, "label", "prediction", ["label"])


_ALPHAS = [0.0, 0.1, 0.25, 0.5, 1.0, 2.0]
_NB = """WITH c AS (SELECT l_partkey, count(*) FILTER (l_returnflag = 'A') AS x0, count(*) FILTER (l_returnflag = 'N') AS x1, count(*) FILTER (l_returnflag = 'R') AS x2,
      count(*) FILTER (l_linestatus = 'F') AS x3, count(*) FILTER (l_linestatus = 'O') AS x4 FROM lineitem GROUP BY 1),
    p AS (SELECT p_partkey, CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS label, x0, x1, x2, x3, x4,
      CAST(floor(CAST('0x' || substr(md5(CAST(p_partkey AS VARCHAR) || ':9'), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE * 4) AS INT) AS fold FROM part JOIN c ON l_partkey = p_partkey),
    s AS (SELECT k, a, label AS cls, count(*) AS n, sum(x0) + a AS s0, sum(x1) + a AS s1, sum(x2) + a AS s2, sum(x3) + a AS s3, sum(x4) + a AS s4
      FROM p JOIN range(4) r(k) ON fold <> k CROSS JOIN (VALUES (0.0::DOUBLE), (0.1), (0.25), (0.5), (1.0), (2.0)) v(a) GROUP BY 1, 2, 3),
    l AS (SELECT k, a, cls, {prior} AS lp, ln(s0 / (s0 + s1 + s2 + s3 + s4)) AS w0, ln(s1 / (s0 + s1 + s2 + s3 + s4)) AS w1, ln(s2 / (s0 + s1 + s2 + s3 + s4)) AS w2,
      ln(s3 / (s0 + s1 + s2 + s3 + s4)) AS w3, ln(s4 / (s0 + s1 + s2 + s3 + s4)) AS w4 FROM s),
    e AS (SELECT k, a, fold, label, arg_max(cls, round(lp + x0 * w0 + x1 * w1 + x2 * w2 + x3 * w3 + x4 * w4, 9)) AS pred FROM p CROSS JOIN l GROUP BY p_partkey, k, a, fold, label)
    SELECT a AS alpha, CAST(k AS INT) AS fold, CASE WHEN fold = k THEN 'test' ELSE 'train' END AS split,
      round(avg(CASE WHEN pred <> label THEN 1.0::DOUBLE ELSE 0 END), 6) AS error, count(*) AS n FROM e GROUP BY 1, 2, 3"""


@query("l14_naive_bayes_sweep", _NB.format(prior="ln(n / sum(n) OVER (PARTITION BY k, a))"))
def l14(spark, d):
    x = folds.kfold_shuffled(_flag_counts(spark, d), 4, "p_partkey", 9)
    return rounded(classify.bayes_sweep(x, _ALPHAS))


@query("l15_naive_bayes_given_priors", _NB.format(prior="ln(CASE WHEN cls = 0 THEN 0.3::DOUBLE ELSE 0.7::DOUBLE END)"))
def l15(spark, d):
    """Priors that differ from the shares of the classes."""
    x = folds.kfold_shuffled(_flag_counts(spark, d), 4, "p_partkey", 9)
    return rounded(classify.bayes_sweep(x, _ALPHAS, priors=[0.3, 0.7]))


@query("l16_network_classifier")
def l16(spark, d):
    x = folds.kfold_shuffled(_quality(spark, d), 3, "doc_id", 2)
    net = networks.train_networks(x, [6, 6], fold="fold", classes=2, epochs=15, l2=1e-4)
    return evaluate.error_rate(networks.predict_by_fold(x, net), "label", "prediction", ["fold"])


@query("l16_network_adam")
def l16_adam(spark, d):
    """Sixteen pairs of hidden layers on three folds, trained together to their own stopping rule."""
    x = folds.kfold_shuffled(_quality(spark, d), 3, "doc_id", 2)
    pairs_ = [(a, b) for a in (2, 4, 6, 8) for b in (2, 4, 6, 8)]
    scored, out = cut_lineage(x, "scored"), None  # the texts are read once for all networks
    for hidden, net in networks.train_adam(x, pairs_, fold="fold", classes=2, rate=0.05, tol=5e-3, patience=3, cuts=1).items():
        error = evaluate.error_rate(networks.predict_by_fold(scored, net), "label", "prediction", ["fold"])
        part = error.select(F.lit(hidden[0]).alias("first"), F.lit(hidden[1]).alias("second"), *error.columns)
        out = part if out is None else out.unionByName(part)
    return out


def _regression(spark, d):
    x = folds.kfold_shuffled(_quality(spark, d), 3, "doc_id", 2)
    return x, networks.train_networks(x, [3], fold="fold", restarts=2, goal=0.01, epochs=15)


@query("l17_network_regression")
def l17(spark, d):
    x, net = _regression(spark, d)
    p = networks.predict_by_fold(x, net).withColumn("cls", encode.threshold(F.col("prediction")))
    sq = (F.col("prediction") - F.col("label")) * (F.col("prediction") - F.col("label"))
    return p.groupBy("fold").agg(F.avg(sq).alias("mse"), F.avg(evaluate.miss("label", "cls")).alias("error"))


@query("e10_learning_curve")
def e10(spark, d):
    return _regression(spark, d)[1].curve


@query("l18_random_forest")
def l18(spark, d):
    x = _quality(spark, d)
    p = classify.forest(x, trees=10, depth=8).transform(x)
    return evaluate.error_rate(p, "label", "prediction", ["label"])


@query("l19_bagging")
def l19(spark, d):
    return ensemble.bagging(_quality(spark, d), 100, id_col="doc_id").rounds


@query("l20_adaboost")
def l20(spark, d):
    return ensemble.adaboost(_quality(spark, d), 100).rounds


@query("l20_adaboost_redrawn")
def l20r(spark, d):
    return ensemble.adaboost(_quality(spark, d), 20, redraw="doc_id").rounds


@query("l21_voting_ensemble")
def l21(spark, d):
    x = _quality(spark, d)
    members = [trees.fit_tree(x, max_depth=k) for k in (2, 4, 6)]
    out = ensemble.VotingEnsemble(members, [0.5, 0.3, 0.2]).transform(x)
    return rounded(out.select("doc_id", "prediction", "probability"))


@query("l23_classifier_sweep")
def l23(spark, d):
    x = folds.kfold_shuffled(_quality(spark, d), 3, "doc_id", 2)

    def fit(train, c):
        return classify.logistic(train, c=c).transform

    return evaluate.sweep(x, fit, [0.01, 1.0, 100.0], 3)


# --- clusters ----------------------------------------------------------------------
_VALID = """WITH c AS ({src}), g AS (SELECT i, j, count(*)::DOUBLE AS n FROM c GROUP BY 1, 2),
    r AS (SELECT i, n, sum(n) OVER (PARTITION BY i) AS mi, sum(n) OVER (PARTITION BY j) AS mj, j FROM g), t AS (SELECT sum(n) AS t FROM g),
    ci AS (SELECT i, any_value(mi) AS m, sum(n / mi * log2(n / mi + 2.22e-16)) AS pl, sum(n / mi * log2(n / mi)) AS ps, max(n / mi) AS top FROM r GROUP BY 1),
    cj AS (SELECT j, any_value(mj) AS m FROM r GROUP BY 1),
    a AS (SELECT t, (SELECT sum(m * (1 - pl)) / (t * count(*)) FROM ci) AS er, (SELECT -sum(m * ps) / t FROM ci) AS es, (SELECT avg(top) FROM ci) AS pu,
      (SELECT sum(n * (n - 1) / 2) FROM g) AS f11, (SELECT sum(m * (m - 1) / 2) FROM ci) AS si, (SELECT sum(m * (m - 1) / 2) FROM cj) AS sj,
      (SELECT sum(n / t * ln(n * t / (mi * mj))) FROM r) AS mi, (SELECT -sum(m / t * ln(m / t)) FROM ci) AS hi, (SELECT -sum(m / t * ln(m / t)) FROM cj) AS hj FROM t)
    SELECT round(er, 6) AS entropy_ref, round(es, 6) AS entropy, round(pu, 6) AS purity, round((t * (t - 1) / 2 - si - sj + 2 * f11) / (t * (t - 1) / 2), 6) AS rand,
      round(f11 / (si + sj - f11), 6) AS jaccard, round(mi / {norm}, 6) AS nmi FROM a"""


@query("c3_cluster_validity", _VALID.format(src="SELECT p_type AS i, p_brand AS j FROM part", norm="((hi + hj) / 2)"))
def c3(spark, d):
    return rounded(cluster.cluster_validity(table(spark, d, "part"), "p_type", "p_brand"))


@query(
    "c3_cluster_validity_geometric",
    _VALID.format(src="SELECT l_returnflag AS i, l_linestatus AS j FROM lineitem", norm="sqrt(hi * hj)"),
)
def c3g(spark, d):
    return rounded(cluster.cluster_validity(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus", normalizer="geometric"))


@query("c1_kmeans")
def c1(spark, d):
    x = _emb(spark, d)
    km = cluster.kmeans(x, 10, n_init=2, max_iter=50)
    return describe.contingency(km.assign(x), "cluster", "label")


@query(
    "c1_kmeans_one_cluster",
    """SELECT 1 AS k, round(sum(v), 4) AS inertia FROM (SELECT pos, var_pop(x) * count(*) AS v FROM
    (SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1)""",
)
def c1one(spark, d):
    km = cluster.kmeans(_emb(spark, d), 1)
    return rounded(spark.createDataFrame([(1, km.inertia)], "k int, inertia double"), 4)


@query("c2_replace_by_centroid")
def c2(spark, d):
    x = _emb(spark, d)
    return cluster.kmeans(x, 10, max_iter=50).replace(x).select("vec_id", "cluster", "features")


@query("c4_validity_sweep")
def c4(spark, d):
    return cluster.validity_sweep(_emb(spark, d), range(1, 11), "label")


@query(
    "c7_single_linkage_heights",
    """WITH RECURSIVE s AS (SELECT s_suppkey AS id, s_acctbal AS v, lag(s_acctbal) OVER (ORDER BY s_acctbal, s_suppkey) AS p FROM supplier)
    SELECT row_number() OVER (ORDER BY v - p) - 1 AS merge, round(v - p, 4) AS height FROM s WHERE p IS NOT NULL""",
)
def c7(spark, d):
    """On one attribute the spanning tree joins neighbours in sorted order."""
    s = table(spark, d, "supplier").select("s_suppkey", pack(["s_acctbal"]))
    tree = hierarchy.spanning_tree(s, "s_suppkey")
    return rounded(hierarchy.linkage_table(tree).select("merge", "height"), 4)


@query(
    "c7_linkage_across_cells",
    """WITH s AS (SELECT o_orderkey, o_totalprice::DOUBLE AS v, lag(o_totalprice::DOUBLE) OVER (ORDER BY o_totalprice, o_orderkey) AS p FROM orders)
    SELECT row_number() OVER (ORDER BY v - p) - 1 AS merge, round(v - p, 3) AS height FROM s WHERE p IS NOT NULL""",
)
def c7_cells(spark, d):
    """More rows than one block holds: trees of cells, and of the rows along their borders."""
    o = table(spark, d, "orders").select("o_orderkey", pack(["o_totalprice"]))
    tree = hierarchy.spanning_tree(o, "o_orderkey")
    return rounded(hierarchy.linkage_table(tree).select("merge", "height"), 3)


@query("c5_single_linkage")
def c5(spark, d):
    x = _emb(spark, d)
    return hierarchy.cut_tree(x, hierarchy.spanning_tree(x, "vec_id"), 10, "vec_id")


@query("c6_ward")
def c6(spark, d):
    x = _emb(spark, d)
    clusters, _ = hierarchy.ward(x, 17, id_col="vec_id")
    return describe.cluster_class_share(clusters.join(x.select("vec_id", "label"), "vec_id"), "cluster", "label")


@query("c6_ward_tree")
def c6_tree(spark, d):
    x = _emb(spark, d)
    clusters = hierarchy.cut_tree(x, hierarchy.ward_tree(x, "vec_id"), 17, "vec_id")
    return describe.cluster_class_share(clusters.join(x.select("vec_id", "label"), "vec_id"), "cluster", "label")


@query("c7_ward_merges")
def c7w(spark, d):
    return hierarchy.ward(_emb(spark, d), 17, id_col="vec_id")[1]


# --- mixtures ----------------------------------------------------------------------
def _plane(spark, d):
    """Customers in two standardised figures: balance and number of orders."""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"), F.avg("o_totalprice").alias("spend"))
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    x = c.join(o, c.c_custkey == o.o_custkey).select("c_custkey", "c_mktsegment", "c_acctbal", "orders", "spend")
    x = x.withColumn("orders", F.col("orders").cast("double"))
    x = encode.standardize(x, ["c_acctbal", "orders", "spend"])
    return x.select("c_custkey", F.col("c_mktsegment").alias("label"), pack(["c_acctbal", "orders", "spend"]))


@query("c8_mixture")
def c8(spark, d):
    return mixture.fit_mixtures(_plane(spark, d), [3], "c_custkey", restarts=3, max_iter=500)[(3, -1)].table(spark)


@query("c8_mixture_diagonal")
def c8d(spark, d):
    return mixture.fit_mixtures(_plane(spark, d), [3], "c_custkey", diagonal=True, restarts=3, max_iter=500)[(3, -1)].table(spark)


@query(
    "c9_log_likelihood",
    """WITH o AS (SELECT o_custkey, count(*)::DOUBLE AS n, avg(o_totalprice) AS s FROM orders GROUP BY 1),
    x AS (SELECT c_custkey, (c_acctbal - avg(c_acctbal) OVER ()) / stddev_samp(c_acctbal) OVER () AS a, (n - avg(n) OVER ()) / stddev_samp(n) OVER () AS b,
      (s - avg(s) OVER ()) / stddev_samp(s) OVER () AS c FROM customer JOIN o ON o_custkey = c_custkey),
    v AS (SELECT var_pop(a) + 1e-6 AS va, var_pop(b) + 1e-6 AS vb, var_pop(c) + 1e-6 AS vc FROM x)
    SELECT c_custkey, 0 AS cluster, round(-0.5 * (3 * ln(2 * pi()) + ln(va) + ln(vb) + ln(vc) + a * a / va + b * b / vb + c * c / vc), 5) AS log_density FROM x, v""",
)
def c9(spark, d):
    """One diagonal component has a closed form, so every row's log density is known."""
    x = _plane(spark, d)
    g = mixture.fit_mixtures(x, [1], "c_custkey", diagonal=True)[(1, -1)]
    return rounded(g.score(x, "c_custkey").drop("responsibilities"), 5)


@query("c10_component_selection")
def c10(spark, d):
    x = folds.kfold_shuffled(_plane(spark, d), 5, "c_custkey", 3)
    return mixture.select_components(x, range(1, 11), 5, "c_custkey", max_iter=500)


@query("c11_out_of_fold_clusters")
def c11(spark, d):
    x = folds.kfold_shuffled(_plane(spark, d), 5, "c_custkey", 3)
    a = mixture.out_of_fold_clusters(x, 3, 5, "c_custkey", max_iter=500)
    return describe.cluster_class_share(a.join(x.select("c_custkey", "label"), "c_custkey"), "cluster", "label")


# --- sinks -------------------------------------------------------------------------
def _round_trip(spark, df, fmt):
    from quarry.session import shared_path

    path = shared_path(spark, "report")
    write_metrics(df, path, fmt)
    return spark.read.schema(df.schema).format(fmt).load(path)


@query("s8_interval_sink", SQL["e9_paired_comparison"])
def s8(spark, d):
    return _round_trip(spark, models.e9(spark, d), "json")


@query("s9_mixture_sink")
def s9(spark, d):
    return _round_trip(spark, c8(spark, d), "parquet")


@query("s10_score_table_sink")
def s10(spark, d):
    return _round_trip(spark, c10(spark, d), "csv")


@query(
    "s6_chunked_basket_export",
    "SELECT count(*) AS baskets, true AS bounded FROM part",
)
def s6(spark, d):
    """Baskets written in files of bounded length, counted after reading them back."""
    from quarry.session import shared_path
    from quarry.sources.text import write_baskets

    p = table(spark, d, "part").select((F.col("p_size") > 25).cast("int").alias("big"), (F.col("p_retailprice") > 1000).cast("int").alias("dear"))
    path = shared_path(spark, "baskets")
    write_baskets(p, path, ["big", "dear"], ["big", "dear"], rows_per_file=1_000)
    files = spark.read.text(path).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    return files.agg(F.sum("n").alias("baskets"), (F.max("n") <= 1_000).alias("bounded"))


# --- splits on an attribute with a value per row ----------------------------------------
def _cuts_sql(rows: str, name: str) -> str:
    """The best Gini cut of each ``part`` of (part, v, y), with the value after it."""
    return f"""{name}_c AS (SELECT part, v, sum(y)::DOUBLE AS p, count(*)::DOUBLE AS n FROM {rows} GROUP BY 1, 2),
    {name}_r AS (SELECT part, v, sum(p) OVER w AS pl, sum(n) OVER w AS nl, sum(p) OVER q AS pt, sum(n) OVER q AS nt, lead(v) OVER o AS next FROM {name}_c
      WINDOW o AS (PARTITION BY part ORDER BY v), w AS (PARTITION BY part ORDER BY v ROWS UNBOUNDED PRECEDING), q AS (PARTITION BY part)),
    {name} AS (SELECT part, (v + next) / 2 AS t, nt AS n, pt / nt AS share FROM {name}_r WHERE next IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY part ORDER BY round(nl - (pl * pl + (nl - pl) * (nl - pl)) / nl
        + (nt - nl) - ((pt - pl) * (pt - pl) + (nt - nl - pt + pl) * (nt - nl - pt + pl)) / (nt - nl), 9), v) = 1)"""


@query(
    "l1_exact_splits",
    f"""WITH x AS (SELECT 0 AS part, l_extendedprice::DOUBLE AS v, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS y FROM lineitem),
    {_cuts_sql("x", "top")},
    z AS (SELECT CASE WHEN x.v <= t THEN 1 ELSE 2 END AS part, x.v, y FROM x CROSS JOIN top), {_cuts_sql("z", "low")}
    SELECT CAST(part AS INT) AS node_id, round(t, 3) AS threshold, CAST(n AS BIGINT) AS n, round(2 * share * (1 - share), 6) AS impurity
    FROM (SELECT * FROM top UNION ALL SELECT * FROM low)""",
)
def l1_exact(spark, d):
    """Two levels on the price of a line: more values than any number of bins holds."""
    x = table(spark, d, "lineitem").select(pack(["l_extendedprice"]), (F.col("l_quantity") > 25).cast("int").alias("label"))
    nodes = trees.fit_exact_tree(x, max_depth=2).nodes(spark)
    return rounded(nodes.filter("depth < 2").select("node_id", F.round("threshold", 3).alias("threshold"), "n", "impurity"))
