"""Fitted operators on data whose optimum has a closed form, so that SQL can give the same values."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from quarry.functions.vectors import pack
from quarry.operators import classify, cluster, ensemble, evaluate, folds, hierarchy, mixture, networks, trees
from quarry.plans.learning import _VALID, _plane, _round_trip
from quarry.plans.registry import query, rounded
from quarry.session import table

# --- trees of depth one on attributes of few values -----------------------------------
_COSTLY = "(SELECT l_orderkey, l_quantity AS x0, l_discount AS x1, CASE WHEN l_quantity * (1 - 5 * l_discount) > 15 THEN 1 ELSE 0 END AS y FROM lineitem)"


def _costly(spark, d):
    x = table(spark, d, "lineitem")
    return x.select("l_orderkey", pack(["l_quantity", "l_discount"]), (F.col("l_quantity") * (1 - 5 * F.col("l_discount")) > 15).cast("int").alias("label"))


def _best_split(src: str, by: str = "") -> str:
    """SQL of the split with the largest drop of the Gini index, over all midpoints of both attributes."""
    part = f"PARTITION BY {by}" if by else ""
    k, ka, on = (f"{by}, ", f"a.{by}, ", f"a.{by} = b.{by}") if by else ("", "", "true")
    return f"""long AS (SELECT {k}'x0' AS f, x0 AS v, y FROM {src} UNION ALL SELECT {k}'x1', x1, y FROM {src}),
    vals AS (SELECT {k}f, v, count(*) AS n, sum(y) AS s FROM long GROUP BY ALL),
    cuts AS (SELECT {k}f, v, (v + lead(v) OVER w) / 2 AS threshold, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
      sum(n) OVER ({part + ',' if part else 'PARTITION BY'} f) AS nt, sum(s) OVER ({part + ',' if part else 'PARTITION BY'} f) AS st
      FROM vals WINDOW w AS (PARTITION BY {k}f ORDER BY v)),
    gains AS (SELECT *, nl * (2 * (sl / nl) * (1 - sl / nl)) + (nt - nl) * (2 * ((st - sl) / (nt - nl)) * (1 - (st - sl) / (nt - nl))) AS rest
      FROM cuts WHERE threshold IS NOT NULL),
    best AS (SELECT * FROM gains QUALIFY row_number() OVER ({part} ORDER BY rest, f, v) = 1)"""


@query(
    "s11_stump_nodes",
    f"""WITH {_best_split(_COSTLY)}
    SELECT 0 AS node_id, f AS feature, round(threshold, 6) AS threshold, CAST(nt AS BIGINT) AS n, CAST(st AS DOUBLE) AS ones FROM best
    UNION ALL SELECT 1, NULL, NULL, CAST(nl AS BIGINT), CAST(sl AS DOUBLE) FROM best
    UNION ALL SELECT 2, NULL, NULL, CAST(nt - nl AS BIGINT), CAST(st - sl AS DOUBLE) FROM best""",
)
def stump(spark, d):
    nodes = trees.fit_tree(_costly(spark, d), max_depth=1).nodes(spark)
    return rounded(nodes.select("node_id", "feature", "threshold", "n", F.get("class_counts", F.lit(1)).alias("ones")))


def _side(src: str) -> str:
    return f"(CASE WHEN (CASE WHEN b.f = 'x0' THEN a.x0 ELSE a.x1 END) <= b.threshold THEN (CASE WHEN 2 * sl > nl THEN 1 ELSE 0 END) ELSE (CASE WHEN 2 * (st - sl) > nt - nl THEN 1 ELSE 0 END) END)"


@query(
    "l2_stump_confusion",
    f"""WITH {_best_split(_COSTLY)}
    SELECT y AS label, {_side(_COSTLY)} AS predicted, count(*) AS cnt FROM {_COSTLY} a, best b GROUP BY ALL""",
)
def stump_confusion(spark, d):
    x = _costly(spark, d)
    p = trees.fit_tree(x, max_depth=1).transform(x).select("label", F.col("prediction").cast("int").alias("pred"))
    return evaluate.confusion(p, "label", "pred")


@query(
    "l18_forest_of_one_stump",
    f"""WITH {_best_split(_COSTLY)}
    SELECT y AS label, {_side(_COSTLY)} AS predicted, count(*) AS cnt FROM {_COSTLY} a, best b GROUP BY ALL""",
)
def forest_of_one(spark, d):
    """A forest of one tree draws no sample and looks at all attributes."""
    x = _costly(spark, d)
    p = classify.forest(x, trees=1, depth=1).transform(x).select("label", F.col("prediction").cast("int").alias("pred"))
    return evaluate.confusion(p, "label", "pred")


@query(
    "l3_stump_shares",
    f"""WITH {_best_split(_COSTLY)}
    SELECT q AS quantity, round(CASE WHEN f = 'x0' THEN (CASE WHEN q <= threshold THEN sl / nl ELSE (st - sl) / (nt - nl) END)
      ELSE (CASE WHEN 0.033::DOUBLE <= threshold THEN sl / nl ELSE (st - sl) / (nt - nl) END) END, 6) AS share_of_1
    FROM best, (SELECT CAST(unnest(range(1, 51)) AS DOUBLE) AS q)""",
)
def stump_shares(spark, d):
    """New objects, one per quantity, classified by the tree."""
    tree = trees.fit_tree(_costly(spark, d), max_depth=1)
    new = spark.range(1, 51).select(F.col("id").cast("double").alias("quantity"))
    new = new.select("quantity", F.array("quantity", F.lit(0.033)).alias("features"))
    return rounded(tree.probabilities(new).select("quantity", F.get("probability", F.lit(1)).alias("share_of_1")))


_FOLD = "CAST(floor(CAST('0x' || substr(md5(CAST({c} AS VARCHAR) || ':{s}'), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE * {k}) AS INT)"
_PARTS = f"(SELECT p_partkey, CAST(p_size AS DOUBLE) AS x0, CAST(p_size % 10 AS DOUBLE) AS x1, CASE WHEN p_size % 10 + p_partkey % 3 > 6 THEN 1 ELSE 0 END AS y, {_FOLD.format(c='p_partkey', s=2, k=3)} AS fold FROM part)"


@query(
    "l1_stump_sweep",
    f"""WITH src AS (SELECT k, fold, x0, x1, y FROM {_PARTS} JOIN range(3) r(k) ON true), tr AS (SELECT k, x0, x1, y FROM src WHERE fold <> k),
    {_best_split('tr', 'k')}
    SELECT 1 AS depth, 1 AS depth_used, CAST(a.k AS INT) AS fold, CASE WHEN a.fold = a.k THEN 'test' ELSE 'train' END AS split,
      round(avg(CASE WHEN {_side('src')} <> y THEN 1.0::DOUBLE ELSE 0 END), 6) AS error, count(*) AS n
    FROM src a JOIN best b ON a.k = b.k GROUP BY ALL""",
)
def stump_sweep(spark, d):
    x = table(spark, d, "part").select(
        "p_partkey",
        F.array(F.col("p_size").cast("double"), (F.col("p_size") % 10).cast("double")).alias("features"),
        (F.col("p_size") % 10 + F.col("p_partkey") % 3 > 6).cast("int").alias("label"),
    )
    return rounded(trees.depth_sweep(folds.kfold_shuffled(x, 3, "p_partkey", 2), [1], 3))


# --- logistic regression on cells: probabilities are shares ----------------------------
@query(
    "l10_logistic_cells",
    "SELECT l_linestatus || l_returnflag AS cell, round(avg(CASE WHEN l_shipdate < TIMESTAMP '1995-06-17' THEN 1.0::DOUBLE ELSE 0 END), 3) + 0.0 AS p1 FROM lineitem GROUP BY 1",
)
def logistic_cells(spark, d):
    """A weight per cell and hardly any penalty: the fitted probability is the share of the class."""
    cells = [a + b for a in "FO" for b in "ANR"]
    x = table(spark, d, "lineitem").select(
        F.concat("l_linestatus", "l_returnflag").alias("cell"), (F.col("l_shipdate") < F.lit("1995-06-17").cast("timestamp")).cast("int").alias("label")
    )
    hot = x.withColumn("features", F.array(*[(F.col("cell") == c).cast("double") for c in cells]))
    p = classify.logistic(hot, c=1e6).transform(hot)
    return rounded(p.groupBy("cell").agg(F.avg(F.get("probability", F.lit(1))).alias("p1")), 3)


@query(
    "l11_multinomial_cells",
    """SELECT l_linestatus AS cell, CAST(k AS INT) AS cls, round(avg(CASE WHEN c = k THEN 1.0::DOUBLE ELSE 0 END), 3) + 0.0 AS p
    FROM (SELECT l_linestatus, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS c FROM lineitem) JOIN range(3) r(k) ON true GROUP BY 1, 2""",
)
def multinomial_cells(spark, d):
    cls = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    x = table(spark, d, "lineitem").select(F.col("l_linestatus").alias("cell"), cls.alias("label"))
    hot = x.withColumn("features", F.array(*[(F.col("cell") == c).cast("double") for c in "FO"]))
    p = classify.logistic(hot, c=1e6, multinomial=True).transform(hot)
    long = p.select("cell", F.posexplode("probability").alias("cls", "p"))
    return rounded(long.groupBy("cell", "cls").agg(F.avg("p").alias("p")), 3)


# --- networks without a hidden layer are least squares ---------------------------------
_SIZE = f"(SELECT p_partkey, p_size / 50.0::DOUBLE AS x, p_retailprice / 1000.0::DOUBLE AS y, {_FOLD.format(c='p_partkey', s=2, k=3)} AS fold FROM part)"


def _linear(spark, d):
    x = table(spark, d, "part").select(
        "p_partkey", F.array(F.col("p_size") / 50.0).alias("features"), (F.col("p_retailprice") / 1000.0).alias("label")
    )
    x = folds.kfold_shuffled(x, 3, "p_partkey", 2)
    return x, networks.train_networks(x, [], fold="fold", goal=0.0, epochs=100, l2=0.0)


@query(
    "l17_network_without_hidden_layer",
    f"""WITH f AS (SELECT k, regr_intercept(y, x) AS b, regr_slope(y, x) AS w FROM {_SIZE} JOIN range(3) r(k) ON fold <> k GROUP BY k)
    SELECT fold, round(avg(pow(y - b - w * x, 2)), 5) AS mse FROM {_SIZE} JOIN f ON fold = k GROUP BY fold""",
)
def network_linear(spark, d):
    x, net = _linear(spark, d)
    p = networks.predict_by_fold(x, net)
    return rounded(p.groupBy("fold").agg(F.avg((F.col("prediction") - F.col("label")) ** 2).alias("mse")), 5)


@query(
    "e10_last_losses",
    f"""WITH f AS (SELECT k, regr_intercept(y, x) AS b, regr_slope(y, x) AS w FROM {_SIZE} JOIN range(3) r(k) ON fold <> k GROUP BY k)
    SELECT CAST(k AS INT) AS fold, round(avg(pow(y - b - w * x, 2)) / 2, 5) AS loss FROM {_SIZE} JOIN f ON fold <> k GROUP BY k""",
)
def network_losses(spark, d):
    """Where each learning curve ends: half the mean squared error of least squares."""
    curve = _linear(spark, d)[1].curve
    return rounded(curve.groupBy("fold").agg(F.min("loss").alias("loss")), 5)


@query(
    "l16_softmax_without_hidden_layer",
    """SELECT l_linestatus AS cell, CAST(arg_max(c, n) AS DOUBLE) AS prediction FROM (SELECT l_linestatus,
      CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS c, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1""",
)
def network_softmax(spark, d):
    """On one-hot cells the most probable class is the cell's most frequent one."""
    cls = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    x = table(spark, d, "lineitem").select(F.col("l_linestatus").alias("cell"), cls.alias("label"), F.lit(0).alias("fold"))
    x = x.withColumn("features", F.array(*[(F.col("cell") == c).cast("double") for c in "FO"]))
    net = networks.train_networks(x, [], classes=3, goal=0.0, epochs=60, l2=0.0).networks[-1]
    return net.transform(x).select("cell", "prediction").distinct()


# --- ensembles and sweeps of given rules ------------------------------------------------
class _Above:
    def __init__(self, pos: int, cut: float):
        self.pos, self.cut = pos, cut

    def transform(self, df):
        return df.withColumn("prediction", (F.get("features", F.lit(self.pos)) > self.cut).cast("double"))


@query(
    "l21_vote_of_rules",
    """WITH v AS (SELECT p_partkey, CASE WHEN p_size > 25 THEN 0.5::DOUBLE ELSE 0 END + CASE WHEN p_retailprice > 1000 THEN 0.3::DOUBLE ELSE 0 END
      + CASE WHEN p_size > 10 THEN 0.2::DOUBLE ELSE 0 END AS v FROM part)
    SELECT p_partkey, CASE WHEN v > 0.5 THEN 1.0::DOUBLE ELSE 0 END AS prediction, round(1 - v, 6) + 0.0 AS probability FROM v""",
)
def vote(spark, d):
    x = table(spark, d, "part").select("p_partkey", pack(["p_size", "p_retailprice"]))
    out = ensemble.VotingEnsemble([_Above(0, 25), _Above(1, 1000), _Above(0, 10)], [0.5, 0.3, 0.2]).transform(x)
    return rounded(out.select("p_partkey", "prediction", "probability"))


@query(
    "u1_sweep_of_a_given_rule",
    f"""WITH m AS (SELECT k, avg(x0) AS m FROM {_PARTS} JOIN range(3) r(k) ON fold <> k GROUP BY k)
    SELECT c AS param, CAST(k AS INT) AS fold, CASE WHEN fold = k THEN 'test' ELSE 'train' END AS split,
      round(avg(CASE WHEN (CASE WHEN x0 > c * m THEN 1 ELSE 0 END) <> y THEN 1.0::DOUBLE ELSE 0 END), 6) AS error, count(*) AS n
    FROM {_PARTS} CROSS JOIN m CROSS JOIN (VALUES (0.5::DOUBLE), (1.0), (1.5)) v(c) GROUP BY ALL""",
)
def rule_sweep(spark, d):
    """The caller's own learner: a threshold at a multiple of the training mean."""
    x = table(spark, d, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("x0"), (F.col("p_size") % 10 + F.col("p_partkey") % 3 > 6).cast("int").alias("label")
    )

    def fit(train, c):
        cut = c * train.agg(F.avg("x0")).first()[0]
        return lambda df: df.withColumn("prediction", (F.col("x0") > cut).cast("int"))

    return rounded(evaluate.sweep(folds.kfold_shuffled(x, 3, "p_partkey", 2), fit, [0.5, 1.0, 1.5], 3))


# --- groups far apart: the optimum of any clustering is the group ------------------------
_FAR = "(SELECT s_suppkey, s_nationkey % 4 AS g, (s_nationkey % 4) * 1e6::DOUBLE + s_acctbal AS v FROM supplier)"


def _far(spark, d):
    g = F.col("s_nationkey") % 4
    return table(spark, d, "supplier").select("s_suppkey", g.alias("g"), F.array(g * F.lit(1e6) + F.col("s_acctbal")).alias("features"))


_GROUPS = f"SELECT g AS least, g AS most, count(*) AS n FROM {_FAR} GROUP BY g"


def _spans(df):
    return df.groupBy("cluster").agg(F.min("g").alias("least"), F.max("g").alias("most"), F.count("*").alias("n")).drop("cluster")


@query("c1_kmeans_of_far_groups", _GROUPS)
def far_kmeans(spark, d):
    x = _far(spark, d)
    return _spans(cluster.kmeans(x, 4, n_init=5).assign(x))


@query("c2_centroids_of_far_groups", f"SELECT s_suppkey, round(avg(v) OVER (PARTITION BY g), 4) AS centre FROM {_FAR}")
def far_centroids(spark, d):
    x = _far(spark, d)
    out = cluster.kmeans(x, 4, n_init=5).replace(x)
    return rounded(out.select("s_suppkey", F.get("features", F.lit(0)).alias("centre")), 4)


def _valid(k: int, src: str) -> str:
    return f"SELECT {k} AS k, * FROM ({_VALID.format(src=src, norm='((hi + hj) / 2)')})"


@query(
    "c4_validity_of_far_groups",
    _valid(1, f"SELECT 0 AS i, g AS j FROM {_FAR}") + " UNION ALL " + _valid(4, f"SELECT g AS i, g AS j FROM {_FAR}"),
)
def far_validity(spark, d):
    return rounded(cluster.validity_sweep(_far(spark, d), [1, 4], "g"))


@query("c6_ward_of_far_groups", _GROUPS)
def far_ward(spark, d):
    x = _far(spark, d)
    clusters, _ = hierarchy.ward(x, 4, 40, "s_suppkey")
    return _spans(clusters.join(x.select("s_suppkey", "g"), "s_suppkey"))


#: One row a step: the clusters left, and the merge of the two whose union adds least scatter.
_GREEDY_WARD = """WITH RECURSIVE step(l, m) AS (
  SELECT list({'id': s_suppkey, 'n': 1.0::DOUBLE, 'v': s_acctbal::DOUBLE}), CAST(NULL AS STRUCT(cost DOUBLE, a BIGINT, b BIGINT, n DOUBLE, v DOUBLE)) FROM supplier
  UNION ALL
  SELECT list_append(list_filter(l, lambda c: c.id <> e.a AND c.id <> e.b), {'id': e.a, 'n': e.n, 'v': e.v}), e
  FROM (
    SELECT l, (
      SELECT min({'cost': (p.v - q.v) * (p.v - q.v) * (p.n * q.n / (p.n + q.n)), 'a': p.id, 'b': q.id, 'n': p.n + q.n, 'v': (p.n * p.v + q.n * q.v) / (p.n + q.n)})
      FROM (SELECT unnest(l) AS p), (SELECT unnest(l) AS q) WHERE p.id < q.id
    ) AS e FROM step WHERE len(l) > 1
  )
)
SELECT m.a AS a, m.b AS b, round(sqrt(2 * m.cost), 6) AS height, CAST(m.n AS BIGINT) AS size FROM step WHERE m IS NOT NULL"""


@query("c7_ward_tree", _GREEDY_WARD)
def ward_rounds(spark, d):
    x = table(spark, d, "supplier").select("s_suppkey", F.array("s_acctbal").alias("features"))
    return rounded(hierarchy.ward_tree(x, "s_suppkey", block=60))


@query(
    "c5_cut_at_the_largest_gaps",
    """WITH s AS (SELECT s_suppkey, s_acctbal AS v, s_acctbal - lag(s_acctbal) OVER (ORDER BY s_acctbal, s_suppkey) AS gap FROM supplier),
    c AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY gap DESC NULLS LAST) <= 9 THEN 1 ELSE 0 END AS cut FROM s),
    p AS (SELECT *, sum(cut) OVER (ORDER BY v, s_suppkey) AS part FROM c),
    n AS (SELECT part, CAST(row_number() OVER (ORDER BY min(s_suppkey)) - 1 AS INT) AS cluster FROM p GROUP BY part)
    SELECT s_suppkey, cluster FROM p JOIN n USING (part)""",
)
def cut_gaps(spark, d):
    x = table(spark, d, "supplier").select("s_suppkey", pack(["s_acctbal"]))
    return hierarchy.cut_tree(x, hierarchy.spanning_tree(x, "s_suppkey"), 10, "s_suppkey")


# --- one component has a closed form ------------------------------------------------------
_PLANE = """o AS (SELECT o_custkey, count(*)::DOUBLE AS n, avg(o_totalprice) AS s FROM orders GROUP BY 1),
    x AS (SELECT c_custkey, c_mktsegment AS label, (c_acctbal - avg(c_acctbal) OVER ()) / stddev_samp(c_acctbal) OVER () AS a,
      (n - avg(n) OVER ()) / stddev_samp(n) OVER () AS b, (s - avg(s) OVER ()) / stddev_samp(s) OVER () AS c FROM customer JOIN o ON o_custkey = c_custkey)"""
_NLL = "0.5 * (3 * ln(2 * pi()) + ln(va) + ln(vb) + ln(vc) + pow(a - ma, 2) / va + pow(b - mb, 2) / vb + pow(c - mc, 2) / vc)"
_MOMENTS = "avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, var_pop(a) + 1e-6 AS va, var_pop(b) + 1e-6 AS vb, var_pop(c) + 1e-6 AS vc"
_ONE_TABLE = f"""WITH {_PLANE}, m AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, covar_pop(a, b) AS ab, covar_pop(a, c) AS ac, covar_pop(b, c) AS bc,
      var_pop(a) + 1e-6 AS va, var_pop(b) + 1e-6 AS vb, var_pop(c) + 1e-6 AS vc FROM x)
    SELECT 0 AS component, 1.0::DOUBLE AS weight, CAST(pos AS INT) AS pos, round([va, ab, ac, ab, vb, bc, ac, bc, vc][pos + 1], 5) + 0.0 AS covariance
    FROM m, range(9) r(pos)"""


def _one(spark, d):
    g = mixture.fit_mixtures(_plane(spark, d), [1], "c_custkey")[(1, -1)]
    return g.table(spark)


def _cells(df):
    return rounded(df.select("component", "weight", F.posexplode("covariance").alias("pos", "covariance")), 5)


@query("c8_one_component", _ONE_TABLE)
def one_component(spark, d):
    return _cells(_one(spark, d))


@query("s9_one_component_sink", _ONE_TABLE)
def one_component_sink(spark, d):
    return _cells(_round_trip(spark, _one(spark, d), "parquet"))


_ONE_SCORE = f"""WITH {_PLANE}, f AS (SELECT *, {_FOLD.format(c='c_custkey', s=3, k=5)} AS fold FROM x),
    w AS (SELECT {_MOMENTS}, count(*) AS n FROM x), ll AS (SELECT sum({_NLL}) AS nll, any_value(n) AS n FROM x, w),
    h AS (SELECT k, {_MOMENTS} FROM f JOIN range(5) r(k) ON fold <> k GROUP BY k), cv AS (SELECT sum({_NLL}) AS held FROM f JOIN h ON fold = k)
    SELECT 1 AS k, round(6 * ln(n) + 2 * nll, 4) AS bic, round(12 + 2 * nll, 4) AS aic, round(2 * held, 4) AS cve FROM ll, cv"""


def _one_score(spark, d):
    x = folds.kfold_shuffled(_plane(spark, d), 5, "c_custkey", 3)
    return mixture.select_components(x, [1], 5, "c_custkey", diagonal=True)


@query("c10_one_component_criteria", _ONE_SCORE)
def one_score(spark, d):
    return rounded(_one_score(spark, d), 4)


@query("s10_criteria_sink", _ONE_SCORE)
def one_score_sink(spark, d):
    return rounded(_round_trip(spark, _one_score(spark, d), "csv"), 4)


@query("c11_one_component_share", f"WITH {_PLANE} SELECT 0 AS cluster, label, count(*) AS cnt, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS pct FROM x GROUP BY label")
def one_share(spark, d):
    from quarry.operators import describe

    x = folds.kfold_shuffled(_plane(spark, d), 5, "c_custkey", 3)
    a = mixture.out_of_fold_clusters(x, 1, 5, "c_custkey")
    return rounded(describe.cluster_class_share(a.join(x.select("c_custkey", "label"), "c_custkey"), "cluster", "label"))


# --- ensembles of cell shares ---------------------------------------------------------------
def _cdf(rate: float = 1.0) -> list[float]:
    out, term, total, i = [], math.exp(-rate), 0.0, 0
    while total < 1 - 1e-16 and i < 200:
        total += term
        out.append(total)
        i += 1
        term *= rate / i
    return out


_CELL = "(SELECT p_partkey, p_size % 5 AS cell, CASE WHEN p_partkey % 7 <= p_size % 5 THEN 1 ELSE 0 END AS y FROM part)"


def _cell_rows(spark, d):
    cell = F.col("p_size") % 5
    return table(spark, d, "part").select(
        "p_partkey", F.array(*[(cell == i).cast("double") for i in range(5)]).alias("features"), (F.col("p_partkey") % 7 <= cell).cast("int").alias("label")
    )


@query(
    "l19_bagging_of_cells",
    f"""WITH r AS (SELECT p_partkey, cell, y, CAST(k AS INT) AS k, len(list_filter([{', '.join(f'{c!r}::DOUBLE' for c in _cdf())}],
        lambda c: c <= CAST('0x' || substr(md5(CAST(p_partkey AS VARCHAR) || ':' || k), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)) AS w
      FROM {_CELL} JOIN range(3) t(k) ON true),
    m AS (SELECT k, cell, CASE WHEN sum(w * y) * 2 > sum(w) THEN 1 ELSE 0 END AS pred FROM r GROUP BY 1, 2),
    p AS (SELECT p_partkey, y, k, pred FROM r JOIN m USING (k, cell)),
    v AS (SELECT y, CASE WHEN avg(pred) > 0.5 THEN 1 ELSE 0 END AS pred FROM p GROUP BY p_partkey, y)
    SELECT k AS round, round(avg(CASE WHEN pred <> y THEN 1.0::DOUBLE ELSE 0 END), 6) AS error FROM p GROUP BY k
    UNION ALL SELECT -1, round(avg(CASE WHEN pred <> y THEN 1.0::DOUBLE ELSE 0 END), 6) FROM v""",
)
def bagged_cells(spark, d):
    """A member with a weight per cell votes for the cell's class in its own sample."""
    return rounded(ensemble.bagging(_cell_rows(spark, d), 3, id_col="p_partkey", c=1e6).rounds.select("round", "error"))


@query(
    "l20_adaboost_of_cells",
    f"""WITH c AS (SELECT p_partkey, cell, y, 1.0::DOUBLE AS w FROM {_CELL}),
    m0 AS (SELECT cell, CASE WHEN sum(w * y) * 2 > sum(w) THEN 1 ELSE 0 END AS pred FROM c GROUP BY cell),
    e0 AS (SELECT sum(CASE WHEN pred <> y THEN w ELSE 0 END) / sum(w) AS e FROM c JOIN m0 USING (cell)),
    c1 AS (SELECT cell, y, w * exp(CASE WHEN pred = y THEN -0.5 * ln((1 - e) / e) ELSE 0.5 * ln((1 - e) / e) END) AS w FROM c JOIN m0 USING (cell), e0),
    m1 AS (SELECT cell, CASE WHEN sum(w * y) * 2 > sum(w) THEN 1 ELSE 0 END AS pred FROM c1 GROUP BY cell),
    e1 AS (SELECT sum(CASE WHEN pred <> y THEN w ELSE 0 END) / sum(w) AS e FROM c1 JOIN m1 USING (cell))
    SELECT 0 AS round, round(e, 6) AS error, round(0.5 * ln((1 - e) / e), 6) AS alpha FROM e0
    UNION ALL SELECT 1, round(e, 6), round(0.5 * ln((1 - e) / e), 6) FROM e1""",
)
def boosted_cells(spark, d):
    rounds = ensemble.adaboost(_cell_rows(spark, d), 2, c=1e6).rounds
    return rounded(rounds.filter("round >= 0").select("round", "error", "alpha"))


# --- forward selection among two attributes: SQL tries every subset ---------------------------
_TWO = f"""WITH p AS (SELECT a, b, a + 0.3::DOUBLE * b + (p_partkey * 7919 % 1000) / 1000.0::DOUBLE AS y, o, i FROM (SELECT p_partkey, p_size / 50.0::DOUBLE AS a,
      (p_partkey % 7) / 7.0::DOUBLE AS b, {_FOLD.format(c='p_partkey', s=5, k=2)} AS o, {_FOLD.format(c='p_partkey', s=6, k=3)} AS i FROM part)),
    f AS (SELECT k, j, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay,
      covar_pop(b, y) AS cy, var_pop(y) AS yy FROM p, range(2) x(k), range(-1, 3) z(j) WHERE o <> k AND i <> j GROUP BY k, j),
    w AS (SELECT k, j, s, ma, mb, my, CASE s WHEN 'a' THEN ay / aa WHEN 'a,b' THEN (bb * ay - ab * cy) / (aa * bb - ab * ab) ELSE 0 END AS wa,
      CASE s WHEN 'b' THEN cy / bb WHEN 'a,b' THEN (aa * cy - ab * ay) / (aa * bb - ab * ab) ELSE 0 END AS wb FROM f, (VALUES ('a'), ('b'), ('a,b')) m(s)),
    e AS (SELECT k, s, avg(e) AS e FROM (SELECT w.k, w.j, s, avg(pow(y - my - wa * (a - ma) - wb * (b - mb), 2)) AS e FROM w JOIN p ON o <> w.k AND i = w.j GROUP BY ALL) GROUP BY k, s),
    c AS (SELECT f.k, yy, max(e) FILTER (s = 'a') AS ea, max(e) FILTER (s = 'b') AS eb, max(e) FILTER (s = 'a,b') AS eab FROM f JOIN e ON f.k = e.k AND f.j = -1 GROUP BY f.k, yy),
    sel AS (SELECT k, CASE WHEN least(ea, eb) >= yy THEN '' WHEN eab < least(ea, eb) THEN (CASE WHEN ea <= eb THEN 'a,b' ELSE 'b,a' END)
      WHEN ea <= eb THEN 'a' ELSE 'b' END AS steps FROM c)"""


def _two(spark, d):
    from quarry.operators import linear

    p = table(spark, d, "part").select("p_partkey", (F.col("p_size") / 50.0).alias("a"), (F.col("p_partkey") % 7 / 7.0).alias("b"))
    p = p.withColumn("y", F.col("a") + F.lit(0.3) * F.col("b") + F.col("p_partkey") * 7919 % 1000 / 1000.0)
    p = folds.kfold_shuffled(p, 2, "p_partkey", 5, out="outer")
    p = folds.kfold_shuffled(p, 3, "p_partkey", 6, out="inner")
    return linear.forward_selection(p, ["a", "b"], "y", "outer", "inner", 3)


@query(
    "l7_selection_of_two",
    _TWO
    + """, m AS (SELECT w.k, w.s, avg(CASE WHEN o <> w.k THEN pow(y - my - wa * (a - ma) - wb * (b - mb), 2) END) AS tr,
      avg(CASE WHEN o = w.k THEN pow(y - my - wa * (a - ma) - wb * (b - mb), 2) END) AS te FROM w CROSS JOIN p WHERE w.j = -1 GROUP BY ALL)
    SELECT CAST(k AS INT) AS fold, 'all' AS model, 'a,b' AS features, round(tr, 6) AS train_mse, round(te, 6) AS test_mse FROM m WHERE s = 'a,b'
    UNION ALL SELECT CAST(sel.k AS INT), 'selected', steps, round(tr, 6), round(te, 6) FROM sel JOIN m ON m.k = sel.k AND s = CASE steps WHEN 'b,a' THEN 'a,b' ELSE steps END
    UNION ALL SELECT CAST(k AS INT), 'none', '', round(var_pop(CASE WHEN o <> k THEN y END), 6), round(var_pop(CASE WHEN o = k THEN y END), 6) FROM p, range(2) x(k) GROUP BY k""",
)
def select_two(spark, d):
    out = _two(spark, d)
    return rounded(out.select("fold", "model", F.array_join("features", ",").alias("features"), "train_mse", "test_mse"))


@query(
    "e12_matrix_of_two",
    _TWO
    + """ SELECT CAST(k AS INT) AS fold, v AS feature, contains(steps, v) AS selected, CAST(nullif(coalesce(list_position(string_split(steps, ','), v), 0), 0) AS INT) AS step
    FROM (SELECT k, steps, unnest(['a', 'b']) AS v FROM sel)""",
)
def matrix_two(spark, d):
    from quarry.operators import linear

    out = linear.selection_matrix(_two(spark, d), ["a", "b"])
    return out.select("fold", "feature", "selected", F.nullif("step", F.lit(0)).alias("step"))
