"""Similarity, neighbours, components and densities on the embedding table and on part."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.vectors import pack
from quarry.operators import approximate, density, folds, neighbours, pairs, reduce, similarity, topk
from quarry.operators.encode import centre_vectors
from quarry.plans.registry import SQL, query, rounded
from quarry.session import table
from quarry.sources.tables import read_matrix


def _emb(spark, d):
    return read_matrix(spark, f"{d}/embeddings.parquet", "embedding")


def _prototypes(spark, d):
    """Mean vector of each class: the bounded second side of a similarity matrix."""
    x = _emb(spark, d).select("label", F.posexplode("features").alias("pos", "v"))
    x = x.groupBy("label", "pos").agg(F.avg("v").alias("v"))
    packed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"])
    return x.groupBy(F.col("label").cast("long").alias("vec_id")).agg(packed.alias("features"))


_X = """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    l AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM e),
    c AS (SELECT label AS y_id, pos, avg(x) AS y FROM l GROUP BY 1, 2),
    p AS (SELECT y_id, list(y ORDER BY pos) AS w FROM c GROUP BY 1)"""
_BIN = (
    _X
    + """, xm AS (SELECT pos, median(x) AS m FROM l GROUP BY 1), ym AS (SELECT pos, median(y) AS m FROM c GROUP BY 1),
    xb AS (SELECT vec_id, pos, CASE WHEN x > m THEN 1 ELSE 0 END AS x FROM l JOIN xm USING (pos)),
    yb AS (SELECT y_id, pos, CASE WHEN y > m THEN 1 ELSE 0 END AS y FROM c JOIN ym USING (pos))"""
)


def _sim(method):
    def run(spark, d):
        return rounded(similarity.similarity(_emb(spark, d), _prototypes(spark, d), method, "vec_id"))

    return run


query(
    "m1_simple_matching",
    _BIN + " SELECT vec_id AS x_id, y_id, round(avg(CASE WHEN x = y THEN 1.0::DOUBLE ELSE 0 END), 6) AS sim FROM xb JOIN yb USING (pos) GROUP BY 1, 2",
)(_sim("SMC"))
query(
    "m2_jaccard",
    _BIN + """ SELECT vec_id AS x_id, y_id, round(sum(x * y)::DOUBLE / sum(CASE WHEN x + y > 0 THEN 1 ELSE 0 END), 6) AS sim
    FROM xb JOIN yb USING (pos) GROUP BY 1, 2""",
)(_sim("Jaccard"))
query(
    "m3_extended_jaccard",
    _X + """ SELECT vec_id AS x_id, y_id, round(list_dot_product(v, w) / (list_dot_product(v, v) + list_dot_product(w, w) - list_dot_product(v, w)), 6) + 0.0 AS sim
    FROM e CROSS JOIN p""",
)(_sim("ExtendedJaccard"))
query(
    "m4_cosine", _X + " SELECT vec_id AS x_id, y_id, round(list_cosine_similarity(v, w), 6) + 0.0 AS sim FROM e CROSS JOIN p"
)(_sim("cos"))
query(
    "m5_correlation", _X + " SELECT vec_id AS x_id, y_id, round(corr(x, y), 6) + 0.0 AS sim FROM l JOIN c USING (pos) GROUP BY 1, 2"
)(_sim("Correlation"))


@query(
    "m6_one_against_all",
    _X + """ SELECT a.vec_id AS x_id, b.vec_id AS y_id, round(list_cosine_similarity(a.v, b.v), 6) + 0.0 AS sim
    FROM e a JOIN e b ON b.vec_id = 7 AND a.vec_id <> 7""",
)
def m6(spark, d):
    return rounded(similarity.to_one(_emb(spark, d), 7, "cos", "vec_id"))


@query(
    "m7_class_matrix",
    _X + """ SELECT a.y_id AS x_id, b.y_id, round(list_cosine_similarity(a.w, b.w), 6) + 0.0 AS sim FROM p a CROSS JOIN p b""",
)
def m7(spark, d):
    p = _prototypes(spark, d)
    return rounded(similarity.similarity(p, p, "cos", "vec_id"))


@query(
    "m8_squared_euclidean",
    _X + " SELECT vec_id AS x_id, y_id, round(pow(list_distance(v, w), 2), 6) AS sim FROM e CROSS JOIN p",
)
def m8(spark, d):
    return rounded(similarity.similarity(_emb(spark, d), _prototypes(spark, d), "sqeuclidean", "vec_id"))


def _nn_sql(k, skip=False):
    cond = "a.vec_id <> b.vec_id" if skip else "true"
    return f"""WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    nn AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, list_distance(a.v, b.v) AS distance,
      CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS INT) AS rank
      FROM e a JOIN e b ON {cond} QUALIFY rank <= {k})"""


@query("m9_nearest_neighbours", _nn_sql(5) + " SELECT query_id, rank, neighbor_id, round(distance, 6) AS distance FROM nn")
def m9(spark, d):
    x = _emb(spark, d)
    return rounded(pairs.nearest_neighbours(x, x, 5, "vec_id"))


@query(
    "m9_neighbours_of_parts",
    """WITH p AS (SELECT p_partkey AS id, p_size::DOUBLE AS a, p_retailprice AS b FROM part),
    d AS (SELECT x.id, y.id AS y_id, (x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) AS d2 FROM p x CROSS JOIN p y)
    SELECT id AS query_id, CAST(row_number() OVER (PARTITION BY id ORDER BY sqrt(d2), y_id) AS INT) AS rank, y_id AS neighbor_id, round(sqrt(d2), 6) AS distance
    FROM d QUALIFY rank <= 4""",
)
def m9p(spark, d):
    p = table(spark, d, "part").select("p_partkey", pack(["p_size", "p_retailprice"]))
    return rounded(pairs.nearest_neighbours(p, p, 4, "p_partkey"))


@query(
    "k3_most_and_least_similar",
    _X + """, s AS (SELECT a.vec_id AS x_id, b.vec_id AS y_id, list_cosine_similarity(a.v, b.v) AS sim FROM e a JOIN e b ON b.vec_id = 7 AND a.vec_id <> 7)
    (SELECT x_id, y_id, round(sim, 6) + 0.0 AS sim, 'most' AS side FROM s ORDER BY s.sim DESC, x_id LIMIT 5) UNION ALL
    (SELECT x_id, y_id, round(sim, 6) + 0.0 AS sim, 'least' AS side FROM s ORDER BY s.sim, x_id LIMIT 5)""",
)
def k3(spark, d):
    return rounded(similarity.most_and_least_similar(_emb(spark, d), 7, 5, "cos", "vec_id"))


def _vote_sql(ks, skip):
    return (
        _nn_sql(max(ks), skip)
        + f""", v AS (SELECT query_id, k, e.label, count(*) AS votes FROM nn JOIN e ON e.vec_id = neighbor_id
      JOIN (VALUES {', '.join(f'({k})' for k in ks)}) s(k) ON rank <= k GROUP BY 1, 2, 3),
    b AS (SELECT query_id, k, label AS prediction FROM v QUALIFY row_number() OVER (PARTITION BY query_id, k ORDER BY votes DESC, label) = 1)"""
    )


@query(
    "l12_knn_classifier",
    """WITH f AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, ntile(4) OVER (ORDER BY vec_id) - 1 AS fold FROM embeddings),
    nn AS (SELECT a.vec_id AS query_id, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rank
      FROM f a JOIN f b ON a.fold = 0 AND b.fold <> 0 QUALIFY rank <= 15),
    v AS (SELECT query_id, k, label, count(*) AS votes FROM nn JOIN (VALUES (1), (5), (15)) s(k) ON rank <= k GROUP BY 1, 2, 3)
    SELECT query_id, k, label AS prediction FROM v QUALIFY row_number() OVER (PARTITION BY query_id, k ORDER BY votes DESC, label) = 1""",
)
def l12(spark, d):
    x = folds.kfold(_emb(spark, d), 4, "vec_id")
    return neighbours.classify(x.filter("fold <> 0"), x.filter("fold = 0"), [1, 5, 15], "label", "vec_id")


@query(
    "l13_leave_one_out_knn",
    _vote_sql(list(range(1, 41)), True)
    + " SELECT k, round(avg(CASE WHEN prediction <> label THEN 1.0::DOUBLE ELSE 0 END), 6) AS error FROM b JOIN e ON vec_id = query_id GROUP BY 1",
)
def l13(spark, d):
    return rounded(neighbours.leave_one_out_sweep(_emb(spark, d), list(range(1, 41)), "label", "vec_id"))


# --- components ------------------------------------------------------------------
_EIG = """WITH m AS (SELECT covar_samp(l_quantity, l_quantity) a, covar_samp(l_quantity, price) b, covar_samp(price, price) c, avg(l_quantity) mq, avg(price) mp
      FROM (SELECT l_quantity, l_extendedprice / 1000 AS price FROM lineitem)),
    e AS (SELECT *, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS l1, (a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b) AS l2 FROM m),
    u AS (SELECT *, b / sqrt(b * b + (l1 - a) * (l1 - a)) AS x, (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS y FROM e),
    s AS (SELECT *, CASE WHEN abs(x) >= abs(y) THEN sign(x) ELSE sign(y) END AS s1 FROM u)"""


def _plane(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_extendedprice") / 1000).alias("price")
    )


@query(
    "d1_components",
    _EIG
    + """, t AS (SELECT CASE WHEN abs(x) >= abs(y) THEN sign(x) ELSE sign(y) END AS f, CASE WHEN abs(y) >= abs(x) THEN sign(-y) ELSE sign(x) END AS g, x, y FROM u)
    SELECT 'l_quantity' AS feature, 0 AS pc, round(f * x, 5) + 0.0 AS loading FROM t UNION ALL SELECT 'price', 0, round(f * y, 5) + 0.0 FROM t
    UNION ALL SELECT 'l_quantity', 1, round(-g * y, 5) + 0.0 FROM t UNION ALL SELECT 'price', 1, round(g * x, 5) + 0.0 FROM t""",
)
def d1(spark, d):
    pca = reduce.fit_components(_plane(spark, d), ["l_quantity", "price"])
    return rounded(pca.table(spark, ["l_quantity", "price"]), 5)


@query("d1_leading_components", SQL["d1_components"])
def d1_leading(spark, d):
    """Subspace iteration instead of the whole scatter matrix."""
    x = _plane(spark, d).select(pack(["l_quantity", "price"]))
    return rounded(reduce.fit_leading(x, 2).table(spark, ["l_quantity", "price"]), 5)


@query(
    "d2_explained_variance",
    _EIG + " SELECT 0 AS pc, round(l1 / (l1 + l2), 6) AS ratio, round(l1 / (l1 + l2), 6) AS cumulative FROM s UNION ALL SELECT 1, round(l2 / (l1 + l2), 6), 1.0::DOUBLE FROM s",
)
def d2(spark, d):
    return rounded(reduce.fit_components(_plane(spark, d), ["l_quantity", "price"]).ratio(spark))


@query(
    "d3_projection",
    _EIG + """ SELECT l_orderkey, l_linenumber, round(s1 * (x * (l_quantity - mq) + y * (l_extendedprice / 1000 - mp)), 4) + 0.0 AS score FROM lineitem, s""",
)
def d3(spark, d):
    x = _plane(spark, d)
    pca = reduce.fit_components(x, ["l_quantity", "price"])
    z = pca.project(x.withColumn("features", pack(["l_quantity", "price"])), 1)
    return rounded(z.select("l_orderkey", "l_linenumber", F.get("scores", F.lit(0)).alias("score")), 4)


_FIRST = """, t AS (SELECT CASE WHEN abs(x) >= abs(y) THEN sign(x) ELSE sign(y) END AS f, x, y, l2, mq, mp FROM u),
    z AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity AS q, l_extendedprice / 1000 AS p, f * x AS vx, f * y AS vy, mq, mp,
      f * (x * (l_quantity - mq) + y * (l_extendedprice / 1000 - mp)) AS score FROM lineitem, t)"""


@query(
    "d4_flag_on_component",
    _EIG + _FIRST + " SELECT l_orderkey, l_linenumber, l_returnflag, round(score, 4) + 0.0 AS score FROM z WHERE l_returnflag = 'A'",
)
def d4flag(spark, d):
    x = table(spark, d, "lineitem").withColumn("price", F.col("l_extendedprice") / 1000)
    pca = reduce.fit_components(x, ["l_quantity", "price"])
    rows = x.select("l_orderkey", "l_linenumber", "l_returnflag", pack(["l_quantity", "price"]))
    return rounded(reduce.class_on_component(rows, pca, "l_returnflag", "A", 0), 4)


@query(
    "d5_reconstruction",
    _EIG + _FIRST + " SELECT l_orderkey, l_linenumber, round(mq + score * vx, 4) + 0.0 AS quantity, round(mp + score * vy, 4) + 0.0 AS price FROM z",
)
def d5rows(spark, d):
    x = _plane(spark, d)
    pca = reduce.fit_components(x, ["l_quantity", "price"])
    z = pca.reconstruct(x.select("l_orderkey", "l_linenumber", pack(["l_quantity", "price"])), 1)
    return rounded(
        z.select("l_orderkey", "l_linenumber", F.get("rebuilt", F.lit(0)).alias("quantity"), F.get("rebuilt", F.lit(1)).alias("price")), 4
    )


@query(
    "d5_reconstruction_error_plane",
    _EIG + " SELECT 1 AS k, round(l2 * (n - 1) / n, 5) AS mse FROM s, (SELECT count(*) AS n FROM lineitem)",
)
def d5plane(spark, d):
    x = _plane(spark, d).withColumn("features", pack(["l_quantity", "price"]))
    return rounded(reduce.reconstruction_error(x, reduce.fit_components(x, ["l_quantity", "price"]), [1]), 5)


@query("d4_class_on_component")
def d4(spark, d):
    x = _emb(spark, d)
    return rounded(reduce.class_on_component(x, reduce.fit_components(x, vec_col="features"), "label", 3, 0))


@query("d5_reconstruction_error")
def d5(spark, d):
    x = _emb(spark, d)
    return rounded(reduce.reconstruction_error(x, reduce.fit_components(x, vec_col="features"), [1, 8, 16, 32, 63]))


@query("d6_component_sweep")
def d6(spark, d):
    x = folds.kfold(_emb(spark, d), 4, "vec_id")
    return rounded(
        reduce.sweep_components(x.filter("fold <> 0"), x.filter("fold = 0"), [1, 4, 16, 40], "label", "vec_id")
    )


# --- densities -------------------------------------------------------------------
_WIDTH = 0.5
_D2 = """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    q AS (SELECT a.vec_id, pow(list_distance(a.v, b.v), 2) AS d2 FROM e a JOIN e b ON a.vec_id <> b.vec_id)"""


@query(
    "o1_kernel_density",
    _D2
    + f""", s AS (SELECT vec_id, count(*) AS n, sum(exp(-d2 / (2 * {_WIDTH}))) AS t FROM q GROUP BY 1)
    SELECT vec_id, {_WIDTH}::DOUBLE AS width, round(-ln(n) - 32 * ln(2 * pi() * {_WIDTH}) + ln(t), 6) AS log_density FROM s""",
)
def o1(spark, d):
    return rounded(density.kernel_density(centre_vectors(_emb(spark, d)), [_WIDTH], "vec_id").drop("density"))


_POW = list(range(-10, 3))


@query(
    "o2_bandwidth",
    _D2
    + f""", w AS (SELECT max(vp) AS top FROM (SELECT var_pop(x) AS vp FROM (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM e) GROUP BY pos)),
    ws AS (SELECT top * pow(2.0, k) AS width FROM w CROSS JOIN (VALUES {', '.join(f'({k})' for k in _POW)}) p(k)),
    near AS (SELECT vec_id, min(d2) AS m FROM q GROUP BY 1),
    s AS (SELECT vec_id, width, count(*) AS n, max(m) AS m, sum(exp(-(d2 - m) / (2 * width))) AS t FROM q JOIN near USING (vec_id) CROSS JOIN ws GROUP BY 1, 2)
    SELECT round(width, 10) AS width, round(sum(-ln(n) - 32 * ln(2 * pi() * width) - m / (2 * width) + ln(t)), 3) AS log_likelihood FROM s GROUP BY 1""",
)
def o2(spark, d):
    x = _emb(spark, d)
    scores = density.bandwidth_scores(centre_vectors(x), density.candidate_widths(x, powers=_POW), "vec_id")
    return rounded(scores, 3, width=10)


@query("o2_best_bandwidth", SQL["o2_bandwidth"] + " ORDER BY log_likelihood DESC LIMIT 1")
def o2b(spark, d):
    x = _emb(spark, d)
    scores = density.bandwidth_scores(centre_vectors(x), density.candidate_widths(x), "vec_id")
    return rounded(density.best_bandwidth(scores), 3, width=10)


_GRID = [i * 10.0 for i in range(0, 21)]


@query(
    "o3_density_on_grid",
    f"""WITH h AS (SELECT pow(count(*), -0.2) * stddev_samp(value) AS h FROM events)
    SELECT g.x, round(avg(exp(-0.5 * pow((g.x - value) / h, 2))) / (any_value(h) * sqrt(2 * pi())), 9) AS density
    FROM events, h, (VALUES {', '.join(f'({x}::DOUBLE)' for x in _GRID)}) g(x) GROUP BY 1""",
)
def o3(spark, d):
    return rounded(density.density_on_grid(table(spark, d, "events"), "value", _GRID), 9)


@query(
    "o3_density_at_points",
    """WITH h AS (SELECT pow(count(*), -0.2) * stddev_samp(c_acctbal) AS h FROM customer)
    SELECT a.c_custkey, round(avg(exp(-0.5 * pow((a.c_acctbal - b.c_acctbal) / h, 2))) / (any_value(h) * sqrt(2 * pi())), 9) AS density
    FROM customer a CROSS JOIN customer b, h GROUP BY 1""",
)
def o3p(spark, d):
    return rounded(density.density_at_points(table(spark, d, "customer"), "c_acctbal", "c_custkey"), 9)


_KD = ", dens AS (SELECT query_id AS id, 5 / sum(distance) AS density FROM nn WHERE rank <= 5 GROUP BY 1)"


@query("o4_neighbour_density", _nn_sql(5) + _KD + " SELECT id, round(density, 6) AS density FROM dens")
def o4(spark, d):
    return rounded(density.neighbour_density(density.self_neighbours(_emb(spark, d), 5, "vec_id"), 5))


@query(
    "o5_relative_density",
    _nn_sql(5)
    + _KD
    + """ SELECT o.id, round(o.density, 6) AS density, round(o.density / (sum(n.density) / 5), 6) AS relative_density
    FROM dens o JOIN nn ON nn.query_id = o.id AND rank >= 2 JOIN dens n ON n.id = neighbor_id GROUP BY o.id, o.density""",
)
def o5(spark, d):
    return rounded(density.relative_density(density.self_neighbours(_emb(spark, d), 5, "vec_id"), 5))


@query(
    "o6_kth_distance",
    _nn_sql(5) + " SELECT query_id AS id, round(distance, 6) AS score FROM nn WHERE rank = 5 ORDER BY nn.distance DESC, query_id LIMIT 20",
)
def o6(spark, d):
    s = density.kth_distance(density.self_neighbours(_emb(spark, d), 5, "vec_id"), 5)
    return rounded(topk.highest(s, "score", 20, "id"))


@query(
    "d6_all_components",
    """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, ntile(4) OVER (ORDER BY vec_id) - 1 AS fold FROM embeddings),
    nn AS (SELECT q.vec_id, q.label, x.label AS pred FROM e q JOIN e x ON q.fold = 0 AND x.fold <> 0
      QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, x.v), x.vec_id) = 1)
    SELECT 64 AS k, round(avg(CASE WHEN label <> pred THEN 1.0::DOUBLE ELSE 0 END), 6) AS error FROM nn""",
)
def d6_all(spark, d):
    """All components keep every distance, so the neighbours are those of the rows themselves."""
    x = folds.kfold(_emb(spark, d), 4, "vec_id")
    return rounded(reduce.sweep_components(x.filter("fold <> 0"), x.filter("fold = 0"), [64], "label", "vec_id"))


# --- bounded output: a threshold or the best k instead of the whole matrix --------------
_COS_PAIRS = _X + """ SELECT a.vec_id AS x_id, b.vec_id AS y_id, round(list_cosine_similarity(a.v, b.v), 6) + 0.0 AS sim
    FROM e a JOIN e b ON list_cosine_similarity(a.v, b.v) >= 0.35"""


@query("m7_similar_pairs", _COS_PAIRS)
def m7_pairs(spark, d):
    x = _emb(spark, d)
    return rounded(similarity.similar_pairs(x, x, 0.35, "cos", "vec_id"))


@query(
    "m7_most_correlated",
    _X + """, z AS (SELECT vec_id, list_transform(v, lambda a: a - list_avg(v)) AS v FROM e),
    s AS (SELECT a.vec_id AS x_id, b.vec_id AS y_id, list_cosine_similarity(a.v, b.v) AS c FROM z a CROSS JOIN z b)
    SELECT x_id, CAST(row_number() OVER (PARTITION BY x_id ORDER BY c DESC, y_id) AS INT) AS rank, y_id, round(c, 6) + 0.0 AS sim
    FROM s QUALIFY rank <= 3""",
)
def m7_most(spark, d):
    x = _emb(spark, d)
    return rounded(similarity.most_similar(x, x, 3, "cor", "vec_id"))


@query("m9_approximate_neighbours")
def m9_near(spark, d):
    """Random projection tables; the tests hold its recall against the exact neighbours."""
    x = _emb(spark, d)
    return rounded(approximate.approximate_neighbours(x, x, 5, "vec_id"))


# --- the shuffled plans: as if nothing were small enough to copy -----------------------
def _in_cells(fn):
    def run(spark, d):
        before = spark.conf.get("quarry.broadcast.bytes", None)
        spark.conf.set("quarry.broadcast.bytes", "60000")
        try:
            return fn(spark, d)
        finally:
            if before is None:
                spark.conf.unset("quarry.broadcast.bytes")
            else:
                spark.conf.set("quarry.broadcast.bytes", before)

    return run


query("m9_neighbours_in_cells", SQL["m9_nearest_neighbours"])(_in_cells(m9))
query("m7_similar_pairs_in_cells", _COS_PAIRS)(_in_cells(m7_pairs))
query("o1_kernel_density_in_cells", SQL["o1_kernel_density"])(_in_cells(o1))
query("o4_neighbour_density_in_cells", SQL["o4_neighbour_density"])(_in_cells(o4))
