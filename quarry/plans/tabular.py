"""Scans, encodings, statistics, reports and folds over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import describe, encode, folds, topk
from quarry.plans.registry import query, rounded
from quarry.session import table

LINE_NUM = ["l_quantity", "l_discount", "l_tax"]


def _line(spark, d):
    return table(spark, d, "lineitem")


# --- scans -------------------------------------------------------------------
@query("s1_table_scan", "SELECT p_partkey, p_size, p_retailprice, p_type AS label FROM part")
def s1(spark, d):
    return encode.pick_target(
        table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice", "p_type"), "p_type"
    )


@query(
    "s2_matrix_scan",
    """
    SELECT vec_id, label, len(embedding) AS m, round(list_sum(embedding::DOUBLE[]), 6) + 0.0 AS total
    FROM embeddings""",
)
def s2(spark, d):
    from quarry.sources.tables import read_matrix

    x = read_matrix(spark, f"{d}/embeddings.parquet", "embedding")
    return rounded(
        x.select("vec_id", "label", F.size("features").alias("m"), encode.total(F.col("features")).alias("total"))
    )


# --- filters and encodings ---------------------------------------------------
@query(
    "t1_features_and_label",
    """
    SELECT p_partkey, round(list_sum([p_size::DOUBLE, p_retailprice]), 4) AS total, p_type AS label FROM part""",
)
def t1(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice", "p_type")
    x = encode.features_label(p, "p_type", "p_partkey")
    return rounded(x.select("p_partkey", encode.total(F.col("features")).alias("total"), "label"), 4)


@query(
    "t2_label_index",
    "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS class_id FROM orders",
)
def t2(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return encode.label_index(o, "o_orderpriority").select("o_orderkey", F.col("class_id").cast("long"))


_SEG = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _hot(col, vals, names=None):
    return ", ".join(
        f"CASE WHEN {col} = '{v}' THEN 1 ELSE 0 END AS \"{n}\"" for v, n in zip(vals, names or [f"{col}_{v}" for v in vals])
    )


@query("t3_one_hot", f"SELECT c_custkey, {_hot('c_mktsegment', _SEG)} FROM customer")
def t3(spark, d):
    return encode.one_hot(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment")


@query(
    "t4_one_hot_many",
    f"""SELECT o_orderkey, {_hot('o_orderstatus', ['F', 'O', 'P'])},
    {_hot('o_orderpriority', ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'])} FROM orders""",
)
def t4(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return encode.one_hot(o, ["o_orderstatus", "o_orderpriority"])


@query(
    "t5_outlier_removal",
    """
    SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem
    WHERE NOT (l_quantity > 45 OR l_discount > 0.08 OR l_extendedprice > 90000) GROUP BY 1""",
)
def t5(spark, d):
    bad = (F.col("l_quantity") > 45) | (F.col("l_discount") > 0.08) | (F.col("l_extendedprice") > 90000)
    kept = encode.drop_where(_line(spark, d), bad)
    return rounded(kept.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty")), 2)


@query("t6_keep_classes", "SELECT p_partkey, p_type FROM part WHERE p_type IN ('ECONOMY', 'PROMO', 'SMALL')")
def t6(spark, d):
    return encode.keep_classes(
        table(spark, d, "part").select("p_partkey", "p_type"), "p_type", ["ECONOMY", "PROMO", "SMALL"]
    )


@query(
    "t7_class_subsets",
    """SELECT l_returnflag AS label, count(*) AS n, round(avg(l_quantity), 6) AS mean_qty FROM lineitem GROUP BY 1""",
)
def t7(spark, d):
    """Figures of every class subset in one scan."""
    parts = _line(spark, d).groupBy(F.col("l_returnflag").alias("label"))
    return rounded(parts.agg(F.count("*").alias("n"), F.avg("l_quantity").alias("mean_qty")))


def _sparse_events(spark, d):
    e = table(spark, d, "events")
    hot = encode.one_hot(e.select("user_id", "event_type"), "event_type")
    users = hot.groupBy("user_id").agg(
        *[F.sum(F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col(c))).alias(c) for c in hot.columns[1:]],
        F.sum(F.lit(0).cast("long")).alias("never"),
    )
    return users, users.columns[1:]


_USERS = """
    WITH u AS (SELECT user_id,
      {sums}, CAST(0 AS BIGINT) AS never FROM events GROUP BY user_id)"""
_KINDS = ["click", "error", "purchase", "signup", "view"]
_USERS = _USERS.format(
    sums=", ".join(
        f"CAST(sum(CASE WHEN user_id % 3 = 0 THEN 0 WHEN event_type = '{k}' THEN 1 ELSE 0 END) AS BIGINT) AS event_type_{k}"
        for k in _KINDS
    )
)
_NONZERO = " OR ".join(f"event_type_{k} <> 0" for k in _KINDS)


@query("t8_drop_zero_columns", _USERS + " SELECT * EXCLUDE never FROM u")
def t8(spark, d):
    users, cols = _sparse_events(spark, d)
    return encode.drop_zero_columns(users, cols)


@query("t9_drop_zero_rows", _USERS + f" SELECT * FROM u WHERE {_NONZERO}")
def t9(spark, d):
    users, cols = _sparse_events(spark, d)
    return encode.drop_zero_rows(users, cols)


@query("t10_drop_zero_both", _USERS + f" SELECT * EXCLUDE never FROM u WHERE {_NONZERO}")
def t10(spark, d):
    users, cols = _sparse_events(spark, d)
    return encode.drop_zero_rows_and_columns(users, cols)


@query("t11_pick_target", "SELECT p_partkey, p_size, p_retailprice AS label FROM part")
def t11(spark, d):
    return encode.pick_target(table(spark, d, "part"), "p_retailprice", ["p_name", "p_brand", "p_type"])


@query(
    "t12_centre",
    """SELECT p_partkey, round(p_size - avg(p_size) OVER (), 6) AS p_size,
    round(p_retailprice - avg(p_retailprice) OVER (), 6) AS p_retailprice FROM part""",
)
def t12(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    return rounded(encode.centre(p, ["p_size", "p_retailprice"]))


@query(
    "t13_centre_by_training_mean",
    """SELECT o_orderkey, round(o_totalprice - (SELECT avg(o_totalprice) FROM orders WHERE o_orderstatus = 'F'), 4) AS o_totalprice
    FROM orders WHERE o_orderstatus = 'O'""",
)
def t13(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    new = o.filter("o_orderstatus = 'O'").drop("o_orderstatus")
    return rounded(encode.centre(new, ["o_totalprice"], o.filter("o_orderstatus = 'F'")), 4)


@query(
    "t14_zscore_sample",
    """SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_samp(c_acctbal) OVER (), 6) AS c_acctbal
    FROM customer""",
)
def t14(spark, d):
    return rounded(encode.standardize(table(spark, d, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"]))


@query(
    "t15_zscore_population",
    """SELECT s_suppkey, round((s_acctbal - avg(s_acctbal) OVER ()) / stddev_pop(s_acctbal) OVER (), 6) AS s_acctbal
    FROM supplier""",
)
def t15(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    return rounded(encode.standardize(s, ["s_acctbal"], ddof=0))


_EMB_LONG = """
    WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS pos
               FROM embeddings)"""


def _emb(spark, d):
    from quarry.sources.tables import read_matrix

    return read_matrix(spark, f"{d}/embeddings.parquet", "embedding")


@query(
    "t16_row_zscore",
    _EMB_LONG
    + """ SELECT vec_id, pos, round((v - avg(v) OVER (PARTITION BY vec_id)) / stddev_samp(v) OVER (PARTITION BY vec_id), 5) AS z
    FROM e""",
)
def t16(spark, d):
    from quarry.functions.vectors import row_zscore

    x = _emb(spark, d).select("vec_id", F.posexplode(row_zscore(F.col("features"))).alias("pos", "z"))
    return rounded(x.withColumn("pos", F.col("pos").cast("long")), 5)


@query(
    "t17_binarize_by_median",
    _EMB_LONG
    + """, m AS (SELECT pos, median(v) AS med FROM e GROUP BY pos)
    SELECT vec_id, CAST(sum(CASE WHEN v > med THEN 1 ELSE 0 END) AS DOUBLE) AS ones,
      CAST(sum(CASE WHEN v > med THEN pos ELSE 0 END) AS DOUBLE) AS checksum
    FROM e JOIN m USING (pos) GROUP BY vec_id""",
)
def t17(spark, d):
    from quarry.functions.vectors import total

    b = encode.binarize(_emb(spark, d).select("vec_id", "features"))
    return b.select(
        "vec_id",
        total(F.col("features")).alias("ones"),
        total(F.transform("features", lambda x, i: x * i)).alias("checksum"),
    )


@query(
    "t18_powers",
    """SELECT p_partkey, p_size, p_size::DOUBLE AS p_size_p1, pow(p_size, 2) AS p_size_p2, pow(p_size, 3) AS p_size_p3 FROM part""",
)
def t18(spark, d):
    return encode.powers(table(spark, d, "part").select("p_partkey", "p_size"), "p_size", 3)


@query(
    "t19_squares_and_product",
    """SELECT l_orderkey, l_quantity, l_tax, round(l_quantity * l_quantity, 6) AS l_quantity_sq,
    round(l_tax * l_tax, 6) AS l_tax_sq, round(l_quantity * l_tax, 6) AS l_quantity_l_tax FROM lineitem""",
)
def t19(spark, d):
    x = _line(spark, d).select("l_orderkey", "l_quantity", "l_tax")
    return rounded(encode.squares_and_product(x, "l_quantity", "l_tax"))


@query("t20_offset_column", "SELECT 1.0::DOUBLE AS \"offset\", p_partkey, p_size FROM part")
def t20(spark, d):
    return encode.add_offset(table(spark, d, "part").select("p_partkey", "p_size"))


@query("t21_first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500")
def t21(spark, d):
    return encode.first_rows(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 500, "o_orderkey")


@query(
    "t22_letter_features",
    """WITH p AS (SELECT p_partkey, lower(trim(p_name)) AS w FROM part)
    SELECT p_partkey, ascii(substr(w, 1, 1)) - 96 AS "first", ascii(substr(w, 2, 1)) - 96 AS "second",
      ascii(substr(w, length(w) - 1, 1)) - 96 AS next_to_last, ascii(substr(w, length(w), 1)) - 96 AS "last"
    FROM p WHERE length(w) > 3""",
)
def t22(spark, d):
    return encode.letter_features(table(spark, d, "part").select("p_partkey", "p_name"), "p_name").drop("p_name")


@query(
    "t23_gaussian_pdf",
    """SELECT l_orderkey, l_quantity, round(exp(-0.5 * pow((l_quantity - 25) / 10, 2)) / (10 * sqrt(2 * pi())), 9) AS pdf
    FROM lineitem""",
)
def t23(spark, d):
    x = _line(spark, d).select("l_orderkey", "l_quantity")
    return rounded(x.withColumn("pdf", encode.gaussian_pdf(F.col("l_quantity"), 25.0, 10.0)), 9)


@query("t24_threshold", "SELECT event_id, CASE WHEN value > 0.5 THEN 1 ELSE 0 END AS cls FROM events")
def t24(spark, d):
    return table(spark, d, "events").select("event_id", encode.threshold(F.col("value")).alias("cls"))


# --- aggregations --------------------------------------------------------------
def _summary_sql(stat):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS attribute, '{s}' AS stat, round({e.format(c=c)}, 5) AS value FROM lineitem"
        for c in LINE_NUM
        for s, e in stat.items()
    )


@query(
    "a1_summary",
    _summary_sql(
        {
            "mean": "avg({c})",
            "std": "stddev_samp({c})",
            "median": "median({c})",
            "range": "max({c}) - min({c})",
            "variance": "var_samp({c})",
        }
    ),
)
def a1(spark, d):
    return rounded(describe.summary_long(_line(spark, d), LINE_NUM), 5)


def _pairs_sql(fn):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round({fn}({a}, {b}), 6) + 0.0 AS value FROM lineitem"
        for a in LINE_NUM
        for b in LINE_NUM
    )


@query("a2_covariance", _pairs_sql("covar_samp"))
def a2(spark, d):
    from quarry.operators.gram import covariance

    return rounded(covariance(_line(spark, d), LINE_NUM))


@query("a3_correlation", _pairs_sql("corr"))
def a3(spark, d):
    from quarry.operators.gram import correlation

    return rounded(correlation(_line(spark, d), LINE_NUM))


@query(
    "a4_histogram",
    """WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
    c AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 20)), 19) AS INT) AS bin, count(*) AS cnt FROM orders, r GROUP BY 1)
    SELECT CAST(g.bin AS INT) AS bin, round(lo + g.bin * ((hi - lo) / 20), 4) AS left_edge, coalesce(cnt, 0) AS cnt
    FROM range(20) g(bin) CROSS JOIN r LEFT JOIN c ON c.bin = g.bin""",
)
def a4(spark, d):
    return rounded(describe.histogram(table(spark, d, "orders"), "o_totalprice", 20), 4)


@query(
    "a5_density_histogram",
    """WITH e AS (SELECT * FROM (VALUES (0, 0.0, 10.0), (1, 10.0, 15.0), (2, 15.0, 40.0), (3, 40.0, 50.0)) t(bin, lo, hi)),
    c AS (SELECT bin, lo, hi, (SELECT count(*) FROM lineitem WHERE l_quantity >= lo AND (l_quantity < hi OR (bin = 3 AND l_quantity = hi))) AS cnt FROM e)
    SELECT bin, lo::DOUBLE AS left_edge, hi::DOUBLE AS right_edge, cnt, round(cnt / (sum(cnt) OVER () * (hi - lo)), 8)::DOUBLE AS density FROM c""",
)
def a5(spark, d):
    return rounded(describe.density_histogram(_line(spark, d), "l_quantity", [0, 10, 15, 40, 50]), 8)


@query(
    "a6_histogram2d",
    """WITH r AS (SELECT min(l_quantity) qlo, max(l_quantity) qhi, min(l_extendedprice) plo, max(l_extendedprice) phi FROM lineitem)
    SELECT CAST(least(floor((l_quantity - qlo) / ((qhi - qlo) / 8)), 7) AS INT) AS bx,
      CAST(least(floor((l_extendedprice - plo) / ((phi - plo) / 8)), 7) AS INT) AS by, count(*) AS cnt
    FROM lineitem, r GROUP BY 1, 2""",
)
def a6(spark, d):
    return describe.histogram2d(_line(spark, d), "l_quantity", "l_extendedprice", 8)


def _box_sql(tab, cols, group=None):
    g = f"{group}, " if group else ""
    parts = []
    for c in cols:
        w = f"PARTITION BY {group}" if group else ""
        parts.append(
            f"""SELECT {g}'{c}' AS attribute, round(q1, 4) AS q1, round(med, 4) AS med, round(q3, 4) AS q3,
            min(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
            max(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
            count(*) FILTER (WHERE NOT v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS fliers
            FROM (SELECT {g}{c}::DOUBLE AS v, quantile_cont({c}::DOUBLE, 0.25) OVER ({w}) AS q1,
              quantile_cont({c}::DOUBLE, 0.5) OVER ({w}) AS med, quantile_cont({c}::DOUBLE, 0.75) OVER ({w}) AS q3 FROM {tab})
            GROUP BY {g}q1, med, q3"""
        )
    return " UNION ALL ".join(parts)


@query("a7_boxplot", _box_sql("events", ["value", "user_id"]))
def a7(spark, d):
    return rounded(describe.boxplot(table(spark, d, "events"), ["value", "user_id"]), 4)


@query("a8_boxplot_by_class", _box_sql("events", ["value"], "event_type"))
def a8(spark, d):
    return rounded(describe.boxplot(table(spark, d, "events"), ["value"], ["event_type"]), 4)


@query(
    "a9_class_priors",
    """WITH c(p_type) AS (VALUES ('ECONOMY'), ('LARGE'), ('MEDIUM'), ('PROMO'), ('SMALL'), ('STANDARD'), ('ABSENT'))
    SELECT c.p_type, count(p.p_partkey) AS cnt, round(count(p.p_partkey) / (SELECT count(*) FROM part WHERE p_type IN (SELECT p_type FROM c)), 6) AS prior
    FROM c LEFT JOIN part p USING (p_type) GROUP BY 1""",
)
def a9(spark, d):
    classes = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "ABSENT"]
    return rounded(describe.class_priors(table(spark, d, "part"), "p_type", classes))


_FOLD5 = "(ntile(5) OVER (ORDER BY o_orderkey) - 1)"


@query(
    "a10_training_priors",
    f"""WITH f AS (SELECT o_orderpriority, {_FOLD5} AS fold FROM orders)
    SELECT o_orderpriority, count(*) AS cnt, round(count(*) / sum(count(*)) OVER (), 6) AS prior FROM f WHERE fold <> 0 GROUP BY 1""",
)
def a10(spark, d):
    o = folds.kfold(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), 5, "o_orderkey")
    return rounded(describe.class_priors(o.filter("fold <> 0"), "o_orderpriority").orderBy("o_orderpriority"))


@query("a11_rows_by_class", _EMB_LONG + " SELECT label, vec_id, pos AS pc, round(v, 6) AS value FROM e")
def a11(spark, d):
    x = describe.class_long(_emb(spark, d), "label", "vec_id", "features")
    return rounded(x.withColumn("pc", F.col("pc").cast("long")))


@query(
    "a12_class_by_cluster",
    "SELECT l_linestatus AS cluster, l_returnflag AS label, count(*) AS cnt FROM lineitem GROUP BY 1, 2",
)
def a12(spark, d):
    x = _line(spark, d).select(F.col("l_linestatus").alias("cluster"), F.col("l_returnflag").alias("label"))
    return describe.contingency(x, "cluster", "label")


@query(
    "a13_cluster_class_share",
    """SELECT p_brand AS cluster, p_type AS label, count(*) AS cnt,
    round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY p_brand), 6)::DOUBLE AS pct FROM part GROUP BY 1, 2""",
)
def a13(spark, d):
    x = table(spark, d, "part").select(F.col("p_brand").alias("cluster"), F.col("p_type").alias("label"))
    return rounded(describe.cluster_class_share(x, "cluster", "label"))


@query(
    "a14_class_moments",
    " UNION ALL ".join(
        f"""SELECT l_returnflag, '{c}' AS attribute, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std
        FROM lineitem GROUP BY 1"""
        for c in LINE_NUM
    ),
)
def a14(spark, d):
    return rounded(describe.class_moments(_line(spark, d), "l_returnflag", LINE_NUM))


@query(
    "a15_cumulative_share",
    """WITH s AS (SELECT o_orderpriority, sum(o_totalprice) AS v FROM orders GROUP BY 1),
    r AS (SELECT o_orderpriority, v / sum(v) OVER () AS share FROM s)
    SELECT o_orderpriority, round(share, 8) AS share, round(sum(share) OVER (ORDER BY o_orderpriority), 8) AS running FROM r""",
)
def a15(spark, d):
    o = table(spark, d, "orders")
    s = o.groupBy("o_orderpriority").agg(F.sum("o_totalprice").alias("v"))
    s = s.select("o_orderpriority", (F.col("v") / o.select(F.sum("o_totalprice")).scalar()).alias("share"))
    return rounded(describe.cumulative(s, "o_orderpriority", "share", "running"), 8)


@query(
    "a16_distinct_counts",
    "SELECT count(DISTINCT p_brand) AS p_brand, count(DISTINCT p_type) AS p_type, count(DISTINCT p_size) AS p_size FROM part",
)
def a16(spark, d):
    return describe.distinct_counts(table(spark, d, "part"), ["p_brand", "p_type", "p_size"])


# --- top-k ---------------------------------------------------------------------
@query("k2_lowest_k", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 20")
def k2(spark, d):
    return topk.lowest(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 20, "c_custkey")


@query("k4_highest_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def k4(spark, d):
    return topk.highest(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 20, "o_orderkey")


@query(
    "k5_argmin_of_sweep",
    """WITH s AS (SELECT p_brand AS model, p_size AS param, round(avg(p_retailprice), 4) AS value FROM part GROUP BY 1, 2)
    SELECT model, param, value FROM s QUALIFY row_number() OVER (PARTITION BY model ORDER BY value, param) = 1""",
)
def k5(spark, d):
    p = table(spark, d, "part").groupBy(F.col("p_brand").alias("model"), F.col("p_size").alias("param"))
    sweep = p.agg(F.round(F.avg("p_retailprice"), 4).alias("value"))
    return topk.best_row(sweep, "value", "param", ["model"])


# --- folds ---------------------------------------------------------------------
@query("f1_kfold", "SELECT o_orderkey, CAST(ntile(10) OVER (ORDER BY o_orderkey) - 1 AS INT) AS fold FROM orders")
def f1(spark, d):
    return folds.kfold(table(spark, d, "orders").select("o_orderkey"), 10, "o_orderkey")


def _u(col, seed):
    return f"(CAST('0x' || substr(md5(CAST({col} AS VARCHAR) || ':{seed}'), 1, 13) AS BIGINT))"


@query(
    "f2_kfold_shuffled",
    f"SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY {_u('o_orderkey', 7)}, o_orderkey) - 1 AS INT) AS fold FROM orders",
)
def f2(spark, d):
    return folds.kfold_shuffled(table(spark, d, "orders").select("o_orderkey"), 5, "o_orderkey", 7, exact=True)


@query(
    "f2_kfold_hashed",
    f"SELECT event_id, CAST(floor({_u('event_id', 3)} / 4503599627370496.0::DOUBLE * 5) AS INT) AS fold FROM events",
)
def f2h(spark, d):
    return folds.kfold_shuffled(table(spark, d, "events").select("event_id"), 5, "event_id", 3)


@query(
    "f3_stratified_kfold",
    """SELECT p_partkey, p_type, CAST(ntile(5) OVER (PARTITION BY p_type ORDER BY p_partkey) - 1 AS INT) AS fold FROM part""",
)
def f3(spark, d):
    return folds.stratified_kfold(table(spark, d, "part").select("p_partkey", "p_type"), 5, "p_type", "p_partkey")


@query(
    "f4_nested_folds",
    """WITH o AS (SELECT c_custkey, ntile(3) OVER (ORDER BY c_custkey) - 1 AS own FROM customer),
    r AS (SELECT c_custkey, CAST(k AS INT) AS outer_fold, own = k AS is_test FROM o CROSS JOIN range(3) t(k))
    SELECT c_custkey, outer_fold, is_test, CASE WHEN is_test THEN NULL ELSE
      CAST(ntile(4) OVER (PARTITION BY outer_fold, is_test ORDER BY c_custkey) - 1 AS INT) END AS inner_fold FROM r""",
)
def f4(spark, d):
    return folds.nested_folds(table(spark, d, "customer").select("c_custkey"), 3, 4, "c_custkey")


@query("f5_leave_one_out", "SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS fold FROM embeddings")
def f5(spark, d):
    return folds.leave_one_out(table(spark, d, "embeddings").select("vec_id"), "vec_id")


@query(
    "f6_repeated_holdout",
    " UNION ALL ".join(
        f"SELECT c_custkey, {s} AS repeat, {_u('c_custkey', s)} / 4503599627370496.0::DOUBLE < 0.8 AS is_test FROM customer"
        for s in range(3)
    ),
)
def f6(spark, d):
    return folds.repeated_holdout(table(spark, d, "customer").select("c_custkey"), 0.8, 3, "c_custkey")


@query(
    "f7_subsample",
    f"SELECT o_orderkey, o_totalprice FROM orders WHERE floor({_u('o_orderkey', 1)} / 4503599627370496.0::DOUBLE * 4) = 0",
)
def f7(spark, d):
    return folds.subsample(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 4, "o_orderkey", 1)


@query(
    "f8_weighted_bootstrap",
    f"""WITH w AS (SELECT p_partkey, sum(p_size) OVER (ORDER BY p_partkey) - p_size AS lo, sum(p_size) OVER () AS tot FROM part),
    d AS (SELECT {_u('i', 11)} / 4503599627370496.0::DOUBLE AS u FROM range(2000) t(i)),
    h AS (SELECT u, w.p_partkey FROM d ASOF JOIN (SELECT p_partkey, lo / tot AS pos FROM w) w ON d.u >= w.pos)
    SELECT h.p_partkey, p.p_size, count(*) AS copies FROM h JOIN part p USING (p_partkey) GROUP BY 1, 2""",
)
def f8(spark, d):
    return folds.bootstrap(table(spark, d, "part").select("p_partkey", "p_size"), 2000, "p_partkey", 11, "p_size")


@query(
    "f8_poisson_weights",
    f"""WITH p AS (SELECT p_partkey, p_size, 2000.0::DOUBLE * p_size / sum(p_size) OVER () AS rate, {_u('p_partkey', 12)} / 4503599627370496.0::DOUBLE AS u FROM part),
    t AS (SELECT p_partkey, any_value(p_size) AS p_size, any_value(u) AS u, k, any_value(exp(k * ln(rate) - rate - lgamma(k + 1.0::DOUBLE))) AS term
      FROM p CROSS JOIN range(120) r(k) GROUP BY p_partkey, k),
    c AS (SELECT *, sum(term) OVER (PARTITION BY p_partkey ORDER BY k) AS cdf FROM t)
    SELECT p_partkey, any_value(p_size) AS p_size, count(*) FILTER (cdf <= u) AS copies FROM c GROUP BY p_partkey""",
)
def f8_poisson(spark, d):
    return folds.poisson_weights(table(spark, d, "part").select("p_partkey", "p_size"), 2000, "p_partkey", 12, "p_size")
