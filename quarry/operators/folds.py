"""Folds, hold-outs and bootstrap samples as columns, never as index lists.

Every assignment is a pure function of the row's id and a seed, so that a task
that runs again after a lost executor places its rows in the same fold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions.ranking import bucketed, running_before, with_row_index
from quarry.functions.vectors import let

HEX_DIGITS = 13  # 52 bits: exact in a double


def _digest(id_col: str, seed: int) -> Column:
    # a null id is an id of its own, so that its rows are in some fold
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(f":{seed}")))


def hash_key(id_col: str, seed: int) -> Column:
    return F.conv(F.substring(_digest(id_col, seed), 1, HEX_DIGITS), 16, 10).cast("long")


def uniform(id_col: str, seed: int) -> Column:
    """Repeatable uniform number in [0, 1) per id."""
    return hash_key(id_col, seed) / F.lit(float(16**HEX_DIGITS))


def _block(index: Column, n: Column, k: int) -> Column:
    """Contiguous blocks; the first ``n mod k`` blocks hold one row more."""
    q, r = F.floor(n / k), n % k
    cut = r * (q + 1)
    return (
        F.when(index < cut, F.floor(index / (q + 1)))
        .otherwise(r + F.floor((index - cut) / F.greatest(q, F.lit(1))))
        .cast("int")
    )


def kfold(df: DataFrame, k: int, id_col: str, out: str = "fold") -> DataFrame:
    """Unshuffled folds of contiguous ids."""
    x = with_row_index(df, [id_col], index="__i")
    return x.withColumn(out, _block(F.col("__i"), F.col("__i_total"), k)).drop("__i", "__i_total")


def kfold_shuffled(
    df: DataFrame, k: int, id_col: str, seed: int = 0, exact: bool = False, out: str = "fold"
) -> DataFrame:
    """Shuffled folds: by hash (no shuffle of data), or with exact sizes by rank of the hash."""
    if not exact:
        return df.withColumn(out, F.floor(uniform(id_col, seed) * k).cast("int"))
    x = with_row_index(df.withColumn("__h", hash_key(id_col, seed)), ["__h", id_col], index="__i")
    return x.withColumn(out, _block(F.col("__i"), F.col("__i_total"), k)).drop("__h", "__i", "__i_total")


def stratified_kfold(df: DataFrame, k: int, label: str, id_col: str, out: str = "fold") -> DataFrame:
    x = with_row_index(df, [id_col], [label], index="__i")
    return x.withColumn(out, _block(F.col("__i"), F.col("__i_total"), k)).drop("__i", "__i_total")


def nested_folds(df: DataFrame, outer: int, inner: int, id_col: str) -> DataFrame:
    """(outer_fold, is_test, inner_fold): every row appears once per outer fold.

    Rows of the outer training part carry an inner fold made from their order
    within that part; rows of the outer test part carry null.
    """
    base = kfold(df, outer, id_col, "own_fold")
    rep = base.withColumn("outer_fold", F.explode(F.sequence(F.lit(0), F.lit(outer - 1))))
    rep = rep.withColumn("is_test", F.col("own_fold") == F.col("outer_fold")).drop("own_fold")
    train = with_row_index(rep.filter(~F.col("is_test")), [id_col], ["outer_fold"], index="__i")
    train = train.withColumn("inner_fold", _block(F.col("__i"), F.col("__i_total"), inner)).drop(
        "__i", "__i_total"
    )
    test = rep.filter("is_test").withColumn("inner_fold", F.lit(None).cast("int"))
    return train.unionByName(test)


def leave_one_out(df: DataFrame, id_col: str, out: str = "fold") -> DataFrame:
    """As many folds as rows: each row is the test part of its own fold."""
    return with_row_index(df, [id_col], index=out).drop(f"{out}_total")


def holdout(df: DataFrame, test_share: float, id_col: str, seed: int = 0, out: str = "is_test") -> DataFrame:
    return df.withColumn(out, uniform(id_col, seed) < F.lit(test_share))


def repeated_holdout(df: DataFrame, test_share: float, repeats: int, id_col: str) -> DataFrame:
    """One copy of the table per repeat, each with its own seed."""
    parts = F.array(
        *[
            F.struct(F.lit(s).alias("repeat"), (uniform(id_col, s) < F.lit(test_share)).alias("is_test"))
            for s in range(repeats)
        ]
    )
    return df.withColumn("__r", F.explode(parts)).select(*df.columns, "__r.repeat", "__r.is_test")


def subsample(df: DataFrame, parts: int, id_col: str, seed: int = 0) -> DataFrame:
    """The test part of one shuffled fold of ``parts``."""
    return kfold_shuffled(df, parts, id_col, seed).filter("fold = 0").drop("fold")


def poisson_copies(id_col: str, seed: int, rate: float = 1.0) -> Column:
    """Number of copies of a row in one bootstrap round, as Poisson(rate) by inverse CDF."""
    if rate > 30:
        raise ValueError("use bootstrap() for large rates")
    cdf, term, acc, i = [], math.exp(-rate), 0.0, 0
    while acc < 1 - 1e-16 and i < 200:
        acc += term
        cdf.append(acc)
        i += 1
        term *= rate / i
    return F.size(F.filter(F.array(*map(F.lit, cdf)), lambda c: c <= uniform(id_col, seed)))


def poisson_weights(df: DataFrame, n: int, id_col: str, seed: int = 0, weight: str | None = None, out: str = "copies") -> DataFrame:
    """The bootstrap as a column: Poisson(n * w / sum of w) copies per row, no shuffle of rows.

    The total is n on average only. Rates of up to 300 per row; heavier rows want
    :func:`bootstrap`.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    total, most = df.agg(F.sum(w), F.max(w)).first()
    if not total:
        return df.withColumn(out, F.lit(0).cast("long"))
    if n * most / total > 300:
        raise ValueError("a row is drawn too often; use bootstrap()")
    top = int(n * most / total + 12 * math.sqrt(n * most / total) + 20)
    u = uniform(id_col, seed)

    def copies(s):
        # number of k whose cumulated probability lies at or below u
        start = F.struct(F.exp(-s["rate"]).alias("term"), F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n"))

        def step(acc, k):
            reached = acc["sum"] + acc["term"]
            return F.struct(
                (acc["term"] * s["rate"] / k).alias("term"),
                reached.alias("sum"),
                (acc["n"] + (reached <= s["u"]).cast("long")).alias("n"),
            )

        return F.aggregate(F.sequence(F.lit(1.0).cast("int"), F.lit(top)), start, step, lambda acc: acc["n"])

    rate = F.coalesce(w, F.lit(0.0)) * F.lit(float(n)) / F.lit(float(total))
    return df.withColumn(out, let(F.struct(rate.alias("rate"), u.alias("u")), copies))


def bootstrap(df: DataFrame, n: int, id_col: str, seed: int = 0, weight: str | None = None) -> DataFrame:
    """Exactly ``n`` draws with replacement, probability proportional to ``weight``.

    Rows own half-open intervals of [0, 1) by running weight and draws are points:
    a draw belongs to the last interval that starts at or before it. Starts and
    draws are ordered together in buckets, so neither a heavy row nor a crowd of
    light ones gathers in one task. Output: the rows drawn, with ``copies``.
    """
    spark = df.sparkSession
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    x = running_before(df.select(id_col, w.alias("__w")).filter("__w > 0"), [id_col], {"__lo": F.col("__w")})
    starts = x.select((F.col("__lo") / F.col("__lo_total")).alias("pos"), F.lit(0).alias("kind"), id_col)
    draws = spark.range(n).select(
        uniform("id", seed).alias("pos"), F.lit(1).alias("kind"), F.lit(None).cast(df.schema[id_col].dataType).alias(id_col)
    )
    line = bucketed(starts.unionByName(draws), ["pos", "kind", id_col])
    per = line.groupBy("__bucket").agg(F.max_by(id_col, F.when(F.col("kind") == 0, F.col("pos"))).alias("__last"))
    # one row per range
    before = W.partitionBy(F.lit(0)).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    carry = per.select("__bucket", F.last("__last", ignorenulls=True).over(before).alias("__carry"))
    inside = W.partitionBy("__bucket").orderBy("pos", "kind").rowsBetween(W.unboundedPreceding, 0)
    owner = F.coalesce(F.last(id_col, ignorenulls=True).over(inside), F.col("__carry"))
    hit = line.join(carry, "__bucket").withColumn("__owner", owner).filter("kind = 1")
    copies = hit.groupBy(F.col("__owner").alias(id_col)).agg(F.count("*").alias("copies"))
    return df.join(copies, id_col)
