"""Summaries, histograms, box-plot figures and class tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions.ranking import exact_quantiles, running_before
from quarry.session import cut_lineage


def melt(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(list(keep), list(cols), "attribute", "value")


def summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(attribute, mean, std, median, range, variance), one row per column."""
    stats = {"mean": F.avg, "std": F.stddev_samp, "variance": F.var_samp}
    one = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{c}__{n}") for c in cols for n, f in stats.items()],
        *[(F.max(F.col(c).cast("double")) - F.min(F.col(c).cast("double"))).alias(f"{c}__range") for c in cols],
    )
    rows = [
        F.struct(F.lit(c).alias("attribute"), *[F.col(f"{c}__{n}").alias(n) for n in (*stats, "range")]) for c in cols
    ]
    base = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    med = exact_quantiles(melt(df, cols), "value", [0.5], ["attribute"]).select(
        "attribute", F.col("q")[0].alias("median")
    )
    return base.join(med, "attribute").select("attribute", "mean", "std", "median", "range", "variance")


def summary_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    s = summary(df, cols)
    return s.unpivot(["attribute"], [c for c in s.columns if c != "attribute"], "stat", "value")


def _bins(spark, n: int) -> DataFrame:
    return spark.range(n).select(F.col("id").cast("int").alias("bin"))


def bin_of(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin; the last bin is closed on the right."""
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    return F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Counts per equal-width bin between the column's min and max, empty bins as 0; no bins without a value.

    Nulls and NaN lie in no bin.
    """
    df = df.filter(~F.isnan(F.col(col).cast("double")))
    lo, hi = df.agg(F.min(F.col(col).cast("double")), F.max(F.col(col).cast("double"))).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, left_edge double, cnt long")
    counts = df.filter(F.col(col).isNotNull()).groupBy(bin_of(F.col(col), lo, hi, bins).alias("bin")).count()
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    return (
        _bins(df.sparkSession, bins)
        .join(counts, "bin", "left")
        .select(
            "bin",
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("left_edge"),
            F.coalesce("count", F.lit(0)).alias("cnt"),
        )
    )


def density_histogram(df: DataFrame, col: str, edges: Sequence[float]) -> DataFrame:
    """Share per bin width over given edges; the last bin is closed, outside values ignored; 0 without any."""
    e = [float(x) for x in edges]
    x = F.col(col)
    arr = F.array(*map(F.lit, e[1:-1]))
    idx = F.size(F.filter(arr, lambda c: c <= x)) if len(e) > 2 else F.lit(0)
    counts = (
        df.filter((x >= e[0]) & (x <= e[-1])).groupBy(idx.cast("int").alias("bin")).agg(F.count("*").alias("cnt"))
    )
    spec = df.sparkSession.createDataFrame(
        [(i, e[i], e[i + 1]) for i in range(len(e) - 1)], "bin int, left_edge double, right_edge double"
    )
    out = spec.join(counts, "bin", "left").withColumn("cnt", F.coalesce("cnt", F.lit(0)))
    # one row per given edge: a window over the bins is bounded by the edge list
    return out.withColumn(
        "density",
        F.coalesce(
            F.try_divide("cnt", F.sum("cnt").over(W.partitionBy(F.lit(0))) * (F.col("right_edge") - F.col("left_edge"))),
            F.lit(0.0),
        ),
    )


def histogram2d(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Counts of the occupied cells of a bins x bins grid; rows with a null or NaN lie in none."""
    for c in (x, y):
        df = df.filter(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
    r = df.agg(*[f(F.col(c).cast("double")) for c in (x, y) for f in (F.min, F.max)]).first()
    if r[0] is None:
        return df.sparkSession.createDataFrame([], "bx int, by int, cnt long")
    return df.groupBy(
        bin_of(F.col(x), r[0], r[1], bins).alias("bx"), bin_of(F.col(y), r[2], r[3], bins).alias("by")
    ).agg(F.count("*").alias("cnt"))


def boxplot(df: DataFrame, cols: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and number of fliers, per column (and class).

    A null class is a class; null values are left out.
    """
    groups = list(groups)
    long = melt(df, cols, groups).filter("value is not null")
    keys = groups + ["attribute"]
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], keys).select(
        *keys, *[F.col("q")[i].alias(n) for i, n in enumerate(("q1", "med", "q3"))]
    )
    iqr = F.col("q3") - F.col("q1")
    inside = (F.col("value") >= F.col("q1") - 1.5 * iqr) & (F.col("value") <= F.col("q3") + 1.5 * iqr)
    # written, so that its size is known: one row per class and attribute
    q = cut_lineage(q.withColumnsRenamed({k: f"__{k}" for k in keys}), "quartiles")
    return (
        long.join(q, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
        .groupBy(*keys, "q1", "med", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(1)).alias("fliers"),
        )
    )


def class_priors(df: DataFrame, label: str, classes: Sequence | None = None) -> DataFrame:
    """Share of each class; of given ``classes`` those absent from the table get 0."""
    counts = df.groupBy(label).agg(F.count("*").alias("cnt"))
    if classes is None:
        counts = cut_lineage(counts.filter(F.col(label).isNotNull()), "classes")
        total = counts.agg(F.sum("cnt")).first()[0]
        return counts.withColumn("prior", F.col("cnt") / F.lit(total))
    names = list(classes)
    kind = df.schema[label].dataType.simpleString()
    dim = df.sparkSession.createDataFrame([(n,) for n in names], f"{label} {kind}")
    every = W.partitionBy(F.lit(0))
    return (
        dim.join(counts, label, "left")
        .withColumn("cnt", F.coalesce("cnt", F.lit(0)))
        .withColumn("prior", F.coalesce(F.try_divide("cnt", F.sum("cnt").over(every)), F.lit(0.0)))
    )


def class_long(df: DataFrame, label: str, id_col: str, vec_col: str) -> DataFrame:
    """Rows by class in long form (label, id, pc, value)."""
    return df.select(label, id_col, F.posexplode(vec_col).alias("pc", "value"))


def contingency(df: DataFrame, cluster: str, label: str) -> DataFrame:
    return df.groupBy(cluster, label).agg(F.count("*").alias("cnt"))


def cluster_class_share(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Per cent of each class within a cluster."""
    c = contingency(df, cluster, label)
    return c.withColumn("pct", F.col("cnt") * 100.0 / F.sum("cnt").over(W.partitionBy(cluster)))


def class_moments(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    return melt(df, cols, [label]).groupBy(label, "attribute").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")
    )


def cumulative(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Running sum in the order of a column without ties, over a table of any size."""
    x = running_before(df, [order], {"__before": F.col(value)})
    return x.withColumn(out, F.col("__before") + F.col(value)).drop("__before", "__before_total")


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    f = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(*[f(c).alias(c) for c in cols])
