"""k-means, and validity of a clustering from its contingency table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.encode import vector_mean


@dataclass(frozen=True)
class Centroids:
    centres: np.ndarray
    inertia: float
    model: object = None

    def assign(self, df: DataFrame, vec_col: str = "features", out: str = "cluster") -> DataFrame:
        if self.model is None:
            return df.withColumn(out, F.lit(0))
        x = df.withColumn("__v", array_to_vector(F.col(vec_col).cast("array<double>")))
        return self.model.transform(x).withColumnRenamed("prediction", out).drop("__v")

    def replace(self, df: DataFrame, vec_col: str = "features") -> DataFrame:
        """Every row's vector replaced by its centroid (a literal table of k vectors)."""
        table = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in self.centres])
        return self.assign(df, vec_col).withColumn(vec_col, F.get(table, F.col("cluster")))

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(i, [float(v) for v in c]) for i, c in enumerate(self.centres)], "cluster int, centroid array<double>"
        )


def kmeans(df: DataFrame, k: int, vec_col: str = "features", n_init: int = 1, max_iter: int = 300, seed: int = 0) -> Centroids:
    """Best of ``n_init`` seeds by inertia. k = 1 is the mean."""
    x = df.select(array_to_vector(F.col(vec_col).cast("array<double>")).alias("__v"))
    if k == 1:
        mean = vector_mean(df, vec_col)
        centre = F.array(*[F.lit(float(m)) for m in mean])
        sq = F.aggregate(
            F.zip_with(F.col(vec_col).cast("array<double>"), centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v
        )
        return Centroids(np.array([mean]), float(df.agg(F.sum(sq)).first()[0]))
    x = x.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        best = None
        for i in range(n_init):
            model = KMeans(k=k, maxIter=max_iter, seed=seed + i, featuresCol="__v", initMode="k-means||").fit(x)
            if best is None or model.summary.trainingCost < best.summary.trainingCost:
                best = model
    finally:
        x.unpersist()
    return Centroids(np.array(best.clusterCenters()), float(best.summary.trainingCost), best)


EPS = 2.22e-16  # fixed value inside the logarithm of the entropy


def cluster_validity(
    df: DataFrame, cluster: str, label: str, by: Sequence[str] = (), normalizer: str = "arithmetic"
) -> DataFrame:
    """Entropy, purity, Rand, Jaccard and normalised mutual information.

    Pair counts come from the contingency table: pairs together in both are the
    sum of n_ij choose 2, and the margins give the rest. ``entropy_ref`` keeps the
    reference form (weighted 1 - sum p log2 p, over N K); ``entropy`` is the usual one. Without a pair of rows,
    Rand and Jaccard are 1.
    """
    by = list(by)
    c = df.groupBy(*by, F.col(cluster).alias("i"), F.col(label).alias("j")).agg(F.count("*").cast("double").alias("n"))
    rows = c.groupBy(*by, "i").agg(F.sum("n").alias("m"), F.collect_list("n").alias("ns"))
    # one row per cluster; ns holds one count per class
    plogp = F.aggregate("ns", F.lit(0.0), lambda a, n: a + n / F.col("m") * F.log2(n / F.col("m") + F.lit(EPS)))
    pure = F.aggregate("ns", F.lit(0.0), lambda a, n: a + n / F.col("m") * F.log2(n / F.col("m")))
    pairs2 = F.aggregate("ns", F.lit(0.0), lambda a, n: a + n * (n - 1) / 2)
    nlogn = F.aggregate("ns", F.lit(0.0), lambda a, n: a + n * F.log(n))
    per_cluster = rows.select(
        *by,
        "m",
        (F.col("m") * (1 - plogp)).alias("ent"),
        (-F.col("m") * pure).alias("ent_std"),
        (F.array_max("ns") / F.col("m")).alias("top"),
        pairs2.alias("together"),
        nlogn.alias("nlogn"),
    )
    pair = lambda m: m * (m - 1) / 2
    left = per_cluster.groupBy(*by).agg(
        F.sum("m").alias("total"),
        F.count("*").alias("k"),
        F.sum("ent").alias("ent"),
        F.sum("ent_std").alias("ent_std"),
        F.sum("top").alias("top"),
        F.sum("together").alias("f11"),
        F.sum(pair(F.col("m"))).alias("same_cluster"),
        F.sum("nlogn").alias("nij"),
        F.sum(F.col("m") * F.log("m")).alias("ni"),
    )
    cols = c.groupBy(*by, "j").agg(F.sum("n").alias("m"))
    right = cols.groupBy(*by).agg(
        F.sum(pair(F.col("m"))).alias("same_class"), F.sum(F.col("m") * F.log("m")).alias("nj"), F.count("*").alias("classes")
    )
    keys = by or ["__one"]
    if not by:
        left, right = left.withColumn("__one", F.lit(1)), right.withColumn("__one", F.lit(1))
    j = left.join(right, keys)
    n = F.col("total")
    all_pairs = pair(n)
    f00 = all_pairs - F.col("same_cluster") - F.col("same_class") + F.col("f11")
    hi, hj = F.log(n) - F.col("ni") / n, F.log(n) - F.col("nj") / n
    mi = F.log(n) + (F.col("nij") - F.col("ni") - F.col("nj")) / n
    norm = F.sqrt(hi * hj) if normalizer == "geometric" else (hi + hj) / 2
    return j.select(
        *by,
        (F.col("ent") / (n * F.col("k"))).alias("entropy_ref"),
        (F.col("ent_std") / n).alias("entropy"),
        (F.col("top") / F.col("k")).alias("purity"),
        F.coalesce(F.try_divide(F.col("f11") + f00, all_pairs), F.lit(1.0)).alias("rand"),
        F.coalesce(F.try_divide("f11", F.col("same_cluster") + F.col("same_class") - F.col("f11")), F.lit(1.0)).alias("jaccard"),
        F.when((F.col("k") == 1) & (F.col("classes") == 1), F.lit(1.0)).when(norm <= 0, F.lit(0.0)).otherwise(F.try_divide(mi, norm)).alias("nmi"),
    )


def validity_sweep(df: DataFrame, ks: Sequence[int], label: str, vec_col: str = "features", seed: int = 0) -> DataFrame:
    """Validity of k-means for each k: fits first, then one grouped pass over all assignments."""
    out = None
    for k in ks:
        a = kmeans(df, k, vec_col, seed=seed).assign(df, vec_col).select(F.lit(k).alias("k"), "cluster", label)
        out = a if out is None else out.unionByName(a)
    return cluster_validity(out.withColumnRenamed("k", "sweep_k"), "cluster", label, ["sweep_k"]).withColumnRenamed("sweep_k", "k")

