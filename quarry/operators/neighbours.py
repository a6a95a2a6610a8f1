"""k-nearest-neighbour classification on neighbour tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.pairs import nearest_neighbours


def vote(nn: DataFrame, labels: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Majority class per (query, k) for every k at once; vote ties go to the smallest class.

    ``labels`` has (neighbor_id, label). Counts are kept per (query, k, label).
    """
    ks_col = F.filter(F.array(*map(F.lit, ks)), lambda k: k >= F.col("rank"))
    votes = (
        nn.join(labels, "neighbor_id")
        .select("query_id", "label", F.explode(ks_col).alias("k"))
        .groupBy("query_id", "k", "label")
        .agg(F.count("*").alias("votes"))
    )
    best = F.min_by("label", F.struct((-F.col("votes")).alias("v"), F.col("label").alias("l")))
    return votes.groupBy("query_id", "k").agg(best.alias("prediction"))


def _labels(df: DataFrame, id_col: str, label: str, name: str) -> DataFrame:
    return df.select(F.col(id_col).alias(name), F.col(label).alias("label"))


def classify(
    train: DataFrame, test: DataFrame, ks: Sequence[int], label: str, id_col: str = "id", vec_col: str = "features",
    include_self: bool = True,
) -> DataFrame:
    """(query_id, k, prediction) for each test row and each k, from one neighbour search at max k."""
    nn = nearest_neighbours(test, train, max(ks), id_col, vec_col, include_self)
    return vote(nn, _labels(train, id_col, label, "neighbor_id"), ks)


def classify_sweep(
    train: DataFrame, test: DataFrame, ks: Sequence[int], label: str, id_col: str = "id", vec_col: str = "features",
    include_self: bool = True,
) -> DataFrame:
    """Error rate per k."""
    p = classify(train, test, ks, label, id_col, vec_col, include_self)
    j = p.join(_labels(test, id_col, label, "query_id"), "query_id")
    return j.groupBy("k").agg(F.avg((F.col("prediction") != F.col("label")).cast("double")).alias("error"))


def leave_one_out_sweep(df: DataFrame, ks: Sequence[int], label: str, id_col: str = "id", vec_col: str = "features") -> DataFrame:
    return classify_sweep(df, df, ks, label, id_col, vec_col, include_self=False)
