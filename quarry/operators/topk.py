"""Sorted reports and top-k. ``orderBy().limit()`` runs as per-task heaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lowest(df: DataFrame, score: str, k: int, id_col: str) -> DataFrame:
    return df.orderBy(F.col(score).asc(), F.col(id_col)).limit(k)


def highest(df: DataFrame, score: str, k: int, id_col: str) -> DataFrame:
    return df.orderBy(F.col(score).desc(), F.col(id_col)).limit(k)


def most_and_least(df: DataFrame, score: str, k: int, id_col: str) -> DataFrame:
    """The k most and the k least similar objects, marked by ``side``."""
    hi = highest(df, score, k, id_col).withColumn("side", F.lit("most"))
    lo = lowest(df, score, k, id_col).withColumn("side", F.lit("least"))
    return hi.unionByName(lo)


def best_row(
    df: DataFrame, metric: str, position: str, groups: Sequence[str] = (), largest: bool = False
) -> DataFrame:
    """argmin / argmax over a sweep; the first position wins ties. One aggregation, no sort."""
    key: Column = F.struct((-F.col(metric) if largest else F.col(metric)).alias("m"), F.col(position).alias("p"))
    rest = [c for c in df.columns if c not in groups]
    row = F.min_by(F.struct(*rest), key).alias("r")
    out = df.groupBy(*groups).agg(row) if groups else df.agg(row)
    return out.select(*groups, "r.*")
