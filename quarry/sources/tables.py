"""Tabular and matrix scans, itemset text, and result sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Table with named columns: Parquet, or CSV with a header row and a given schema."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")


def read_matrix(spark: SparkSession, path: str, vec_col: str) -> DataFrame:
    """Matrix container: the vector column becomes ``features`` (array<double>)."""
    df = spark.read.parquet(path)
    rest = [c for c in df.columns if c != vec_col]
    return df.select(*rest, F.col(vec_col).cast("array<double>").alias("features"))


def read_numbers(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Headerless numbers separated by blanks."""
    parts = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    return lines.select(*[F.get(parts, F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)])


def write_metrics(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Tidy metrics, intervals, score tables or mixtures; one format for all reports."""
    df.write.mode("overwrite").format(fmt).save(path)
