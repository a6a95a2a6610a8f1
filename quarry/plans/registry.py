"""Registry: each query is a function (spark, folder) -> DataFrame with an optional SQL twin."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn

    return add


def rounded(df, digits: int = 6, **per_column: int):
    """Round the double columns, so that both engines' last bits do not matter."""
    from pyspark.sql import functions as F

    cols = []
    for f in df.schema.fields:
        if f.dataType.simpleString() in ("double", "float"):
            # adding 0.0 turns a rounded -0.0 into 0.0
            cols.append((F.round(F.col(f.name), per_column.get(f.name, digits)) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
