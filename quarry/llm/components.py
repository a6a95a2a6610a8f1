"""Connected components of a link table by contraction to least neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written


COPY_ROWS = 1 << 17  # rows of two columns that are copied to every task instead of being shuffled


def _both(edges: DataFrame) -> DataFrame:
    """Every link from both ends."""
    ends = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    return edges.select(F.inline(ends))


def _copied(names: DataFrame) -> DataFrame:
    """A written table as it is joined: copied if it is measured as small."""
    return F.broadcast(names) if names.count() <= COPY_ROWS else names


def _followed(near: DataFrame) -> DataFrame:
    """``node`` and ``root``, where a root's root is itself; the way is halved in each pass."""
    while True:
        up = near.filter("node <> root").select(F.col("node").alias("k"), F.col("root").alias("top"))
        up = near.join(_copied(up), F.col("root") == F.col("k"), "left")
        near = written(up.select("node", F.coalesce("top", "root").alias("root"), F.col("k").isNotNull().alias("moved")), "followed")
        if near.filter("moved").isEmpty():
            return near.select("node", "root")


def renamed(names: DataFrame, roots: DataFrame) -> DataFrame:
    """``node`` and ``root`` with the roots that have a root in ``roots`` replaced by it."""
    tops = _copied(roots.select(F.col("node").alias("k"), F.col("root").alias("top")))
    return names.join(tops, F.col("root") == F.col("k"), "left").select("node", F.coalesce("top", "root").alias("root"))


def between(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The links that are left between the components of ``roots``; a node it does not name stays."""
    tops = _copied(roots.select(F.col("node").alias("k"), F.col("root").alias("top")))
    for end in ("a", "b"):
        joined = edges.join(tops, F.col(end) == F.col("k"), "left")
        edges = joined.withColumn(end, F.coalesce("top", end)).drop("k", "top")
    return edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) for each node that has a link.

    ``edges`` has comparable columns ``a`` and ``b``; links to itself are ignored, repeated
    links count once, an empty table gives an empty table. In each round a node points to the
    least of its neighbours and itself, the pointers are followed to their ends, and the links
    between different ends go on. An end that has a neighbour of another tree is next to a
    lesser end, so two rounds at least halve the nodes. Tables are written in the shared
    folder, as those of a hot node can be split then; only counts come to the driver.
    """
    now = written(edges.select("a", "b").filter("a <> b"), "links")
    names = None
    while names is None or not now.isEmpty():
        near = _both(now).groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.min("u")).alias("root"))
        roots = _followed(written(near, "least"))
        now = written(between(now, roots), "links")
        names = roots if names is None else written(renamed(names, roots), "roots")
    return names
