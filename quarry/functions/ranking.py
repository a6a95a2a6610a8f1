"""Running totals, row numbers and exact quantiles over a whole table.

A window without partition keys would pull every row into one task. Here the rows
are dealt into ranges of the order columns, windows run inside the ranges, and a
small table of range totals supplies the offsets. Any comparable type orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.session import cut_lineage

ROWS_PER_BUCKET = 200_000
SKETCH = 10_000  # accuracy of the sketch that brackets a quantile
MARGIN = 0.001  # width of a bracket on either side, as a share of the rows


def bucketed(df: DataFrame, order: str | Sequence[str], groups: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Add ``__bucket``, non-decreasing in the order columns inside each group.

    The number of ranges follows the number of rows. Ties in all columns stay
    together, so name enough columns to tell rows apart. Several ranges are written:
    the cuts come from a sample, and a plan that took it twice could place one row in
    two ranges.
    """
    order = [order] if isinstance(order, str) else list(order)
    n = buckets or -(-df.count() // ROWS_PER_BUCKET)
    if n <= 1:
        return df.withColumn("__bucket", F.lit(0))
    dealt = df.repartitionByRange(n, *groups, *order)
    return cut_lineage(dealt.withColumn("__bucket", F.spark_partition_id()), "ranges")


def running_before(
    df: DataFrame,
    order: Sequence[str],
    sums: dict[str, Column],
    groups: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """For each output name: the sum of its column over all rows that sort before.

    The order must be total. ``<name>_total`` gives the whole group's sum; a null
    group is a group.
    """
    groups = list(groups)
    vals = {f"__v_{n}": c for n, c in sums.items()}
    b = bucketed(df.withColumns(vals), order, groups, buckets)
    keys = groups + ["__bucket"]
    per = b.groupBy(*keys).agg(*[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in sums])
    # one row per range and group
    before = W.partitionBy(*groups).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(*groups)
    offsets = per.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in sums],
        *[F.sum(f"__t_{n}").over(every).alias(f"{n}_total") for n in sums],
    )
    cond = [b[k].eqNullSafe(offsets[f"__k_{k}"]) for k in keys]
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    joined = b.join(offsets, cond, "inner")
    out = joined.withColumns(
        {n: F.col(f"__o_{n}") + F.coalesce(F.sum(f"__v_{n}").over(inside), F.lit(0)) for n in sums}
    )
    return out.drop(
        "__bucket",
        *vals,
        *[f"__k_{k}" for k in keys],
        *[f"__o_{n}" for n in sums],
    )


def with_row_index(
    df: DataFrame,
    order: Sequence[str],
    groups: Sequence[str] = (),
    buckets: int | None = None,
    index: str = "row_index",
) -> DataFrame:
    """0-based position in ``order`` (inside each group), plus ``<index>_total``."""
    return running_before(df, order, {index: F.lit(1).cast("long")}, groups, buckets)


def _bracketed(src: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """(keys, ``__v``, ``__out``, ``__c``): values near the wanted ranks with their counts.

    A sketch gives, per group and quantile, two values between which the rank must lie.
    Values between them are counted one by one; all others only per gap, which the task
    sums up before anything is shuffled. Groups below the sketch's accuracy stay whole.
    """
    edges = [p for q in probs for p in (max(0.0, q - MARGIN), min(1.0, q + MARGIN))]
    sketch = src.groupBy(*keys).agg(
        F.count("*").alias("__n"), F.percentile_approx("__x", F.array(*map(F.lit, edges)), SKETCH).alias("__e")
    )
    sketch = cut_lineage(sketch.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__n", "__e"), "brackets")
    near = src.join(sketch, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    x = F.col("__x")
    inside = F.col("__n") <= SKETCH
    for i in range(0, len(edges), 2):
        inside = inside | ((x >= F.get("__e", F.lit(i))) & (x <= F.get("__e", F.lit(i + 1))))
    below = F.array_max(F.filter("__e", lambda e: e < x))
    rows = near.select(*keys, F.when(inside, x).otherwise(below).alias("__v"), (~inside).alias("__out"))
    return rows.groupBy(*keys, "__v", "__out").agg(F.count("*").alias("__c"))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    groups: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation: groups, ``n`` and ``q`` (array).

    Nulls are left out, a null group is a group. Two scans: one for brackets around
    the wanted ranks, one that counts the values between them (:func:`_bracketed`).
    """
    keys = list(groups) or ["__g"]
    src = df if groups else df.withColumn("__g", F.lit(0))
    src = src.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__x"))
    counts = cut_lineage(_bracketed(src, keys, probs), "counts")
    placed = running_before(counts, ["__v", "__out"], {"__lo": F.col("__c")}, keys, buckets)
    n = F.col("__lo_total")
    wanted = F.array(
        *[
            F.struct(F.lit(i).alias("p"), F.lit(s).alias("side"), f((n - 1) * F.lit(float(p))).cast("long").alias("pos"))
            for i, p in enumerate(probs)
            for s, f in ((0, F.floor), (1, F.ceil))
        ]
    )
    here = F.filter(wanted, lambda t: (t["pos"] >= F.col("__lo")) & (t["pos"] < F.col("__lo") + F.col("__c")))
    hit = placed.select(*keys, n.alias("__n"), F.col("__v").cast("double").alias("__v"), F.explode(here).alias("t"))
    out = []
    for i, p in enumerate(probs):
        lo = F.max(F.when((F.col("t.p") == i) & (F.col("t.side") == 0), F.col("__v")))
        hi = F.max(F.when((F.col("t.p") == i) & (F.col("t.side") == 1), F.col("__v")))
        h = (F.max("__n") - 1) * F.lit(float(p))
        out.append(lo + (hi - lo) * (h - F.floor(h)))
    res = hit.groupBy(*keys).agg(F.max("__n").alias("n"), F.array(*out).alias("q"))
    return res if groups else res.drop("__g")
