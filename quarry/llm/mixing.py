"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import quoted, text_of, words_of, written

BUCKETS = 4096


def word_count(text: Column) -> Column:
    """Runs of ``[^\\x20\\x09-\\x0D]``."""
    return F.size(words_of(text)).cast("long")


def fill_targets(groups: DataFrame, share: float, most: float) -> float | None:
    """The level L at which targets ``least(most * size, L * weight)`` sum to ``share`` of all sizes.

    ``groups`` has one row per group with ``size`` and ``weight``. The excess of capped groups
    is reshared by weight until none is above its cap. Each round is one aggregation; None if
    every group is at its cap or all sizes are zero.
    """
    cap = F.col("size") * F.lit(float(most))
    total = groups.agg(F.sum("size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = cap < F.lit(level) * F.col("weight") if capped >= 0 else F.lit(False)
        row = groups.filter("size > 0").agg(
            F.sum(F.when(over, cap).otherwise(0.0)).alias("held"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(F.when(over, 1).otherwise(0)).alias("n"),
        ).first()
        if not row["weight"]:
            return None
        if row["n"] == capped:
            return level
        level, capped = (share * total - row["held"]) / row["weight"], row["n"]


def _uniform(id_: Column, text: Column, seed: int) -> Column:
    """A number in (0, 1) from the id, where that is null from the text: 52 bits of md5."""
    key = F.coalesce(id_.cast("string"), F.concat(F.lit("text:"), F.md5(text)))
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{seed}"))), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def pareto_mix(
    df: DataFrame,
    weights: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_col: str = "source",
    share: float = 1.5,
    most: float = 2.0,
    appeal_col: str | None = None,
    seed: int = 42,
) -> DataFrame:
    """How often the mix takes each row: ``id``, ``tk`` (text hash), ``group``, ``size``,
    ``group_size``, ``target`` (words of the group) and ``copies``; one row per input row.

    ``weights`` has ``group`` and ``weight``. The groups share ``share`` times all words by
    weight; a target stops at ``most`` times its group's words and the excess goes to the
    others by weight. With ``appeal_col``, expected copies within a group are in proportion
    to that column (null or negative: 0), none above ``most``; without, they are equal.

    A row's whole expected copies are certain. For the rest p, rows are ranked by random odds
    over inclusion odds, ``(u / (1 - u)) / (p / (1 - p))``, and taken in that order as long as
    the words taken stay within what the group's target leaves; one further row, that whose
    size is nearest to the words still missing, is added if that brings the sum nearer. u is a
    function of id and seed, so reruns agree.

    A null or empty text has size 0, a null group is a group like any other, groups without a
    weight get none of the mix. Rows repeated in full rank equal and are taken or left
    together. An empty table gives an empty table.

    Plan: sizes are written once as narrow rows. Groups are summed before their shuffle. The
    place where a group's sampling stops is found in two steps, by sums over 4,096 buckets of
    its order and then by ordering the one bucket in which it lies, so a group with a third of
    all rows is never in one task.
    """
    text = text_of(text_col)
    appeal = F.greatest(F.coalesce(F.col(quoted(appeal_col)).cast("double"), F.lit(0.0)), F.lit(0.0)) if appeal_col else F.lit(1.0)
    id_ = F.col(quoted(id_col))
    rows = written(
        df.select(
            id_.alias("id"),
            F.xxhash64(text).alias("tk"),
            F.col(quoted(group_col)).alias("group"),
            word_count(text).alias("size"),
            appeal.alias("appeal"),
            _uniform(id_, text, seed).alias("u"),
        ),
        "sizes",
    )
    sums = rows.groupBy("group").agg(F.sum("size").alias("size"), F.sum(F.col("size") * F.col("appeal")).alias("drawn"))
    w = weights.select(F.col("group").alias("w_group"), F.col("weight").cast("double").alias("weight"))
    groups = written(
        sums.join(w, F.col("group").eqNullSafe(F.col("w_group")), "left").select(
            "group", "size", "drawn", F.coalesce("weight", F.lit(0.0)).alias("weight")
        ),
        "groups",
    )
    level = fill_targets(groups.filter("weight > 0"), share, most)
    cap = F.col("size") * F.lit(float(most))
    target = F.when(F.col("weight") <= 0, 0.0).otherwise(cap if level is None else F.least(cap, F.lit(level) * F.col("weight")))
    groups = groups.withColumn("target", target)
    # expected copies of a row are least(most, rate * appeal)
    groups = groups.withColumn("rate", F.coalesce(F.try_divide("target", "drawn"), F.lit(0.0)))
    groups = written(groups, "rates")
    if appeal_col:
        groups = _rates(rows, groups, most)
    named = groups.select(F.col("group").alias("g"), F.col("size").alias("group_size"), "target", "rate")
    on = F.col("group").eqNullSafe(F.col("g"))
    expected = F.least(F.lit(float(most)), F.col("rate") * F.col("appeal"))
    drawn = (
        rows.join(named, on, "left")
        .withColumn("expected", expected)
        .withColumn("whole", F.floor("expected").cast("long"))
        .withColumn("p", F.col("expected") - F.col("whole"))
        .withColumn("order", F.try_divide(F.col("u") * (1 - F.col("p")), (1 - F.col("u")) * F.col("p")))
        .select("id", "tk", "group", "size", "group_size", "target", "u", "whole", "p", F.when(F.col("p") > 0, F.col("order")).alias("order"))
    )
    drawn = written(drawn, "ranks")
    return _cut(drawn).select(
        "id", "tk", "group", "size", "group_size", "target", (F.col("whole") + F.col("more")).alias("copies")
    )


def _rates(rows: DataFrame, groups: DataFrame, most: float) -> DataFrame:
    """Rates at which ``least(most, rate * appeal)`` copies meet the targets, one pass per round."""
    held = None
    while True:
        g = groups.select(F.col("group").alias("g"), "rate", "target")
        over = F.col("rate") * F.col("appeal") >= F.lit(float(most))
        per = (
            rows.join(g, F.col("group").eqNullSafe(F.col("g")))
            .groupBy("group")
            .agg(
                F.sum(F.when(over, F.col("size") * F.lit(float(most))).otherwise(0.0)).alias("held"),
                F.sum(F.when(over, 0.0).otherwise(F.col("size") * F.col("appeal"))).alias("free"),
                F.sum(over.cast("long")).alias("n"),
            )
        )
        per = written(per, "held").withColumnRenamed("group", "h")
        now = per.agg(F.sum("n")).first()[0] or 0
        if now == held:
            return groups
        held = now
        rate = F.try_divide(F.col("target") - F.col("held"), F.col("free"))
        rate = F.greatest(F.coalesce(rate, F.col("rate")), F.col("rate"))
        groups = written(
            groups.join(per, F.col("group").eqNullSafe(F.col("h")), "left").withColumn("rate", rate).drop("h", "held", "free", "n"),
            "rates",
        )


def _cut(drawn: DataFrame) -> DataFrame:
    """``more``: 1 for the rows that the order sample takes."""
    totals = drawn.groupBy("group").agg(
        F.max("target").alias("t"),
        F.sum(F.col("whole") * F.col("size")).alias("sure"),
        F.avg(F.when(F.col("p") > 0, F.col("p"))).alias("mean_p"),
    )
    totals = written(
        totals.select(F.col("group").alias("g"), F.greatest(F.col("t") - F.col("sure"), F.lit(0.0)).alias("left"), F.coalesce("mean_p", F.lit(0.5)).alias("mean_p")),
        "left",
    )
    on = F.col("group").eqNullSafe(F.col("g"))
    # with equal p the position in the order is u; other p bend the scale, the order holds
    odds = F.col("order") * F.col("mean_p") / (1 - F.col("mean_p"))
    bucket = F.least(F.floor(odds / (1 + odds) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    ranked = drawn.filter(F.col("order").isNotNull()).join(totals, on).select(
        "group", "tk", "size", "order", "left", bucket.alias("bucket")
    )
    per = ranked.groupBy("group", "bucket").agg(F.sum("size").alias("s"), F.max("left").alias("left"))
    before = W.partitionBy("group").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    edges = per.withColumn("before", F.coalesce(F.sum("s").over(before), F.lit(0))).filter(
        (F.col("before") <= F.col("left")) & (F.col("before") + F.col("s") > F.col("left"))
    )
    edges = edges.groupBy(F.col("group").alias("e")).agg(F.min("bucket").alias("edge"), F.min_by("before", "bucket").alias("before"))
    edges = written(edges, "edges")
    inside = ranked.join(edges, F.col("group").eqNullSafe(F.col("e"))).filter(F.col("bucket") == F.col("edge"))
    to_here = W.partitionBy("group").orderBy("order", "tk").rangeBetween(W.unboundedPreceding, 0)
    fits = inside.withColumn("sum", F.col("before") + F.sum("size").over(to_here)).filter(F.col("sum") <= F.col("left"))
    stops = fits.groupBy(F.col("group").alias("f")).agg(F.max(F.struct("order", "tk")).alias("last"), F.max("sum").alias("sum"))
    place = F.struct(F.col("order"), F.col("tk"))
    stop = (
        totals.join(edges, F.col("g").eqNullSafe(F.col("e")), "left")
        .join(stops, F.col("g").eqNullSafe(F.col("f")), "left")
        .select("g", "left", "mean_p", "edge", "last", F.coalesce("sum", "before").alias("sum"))
    )
    stop = written(stop, "stops")
    marked = drawn.join(stop, on, "left")
    taken = F.col("order").isNotNull() & (
        F.col("edge").isNull() | (bucket < F.col("edge")) | ((bucket == F.col("edge")) & F.coalesce(place <= F.col("last"), F.lit(False)))
    )
    marked = marked.withColumn("taken", taken)
    gap = F.col("left") - F.col("sum")
    off = F.abs(F.col("size") - gap)
    extra = (
        marked.filter(F.col("order").isNotNull() & ~F.col("taken") & (off < gap))
        .groupBy(F.col("group").alias("x"))
        .agg(F.min(F.struct(off.alias("off"), F.col("order"), F.col("tk"))).alias("extra"))
    )
    marked = marked.join(written(extra, "extra"), F.col("group").eqNullSafe(F.col("x")), "left")
    also = F.coalesce((F.col("extra.order") == F.col("order")) & (F.col("extra.tk") == F.col("tk")), F.lit(False))
    return marked.withColumn("more", (F.col("taken") | also).cast("long"))


def cyclic_weights(df: DataFrame, group_col: str = "source", cycle: tuple[float, ...] = (5, 2, 1)) -> DataFrame:
    """``group`` and ``weight``: the groups in code point order, null last, weigh as the cycle says.

    The order is taken over the list of groups, one row each.
    """
    groups = df.select(F.col(quoted(group_col)).alias("group")).distinct()
    rank = F.row_number().over(W.orderBy(F.col("group").asc_nulls_last())) - 1
    pick = F.get(F.array(*[F.lit(float(w)) for w in cycle]), F.pmod(rank, F.lit(len(cycle))))
    return groups.select("group", pick.alias("weight"))


def mix(
    df: DataFrame,
    weights: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_col: str = "source",
    **options,
) -> DataFrame:
    """The rows of ``df`` that the mix takes, with ``copies`` (replaces a column of that name).

    Rows that share id, text and group share their copies. See :func:`pareto_mix`.
    """
    drawn = pareto_mix(df, weights, id_col, text_col, group_col, **options).filter("copies > 0")
    drawn = drawn.groupBy(F.col("id").alias("__id"), F.col("tk").alias("__tk"), F.col("group").alias("__group")).agg(
        F.max("copies").alias("__copies")
    )
    cond = (
        F.col(quoted(id_col)).eqNullSafe(F.col("__id"))
        & (F.xxhash64(text_of(text_col)) == F.col("__tk"))
        & F.col(quoted(group_col)).eqNullSafe(F.col("__group"))
    )
    keep = [F.col(quoted(c)) for c in df.columns if c.lower() != "copies"]
    return df.join(written(drawn, "drawn"), cond).select(*keep, F.col("__copies").alias("copies"))
