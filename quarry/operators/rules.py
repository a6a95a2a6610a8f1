"""Frequent itemsets and association rules on FP-growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage, spread_small
from quarry.sources.text import basket_items


def baskets_of_rows(df: DataFrame, cols: Sequence[str], id_col: str, titles: Sequence[str] | None = None) -> DataFrame:
    """0/1 columns as baskets of column positions or titles."""
    return df.select(F.col(id_col).alias("basket_id"), basket_items(cols, titles).alias("items"))


def baskets_of_pairs(df: DataFrame, basket: str, item: str) -> DataFrame:
    """One basket per key from (key, item) rows, each item once.

    Sets are merged map-side, so a basket grows with the number of different items only.
    """
    items = F.sort_array(F.collect_set(F.col(item).cast("string"))).alias("items")
    return df.groupBy(F.col(basket).alias("basket_id")).agg(items)


class Mined:
    """One FP-growth run; itemsets and rules read from it."""

    def __init__(self, baskets: DataFrame, min_support: float):
        self.min_support = min_support
        held = baskets.select("items").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # empty baskets count in every share
            self.total = held.count()
            full = held.filter(F.size("items") > 0)
            n, widest = full.agg(F.count("*"), F.max(F.size("items"))).first()
            spark = baskets.sparkSession
            # one conditional tree set per task: more tasks, smaller trees
            parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
            least = min(1.0, max(0.0, (min_support * self.total - 1e-9) / max(1, n)))
            grow = FPGrowth(itemsCol="items", minSupport=least, minConfidence=0.0, numPartitions=parts)
            model = grow.fit(spread_small(full, n, 4 * (widest or 1), 100))
            sets = model.freqItemsets.select(F.sort_array("items").alias("items"), "freq")
            # the model mines again each time its itemsets are read
            self.sets = cut_lineage(sets.filter(F.col("freq") >= min_support * self.total - 1e-9), "itemsets")
        finally:
            held.unpersist()

    def itemsets(self, max_size: int | None = None) -> DataFrame:
        """(items, freq, support), at least ``min_support`` of all baskets."""
        s = self.sets.filter(F.size("items") <= max_size) if max_size else self.sets
        return s.withColumn("support", F.col("freq") / F.lit(self.total))

    def rules(self, min_confidence: float, max_size: int | None = None, support_mode: str = "rule") -> DataFrame:
        """(antecedent, consequent, confidence, support, lift), one head item.

        Size-1 itemsets give rules with empty body, whose confidence is their
        support. ``support_mode="body"`` reports the share of the body instead
        of body and head together.
        """
        sets = self.itemsets()
        grown = sets.filter(F.size("items") >= 2)
        if max_size:
            grown = grown.filter(F.size("items") <= max_size)
        split = grown.select("items", "freq", F.explode("items").alias("head")).select(
            F.array_remove("items", F.col("head")).alias("antecedent"), F.array("head").alias("consequent"), "freq"
        )
        body = sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("body_freq"))
        head = sets.filter(F.size("items") == 1).select(F.col("items").alias("consequent"), F.col("freq").alias("head_freq"))
        full = split.join(body, "antecedent").join(head, "consequent")
        empty = head.select(
            "consequent",
            F.array().cast("array<string>").alias("antecedent"),
            F.col("head_freq").alias("freq"),
            F.lit(self.total).alias("body_freq"),
            "head_freq",
        )
        n = F.lit(float(self.total))
        every = full.unionByName(empty).withColumn("confidence", F.col("freq") / F.col("body_freq"))
        shown = F.col("freq") if support_mode == "rule" else F.col("body_freq")
        return every.filter(F.col("confidence") >= min_confidence - 1e-12).select(
            "antecedent", "consequent", "confidence", (shown / n).alias("support"), (F.col("confidence") * n / F.col("head_freq")).alias("lift")
        )


def sorted_itemsets(sets: DataFrame) -> DataFrame:
    return sets.orderBy(F.desc("support"), "items")


def sorted_rules(rules: DataFrame) -> DataFrame:
    return rules.orderBy(F.desc("confidence"), "antecedent", "consequent")


def readable(items: Column, names: Sequence[str]) -> Column:
    """Item positions replaced by names."""
    table = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (str(i), n)])
    return F.transform(items, lambda i: F.try_element_at(table, i))


def readable_itemsets(sets: DataFrame, names: Sequence[str]) -> DataFrame:
    return sets.withColumn("items", readable(F.col("items"), names))


def readable_rules(rules: DataFrame, names: Sequence[str]) -> DataFrame:
    return rules.withColumns({c: readable(F.col(c), names) for c in ("antecedent", "consequent")})
