"""Decision trees: one fit at full depth, node table, pruning and depth sweeps."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.ranking import running_before
from quarry.functions.vectors import batches_to_matrices
from quarry.session import cut_lineage, shared_path

DEEPEST = 30  # limit of pyspark.ml
NODES = (
    "node_id int, depth int, feature string, threshold double, impurity double, n long, "
    "class_counts array<double>, prediction double, left int, right int"
)


def vectors(df: DataFrame, vec_col: str, label: str) -> DataFrame:
    """The (label, vector) form that pyspark.ml estimators take."""
    return df.withColumns(
        {"__x": array_to_vector(F.col(vec_col).cast("array<double>")), "__y": F.col(label).cast("double")}
    )


@dataclass
class Tree:
    """Node arrays of one fitted tree; leaves have left = -1."""

    names: list[str]
    feature: np.ndarray
    threshold: np.ndarray
    impurity: np.ndarray
    n: np.ndarray
    counts: np.ndarray
    prediction: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def depths(self) -> np.ndarray:
        d = np.zeros(len(self.n), int)
        for i in range(len(d)):  # children always follow their parent
            if self.left[i] >= 0:
                d[self.left[i]] = d[self.right[i]] = d[i] + 1
        return d

    def collapse(self, min_samples_split: int) -> Tree:
        """Nodes with fewer rows than the threshold become leaves.

        Greedy growth never looks ahead, so this equals stopping there while growing.
        """
        left = np.where(self.n < min_samples_split, -1, self.left)
        keep, stack = [], [0]
        while stack:
            i = stack.pop()
            keep.append(i)
            if left[i] >= 0:
                stack += [self.right[i], left[i]]
        keep = np.array(sorted(keep))
        new = np.full(len(self.n), -1)
        new[keep] = np.arange(len(keep))
        child = lambda c: np.where(left[keep] >= 0, new[np.maximum(c[keep], 0)], -1)
        return Tree(
            self.names, self.feature[keep], self.threshold[keep], self.impurity[keep], self.n[keep],
            self.counts[keep], self.prediction[keep], child(self.left), child(self.right),
        )

    def nodes(self, spark) -> DataFrame:
        d = self.depths()
        inner = self.left >= 0
        rows = [
            (
                i, int(d[i]), self.names[self.feature[i]] if inner[i] else None, float(self.threshold[i]) if inner[i] else None,
                float(self.impurity[i]), int(self.n[i]), [float(c) for c in self.counts[i]], float(self.prediction[i]),
                int(self.left[i]) if inner[i] else None, int(self.right[i]) if inner[i] else None,
            )
            for i in range(len(self.n))
        ]
        return spark.createDataFrame(rows, NODES)

    def _walk(self, x: np.ndarray, depths: Sequence[int]):
        """Node of every row after each of the given depths."""
        at = np.zeros(len(x), int)
        want, out = set(depths), {}
        for level in range(max(depths) + 1):
            if level in want:
                out[level] = at.copy()
            inner = self.left[at] >= 0
            if inner.any():
                i = at[inner]
                goes_left = x[inner, self.feature[i]] <= self.threshold[i]
                at[inner] = np.where(goes_left, self.left[i], self.right[i])
        return out

    def transform(self, df: DataFrame, vec_col: str = "features", out: str = "prediction") -> DataFrame:
        bottom = int(self.depths().max())

        @F.pandas_udf("double")
        def predict(v: pd.Series) -> pd.Series:
            if not len(v):
                return pd.Series([], dtype=float)
            x = np.stack(v.to_numpy()).astype(float)
            return pd.Series(self.prediction[self._walk(x, [bottom])[bottom]])

        return df.withColumn(out, predict(F.col(vec_col).cast("array<double>")))

    def probabilities(self, df: DataFrame, vec_col: str = "features", out: str = "probability") -> DataFrame:
        bottom = int(self.depths().max())
        share = self.counts / np.maximum(self.counts.sum(1, keepdims=True), 1)

        @F.pandas_udf("array<double>")
        def predict(v: pd.Series) -> pd.Series:
            if not len(v):
                return pd.Series([], dtype=object)
            x = np.stack(v.to_numpy()).astype(float)
            return pd.Series(list(share[self._walk(x, [bottom])[bottom]]))

        return df.withColumn(out, predict(F.col(vec_col).cast("array<double>")))

    def at_depths(self, df: DataFrame, depths: Sequence[int], vec_col: str = "features", out: str = "predictions") -> DataFrame:
        """One prediction per depth limit in one pass: a tree cut at depth d is the depth-d tree."""
        depths = list(depths)

        @F.pandas_udf("array<double>")
        def predict(v: pd.Series) -> pd.Series:
            if not len(v):
                return pd.Series([], dtype=object)
            x = np.stack(v.to_numpy()).astype(float)
            seen = self._walk(x, depths)
            return pd.Series(list(np.column_stack([self.prediction[seen[d]] for d in depths])))

        return df.withColumn(out, predict(F.col(vec_col).cast("array<double>")))


def bins_for(df: DataFrame, vec_col: str, most: int) -> int:
    """Bins that hold every value of the widest attribute, up to ``most``; splits are then exact."""
    long = df.select(F.posexplode(F.col(vec_col).cast("array<double>")).alias("pos", "v"))
    widest = long.groupBy("pos").agg(F.approx_count_distinct("v", 0.02).alias("n")).agg(F.max("n")).first()[0] or 0
    return max(2, min(most, int(widest * 1.1) + 2))


def clamp_depths(depths: Sequence[int]) -> list[int]:
    kept = sorted({min(int(d), DEEPEST) for d in depths})
    if max(depths) > DEEPEST:
        warnings.warn(f"depths above {DEEPEST} are clamped to {DEEPEST}", stacklevel=2)
    return kept


def fit_tree(
    df: DataFrame,
    label: str = "label",
    vec_col: str = "features",
    impurity: str = "gini",
    max_depth: int = 5,
    min_samples_split: int = 2,
    max_bins: int = 1_024,
    names: Sequence[str] | None = None,
    seed: int = 0,
) -> Tree:
    """One tree. Splits are exact for attributes of up to about ``max_bins`` values, else by quantiles,
    with a warning; :func:`fit_exact_tree` has no such bound."""
    spark = df.sparkSession
    x = vectors(df, vec_col, label)
    wanted, max_bins = max_bins, bins_for(df, vec_col, max_bins)
    if max_bins == wanted:
        warnings.warn(f"an attribute has more values than {wanted} bins; splits fall on quantiles", stacklevel=2)
    model = DecisionTreeClassifier(
        featuresCol="__x", labelCol="__y", impurity=impurity, maxDepth=clamp_depths([max_depth])[0], maxBins=max_bins, seed=seed
    ).fit(x)
    path = shared_path(spark, "tree")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").orderBy("id").collect()  # a model, bounded by its depth
    rows = [r["nodeData"] if "nodeData" in r.__fields__ else r for r in rows]
    m = model.numFeatures
    tree = Tree(
        list(names) if names else [f"x{i}" for i in range(m)],
        np.array([r["split"]["featureIndex"] for r in rows]),
        np.array([(r["split"]["leftCategoriesOrThreshold"] or [0.0])[0] for r in rows]),
        np.array([r["impurity"] for r in rows]),
        np.array([r["rawCount"] for r in rows]),
        np.array([r["impurityStats"] for r in rows]),
        np.array([r["prediction"] for r in rows]),
        np.array([r["leftChild"] for r in rows]),
        np.array([r["rightChild"] for r in rows]),
    )
    return tree.collapse(min_samples_split) if min_samples_split > 2 else tree


def _cost(counts: Sequence[Column], impurity: str) -> Column:
    """Impurity times rows of one side of a split."""
    n = sum(counts[1:], counts[0])
    if impurity == "gini":
        return n - sum((c * c for c in counts[1:]), counts[0] * counts[0]) / n
    parts = [F.when(c > 0, -c * F.log2(c / n)).otherwise(0.0) for c in counts]
    return sum(parts[1:], parts[0])


def _impurity(counts: np.ndarray, impurity: str) -> float:
    p = counts / max(counts.sum(), 1)
    return float(1 - (p * p).sum()) if impurity == "gini" else float(-(p[p > 0] * np.log2(p[p > 0])).sum())


def fit_exact_tree(
    df: DataFrame,
    label: str = "label",
    vec_col: str = "features",
    impurity: str = "gini",
    max_depth: int = 5,
    min_samples_split: int = 2,
    names: Sequence[str] | None = None,
) -> Tree:
    """One tree whose splits are the best of all cuts between neighbouring values, however many there are.

    Labels are 0, 1, 2, ...; a cut lies halfway between two values, ties go to the first
    attribute and the lowest cut, and a node that no cut improves is a leaf.

    Plan: one round per level. Rows find their node by the tree so far; the class counts of
    every (node, attribute, value) are added up along the sorted values, dealt into ranges
    whose totals supply the offsets (no node is one task), and each node keeps its best cut.
    The driver gets one row per node.
    """
    if impurity not in ("gini", "entropy"):
        raise ValueError(f"unknown impurity {impurity!r}")
    x = df.select(F.col(vec_col).cast("array<double>").alias("x"), F.col(label).cast("int").alias("y"))
    x = cut_lineage(x, "tree-rows")
    found = {r["y"]: r["n"] for r in x.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not found:
        raise ValueError("empty table")
    width, k = x.agg(F.max(F.size("x"))).first()[0], max(found) + 1
    counts = [np.array([found.get(c, 0) for c in range(k)], float)]
    feature, threshold, left, right, open_ = [0], [0.0], [-1], [-1], [0]

    def tree() -> Tree:
        c = np.array(counts)
        return Tree(
            list(names) if names else [f"x{i}" for i in range(width)], np.array(feature), np.array(threshold),
            np.array([_impurity(r, impurity) for r in c]), c.sum(1).astype(int), c, c.argmax(1).astype(float),
            np.array(left), np.array(right),
        )

    for level in range(max_depth):
        open_ = [i for i in open_ if counts[i].sum() >= max(2, min_samples_split) and (counts[i] > 0).sum() > 1]
        if not open_:
            break
        grown, wanted = tree(), np.array(open_)

        def to_nodes(batches, grown=grown, wanted=wanted, level=level):
            for b, v in batches_to_matrices(batches, "x"):
                node = grown._walk(v, [level])[level]
                some = np.isin(node, wanted)
                v, node, y = v[some], node[some], b.column("y").to_numpy()[some]
                cols = [np.repeat(node, width), np.tile(np.arange(width), len(v)), v.ravel(), np.repeat(y, width)]
                kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["node", "pos", "v", "y"])

        long = x.mapInArrow(to_nodes, "node int, pos int, v double, y int")
        own = [F.sum((F.col("y") == c).cast("long")).alias(f"c{c}") for c in range(k)]
        values = cut_lineage(long.groupBy("node", "pos", "v").agg(*own), "value-counts")
        run = running_before(values, ["v"], {f"b{c}": F.col(f"c{c}") for c in range(k)}, ["node", "pos"])
        here = [(F.col(f"b{c}") + F.col(f"c{c}")).cast("double") for c in range(k)]
        there = [F.col(f"b{c}_total") - h for c, h in enumerate(here)]
        cut = run.filter(sum(there[1:], there[0]) > 0).withColumn("cost", F.round(_cost(here, impurity) + _cost(there, impurity), 9))
        pick = F.min_by(F.struct("cost", "pos", "v", F.array(*here).alias("here")), F.struct("cost", "pos", "v"))
        best = cut_lineage(cut.groupBy("node").agg(pick.alias("s")).select("node", "s.*"), "best-cuts")
        after = values.join(F.broadcast(best.select("node", "pos", F.col("v").alias("at"))), ["node", "pos"])  # a row per node
        after = after.filter(F.col("v") > F.col("at")).groupBy("node").agg(F.min("v").alias("next"))
        grown_to = []
        for r in best.join(after, "node").orderBy("node").collect():
            i, side = r["node"], np.array(r["here"])
            if r["cost"] >= _impurity(counts[i], impurity) * counts[i].sum() - 1e-9:
                continue
            feature[i], threshold[i] = r["pos"], (r["v"] + r["next"]) / 2
            if not r["v"] <= threshold[i] < r["next"]:
                threshold[i] = r["v"]
            left[i], right[i] = len(counts), len(counts) + 1
            grown_to += [len(counts), len(counts) + 1]
            counts += [side, counts[i] - side]
            for column, empty in ((feature, 0), (threshold, 0.0), (left, -1), (right, -1)):
                column += [empty, empty]
        open_ = grown_to
    return tree()


def depth_sweep(
    df: DataFrame, depths: Sequence[int], folds: int, label: str = "label", vec_col: str = "features", fold: str = "fold",
    impurity: str = "gini", max_bins: int = 1_024,
) -> DataFrame:
    """(depth, depth_used, fold, split, error, n): one fit per fold at the greatest depth, all depths scored at once.

    A depth beyond the limit of pyspark.ml keeps its row and is scored at that limit.
    """
    asked = sorted({int(d) for d in depths})
    depths = [min(d, DEEPEST) for d in asked]
    df = cut_lineage(df.select(fold, vec_col, label), "sweep")  # read once per fold, derived once
    out = None
    for k in range(folds):
        tree = fit_tree(df.filter(F.col(fold) != k), label, vec_col, impurity, max(depths), max_bins=max_bins)
        p = tree.at_depths(df, depths, vec_col).select(
            F.col(label).cast("double").alias("y"),
            F.when(F.col(fold) == k, "test").otherwise("train").alias("split"),
            F.explode(
                F.arrays_zip(
                    F.array(*map(F.lit, asked)).alias("depth"), F.array(*map(F.lit, depths)).alias("depth_used"), F.col("predictions").alias("p")
                )
            ).alias("z"),
        )
        e = p.groupBy(F.col("z.depth").alias("depth"), F.col("z.depth_used").alias("depth_used"), F.lit(k).alias("fold"), "split").agg(
            F.avg((F.col("z.p") != F.col("y")).cast("double")).alias("error"), F.count("*").alias("n")
        )
        out = e if out is None else out.unionByName(e)
    return out
