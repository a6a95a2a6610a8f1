"""Filters, encodings and scalar transforms on wide numeric tables."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.ranking import exact_quantiles, with_row_index
from quarry.functions.vectors import let, pack, total
from quarry.session import cut_lineage

MAX_LEVELS = 10_000


def levels(df: DataFrame, col: str, limit: int = MAX_LEVELS) -> list:
    """Sorted distinct values of a categorical column; refuses an unbounded one."""
    rows = df.select(col).filter(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} levels; it is not categorical")
    return sorted(r[0] for r in rows)


def features_label(df: DataFrame, label: str, id_col: str, features: Sequence[str] | None = None) -> DataFrame:
    """All attributes but the target as one vector, next to id and label."""
    cols = list(features) if features else [c for c in df.columns if c not in (label, id_col)]
    return df.select(id_col, pack(cols), F.col(label).alias("label"))


def label_dimension(df: DataFrame, col: str) -> DataFrame:
    """Table (class_id, class_name) in sorted order, of any number of classes."""
    names = df.select(F.col(col).alias("class_name")).filter(F.col(col).isNotNull()).distinct()
    return with_row_index(names, ["class_name"], index="__i").select(F.col("__i").cast("int").alias("class_id"), "class_name")


def label_index(df: DataFrame, col: str, out: str = "class_id") -> DataFrame:
    """The class number next to each row; null for a null class."""
    dim = label_dimension(df, col).select(F.col("class_id").alias(out), F.col("class_name").alias(col))
    return df.join(cut_lineage(dim, "classes"), col, "left")


def one_hot(df: DataFrame, cols: str | Sequence[str], values: dict[str, list] | None = None) -> DataFrame:
    """0/1 columns ``<col>_<value>`` in sorted value order, after the untouched ones."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    keep = [c for c in df.columns if c not in cols]
    out = []
    for c in cols:
        vals = values[c] if values and c in values else levels(df, c)
        out += [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}") for v in vals]
    return df.select(*keep, *out)


def drop_where(df: DataFrame, outlier: Column) -> DataFrame:
    """Complement of an outlier predicate."""
    return df.filter(~outlier)


def keep_classes(df: DataFrame, label: str, classes: Sequence) -> DataFrame:
    return df.filter(F.col(label).isin(list(classes)))


def class_subsets(df: DataFrame, label: str) -> dict:
    """One lazily filtered frame per class, each of which scans the table.

    For figures per class, group by the class instead: one scan for all.
    """
    return {v: df.filter(F.col(label) == F.lit(v)) for v in levels(df, label)}


def nonzero_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    row = df.agg(*[F.max(F.abs(F.col(c))).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]]


def drop_zero_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    keep = set(nonzero_columns(df, cols))
    return df.select(*[c for c in df.columns if c not in cols or c in keep])


def drop_zero_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    any_set = F.lit(False)
    for c in cols:
        any_set = any_set | (F.col(c) != 0)
    return df.filter(any_set)


def drop_zero_rows_and_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    keep = nonzero_columns(df, cols)
    rows = drop_zero_rows(df, cols)
    return rows.select(*[c for c in df.columns if c not in cols or c in keep])


def pick_target(df: DataFrame, target: str, drop: Sequence[str] = ()) -> DataFrame:
    """Make one attribute the target; the rest, minus ``drop``, stay attributes."""
    rest = [c for c in df.columns if c != target and c not in drop]
    return df.select(*rest, F.col(target).alias("label"))


@dataclass(frozen=True)
class Scaler:
    """Column means and divisors measured on one table, applied to any other.

    A column without spread (constant, or one row) is only centred.
    """

    mean: dict[str, float]
    scale: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: (F.col(c) - F.lit(m)) / F.lit(self.scale[c] or 1.0) for c, m in self.mean.items()}
        )


def fit_scaler(df: DataFrame, cols: Sequence[str], with_std: bool = True, ddof: int = 1) -> Scaler:
    sd = F.stddev_samp if ddof == 1 else F.stddev_pop
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[sd(c).alias(f"s_{c}") for c in cols]
    ).first()
    scale = {c: (row[f"s_{c}"] if with_std else 1.0) for c in cols}
    return Scaler({c: row[f"m_{c}"] for c in cols}, scale)


def centre(df: DataFrame, cols: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    return fit_scaler(df if train is None else train, cols, with_std=False).transform(df)


def standardize(df: DataFrame, cols: Sequence[str], ddof: int = 1) -> DataFrame:
    return fit_scaler(df, cols, True, ddof).transform(df)


def centre_vectors(df: DataFrame, vec_col: str = "features", train: DataFrame | None = None) -> DataFrame:
    """Vector twin of :func:`centre`; the mean comes from one Summarizer pass."""
    mean = vector_mean(df if train is None else train, vec_col)
    means = F.array(*[F.lit(float(m)) for m in mean])
    return df.withColumn(vec_col, F.zip_with(vec_col, means, lambda x, m: x - m))


def vector_mean(df: DataFrame, vec_col: str) -> list[float]:
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    return df.agg(Summarizer.mean(array_to_vector(F.col(vec_col).cast("array<double>")))).first()[0].toArray().tolist()


def column_medians(df: DataFrame, vec_col: str) -> list[float]:
    long = df.select(F.posexplode(vec_col).alias("pos", "value"))
    rows = exact_quantiles(long, "value", [0.5], ["pos"]).collect()
    return [r["q"][0] for r in sorted(rows, key=lambda r: r["pos"])]


def binarize(df: DataFrame, vec_col: str = "features", single_row: bool = False) -> DataFrame:
    """1.0 where a value exceeds its column's median, else 0.0.

    A table of one object compares with the median over that object's elements.
    """
    if single_row:
        s = F.sort_array(vec_col)
        n = F.size(vec_col)
        med = (F.get(s, ((n - 1) / 2).cast("int")) + F.get(s, (n / 2).cast("int"))) / 2
        ones = let(med, lambda m: F.transform(vec_col, lambda x: (x > m).cast("double")))
        return df.withColumn(vec_col, ones)
    meds = F.array(*[F.lit(m) for m in column_medians(df, vec_col)])
    return df.withColumn(vec_col, F.zip_with(vec_col, meds, lambda x, m: (x > m).cast("double")))


def powers(df: DataFrame, col: str, degree: int) -> DataFrame:
    return df.withColumns({f"{col}_p{k}": F.pow(F.col(col), F.lit(k)) for k in range(1, degree + 1)})


def squares_and_product(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.withColumns(
        {f"{a}_sq": F.col(a) * F.col(a), f"{b}_sq": F.col(b) * F.col(b), f"{a}_{b}": F.col(a) * F.col(b)}
    )


def add_offset(df: DataFrame, name: str = "offset") -> DataFrame:
    return df.select(F.lit(1.0).alias(name), "*")


def first_rows(df: DataFrame, n: int, id_col: str) -> DataFrame:
    return df.orderBy(id_col).limit(n)


def letter_features(df: DataFrame, name: str, min_length: int = 4) -> DataFrame:
    """Alphabet positions (a = 1) of the first, second, next-to-last and last letter."""
    w = F.lower(F.trim(name))
    n = F.length(w)
    pos = {"first": F.lit(1), "second": F.lit(2), "next_to_last": n - 1, "last": n}
    kept = df.filter(n >= min_length)
    return kept.withColumns({k: F.ascii(F.substr(w, p, F.lit(1))) - 96 for k, p in pos.items()})


def gaussian_pdf(x: Column, mean: float, sd: float) -> Column:
    z = (x - F.lit(mean)) / F.lit(sd)
    return F.exp(z * z * F.lit(-0.5)) / F.lit(sd * math.sqrt(2 * math.pi))


def threshold(score: Column, at: float = 0.5) -> Column:
    return (score > F.lit(at)).cast("int")


def row_is_zero(vec_col: str) -> Column:
    return total(F.transform(vec_col, lambda x: F.abs(x))) == 0
