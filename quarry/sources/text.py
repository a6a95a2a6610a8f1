"""Line-oriented documents, baskets and recorded itemset files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, id_name: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per non-empty line, with an id that grows along the file."""
    lines = spark.read.text(path).filter(F.length("value") > 0)
    return lines.select(F.monotonically_increasing_id().alias(id_name), F.col("value").alias(text))


def read_baskets(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(basket_id, items) from lines of separated item ids; duplicates within a line count once."""
    return parse_baskets(read_lines(spark, path, "basket_id", "line"), "line", sep)


def parse_baskets(df: DataFrame, line: str, sep: str = ",") -> DataFrame:
    items = F.array_distinct(F.transform(F.split(F.col(line), f"\\Q{sep}\\E"), lambda s: F.trim(s)))
    items = F.filter(items, lambda s: s != "")
    return df.select("basket_id", items.alias("items"))


def basket_items(cols: Sequence[str], titles: Sequence[str] | None = None) -> Column:
    """Array of the positions (or titles) of all columns equal to 1; empty when none is."""
    names = list(titles) if titles else [str(i) for i in range(len(cols))]
    return F.array_compact(F.array(*[F.when(F.col(c) == 1, F.lit(n)) for c, n in zip(cols, names)]))


def basket_lines(df: DataFrame, cols: Sequence[str], titles: Sequence[str] | None = None, sep: str = ",") -> DataFrame:
    """0/1 rows as separated text; a row without a 1 gives an empty line of its own."""
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, F.concat_ws(sep, basket_items(cols, titles)).alias("line"))


def write_baskets(
    df: DataFrame, path: str, cols: Sequence[str], titles: Sequence[str] | None = None, rows_per_file: int = 100_000
) -> None:
    """Text files of at most ``rows_per_file`` baskets each."""
    lines = basket_lines(df, cols, titles).select("line")
    lines.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).text(path)


# fixed formats of the recorded files: "a b[Sup. 42]" and "h <- b[Conf. 42,Sup. 42]"
def parse_itemsets(lines: DataFrame, col: str = "text") -> DataFrame:
    v = F.col(col)
    items = F.split(F.trim(F.regexp_extract(v, r"^([^\[]*)\[", 1)), r"\s+")
    return lines.filter(F.rlike(v, F.lit(r"\[Sup\. "))).select(
        items.alias("items"), F.regexp_extract(v, r"Sup\. ([0-9.]+)", 1).cast("double").alias("support_pct")
    )


def parse_rules(lines: DataFrame, col: str = "text") -> DataFrame:
    v = F.col(col)

    def words(group):
        parts = F.split(F.trim(F.regexp_extract(v, r"^(.*?)<-(.*?)\[", group)), r"\s+")
        return F.filter(parts, lambda s: s != "")

    return lines.filter(F.contains(v, F.lit("<-"))).select(
        words(1).alias("consequent"),
        words(2).alias("antecedent"),
        F.regexp_extract(v, r"Conf\. ([0-9.]+)", 1).cast("double").alias("conf_pct"),
        F.regexp_extract(v, r"Sup\. ([0-9.]+)", 1).cast("double").alias("sup_pct"),
    )
