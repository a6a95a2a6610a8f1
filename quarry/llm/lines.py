"""Line dedup: lines that several documents hold stay only in the first of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import BLANKS, ascii_lower, let, quoted, text_of, written


def line_key(line: Column) -> Column:
    """The line without blanks at both ends and with A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _occurrences(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    text = text_of(text_col)
    rows = df.select(
        F.col(quoted(id_col)).alias("id"),
        F.xxhash64(text).alias("tk"),
        F.posexplode(F.split(text, "\n")).alias("pos", "line"),
    )
    keyed = rows.select("id", "tk", "pos", line_key(F.col("line")).alias("key"))
    # 96 bits of hash: at 10^12 lines, the odds of any wrong match are below 10^-5
    return keyed.filter(F.length("key") >= min_chars).select(
        "id", "tk", "pos", F.xxhash64("key").alias("h1"), F.hash("key").alias("h2")
    )


def _shared(occ: DataFrame, min_docs: int) -> DataFrame:
    """Keys held by at least ``min_docs`` documents, with the smallest id holding each."""
    if min_docs == 2:  # the smallest and largest holder tell, so sums are made before the shuffle
        per = occ.groupBy("h1", "h2").agg(
            F.min("id").alias("first_id"),
            F.max("id").alias("last_id"),
            F.max(F.col("id").isNull()).alias("with_null"),
        )
        several = (F.col("first_id") < F.col("last_id")) | (
            F.col("first_id").isNotNull() & F.col("with_null")
        )
        return per.filter(several).select("h1", "h2", "first_id")
    per = occ.select("h1", "h2", "id").distinct().groupBy("h1", "h2")
    return (
        per.agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
        .filter(F.col("n") >= min_docs)
        .select("h1", "h2", "first_id")
    )


def _without(text: Column, dropped: Column) -> Column:
    """The text without the lines at the sorted positions ``dropped``, in linear time."""

    def pieces(s):
        n, d = F.size(s["lines"]), s["dropped"]
        m = F.size(d)

        def piece(k):
            start = F.when(k == 0, 0).otherwise(F.get(d, k - 1) + 1)
            stop = F.when(k == m, n).otherwise(F.get(d, k))
            return F.slice(s["lines"], start + 1, stop - start)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), m), piece)), "\n")

    return let(F.struct(F.split(text, "\n").alias("lines"), dropped.alias("dropped")), pieces)


def _cleaned(df: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """Per input row: ``row`` (its columns), the cleaned ``text``, ``n_lines`` and ``n_dropped``."""
    occ = _occurrences(df, id_col, text_col, min_chars)
    shared = written(_shared(occ, min_docs), "shared-lines")
    dropped = (
        occ.join(shared, ["h1", "h2"])
        .filter(~F.col("id").eqNullSafe(F.col("first_id")))
        .groupBy(F.col("id").alias("gone_id"), F.col("tk").alias("gone_tk"))
        .agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    )
    text = text_of(text_col)
    base = df.select(
        F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"),
        F.col(quoted(id_col)).alias("id"),
        text.alias("text"),
        F.xxhash64(text).alias("tk"),
    )
    cond = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("tk") == F.col("gone_tk"))
    joined, untouched = base.join(dropped, cond, "left"), F.col("dropped").isNull()
    return joined.select(
        "row",
        F.when(untouched, F.col("text")).otherwise(_without(F.col("text"), F.col("dropped"))).alias("text"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        F.when(untouched, 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
    )


def _replaced(cleaned: DataFrame, columns: list[str], new: dict[str, Column]) -> DataFrame:
    low = {n.lower(): c for n, c in new.items()}
    out = [low.pop(c.lower(), F.col("row")[c]).alias(c) for c in columns]
    return cleaned.select(*out, *[new[n].alias(n) for n in new if n.lower() in low])


def dedup_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    min_docs: int = 2,
) -> DataFrame:
    """The rows of ``df`` with repeated lines taken out of the text.

    A text is split at ``\\n``. Lines whose key (see :func:`line_key`) has at least
    ``min_chars`` code points and is found in at least ``min_docs`` documents go, except
    in the document with the smallest id holding the key, which keeps all of its lines.
    Adds ``n_lines`` (before) and ``n_dropped``; these replace input columns of the same
    name, all others pass through.

    A null text is one empty line and comes back as the empty text. All rows with a null
    id count as one document that sorts after all others. Repeated rows and rows that share
    an id count as one document; each row is returned with its own text cleaned. An empty
    table gives an empty table.

    Plan: lines travel as hashes; the count per key is summed before its shuffle, so a line
    in a third of all documents costs one row per task. Shared keys are written once and
    joined back (Spark copies them only if their files are small, else both sides are
    shuffled and a hot key is split by the adaptive skew join). The text is shuffled once.
    """
    new = {text_col: F.col("text"), "n_lines": F.col("n_lines"), "n_dropped": F.col("n_dropped")}
    return _replaced(_cleaned(df, id_col, text_col, min_chars, min_docs), df.columns, new)


def clean_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = None,
    min_chars: int = 10,
    min_docs: int = 2,
) -> DataFrame:
    """As :func:`dedup_lines` with the columns of ``df`` alone; ``length_col`` gets the new length."""
    new = {text_col: F.col("text")}
    if length_col:
        new[length_col] = F.length("text").cast(df.schema[length_col].dataType)
    return _replaced(_cleaned(df, id_col, text_col, min_chars, min_docs), df.columns, new)
