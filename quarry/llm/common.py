"""Text expressions and written tables that the operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage

BLANKS = " \t\n\x0b\f\r"  # the characters of [\x20\x09-\x0D]
BLANK_RUN = r"[\x20\x09-\x0D]+"


def text_of(name: str) -> Column:
    """The text of a column; a null is an empty text."""
    return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, whatever the case."""
    taken, name = {c.lower() for c in df.columns}, f"__{stem}"
    while name in taken:
        name = f"_{name}"
    return name


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, every other letter as it is.

    Text of ASCII alone takes the fast built-in; ``lower`` on anything else would
    also fold letters beyond A-Z.
    """
    plain = F.length(c) == F.octet_length(c)
    return F.when(plain, F.lower(c)).otherwise(
        F.translate(c, string.ascii_uppercase, string.ascii_lowercase)
    )


def words_of(c: Column) -> Column:
    """The runs of ``[^\\x20\\x09-\\x0D]`` as an array."""
    return F.array_remove(F.split(c, BLANK_RUN), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also inside lambdas of the body."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def written(df: DataFrame, stem: str) -> DataFrame:
    """The rows as a table in the shared folder: read again rather than computed again."""
    return cut_lineage(df, stem)


def put(df: DataFrame, **columns: Column) -> DataFrame:
    """Result columns; they replace input columns of the same name, whatever their case."""
    names = {n.lower() for n in columns}
    keep = [F.col(quoted(c)) for c in df.columns if c.lower() not in names]
    return df.select(*keep, *[c.alias(n) for n, c in columns.items()])
