"""Resampling towards a target distribution by importance weights of hashed word runs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.ranking import with_row_index
from quarry.llm.bytewords import LOWERED, Crc, runs, texts, word_spans
from quarry.llm.common import quoted, text_of, written


def _buckets(column: pa.Array, crc: Crc, sizes: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of a text column: first row, words per text, features per text and their buckets, text by text.

    The buckets of one part come size by size, so every size is yielded by itself.
    """
    for row, body, offsets in texts(column):
        body = LOWERED[body]
        starts, lengths, counts = word_spans(body, offsets)
        for size in range(1, sizes + 1):
            joined, at, span, own = runs(body, starts, lengths, counts, size)
            yield row, counts, own, (crc(joined, at, span) % np.uint32(buckets)).astype(np.int64)


def bucket_counts(df: DataFrame, text_col: str = "text", sizes: int = 1, buckets: int = 10_000) -> DataFrame:
    """``bucket`` and ``n``: the features of all texts in each bucket that has any.

    A task adds up its rows and gives one row per bucket; texts are not shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, held = Crc(), np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, _, found in _buckets(b.column("t"), crc, sizes, buckets):
                held += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["bucket", "n"])

    parts = df.select(text_of(text_col).alias("t")).mapInArrow(count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(df: DataFrame, target: DataFrame, text_col: str, target_text_col: str, sizes: int, buckets: int) -> np.ndarray:
    """Per bucket the thousandfold log ratio of its share in the target to that in ``df``, floored.

    Counts of one are added everywhere. The driver gets a number per bucket and table.
    """
    held = np.zeros((2, buckets), np.int64)
    for k, (rows, col) in enumerate([(df, text_col), (target, target_text_col)]):
        for r in bucket_counts(rows, col, sizes, buckets).collect():  # at most ``buckets`` rows
            held[k, r["bucket"]] = r["n"]
    s, t = held.astype(float)
    ratio = ((t + 1) * (held[0].sum() + buckets)) / ((s + 1) * (held[1].sum() + buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def weigh(df: DataFrame, gain: np.ndarray, id_col: str, text_col: str, sizes: int) -> DataFrame:
    """``id``, ``n_words``, ``n_features`` and ``weight`` (floored mean gain of a text's features)."""
    rows = df.select(F.col(quoted(id_col)).alias("id"), text_of(text_col).alias("t"))
    names = ["n_words", "n_features", "weight"]
    schema = T.StructType([rows.schema["id"], *[T.StructField(n, T.LongType()) for n in names]])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, buckets = Crc(), len(gain)
        for b in batches:
            words, n, total = np.zeros((3, b.num_rows), np.int64)
            for row, counts, own, found in _buckets(b.column("t"), crc, sizes, buckets):
                here = slice(row, row + len(own))
                words[here] = counts
                n[here] += own
                until = np.r_[0, np.cumsum(gain[found])]
                ends = np.cumsum(own)
                total[here] += until[ends] - until[ends - own]
            mean = np.floor_divide(total, np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays([b.column("id"), *map(pa.array, (words, n, mean))], schema.names)

    return rows.mapInArrow(score, schema)


def draw_number(id_col: Column, seed: int) -> Column:
    """The first 32 bits of the SHA-256 of ``<seed>:<id>``; a null id is an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")


def resample(
    df: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    sizes: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
) -> DataFrame:
    """``id``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row; drawn rows have a rank.

    Features are the runs of 1 to ``sizes`` words (letters, digits and all characters beyond
    ASCII; A-Z in lower case), each in the bucket CRC-32 modulo ``buckets``. The weight is the
    floored mean of the buckets' gains (see :func:`gains`), the score adds a Gumbel number of
    the id and the seed. Of the rows with at least ``least_words`` words, ``percent`` per cent
    (rounded down) with the highest scores are drawn, ties by smaller id, null ids last: a
    sample without replacement with odds in proportion to exp(weight / 1000).

    Null and empty texts have no features and weight 0. Repeated rows are rows of their own
    with equal scores; their ranks differ. An empty target weighs by rarity alone, an empty
    table gives an empty table. Other columns of the inputs are not read.

    Plan: two passes over the texts, neither shuffles them. Tasks hold the bucket table
    (``buckets`` numbers); the ranks come from rows of two numbers dealt into ranges.
    """
    gain = gains(df, target, text_col, target_text_col, sizes, buckets)
    open_ = -F.log((draw_number(F.col("id"), seed) + F.lit(0.5)) / F.lit(4294967296.0))
    gumbel = F.floor(F.lit(-1000.0) * F.log(open_)).cast("long")
    scored = weigh(df, gain, id_col, text_col, sizes).withColumn("score", F.col("weight") + gumbel)
    scored = written(scored, "scored")
    fit = scored.filter(F.col("n_words") >= least_words)
    drawn = fit.count() * percent // 100
    order = fit.select("id", "n_words", "n_features", "weight", "score", (-F.col("score")).alias("down"), F.col("id").isNull().alias("last"))
    ranked = with_row_index(order, ["down", "last", "id", "n_features", "weight"], index="place")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).cast("long")
    cols = ["id", "n_features", "weight", "score"]
    rest = scored.filter(F.col("n_words") < least_words).select(*cols, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*cols, rank.alias("rank")).unionByName(rest)
