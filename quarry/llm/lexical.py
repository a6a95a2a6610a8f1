"""Ranked lexical search: all documents for each item, in whole numbers, over classes of equal bags."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.bytewords import LOWERED, Terms, texts, word_spans
from quarry.llm.common import quoted, text_of, written

BLOCK_WORDS = 1 << 18  # words of the items that are ranked in one pass over the documents
SHEET_ITEMS = 256  # items that are scored by one product of matrices
SHEET_CELLS = 1 << 22


def _terms_of(column: pa.Array) -> list[list[bytes]]:
    out: list[list[bytes]] = []
    for _, body, offsets in texts(column):
        body = LOWERED[body]
        starts, lengths, counts = word_spans(body, offsets)
        words = [body[a : a + n].tobytes() for a, n in zip(starts.tolist(), lengths.tolist())]
        ends = np.cumsum(counts)
        out += [words[e - n : e] for e, n in zip(ends.tolist(), counts.tolist())]
    return out


def bags(df: DataFrame, terms: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """Per row ``id``, ``n`` (its words) and ``bag``: number and count, four bytes each, of every listed term it holds."""
    rows = df.select(F.col(quoted(id_col)).alias("id"), text_of(text_col).alias("t"))
    schema = T.StructType([rows.schema["id"], T.StructField("n", T.LongType()), T.StructField("bag", T.BinaryType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms(terms)
        for b in batches:
            n = np.zeros(b.num_rows, np.int64)
            held: list[bytes] = []
            for row, body, offsets in texts(b.column("t")):
                body = LOWERED[body]
                starts, lengths, counts = word_spans(body, offsets)
                n[row : row + len(counts)] = counts
                place = known.places(body, starts, lengths)
                key = np.repeat(np.arange(len(counts)), counts) * len(terms) + place
                key, times = np.unique(key[place >= 0], return_counts=True)
                pair = np.stack([key % max(len(terms), 1), times], 1).astype("<i4")
                ends = np.searchsorted(key, (np.arange(len(counts)) + 1) * len(terms))
                held += [pair[a:e].tobytes() for a, e in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n), pa.array(held, pa.binary())], schema.names)

    return rows.mapInArrow(count, schema)


def _holders(bag_rows: DataFrame, terms: int) -> np.ndarray:
    """Per term the documents that hold it; a task adds up its rows, the driver gets a number per term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms, np.int64)
        for b in batches:
            held += np.bincount(_pairs(b.column("bag"))[0][:, 0], minlength=terms)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["term", "n"])

    out = np.zeros(terms, np.int64)
    for r in bag_rows.select("bag").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The (term, count) pairs of a batch of bags and the number of pairs of each."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body.view("<i4").reshape(-1, 2), np.diff(at) // 8


class Sheet:
    """Weights of the terms of a few items, as a matrix of their own terms by items."""

    def __init__(self, first: int, item: np.ndarray, term: np.ndarray, weight: np.ndarray, items: int, terms: int):
        self.first, self.items = first, items
        own, col = np.unique(term, return_inverse=True)
        self.place = np.full(terms, -1, np.int64)
        self.place[own] = np.arange(len(own))
        self.weights = np.zeros((len(own), items))
        np.add.at(self.weights, (col, item - first), weight)

    def scores(self, pairs: np.ndarray, sizes: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """Scores of a few bags, bags by items. Whole numbers below 2^53 are exact in doubles."""
        cells = np.zeros((len(sizes), len(self.weights)))
        at = self.place[pairs[:, 0]]
        row = np.repeat(np.arange(len(sizes)), sizes)
        cells[row[at >= 0], at[at >= 0]] = impact[at >= 0]
        return cells @ self.weights


def _best(score: np.ndarray, item: np.ndarray, first_id: pa.Array, top: int) -> np.ndarray:
    """Rows of the ``top`` highest scores of each item, ties by the smaller id, nulls last."""
    rank = pc.rank(first_id, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy()
    order = np.lexsort([rank, -score, item])
    group = item[order]
    head = np.r_[True, group[1:] != group[:-1]]
    nth = np.arange(len(order)) - np.repeat(np.flatnonzero(head), np.diff(np.r_[np.flatnonzero(head), len(order)]))
    return np.sort(order[nth < top])


def _scored(classes: DataFrame, entries: tuple[np.ndarray, np.ndarray, np.ndarray], items: int, terms: int, top: int, k1: int) -> DataFrame:
    """``item``, ``score`` and ``ids``: per task the best ``top`` classes of each item."""
    item, term, weight = entries
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("score", T.LongType()), classes.schema["ids"]])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sheets = []
        for first in range(0, items, SHEET_ITEMS):
            mine = (item >= first) & (item < first + SHEET_ITEMS)
            sheets.append(Sheet(first, item[mine], term[mine], weight[mine], min(SHEET_ITEMS, items - first), terms))
        held = None
        floor = np.ones(items)  # the score that a class must reach to be among the best
        for b in batches:
            pairs, sizes = _pairs(b.column("bag"))
            m = b.column("m").to_numpy()
            tf = pairs[:, 1].astype(np.int64)
            impact = (1_000_000_000 * tf) // (1000 * tf + k1 * np.repeat(m, sizes))
            ends = np.cumsum(sizes)
            found_item, found_score, found_row = [], [], []
            for sheet in sheets:
                step = max(1, SHEET_CELLS // max(len(sheet.weights), sheet.items, 1))
                for lo in range(0, len(sizes), step):
                    hi = min(len(sizes), lo + step)
                    here = slice(int(ends[lo] - sizes[lo]), int(ends[hi - 1]))
                    cells = sheet.scores(pairs[here], sizes[lo:hi], impact[here])
                    limit = floor[sheet.first : sheet.first + sheet.items]
                    if hi - lo > top:
                        limit = np.maximum(limit, np.partition(cells, hi - lo - top, axis=0)[hi - lo - top])
                    r, c = np.nonzero(cells >= limit)
                    found_row.append(r + lo)
                    found_item.append(c + sheet.first)
                    found_score.append(cells[r, c].astype(np.int64))
            if not found_row:
                continue
            row = np.concatenate(found_row)
            ids = b.column("ids").take(pa.array(row))
            new = [np.concatenate(found_item), np.concatenate(found_score), ids]
            if held is not None:
                new = [np.concatenate([held[0], new[0]]), np.concatenate([held[1], new[1]]), pa.concat_arrays([held[2], new[2]])]
            keep = _best(new[1], new[0], pc.list_element(new[2], 0), top) if len(new[0]) else np.zeros(0, np.int64)
            held = [new[0][keep], new[1][keep], new[2].take(pa.array(keep))]
            full = np.bincount(held[0], minlength=items) >= top
            least = np.full(items, np.inf)
            np.minimum.at(least, held[0], held[1])
            floor = np.where(full, least, 1.0)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1]), held[2]], schema.names)

    return classes.select("m", "bag", "ids").mapInArrow(score, schema)


def _ranked(df: DataFrame, item_texts: list, id_col: str, text_col: str, top: int, k1: int, b: int) -> DataFrame:
    """``item`` (place in the list), ``rank``, ``id`` and ``score`` for one block of items."""
    own = _terms_of(pa.array(item_texts, pa.large_string()))
    terms = sorted({t for words in own for t in words})
    number = {t: i for i, t in enumerate(terms)}
    rows = written(bags(df, terms, id_col, text_col), "bags")
    total = rows.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    weigh = [math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * d + 1))) for d in _holders(rows, len(terms)).tolist()]
    item = np.array([i for i, words in enumerate(own) for _ in words], np.int64)
    term = np.array([number[t] for words in own for t in words], np.int64)
    weight = np.array(weigh + [0], np.int64)[term]
    mean = F.expr(f"({b} * n * {total['docs']}L) div {max(total['words'], 1)}L")
    sized = rows.filter(F.octet_length("bag") > 0).select("id", "bag", (F.lit(100 - b) + mean).alias("m"))
    # rows of one class meet under its hash and are told apart by the bag itself
    key = [F.xxhash64("bag", "m").alias("h"), "m", "bag"]
    ordered = W.partitionBy("h", "m", "bag").orderBy(F.col("id").asc_nulls_last())
    first = sized.select(*key, "id").withColumn("nth", F.row_number().over(ordered)).filter(F.col("nth") <= top)
    classes = first.groupBy("h", "m", "bag").agg(F.sort_array(F.collect_list(F.struct("nth", "id"))).alias("ids"))
    classes = written(classes.select("m", "bag", F.col("ids.id").alias("ids")), "classes")
    best = _scored(classes, (item, term, weight), len(item_texts), len(terms), top, k1)
    members = best.select("item", "score", F.explode("ids").alias("id"))
    place = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last()))
    return members.withColumn("rank", place).filter(F.col("rank") <= top).select("item", "rank", "id", "score")


def search(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    top: int = 10,
    k1: int = 8,
    b: int = 75,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``item_id``, ``rank``, ``id`` and ``score``: the ``top`` documents of each item with a score above 0.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z in lower case. A term
    weighs floor(1000 ln((2 N + 2) / (2 df + 1))); its share in a document is
    10^9 tf div (1000 tf + ``k1`` m) with m = 100 - ``b`` + ``b`` n N div L (N documents with a
    term, L their terms, n the document's). A score sums weight times share over the item's
    terms with repeats. Equal scores rank by the smaller id, null ids last.

    Null and empty texts have no terms: such documents do not count and such items find
    nothing. Repeated documents are documents of their own; so are repeated items, each with
    its ranks. Empty tables give an empty table. Other columns are not read.

    Method: a document is cut down to the items' terms; documents with equal counts of these
    and equal m are one class, found by hash and told apart by the counts themselves. Classes
    are scored once and expanded by ascending id, of which the first ``top`` matter.

    Plan: items come in blocks of at most ``block_words`` words (or one item), each with one
    pass over the texts, which are not shuffled. Bags are shuffled once, at most ``top`` rows
    of a class from each task. Tasks multiply bags with the weights of 256 items at a time and
    keep the best ``top`` classes per item.
    """
    tests = items.select(F.col(quoted(item_id_col)).alias("item_id"), text_of(item_text_col).alias("text"))
    spark, out = df.sparkSession, None
    kind = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", tests.schema["item_id"].dataType)])
    block: list = []
    words = 0

    def with_block(out):
        ranked = written(_ranked(df, [r["text"] for r in block], id_col, text_col, top, k1, b), "ranked")
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], kind)
        part = ranked.join(names, "item").select("item_id", "rank", "id", "score")
        return part if out is None else out.unionByName(part)

    for r in tests.toLocalIterator():
        n = len(r["text"]) // 2 + 1  # no text has more words than this
        if block and words + n > block_words:
            out, block, words = with_block(out), [], 0
        block.append(r)
        words += n
    return with_block(out) if block or out is None else out
