"""Benchmark decontamination: rare n-gram seeds, then local alignment of the words around them."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import quoted, text_of, written

GRAM = 3
WORD = re.compile(r"\w+")
#: Thai and Lao, Burmese, Khmer, kana, Han: written without blanks
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
SIGN = re.compile(f"[{UNSPACED}]")
SIGN_OR_WORD = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")
PART = 64  # words of an item's overlapping parts, each found by itself
SHORT = 24  # items up to this length have all their runs as seeds
BLOCK_WORDS = 200_000  # words of test items looked for in one pass
CELLS_AT_ONCE = 1 << 20
MATCH, MISS, GAP = 2, -1, -1  # scores of an aligned pair of words and of a word left out


def _pattern(text: str) -> re.Pattern:
    return SIGN_OR_WORD if not text.isascii() and SIGN.search(text) else WORD


def _words(text: str) -> list[str]:
    low, pattern = text.lower(), _pattern(text)
    if len(low) == len(text):
        return pattern.findall(low)
    return [w.lower() for w in pattern.findall(text)]  # a letter that grows in lower case


def _parts(w: np.ndarray) -> list[np.ndarray]:
    """The item, and if it is long its overlapping parts of PART words."""
    if len(w) <= PART:
        return [w]
    step = PART // 2
    return [w, *(w[a : a + PART] for a in range(0, len(w) - PART, step)), w[-PART:]]


class Items:
    """Test items and their parts as numbers: word 0 is any word that no item holds."""

    def __init__(self, texts: list[str]):
        self.index: dict[str, int] = {}
        whole = [np.array([self.index.setdefault(w, len(self.index) + 1) for w in _words(t)], np.int64) for t in texts]
        parts = [_parts(w) for w in whole]
        self.words = [x for p in parts for x in p]
        self.owner = [i for i, p in enumerate(parts) for _ in p]
        self.base = len(self.index) + 1
        places = [(self.codes(w), i) for i, w in enumerate(self.words)]
        self.code = np.concatenate([c for c, _ in places] or [np.empty(0, np.int64)])
        self.item = np.concatenate([np.full(len(c), i) for c, i in places] or [np.empty(0, np.int64)])
        self.at = np.concatenate([np.arange(len(c)) for c, _ in places] or [np.empty(0, np.int64)])

    def codes(self, w: np.ndarray) -> np.ndarray:
        """One number per run of GRAM words; -1 where a word is unknown."""
        if len(w) < GRAM:
            return np.empty(0, np.int64)
        code, known = np.zeros(len(w) - GRAM + 1, np.int64), np.ones(len(w) - GRAM + 1, bool)
        for k in range(GRAM):
            part = w[k : len(w) - GRAM + 1 + k]
            code = code * self.base + part
            known &= part > 0
        return np.where(known, code, -1)

    def read(self, text: str) -> np.ndarray:
        found = _words(text)
        return np.fromiter(map(self.index.get, found, itertools.repeat(0)), np.int64, len(found))

    def rarest(self, seen: dict[int, int], window: int) -> None:
        """Keep as seeds the rarest run in each ``window`` consecutive runs, and all of a short item.

        Rarity is relative to the neighbours, so an item that a third of all documents hold
        has as many seeds as any other.
        """
        keep = np.zeros(len(self.code), bool)
        rank = np.array([seen.get(c, 0) for c in self.code.tolist()], np.int64)
        for i in range(len(self.words)):
            own = np.flatnonzero(self.item == i)
            if len(self.words[i]) <= SHORT:
                keep[own] = True
                continue
            for a in range(max(1, len(own) - window + 1)):
                part = own[a : a + window]
                if len(part):
                    keep[part[np.argmin(rank[part])]] = True
        order = np.argsort(self.code[keep], kind="stable")
        self.code, self.item, self.at = (x[keep][order] for x in (self.code, self.item, self.at))


def align(items: list[np.ndarray], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smith-Waterman over words, many pairs at once: best score, first and end word in the text.

    Gaps cost the same per word, so the best gap along the text is a running maximum. Of equal
    scores the first cell (by item word, then text word) counts.
    """
    n, rows, width = len(items), max(map(len, items)), max(map(len, texts))
    a = np.full((n, rows), -2, np.int64)
    b = np.full((n, width), -1, np.int64)
    for i, (x, y) in enumerate(zip(items, texts)):
        a[i, : len(x)] = np.where(x > 0, x, -2)
        b[i, : len(y)] = np.where(y > 0, y, -1)
    col = np.arange(width + 1)
    score = np.zeros((n, width + 1), np.int32)
    start = np.tile(col, (n, 1))
    best, first, last = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
    every = np.arange(n)
    for r in range(rows):
        cell, begin = np.zeros_like(score), np.tile(col, (n, 1))
        diagonal = score[:, :-1] + np.where(b == a[:, r : r + 1], MATCH, MISS).astype(np.int32)
        up = score[:, 1:] + GAP
        cell[:, 1:] = np.maximum(np.maximum(diagonal, up), 0)
        begin[:, 1:] = np.where(diagonal > 0, start[:, :-1], col[1:])
        begin[:, 1:] = np.where((up > diagonal) & (up > 0), start[:, 1:], begin[:, 1:])
        lifted = cell - GAP * col
        top = np.maximum.accumulate(lifted, axis=1)
        source = np.maximum.accumulate(np.where(lifted == top, col, 0), axis=1)
        score = (top + GAP * col).astype(np.int32)
        start = np.take_along_axis(begin, source, 1)
        at = score.argmax(axis=1)
        better = score[every, at] > best
        best[better], first[better], last[better] = score[every, at][better], start[every, at][better], at[better]
    return best, first, last


def _regions(items: Items, w: np.ndarray) -> list[tuple[int, int, int]]:
    """(item, first word, end word) of the parts of a text that seeds point to."""
    codes = items.codes(w)
    at = np.flatnonzero(codes >= 0)
    if not len(at) or not len(items.code):
        return []
    lo = np.searchsorted(items.code, codes[at], "left")
    hi = np.searchsorted(items.code, codes[at], "right")
    hits = np.repeat(at, hi - lo)
    if not len(hits):
        return []
    seed = np.concatenate([np.arange(x, y) for x, y in zip(lo[hi > lo].tolist(), hi[hi > lo].tolist())])
    item, begin = items.item[seed], hits - items.at[seed]  # where the item would begin
    order = np.lexsort((begin, item))
    out: list[tuple[int, int, int]] = []
    for i, s in zip(item[order].tolist(), begin[order].tolist()):
        size = len(items.words[i])
        slack = size // 2 + GRAM
        lo_, hi_ = max(0, s - slack), min(len(w), s + size + slack)
        if out and out[-1][0] == i and lo_ <= out[-1][2]:
            out[-1] = (i, out[-1][1], max(hi_, out[-1][2]))
        else:
            out.append((i, lo_, hi_))
    return out


def _block_matches(docs: DataFrame, ids: list, texts: list[str], id_type, threshold: float, window: int) -> DataFrame:
    items = Items(texts)
    known = np.unique(items.code)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(known), np.int64)
        for b in batches:
            for t in b.column("text"):
                codes = items.codes(items.read(t.as_py()))
                codes = np.unique(codes[codes >= 0])
                place = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
                if len(known):
                    n[place[known[place] == codes]] += 1
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(known[some]), pa.array(n[some])], ["code", "n"])

    per = docs.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    items.rarest({r["code"]: r["n"] for r in per.toLocalIterator()}, window)  # at most a row per run of the block

    schema = T.StructType(
        [
            docs.schema["id"],
            T.StructField("item", T.IntegerType()),
            T.StructField("similarity", T.DoubleType()),
            T.StructField("begin", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def scored(wait):
            # pairs of like size together, so that padding stays small
            wait.sort(key=lambda x: x[3] - x[2])
            size = len(wait[-1][4]) * max(len(items.words[x[1]]) for x in wait) if wait else 1
            step = max(1, CELLS_AT_ONCE // max(1, size))
            for k in range(0, len(wait), step):
                part = wait[k : k + step]
                best, first, last = align([items.words[x[1]] for x in part], [x[4] for x in part])
                for x, s, f, e in zip(part, best.tolist(), first.tolist(), last.tolist()):
                    share = s / (MATCH * len(items.words[x[1]]))
                    if share >= threshold:
                        yield x[0], items.owner[x[1]], share, x[2] + f, x[2] + e

        for b in batches:
            texts, wait, found = b.column("text"), [], []
            for row in range(b.num_rows):
                w = items.read(texts[row].as_py())
                for i, lo, hi in _regions(items, w):
                    wait.append((row, i, lo, hi, w[lo:hi].copy()))
                if len(wait) > 20_000:
                    found += scored(wait)
                    wait = []
            found += scored(wait)
            top: dict[tuple[int, int], tuple] = {}
            for row, i, share, f, e in found:
                if (row, i) not in top or (-share, f) < (-top[row, i][0], top[row, i][1]):
                    top[row, i] = (share, f, e)
            spans = {}
            for row in {k[0] for k in top}:
                spans[row] = [m.span() for m in _pattern(texts[row].as_py()).finditer(texts[row].as_py())]
            keys = sorted(top)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("id").take(pa.array([k[0] for k in keys], pa.int64())),
                    pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([top[k][0] for k in keys], pa.float64()),
                    pa.array([spans[k[0]][top[k][1]][0] for k in keys], pa.int64()),
                    pa.array([spans[k[0]][top[k][2] - 1][1] for k in keys], pa.int64()),
                ],
                ["id", "item", "similarity", "begin", "end"],
            )

    names = docs.sparkSession.createDataFrame([(i, v) for i, v in enumerate(ids)], T.StructType([T.StructField("n", T.IntegerType()), T.StructField("item_id", id_type)]))
    found = docs.mapInArrow(match, schema)
    return found.join(F.broadcast(names), F.col("item") == F.col("n")).select("id", "item_id", "similarity", "begin", "end")


def matches(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = 0.5,
    window: int = 3,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Passages of documents that align with test items: ``id``, ``item_id``, ``similarity``,
    ``begin`` and ``end`` (code points of the passage, end exclusive); the best per pair.

    Words are runs of letters, digits and ``_`` in lower case; where no blanks are written (Han,
    kana, Thai and their like) each sign is a word. Of each ``window`` consecutive three-word runs
    of an item, the one that the fewest documents hold is a seed, so any ``window + 2`` words in a
    row left unedited hold one; of items up to 24 words all runs are. Around each seed found in
    a text the words are aligned with the item (match 2, other word -1, word left out -1);
    similarity is the score over that of the item with itself, matches reach ``threshold``. An
    item of more than 64 words is also looked for in overlapping parts of 64, each scored by
    itself, so that 48 of its words in a row match however long it is; the best score counts.

    Items of fewer than three words have no seed and match nothing. Null and empty texts match
    nothing. Repeated items with different ids match each by itself; items repeated in full
    count once. Repeated documents give repeated rows. Empty tables give an empty table.

    Plan: two passes over the texts, one to count the runs of the items in all documents, one
    to align; neither shuffles a text. Items come to the driver and the tasks in blocks of at
    most ``block_words`` words, with two passes for each block.
    """
    docs = df.select(F.col(quoted(id_col)).alias("id"), text_of(text_col).alias("text"))
    tests = items.select(F.col(quoted(item_id_col)).alias("item_id"), text_of(item_text_col).alias("text")).distinct()
    kind = tests.schema["item_id"].dataType
    out = None
    ids, texts, n = [], [], 0

    def with_block(out):
        part = written(_block_matches(docs, ids, texts, kind, threshold, window), "matches")
        return part if out is None else out.unionByName(part)

    for r in tests.orderBy("item_id", "text").toLocalIterator():
        size = len(_words(r["text"]))
        if ids and n + size > block_words:
            out = with_block(out)
            ids, texts, n = [], [], 0
        ids.append(r["item_id"])
        texts.append(r["text"])
        n += size
    if ids or out is None:
        out = with_block(out)
    return out


def drop_contaminated(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` without those whose id has a match (see :func:`matches`).

    A null id is one id: its rows go together.
    """
    bad = matches(df, items, id_col, text_col, **options).select(F.col("id").alias("__id")).distinct()
    bad = written(bad, "contaminated")
    return df.join(bad, F.col(quoted(id_col)).eqNullSafe(F.col("__id")), "left_anti")
