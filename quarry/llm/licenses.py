"""License scans: word windows of whole texts against templates by Dice coefficient over word bigrams."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower, let, quoted, text_of

#: The notices by which public licences ask to be named.
TEMPLATES = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal"),
    ("EPL-2.0", "This program is made available under the terms of the Eclipse Public License 2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

SPLIT = "[^a-z0-9]+"


def bigrams_of(text: str) -> list[str]:
    """Distinct word bigrams of a template in its normalised form."""
    words = [w for w in re.split(SPLIT, re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def sizes(m: int, threshold: float) -> tuple[int, int]:
    """The least and the greatest number of bigrams that may reach ``threshold`` against ``m``."""
    return math.ceil(m * threshold / (2 - threshold) - 1e-9), math.floor(m * (2 - threshold) / threshold + 1e-9)


def _hash(bigram: str) -> int:
    """What ``xxhash64(first word, second word)`` gives in Spark: the first hash seeds the second."""
    h = 42
    for word in bigram.split(" "):
        h = xxhash.xxh64_intdigest(word.encode(), h)
    return h - (1 << 64) if h >> 63 else h


def _words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), SPLIT), "")


def _bigrams(text: Column) -> Column:
    """Hashes of all word bigrams in order: A-Z lower-cased, words are runs of a-z and 0-9."""

    def pairs(w):
        hashed = F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i)))
        return F.when(F.size(w) > 1, hashed)

    return let(_words(text), pairs)


def _line_of_word(text: Column) -> Column:
    """For each word of a text the number of its line."""
    return F.flatten(F.transform(F.split(text, "\n"), lambda t, i: F.array_repeat(i, F.size(_words(t)))))


def _candidates(text: Column, grams: list[tuple[str, list[int]]], threshold: float) -> Column:
    """The templates of which a text holds enough bigrams, with the text's bigrams and the places of the template's."""
    known = sorted({h for _, g in grams for h in g})

    def of_template(g, places, license, own):
        low, high = sizes(len(own), threshold)
        mine = F.filter(places, lambda i: F.get(g, i).isin(own))
        entry = lambda at: F.when(
            F.size(at) >= low,
            F.struct(
                g.alias("g"), at.alias("at"), F.lit(license).alias("license"), F.lit(len(own)).alias("m"),
                F.lit(low).alias("low"), F.lit(high).alias("high"), F.array(*map(F.lit, own)).alias("own"),
            ),
        )
        return let(mine, entry)

    def of_text(g):
        places = F.filter(F.sequence(F.lit(0), F.size(g) - 1), lambda i: F.get(g, i).isin(known))
        every = lambda at: F.when(
            F.size(at) > 0, F.array_compact(F.array(*[of_template(g, at, n, own) for n, own in grams]))
        )
        return F.when(F.size(g) > 0, let(places, every))

    return let(_bigrams(text), of_text)


def _best_windows(lines: Column) -> Column:
    """For each place of a template's bigram the best window that begins there."""
    g, at, m, low, high = (F.col(c) for c in ("g", "at", "m", "low", "high"))

    def to_end(first):
        def window(last):
            part = F.slice(g, first + 1, last - first + 1)
            common = F.size(F.array_intersect(part, F.col("own")))
            dice = F.lit(2.0) * common / (F.size(F.array_distinct(part)) + m)
            return F.struct((-dice).alias("d"), (last - first + 2).alias("n_words"))

        return window

    def beginning(first, i):
        fitting = lambda q: (q - first + 1 >= low) & (q - first + 1 <= high)
        ends = F.filter(F.slice(at, i + 1, high), fitting)
        # a window that may reach the threshold holds ``low`` of the template's bigrams
        dense = F.get(at, i + low - 1) - first < high
        best = F.when(dense, F.array_min(F.transform(ends, to_end(first))))
        return F.struct(first.alias("begin"), F.get(lines, first).alias("line"), best.alias("w"))

    return F.transform(at, beginning)


def scan(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[tuple[str, str]] = tuple(TEMPLATES),
    threshold: float = 0.8,
) -> DataFrame:
    """Licence notices found: ``id_col``, ``line`` (of the first word, from 0), ``license``, ``dice``,
    ``begin`` (number of the first word in the text, from 0) and ``n_words``.

    A text is one row of words; line ends part words and mean nothing else, so a notice may be
    wrapped or stand inside a longer line. Every window of words that begins and ends with a
    bigram of a template is compared with it: window and template are sets of word bigrams A
    and B, the Dice coefficient is 2 |A and B| / (|A| + |B|). It can reach the threshold t only if
    |A| lies between t / (2 - t) and (2 - t) / t times |B|; windows of other sizes (repeats
    included) are not looked at, nor texts and stretches that hold too few of B. Other words
    at the ends of a window only lower the coefficient.

    Of the windows that begin at one word the best licence stays (ties: first name, then fewest
    words); of those that begin in one line the best of each licence (ties: first); and a
    window all of whose words stand in better ones of its licence goes. So each word of a notice
    stands in a reported window at least as good as any that holds it and its line reports.

    Null, empty and one-word texts hold nothing. Rows that repeat an id and a text are reported
    once; other rows that share an id or have a null id each report their own notices. An empty
    table gives an empty table.

    Plan: texts stay in their task; only windows that reach the threshold are shuffled.
    Templates are the caller's list, in the plan.
    """
    grams = [(n, sorted({_hash(b) for b in bigrams_of(t)})) for n, t in templates]
    grams = [(n, g) for n, g in grams if g]
    text = text_of(text_col)
    base = df.select(F.col(quoted(id_col)).alias("id"), F.xxhash64(text).alias("tk"), text.alias("t"))
    if not grams:
        none = base.filter(F.lit(False)).select("id", *[F.lit(0).alias(c) for c in ("line", "begin", "n_words")])
        none = none.select(F.col("id").alias(id_col), "line", F.lit("").alias("license"), F.lit(0.0).alias("dice"), "begin", "n_words")
        return none
    # the outer form keeps the optimiser from computing the candidates twice, for a filter and for the rows
    near = base.select("id", "tk", "t", F.explode_outer(_candidates(F.col("t"), grams, threshold)).alias("c"))
    near = near.filter(F.col("c").isNotNull()).select("id", "tk", "t", "c.*")
    found = near.select("id", "tk", "license", F.explode_outer(let(_line_of_word(F.col("t")), _best_windows)).alias("c"))
    found = found.select("id", "tk", "license", "c.begin", "c.line", "c.w.*").filter(F.col("d") <= -threshold)
    per_word = found.groupBy("id", "tk", "line", "begin").agg(F.min(F.struct("d", "license", "n_words")).alias("b"))
    per_line = per_word.groupBy("id", "tk", "line", "b.license").agg(F.min(F.struct("b.d", "begin", "b.n_words")).alias("b"))
    rows = per_line.select("id", "tk", "line", "license", "b.*").withColumn("end", F.col("begin") + F.col("n_words"))
    longest = max(sizes(len(g), threshold)[1] for _, g in grams)
    # windows of one licence in one text that may share a word with the row's own
    around = W.partitionBy("id", "tk", "license").orderBy("begin").rangeBetween(-longest, longest)
    rows = rows.withColumn("near", F.collect_list(F.struct("d", "begin", "end")).over(around))
    better = F.filter("near", lambda o: o["d"] < F.col("d"))
    holds = lambda p: lambda o: (o["begin"] <= p) & (o["end"] > p)
    words = F.sequence(F.col("begin"), F.col("end") - 1)
    inside = let(better, lambda others: F.forall(words, lambda p: F.exists(others, holds(p))))
    return rows.filter(~inside).select(F.col("id").alias(id_col), "line", "license", (-F.col("d")).alias("dice"), "begin", "n_words")
