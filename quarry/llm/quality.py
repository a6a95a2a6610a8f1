"""Host-level quality rules: failures per host, shrunk with an empirical beta prior."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import BLANKS, let, quoted, text_of, words_of, written

RULES = ("base", "symbols", "lines", "lengths")


@dataclass(frozen=True)
class Limits:
    """Parameters of the rules and of the host verdict."""

    min_words: int = 50
    repeat_pct: int = 50  # base: more than this share of words in repeated windows
    symbol_pct: int = 100  # symbols: more than this many symbols per 100 words
    dup_line_pct: int = 50  # lines: more than this share of repeated lines
    min_length: int = 2  # lengths: mean word length outside these bounds
    max_length: int = 12
    gross: tuple[float, float, float] = (1.5, 1.5, 2.0)  # symbols, lines, lengths: beyond the limit times this on any host
    strict: float = 0.02  # the shrunk rate at which a host's documents get half of that tolerance
    ban: float = 0.8  # all documents of a host go if a shrunk rate is above


def _repeated_words(words: Column, n: int = 3) -> Column:
    """Words covered by windows of ``n`` words that the text holds twice or more."""

    def of(ws):
        last = F.size(ws) - n
        hashed = F.transform(
            F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(n)])
        )

        def covered(hs):
            placed = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

            def positions(s):
                twin = F.filter(
                    F.sequence(F.lit(0), F.size(s) - 1),
                    lambda j: F.get(s, j)["h"].eqNullSafe(F.get(s, j - 1)["h"])
                    | F.get(s, j)["h"].eqNullSafe(F.get(s, j + 1)["h"]),
                )
                return F.sort_array(F.transform(twin, lambda j: F.get(s, j)["p"]))

            # each window adds the words that the window before it does not reach
            start = F.struct(F.lit(-n).alias("prev"), F.lit(0).alias("total"))
            total = F.aggregate(
                let(placed, positions),
                start,
                lambda acc, p: F.struct(
                    p.alias("prev"), (acc["total"] + F.least(F.lit(n), p - acc["prev"])).alias("total")
                ),
                lambda acc: acc["total"],
            )
            return F.when(F.size(F.array_distinct(hs)) == F.size(hs), 0).otherwise(total)

        return F.when(last < 0, 0).otherwise(let(hashed, covered))

    return let(words, of).cast("long")


def metrics(df: DataFrame, text_col: str, keep: dict[str, Column], limits: Limits) -> DataFrame:
    """``keep`` columns, the counts per document and one failure flag per rule.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` of the whole text; a null text has none.
    """
    base = df.select(*[c.alias(n) for n, c in keep.items()], text_of(text_col).alias("__t"))
    base = base.withColumn("__w", words_of(F.col("__t")))
    filled = F.filter(F.split("__t", "\n"), lambda s: F.btrim(s, F.lit(BLANKS)) != "")
    base = base.withColumn("__l", filled)
    counted = base.select(
        *keep,
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.regexp_count("__t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.size("__l").cast("long").alias("n_filled_lines"),
        _repeated_words(F.col("__w")).alias("n_repeat_words"),
    )
    n, m = F.col("n_words"), limits
    fails = {
        "base": (n < m.min_words) | (100 * F.col("n_repeat_words") > m.repeat_pct * n),
        "symbols": 100 * F.col("n_symbols") > m.symbol_pct * n,
        "lines": 100 * F.col("n_dup_lines") > m.dup_line_pct * F.col("n_filled_lines"),
        "lengths": (F.col("word_chars") < m.min_length * n) | (F.col("word_chars") > m.max_length * n),
    }
    return counted.withColumns({f"fail_{r}": fails[r] for r in RULES})


def host_rates(scored: DataFrame, host: str) -> DataFrame:
    """Per host the documents and, for each rule, failures and the shrunk rate.

    The prior of a rule is the beta distribution whose mean is the overall rate and whose
    variance is the spread of the hosts' rates beyond what chance alone gives (method of
    moments), its weight held between 1 and 10^6 documents. Only sums over hosts, one row,
    come to the driver.
    """
    per = scored.groupBy(F.col(quoted(host)).alias("host")).agg(
        F.count("*").alias("n"), *[F.sum(F.col(f"fail_{r}").cast("long")).alias(f"k_{r}") for r in RULES]
    )
    per = written(per, "host-rules")
    sums = per.agg(
        F.count("*").alias("hosts"),
        F.sum("n").alias("n"),
        *[F.sum(f"k_{r}").alias(f"k_{r}") for r in RULES],
        *[F.sum(F.col(f"k_{r}") * F.col(f"k_{r}") / F.col("n")).alias(f"q_{r}") for r in RULES],
    ).first()
    out = {}
    for r in RULES:
        total = sums["n"] or 0
        mean = sums[f"k_{r}"] / total if total else 0.0
        chance = mean * (1 - mean)
        spread = (sums[f"q_{r}"] / total - mean * mean - chance * sums["hosts"] / total) if total else 0.0
        weight = min(1e6, max(1.0, chance / spread - 1)) if spread > 0 else 1e6
        out[f"rate_{r}"] = (F.col(f"k_{r}") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))
    return per.withColumns(out)


def _tolerance(rate: Column, gross: float, strict: float) -> Column:
    """By how much a limit is widened: ``gross`` times where no document fails, less the more do."""
    return F.lit(1.0) + F.lit((gross - 1) * strict) / (F.lit(strict) + rate)


def judge(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limits: Limits = Limits(),
) -> DataFrame:
    """Counts per document, ``base_failed`` and ``kept``; one row per input row.

    Returns id, the text's hash ``text_key``, ``host``, ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept``. A document
    is kept unless it fails the base rule, or is beyond the limit of another rule as its host's
    shrunk failure rate widens it (``gross`` times at rate 0, half of that tolerance at
    ``strict``, ever less above), or its host has a rate above ``ban``. So gross failures go on
    any host, however rare they are, and slight ones where they are common.

    A null or empty text has no words and fails the base rule. Rows with a null host form one
    host. Repeated rows count as often as they occur. An empty table gives an empty table.

    Plan: the texts are read once and leave as one narrow row each, written to the shared
    folder. Hosts are summed before their shuffle; the verdict table is written, so that
    Spark copies it when small and splits hot hosts in a shuffled join when not.
    """
    text = text_of(text_col)
    keep = {
        "id": F.col(quoted(id_col)),
        "text_key": F.xxhash64(text),
        "host": F.col(quoted(host_col)),
    }
    scored = written(metrics(df, text_col, keep, limits), "quality")
    rates = host_rates(scored, "host").select(
        F.col("host").alias("__host"),
        F.greatest(*[F.col(f"rate_{r}") for r in RULES]).alias("worst"),
        *[_tolerance(F.col(f"rate_{r}"), g, limits.strict).alias(f"times_{r}") for r, g in zip(RULES[1:], limits.gross)],
    )
    joined = scored.join(written(rates, "host-verdicts"), F.col("host").eqNullSafe(F.col("__host")), "left")
    n, m = F.col("n_words"), limits
    symbols, lines, lengths = (F.col(f"times_{r}") for r in RULES[1:])
    bad = (
        (F.col("worst") > m.ban)
        | (100 * F.col("n_symbols") > m.symbol_pct * n * symbols)
        | (100 * F.col("n_dup_lines") > m.dup_line_pct * F.col("n_filled_lines") * lines)
        | (F.col("word_chars") * lengths < m.min_length * n)
        | (F.col("word_chars") > m.max_length * n * lengths)
    )
    return joined.select(
        F.col("id").alias(id_col),
        "text_key",
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.col("fail_base").alias("base_failed"),
        (~F.col("fail_base") & ~bad).alias("kept"),
    )


def keep_good(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limits: Limits = Limits(),
) -> DataFrame:
    """The rows of ``df`` that :func:`judge` keeps, with their columns as they were.

    Rows that repeat an id and a text share their verdict by host; two hosts of one such pair
    are judged apart.
    """
    good = judge(df, id_col, text_col, host_col, limits).filter("kept")
    good = good.select(
        F.col(quoted(id_col)).alias("__id"), F.col("text_key").alias("__tk"), F.col("host").alias("__host")
    ).distinct()
    cond = (
        F.col(quoted(id_col)).eqNullSafe(F.col("__id"))
        & (F.xxhash64(text_of(text_col)) == F.col("__tk"))
        & F.col(quoted(host_col)).eqNullSafe(F.col("__host"))
    )
    return df.join(good, cond, "left_semi")
