"""URL filters: host and path rules, and association rules mined from labelled URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower, quoted, written


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (after the first ``://``, A-Z lower-cased) and the path; empty without ``://``."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``rule``, ``verdict`` of (verdict, ``host/path``) pairs."""
    rows = [F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for v, r in rules]
    if not rows:
        return spark.sql("SELECT '' AS rule, '' AS verdict WHERE false")
    return spark.range(1).select(F.inline(F.array(*rows)))


def tokens_of(host: Column, path: Column, url: Column) -> Column:
    """Distinct parts of a URL, marked by where they stand: host, path or query name."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda q: F.regexp_extract(q, "^[^=]*", 0))
    marked = [
        F.transform(F.filter(parts, lambda p: p != ""), lambda p, m=mark: F.concat(F.lit(m), p))
        for mark, parts in (
            ("h:", F.split(host, "[.-]")),
            ("p:", F.split(ascii_lower(path), "[/._-]+")),
            ("q:", names),
        )
    ]
    return F.array_distinct(F.concat(*marked))


def listed_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url``, ``rule`` and ``verdict`` of the longest rule that fits, where one does.

    ``urls`` has distinct ``url`` with ``host`` and ``path``. The ends of a host are looked up
    as they are, so the work does not grow with the number of rules. Of equally long rules the
    first by code point counts.
    """
    parts = F.split("host", "[.]")
    n = F.size(parts)
    ends = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(F.split("host", "[.]"), i, n), "."))
    known = rules.select(
        "rule", "verdict", F.regexp_extract("rule", "^[^/]*", 0).alias("end"), F.regexp_extract("rule", "^[^/]*(.*)$", 1).alias("start")
    )
    fit = urls.filter("host <> ''").select("url", "path", F.explode(ends).alias("e"))
    fit = fit.join(known, (F.col("e") == F.col("end")) & F.startswith("path", "start"))
    best = F.min(F.struct((-F.length("rule")).alias("n"), F.col("rule").alias("rule"), F.col("verdict").alias("verdict")))
    return fit.groupBy("url").agg(best.alias("b")).select("url", "b.rule", "b.verdict")


def matching(items: DataFrame, rules: DataFrame) -> DataFrame:
    """``key`` and ``set_id`` for each row of ``items`` (``key``, ``tokens``) and each rule
    (``set_id``, ``tokens``, ``posting``) whose tokens it holds.

    The index has one entry per rule, under its rarest token.
    """
    entries = rules.select("set_id", F.col("tokens").alias("wanted"), "posting")
    seen = items.select("key", "tokens", F.explode("tokens").alias("t"))
    hit = seen.join(entries, F.col("t") == F.col("posting"))
    return hit.filter(F.size(F.array_except("wanted", "tokens")) == 0).select("key", "set_id")


def token_classes(labelled: DataFrame) -> DataFrame:
    """``t`` and ``class``: tokens that exactly the same rows of ``labelled`` (``key``, ``tokens``)
    hold are one class, named by a 64-bit hash.

    A class is the pair of the count and the exclusive-or of hashed keys, with a second sum of
    hashes against collisions.
    """
    held = labelled.select("key", F.explode("tokens").alias("t")).groupBy("t")
    same = held.agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("key")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("y"),
    )
    return same.select("t", F.xxhash64("n", "x", "y").alias("class"))


def in_classes(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``key`` and ``tokens`` of ``rows``, the tokens replaced by their classes; unknown ones go."""
    at = rows.select("key", F.explode("tokens").alias("t")).join(classes, "t")
    return at.groupBy("key").agg(F.collect_set("class").alias("tokens"))


def mine(labelled: DataFrame, min_count: int = 5, min_confidence: float = 0.8) -> DataFrame:
    """Token combinations that mark bad URLs: ``set_id``, ``tokens``, ``posting``, ``bad``, ``all``.

    ``labelled`` has ``tokens`` (an array of one type) and ``bad`` (boolean). Combinations of any
    number of tokens that at least ``min_count`` bad rows hold become rules if at least
    ``min_confidence`` of all labelled rows that hold them are bad. Only the least combinations
    are rules: one that contains a shorter rule adds no verdict and is left out. No bad row: no
    rules.

    Single tokens are judged by counting; FP-growth then finds the combinations of the others.
    Its work is a row per frequent combination, so it doubles with each further token that
    frequent URLs share and that no rule holds.
    """
    labelled = written(labelled.select("tokens", "bad"), "labelled")
    one = labelled.select(F.explode("tokens").alias("t"), F.col("bad").cast("long").alias("b")).groupBy("t")
    one = written(one.agg(F.sum("b").alias("bad"), F.count("*").alias("all")), "tokens")
    often = one.filter(F.col("bad") >= min_count).withColumn("sure", F.col("bad") >= min_confidence * F.col("all"))
    singles = often.filter("sure").select(
        F.xxhash64(F.array("t")).alias("set_id"), F.array("t").alias("tokens"), F.col("t").alias("posting"), "bad", "all"
    )
    # equal token sets are one row that counts several times; only tokens that can be part of a longer rule stay
    kinds = labelled.groupBy("tokens").agg(F.count("*").alias("times"), F.sum(F.col("bad").cast("long")).alias("bad"))
    kinds = written(kinds.withColumn("key", F.xxhash64("tokens")), "kinds")
    open_ = often.filter("not sure").select("t")
    part = kinds.select("key", "times", "bad", F.explode("tokens").alias("t")).join(open_, "t")
    part = part.groupBy("key", "times", "bad").agg(F.array_sort(F.collect_set("t")).alias("tokens")).filter(F.size("tokens") > 1)
    part = part.groupBy("tokens").agg(F.sum("times").alias("times"), F.sum("bad").alias("bad"))
    part = written(part.withColumn("key", F.monotonically_increasing_id()), "open-kinds")
    # a kind comes as often as it has bad rows, dealt in blocks so that a hot one is no single task
    deal = F.sequence(F.lit(0).cast("long"), F.expr("(bad - 1) div 1000"))
    blocks = part.filter("bad > 0").select("tokens", "bad", F.explode(deal).alias("block")).repartition("tokens", "block")
    times = F.least(F.lit(1000), F.col("bad") - 1000 * F.col("block")).cast("int")
    baskets = blocks.select(F.explode(F.array_repeat("tokens", times)).alias("tokens"))
    n = baskets.count()
    if not n:
        return singles
    model = FPGrowth(itemsCol="tokens", minSupport=min(1.0, (min_count - 0.5) / n)).fit(baskets)
    sets = model.freqItemsets.filter(F.size("items") > 1).select(F.array_sort("items").alias("tokens"), F.col("freq").alias("bad"))
    sets = sets.withColumn("set_id", F.xxhash64("tokens"))
    posting = sets.select("set_id", F.explode("tokens").alias("t")).join(one.select("t", F.col("all").alias("n")), "t")
    posting = posting.groupBy("set_id").agg(F.min(F.struct("n", "t"))["t"].alias("posting"))
    sets = written(sets.join(posting, "set_id"), "combinations")
    held = matching(part, sets).join(part.select("key", "times"), "key").groupBy(F.col("set_id").alias("id"))
    both = sets.join(held.agg(F.sum("times").alias("all")), F.col("set_id") == F.col("id"))
    sure = written(both.filter(F.col("bad") >= min_confidence * F.col("all")).drop("id"), "sure")
    inside = matching(sure.select(F.col("set_id").alias("key"), "tokens"), sure).filter("key <> set_id").select("key").distinct()
    least = sure.join(inside, F.col("set_id") == F.col("key"), "left_anti")
    return singles.unionByName(least.select("set_id", "tokens", "posting", "bad", "all"))


def judge(
    df: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    label_id_col: str = "doc_id",
    bad: Column | None = None,
    **options,
) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule``, ``verdict``; one row per row.

    The longest listed rule decides: it fits its host and all subdomains if the path starts
    with the rule's. Where none fits, a URL that holds all tokens of a mined combination (see
    :func:`mine`; tokens that the same labelled rows hold stand for each other there) is blocked
    and any other allowed. ``labels`` names rows of ``df`` by id and
    ``bad`` (default: ``quality`` 0 or ``toxic`` 1) says which are bad; null labels are not.

    A null URL, or one without ``://``, has an empty host and path and is allowed. Null ids are
    judged and have no label. Repeated rows count as often as they occur; two labels of one id
    count as bad if either is. Empty tables: no labels, no mined rules; no URLs, no rows.

    Plan: each distinct URL is judged once; verdicts are written and joined back (copied only
    if small, a hot URL split if not).
    """
    spark = df.sparkSession
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1) if bad is None else bad
    rows = df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(url_col)).cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    urls = rows.select("url").distinct().withColumns({"host": host, "path": path})
    urls = written(urls.withColumn("tokens", tokens_of(F.col("host"), F.col("path"), F.col("url"))), "urls")
    marks = labels.select(F.col(quoted(label_id_col)).alias("l"), F.coalesce(bad, F.lit(False)).alias("bad"))
    marks = marks.groupBy("l").agg(F.max("bad").alias("bad"))
    own = rows.join(marks, F.col("id") == F.col("l")).join(
        urls.select(F.col("url").alias("u"), "tokens"), F.col("url").eqNullSafe(F.col("u"))
    )
    own = written(own.withColumn("key", F.monotonically_increasing_id()).select("key", "tokens", "bad"), "labelled-urls")
    classes = written(token_classes(own), "token-classes")
    mined = written(mine(own.select("key", "bad").join(in_classes(own, classes), "key"), **options), "rules")
    seen = in_classes(urls.select(F.col("url").alias("key"), "tokens"), classes)
    hit = matching(seen, mined).select(F.col("key").alias("m")).distinct()
    listed = listed_verdicts(urls, rule_table(spark, rules)).select(F.col("url").alias("v"), "rule", "verdict")
    judged = urls.join(listed, F.col("url") == F.col("v"), "left").join(hit, F.col("url") == F.col("m"), "left")
    judged = judged.select(
        F.col("url").alias("u"),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.when(F.col("m").isNotNull(), "block").otherwise("allow")).alias("verdict"),
    )
    out = rows.join(written(judged, "verdicts"), F.col("url").eqNullSafe(F.col("u")))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", "verdict")
