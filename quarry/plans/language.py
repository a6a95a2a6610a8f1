"""Text and association queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import approximate, encode, rules, text
from quarry.plans.registry import query, rounded
from quarry.session import table
from quarry.sources import text as sources

# fixed values: function words of the corpus, handed to the operator as its stop list
STOP = ["that", "and", "the", "of", "in", "to", "it", "for", "on", "at", "or", "is", "as", "by", "be", "la", "le", "les", "des", "un", "une", "qui", "que", "dans", "der", "die", "das", "und"]


def _sql_tokens(col: str) -> str:
    e = col
    for rule in text.TREEBANK_RULES:
        if rule == "BLANK":
            e = f"(' ' || {e} || ' ')"
        else:
            pat, rep = (x.replace("'", "''") for x in rule)
            rep = rep.replace("$1", "\\1").replace("$2", "\\2").replace("$3", "\\3")
            e = f"regexp_replace({e}, '{pat}', '{rep}', 'g')"
    return f"list_filter(regexp_split_to_array({e}, '[ \\t\\n\\r\\f\\x0B]+'), lambda t: t <> '')"


def _words_sql(tab: str, idc: str, stop=None) -> str:
    # the tokens are materialized before they are unnested
    cond = f" WHERE w NOT IN ({', '.join(repr(s) for s in stop)})" if stop else ""
    return f"""WITH tk AS MATERIALIZED (SELECT {idc}, {_sql_tokens('text')} AS ts FROM {tab}),
    wd AS (SELECT {idc}, trim(lower(unnest(ts)), ',. ') AS w FROM tk),
    kept AS (SELECT {idc}, w FROM wd{cond}),
    bag AS (SELECT {idc}, w AS term, count(*) AS cnt FROM kept WHERE length(w) BETWEEN 3 AND 30 GROUP BY 1, 2)"""


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


@query(
    "s3_text_lines",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    SELECT doc_id, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM l WHERE length(line) > 0 GROUP BY 1""",
)
def s3(spark, d):
    """The documents written as text and scanned back line by line."""
    from quarry.session import shared_path

    path = shared_path(spark, "lines")
    keyed = _docs(spark, d).select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    keyed.select(F.concat("doc_id", F.lit("\t"), "line").alias("value")).write.text(path)
    back = sources.read_lines(spark, path, "line_id", "value")
    parts = F.split("value", "\t", 2)
    rows = back.select(F.get(parts, F.lit(0)).cast("long").alias("doc_id"), F.get(parts, F.lit(1)).alias("line"))
    return rows.filter(F.length("line") > 0).groupBy("doc_id").agg(
        F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars")
    )


_ORDER_BASKETS = """(SELECT DISTINCT l_orderkey AS basket_id, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _brand_baskets(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    return rules.baskets_of_pairs(li.join(p, li.l_partkey == p.p_partkey), "l_orderkey", "p_brand")


@query(
    "s4_basket_scan",
    f"SELECT basket_id, len(list(item)) AS n, list_aggregate(list_sort(list(item)), 'string_agg', '|') AS items FROM {_ORDER_BASKETS} GROUP BY 1",
)
def s4(spark, d):
    lines = _brand_baskets(spark, d).select("basket_id", F.concat_ws(",", "items", F.slice("items", 1, 1)).alias("line"))
    b = sources.parse_baskets(lines, "line")
    return b.select("basket_id", F.size("items").cast("long").alias("n"), F.concat_ws("|", "items").alias("items"))


_FLAGS = ["p_type_ECONOMY", "p_type_LARGE", "p_type_MEDIUM", "p_type_PROMO", "p_type_SMALL", "p_type_STANDARD"]
_TYPES = [f.removeprefix("p_type_") for f in _FLAGS]


@query(
    "s5_basket_lines",
    f"""SELECT p_partkey, concat_ws(',', {', '.join(f"CASE WHEN p_type = '{t}' THEN '{i}' END" for i, t in enumerate(_TYPES[:5]))},
      CASE WHEN p_size > 25 THEN '5' END) AS line FROM part""",
)
def s5(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_type", (F.col("p_size") > 25).cast("int").alias("big"))
    hot = encode.one_hot(p, "p_type", {"p_type": _TYPES})
    return sources.basket_lines(hot.select("p_partkey", *_FLAGS[:5], "big"), [*_FLAGS[:5], "big"])


@query("n1_treebank_tokens", f"SELECT doc_id, len(ts) AS n, list_aggregate(ts, 'string_agg', ' ') AS tokens FROM (SELECT doc_id, {_sql_tokens('text')} AS ts FROM documents)")
def n1(spark, d):
    t = _docs(spark, d).select("doc_id", text.tokens(F.col("text")).alias("ts"))
    return t.select("doc_id", F.size("ts").cast("long").alias("n"), F.concat_ws(" ", "ts").alias("tokens"))


@query("n2_filtered_words", _words_sql("documents", "doc_id", STOP) + " SELECT doc_id, count(*) AS terms, CAST(sum(cnt) AS BIGINT) AS occurrences FROM bag GROUP BY 1")
def n2(spark, d):
    bag = text.bag_of_words(_docs(spark, d), stop=STOP)
    return bag.groupBy("doc_id").agg(F.count("*").alias("terms"), F.sum("cnt").alias("occurrences"))


@query(
    "n3_stop_words_from_text",
    _words_sql("benchmark", "item_id").replace(
        "FROM wd)", f"FROM wd WHERE w NOT IN (SELECT unnest({_sql_tokens('text')}) FROM conversations))"
    )
    + " SELECT item_id, term, cnt FROM bag",
)
def n3(spark, d):
    """Tokens of all turns as the stop list of the benchmark texts."""
    stop = text.stop_words(table(spark, d, "conversations"))
    return text.bag_of_words(table(spark, d, "benchmark"), "item_id", stop=stop)


@query("n4_stemmed_bag")
def n4(spark, d):
    return text.bag_of_words(_docs(spark, d), stop=STOP, stem=True)


@query(
    "m2_similar_bags",
    _words_sql("documents", "doc_id", STOP)
    + """, s AS (SELECT DISTINCT doc_id, term FROM bag), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.term = y.term AND x.doc_id < y.doc_id GROUP BY 1, 2)
    SELECT a, b, round(c.c / (x.n + y.n - c.c)::DOUBLE, 6) AS sim FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * c.c >= 80 * (x.n + y.n - c.c)""",
)
def m2_bags(spark, d):
    """Documents whose sets of terms are alike, without a pair table."""
    bag = text.bag_of_words(_docs(spark, d), stop=STOP)
    return rounded(approximate.similar_sets(bag, 80, "doc_id", "term"))


@query("n5_vocabulary", _words_sql("documents", "doc_id", STOP) + " SELECT term, row_number() OVER (ORDER BY encode(term)) - 1 AS idx FROM (SELECT DISTINCT term FROM bag)")
def n5(spark, d):
    return text.vocabulary(text.bag_of_words(_docs(spark, d), stop=STOP))


@query("n6_bag_of_words", _words_sql("documents", "doc_id", STOP) + " SELECT doc_id, term, cnt FROM bag")
def n6(spark, d):
    return text.bag_of_words(_docs(spark, d), stop=STOP)


@query(
    "n7_corpus_counts",
    _words_sql("documents", "doc_id") + " SELECT count(DISTINCT doc_id) AS documents, count(DISTINCT term) AS terms, CAST(sum(cnt) AS BIGINT) AS occurrences FROM bag",
)
def n7(spark, d):
    return text.corpus_counts(text.bag_of_words(_docs(spark, d)))


@query(
    "n8_rank_by_query",
    _words_sql("documents", "doc_id")
    + """ SELECT doc_id, round(sum(CASE WHEN term IN ('then', 'whou', 'eaux') THEN cnt ELSE 0 END) / (sqrt(sum(cnt * cnt)) * sqrt(3.0::DOUBLE)), 6) AS sim
    FROM bag GROUP BY 1""",
)
def n8(spark, d):
    return rounded(text.rank_documents(text.bag_of_words(_docs(spark, d)), ["then", "whou", "eaux"]))


# --- association rules -------------------------------------------------------------
_SUP, _CONF = 0.02, 0.15
_ITEMSETS = f"""WITH b AS {_ORDER_BASKETS}, t AS (SELECT count(DISTINCT basket_id) AS n FROM b),
    s1 AS (SELECT item AS a, count(*) AS freq FROM b GROUP BY 1 HAVING count(*) >= {_SUP} * (SELECT n FROM t)),
    f AS (SELECT b.* FROM b JOIN s1 ON item = a),
    s2 AS (SELECT x.item AS a, y.item AS b, count(*) AS freq FROM f x JOIN f y ON x.basket_id = y.basket_id AND x.item < y.item GROUP BY 1, 2
      HAVING count(*) >= {_SUP} * (SELECT n FROM t)),
    s3 AS (SELECT x.item AS a, y.item AS b, z.item AS c, count(*) AS freq FROM f x JOIN f y ON x.basket_id = y.basket_id AND x.item < y.item
      JOIN f z ON z.basket_id = y.basket_id AND y.item < z.item GROUP BY 1, 2, 3 HAVING count(*) >= {_SUP} * (SELECT n FROM t)),
    sets AS (SELECT [a] AS items, freq FROM s1 UNION ALL SELECT [a, b], freq FROM s2 UNION ALL SELECT [a, b, c], freq FROM s3)"""
_RULES = (
    _ITEMSETS
    + f""", r AS (SELECT list_filter(items, lambda i: i <> h) AS antecedent, [h] AS consequent, freq FROM (SELECT items, freq, unnest(items) AS h FROM sets)),
    j AS (SELECT r.*, CASE WHEN len(antecedent) = 0 THEN (SELECT n FROM t) ELSE body.freq END AS body_freq, head.freq AS head_freq
      FROM r LEFT JOIN sets body ON body.items = antecedent JOIN sets head ON head.items = consequent),
    q AS (SELECT array_to_string(antecedent, ' ') AS antecedent, array_to_string(consequent, ' ') AS consequent, freq / body_freq AS confidence, freq / (SELECT n FROM t) AS support,
      body_freq / (SELECT n FROM t) AS body_support, freq / body_freq * (SELECT n FROM t) / head_freq AS lift FROM j)"""
)


@query(
    "r1_rows_to_baskets",
    f"""SELECT p_partkey AS basket_id, concat_ws(' ', 'p_type_' || p_type, CASE WHEN p_size > 25 THEN 'big' END) AS items FROM part""",
)
def r1(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_type", (F.col("p_size") > 25).cast("int").alias("big"))
    hot = encode.one_hot(p, "p_type", {"p_type": _TYPES})
    b = rules.baskets_of_rows(hot, [*_FLAGS, "big"], "p_partkey", [*_FLAGS, "big"])
    return b.select("basket_id", F.concat_ws(" ", "items").alias("items"))


@query("r2_frequent_itemsets", _ITEMSETS + " SELECT array_to_string(items, ' ') AS items, freq, round(freq / (SELECT n FROM t), 8) AS support FROM sets")
def r2(spark, d):
    sets = rules.sorted_itemsets(rules.Mined(_brand_baskets(spark, d), _SUP).itemsets())
    return rounded(sets.select(F.concat_ws(" ", "items").alias("items"), "freq", "support"), 8)


def _flat(df):
    return df.select(
        F.concat_ws(" ", "antecedent").alias("antecedent"), F.concat_ws(" ", "consequent").alias("consequent"), "confidence", "support", "lift"
    )


@query(
    "r3_association_rules",
    _RULES + f" SELECT antecedent, consequent, round(confidence, 8) AS confidence, round(support, 8) AS support, round(lift, 8) AS lift FROM q WHERE confidence >= {_CONF}",
)
def r3(spark, d):
    mined = rules.Mined(_brand_baskets(spark, d), _SUP)
    return rounded(_flat(rules.sorted_rules(mined.rules(_CONF))), 8)


@query(
    "r4_rules_with_body_support",
    _RULES + f" SELECT antecedent, consequent, round(confidence, 8) AS confidence, round(body_support, 8) AS support, round(lift, 8) AS lift FROM q WHERE confidence >= {_CONF}",
)
def r4(spark, d):
    mined = rules.Mined(_brand_baskets(spark, d), _SUP)
    return rounded(_flat(mined.rules(_CONF, support_mode="body")), 8)


def _mined_types(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_type", (F.col("p_size") > 25).cast("int").alias("big"))
    hot = encode.one_hot(p, "p_type", {"p_type": _TYPES})
    return rules.Mined(rules.baskets_of_rows(hot, [*_FLAGS, "big"], "p_partkey"), 0.03)


_TYPE_SETS = """WITH n AS (SELECT count(*) AS n FROM part),
    s AS (SELECT 'p_type_' || p_type AS a, NULL AS b, count(*) AS freq FROM part GROUP BY 1 UNION ALL SELECT 'big', NULL, count(*) FROM part WHERE p_size > 25
      UNION ALL SELECT 'p_type_' || p_type, 'big', count(*) FROM part WHERE p_size > 25 GROUP BY 1)"""


@query(
    "r5_readable_itemsets",
    _TYPE_SETS + " SELECT concat_ws(' ', a, b) AS items, freq, round(freq / n, 8) AS support FROM s, n WHERE freq >= 0.03 * n",
)
def r5(spark, d):
    sets = rules.readable_itemsets(_mined_types(spark, d).itemsets(), [*_FLAGS, "big"])
    return rounded(sets.select(F.concat_ws(" ", "items").alias("items"), "freq", "support"), 8)


@query(
    "r6_readable_rules",
    _TYPE_SETS
    + """, p AS (SELECT a, b, freq FROM s WHERE b IS NOT NULL AND freq >= 0.03 * (SELECT n FROM n)), o AS (SELECT a, freq FROM s WHERE b IS NULL),
    r AS (SELECT '' AS antecedent, a AS consequent, freq, (SELECT n FROM n) AS body, freq AS head FROM o
      UNION ALL SELECT p.a, p.b, p.freq, x.freq, y.freq FROM p JOIN o x ON x.a = p.a JOIN o y ON y.a = p.b
      UNION ALL SELECT p.b, p.a, p.freq, y.freq, x.freq FROM p JOIN o x ON x.a = p.a JOIN o y ON y.a = p.b)
    SELECT antecedent, consequent, round(freq / body, 8) AS confidence, round(freq / (SELECT n FROM n), 8) AS support, round(freq / body * (SELECT n FROM n) / head, 8) AS lift
    FROM r WHERE freq / body >= 0.1""",
)
def r6(spark, d):
    return rounded(_flat(rules.readable_rules(_mined_types(spark, d).rules(0.1), [*_FLAGS, "big"])), 8)


@query(
    "r7_parsed_rule_lines",
    """SELECT p_brand AS consequent, '' AS antecedent, round(count(*) * 100.0 / (SELECT count(*) FROM part), 2)::DOUBLE AS conf_pct,
    round(count(*) * 100.0 / (SELECT count(*) FROM part), 2)::DOUBLE AS sup_pct FROM part GROUP BY 1""",
)
def r7(spark, d):
    """Empty-body rules printed in the recorded line format and read back."""
    p = table(spark, d, "part")
    share = F.round(F.count("*") * 100.0 / p.select(F.count("*")).scalar(), 2).cast("string")
    lines = p.groupBy("p_brand").agg(share.alias("s")).select(
        F.concat("p_brand", F.lit(" <- [Conf. "), "s", F.lit(",Sup. "), "s", F.lit("]")).alias("text")
    )
    r = sources.parse_rules(lines)
    return r.select(F.concat_ws(" ", "consequent").alias("consequent"), F.concat_ws(" ", "antecedent").alias("antecedent"), "conf_pct", "sup_pct")


@query("k1_top_itemsets", _ITEMSETS + " SELECT array_to_string(items, ' ') AS items, freq FROM sets ORDER BY freq DESC, array_to_string(items, ' ') LIMIT 20")
def k1(spark, d):
    sets = rules.Mined(_brand_baskets(spark, d), _SUP).itemsets()
    return sets.withColumn("items", F.concat_ws(" ", "items")).orderBy(F.desc("freq"), "items").limit(20).select("items", "freq")
