"""Registered queries of the pipeline operators and, where SQL can tell, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from quarry.llm import (
    decontaminate,
    importance,
    lexical,
    licenses,
    lines,
    minhash,
    mixing,
    quality,
    secrets,
    simhash,
    tokens,
    urls,
    warc,
)
from quarry.session import shared_path, table

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn

    return add


_BLANKS_SQL = "[\\x20\\x09-\\x0D]"


@query(
    "op1_mixing",
    rf"""
WITH s AS (
  SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '{_BLANKS_SQL}+'), lambda x: x <> '')) AS BIGINT) AS size
  FROM documents
), g AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS ss,
    CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w
  FROM s GROUP BY source
), o AS (SELECT *, row_number() OVER (ORDER BY 2 * ss / w, source) AS k FROM g WHERE ss > 0),
lv AS (
  SELECT k, 2 * ss / w AS r,
    (1.5::DOUBLE * sum(ss) OVER () - coalesce(sum(2 * ss) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lam
  FROM o
), t AS (
  SELECT source, ss, least(2.0::DOUBLE * ss, (SELECT lam FROM lv WHERE r >= lam ORDER BY k LIMIT 1) * w) AS target FROM g
), e AS (
  SELECT doc_id, s.source, size, ss, target, coalesce(CASE WHEN ss > 0 THEN target / ss END, 0.0::DOUBLE) AS rate,
    (CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source
), p AS (SELECT *, floor(rate) AS whole, rate - floor(rate) AS p FROM e),
q AS (
  SELECT *, CASE WHEN p > 0 THEN u * (1 - p) / ((1 - u) * p) END AS ord,
    greatest(target - sum(whole * size) OVER (PARTITION BY source), 0.0::DOUBLE) AS rest FROM p
), c AS (
  SELECT *, CASE WHEN ord IS NOT NULL THEN sum(size) OVER (PARTITION BY source, ord IS NULL ORDER BY ord) END AS cum FROM q
), d AS (
  SELECT *, coalesce(cum <= rest, false) AS taken,
    rest - coalesce(max(cum) FILTER (WHERE cum <= rest) OVER (PARTITION BY source), 0) AS gap FROM c
), x AS (
  SELECT *, ord IS NOT NULL AND NOT taken AND abs(size - gap) < gap AS may FROM d
), y AS (
  SELECT *, CASE WHEN may THEN row_number() OVER (PARTITION BY source, may ORDER BY abs(size - gap), ord) END AS n FROM x
)
SELECT doc_id, size, ss AS source_size, target,
  CAST(size * (whole + CASE WHEN taken OR coalesce(n, 0) = 1 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM y
""",
)
def op1(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    out = mixing.pareto_mix(docs, mixing.cyclic_weights(docs))
    return out.select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("group_size").alias("source_size"),
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


@query(
    "op2_line_dedup",
    r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), shared AS (
  SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), f AS (
  SELECT k.doc_id, k.pos, k.line, s.first_id IS NOT NULL AND s.first_id <> k.doc_id AS gone
  FROM k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
""",
)
def op2(spark, d):
    out = lines.dedup_lines(table(spark, d, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query(
    "op3_quality_rules",
    rf"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, list_filter(regexp_split_to_array(t, '{_BLANKS_SQL}+'), lambda x: x <> '') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS p FROM w),
gr AS (SELECT doc_id, p, ws[p] || ' ' || ws[p+1] || ' ' || ws[p+2] AS g FROM g),
rep AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM gr) WHERE c >= 2),
cov AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM rep) GROUP BY doc_id),
m AS (SELECT w.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS nl, coalesce(cov.n, 0) AS n_repeat_words
  FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 100 * n_symbols > 100 * n_words AS f1,
  100 * n_dup_lines > 50 * nl AS f2, word_chars < 2 * n_words OR word_chars > 12 * n_words AS f3 FROM m),
h AS (SELECT source, count(*) AS n, unnest([0, 1, 2, 3]) AS r,
  unnest([count(*) FILTER (WHERE base_failed), count(*) FILTER (WHERE f1), count(*) FILTER (WHERE f2), count(*) FILTER (WHERE f3)]) AS k
  FROM f GROUP BY source),
s AS (SELECT r, sum(k) / sum(n) AS mean, sum(k * k / n) / sum(n) - (sum(k) / sum(n)) ** 2 - (sum(k) / sum(n)) * (1 - sum(k) / sum(n)) * count(*) / sum(n) AS spread
  FROM h GROUP BY r),
a AS (SELECT r, mean, CASE WHEN spread > 0 THEN least(1e6, greatest(1.0, mean * (1 - mean) / spread - 1)) ELSE 1e6 END AS weight FROM s),
v AS (SELECT source, max((k + mean * weight) / (n + weight)) AS worst,
  max((k + mean * weight) / (n + weight)) FILTER (WHERE h.r = 1) AS r1, max((k + mean * weight) / (n + weight)) FILTER (WHERE h.r = 2) AS r2,
  max((k + mean * weight) / (n + weight)) FILTER (WHERE h.r = 3) AS r3
  FROM h JOIN a ON h.r = a.r GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT (base_failed OR worst > 0.8 OR 100 * n_symbols > 100 * n_words * (1 + 0.01::DOUBLE / (0.02::DOUBLE + r1))
  OR 100 * n_dup_lines > 50 * nl * (1 + 0.01::DOUBLE / (0.02::DOUBLE + r2))
  OR word_chars * (1 + 0.02::DOUBLE / (0.02::DOUBLE + r3)) < 2 * n_words OR word_chars > 12 * n_words * (1 + 0.02::DOUBLE / (0.02::DOUBLE + r3))) AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
""",
)
def op3(spark, d):
    out = quality.judge(table(spark, d, "documents").select("doc_id", "text", "source"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op4_simhash")
def op4(spark, d):
    out = simhash.near_groups(table(spark, d, "documents").select("doc_id", "text"))
    return out.select(
        F.col("id").alias("doc_id"), simhash.hex_of().alias("fingerprint"), F.col("component").alias("component_id")
    )


@query("op6_decontamination")
def op6(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    out = decontaminate.matches(docs, table(spark, d, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "item_id", F.round("similarity", 6).alias("similarity"), "begin", "end")


def _page(c):
    return F.regexp_extract(c, "^urn:page:(-?[0-9]+)$", 1)


@query(
    "op7_warc",
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS n, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(x, CAST(10 * (i // 8) + 1 AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INT)) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM g
""",
)
def op7(spark, d):
    path = shared_path(spark, "archives")
    warc.archive(table(spark, d, "pages").select("page_id", "url", "html"), path)
    back = warc.read_warc(spark, path)
    number = lambda c: F.when(_page(F.col(c)) != "", _page(F.col(c)).cast("long"))
    return back.select(
        number("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("long"), F.col("payload_length")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )


@query("op9_token_counts")
def op9(spark, d):
    import public_tokenizers

    docs = table(spark, d, "documents").select("doc_id", "text")
    return tokens.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query("op10_secret_scan")
def op10(spark, d):
    out = secrets.scan(table(spark, d, "documents").select("doc_id", "text"))
    kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return out.select(
        "doc_id",
        kind(0).alias("n_assign"),
        kind(1).alias("n_access"),
        kind(2).alias("n_hex"),
        F.sha2(secrets.spelled(F.col("base")), 256).alias("base_sha256"),
        secrets.spelled(F.col("spans")).alias("spans"),
    )


def _license_sql() -> str:
    def entry(i, name, text):
        g = licenses.bigrams_of(text)
        low, high = licenses.sizes(len(g), 0.8)
        return "(%d, '%s', %d, %d, [%s])" % (i, name, low, high, ", ".join(f"'{b}'" for b in g))

    rows = ", ".join(entry(i, n, t) for i, (n, t) in enumerate(licenses.TEMPLATES))
    return rf"""
WITH tpl(i, license, low, high, g) AS (VALUES {rows}),
tb AS (SELECT i, license, low, high, len(g) AS m, unnest(g) AS b FROM tpl),
l AS (
  SELECT doc_id, CAST(unnest(range(len(ls))) AS INT) AS line, unnest(ls) AS t
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), lw AS (
  SELECT doc_id, line, list_filter(regexp_split_to_array(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+'), lambda x: x <> '') AS ws FROM l
), w AS (SELECT doc_id, line, unnest(range(len(ws))) AS k, unnest(ws) AS w FROM lw),
o AS (SELECT doc_id, line, w, row_number() OVER s - 1 AS p, lead(w) OVER s AS nxt FROM w WINDOW s AS (PARTITION BY doc_id ORDER BY line, k)),
g AS (SELECT doc_id, line, p, w || ' ' || nxt AS b FROM o WHERE nxt IS NOT NULL),
hit AS (SELECT doc_id, line, p, i, license, low, high, m FROM g JOIN tb USING (b)),
span AS (
  SELECT a.doc_id, a.line, a.p AS p, z.p AS q, a.i, a.license, a.m
  FROM hit a JOIN hit z ON a.doc_id = z.doc_id AND a.i = z.i AND z.p - a.p + 1 BETWEEN a.low AND a.high
), win AS (
  SELECT s.doc_id, s.line, s.p, s.q, s.i, s.license, 2.0::DOUBLE * count(DISTINCT tb.b) / (count(DISTINCT g.b) + s.m) AS dice
  FROM span s JOIN g ON g.doc_id = s.doc_id AND g.p BETWEEN s.p AND s.q LEFT JOIN tb ON tb.i = s.i AND tb.b = g.b
  GROUP BY s.doc_id, s.line, s.p, s.q, s.i, s.license, s.m
), word AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, p ORDER BY dice DESC, license, q) AS r FROM win WHERE dice >= 0.8) WHERE r = 1
), line AS (
  SELECT * FROM (SELECT * EXCLUDE r, row_number() OVER (PARTITION BY doc_id, line, license ORDER BY dice DESC, p) AS r FROM word) WHERE r = 1
)
SELECT x.doc_id, x.line, x.license, x.dice, CAST(x.p AS INT) AS begin, CAST(x.q - x.p + 2 AS INT) AS n_words
FROM (SELECT *, unnest(range(p, q + 2)) AS word FROM line) x
LEFT JOIN line y ON y.doc_id = x.doc_id AND y.license = x.license AND y.dice > x.dice AND x.word BETWEEN y.p AND y.q + 1
GROUP BY x.doc_id, x.line, x.license, x.dice, x.p, x.q HAVING bool_or(y.p IS NULL)
"""


@query("op5_license_scan", _license_sql())
def op5(spark, d):
    return licenses.scan(table(spark, d, "documents").select("doc_id", "text"))


#: The listed rules, longest first in force.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query(
    "op8_url_filters",
    r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
r AS (SELECT page_id, u, CASE WHEN instr(u, '://') > 0 THEN substr(u, instr(u, '://') + 3) ELSE '' END AS rest FROM p),
h AS (SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules(rule, verdict) AS (VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')),
k AS (SELECT rule, verdict, regexp_extract(rule, '^[^/]*') AS rh, regexp_extract(rule, '^[^/]*(.*)$', 1) AS rp FROM rules),
f AS (SELECT page_id, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, rule) AS n
  FROM h JOIN k ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
t AS (SELECT page_id, list_distinct(
    list_transform(list_filter(regexp_split_to_array(host, '[.-]'), lambda x: x <> ''), lambda x: 'h:' || x)
    || list_transform(list_filter(regexp_split_to_array(translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[/._-]+'), lambda x: x <> ''), lambda x: 'p:' || x)
    || list_transform(list_filter(list_transform(string_split(regexp_extract(u, '^[^?#]*\?([^#]*)', 1), '&'), lambda q: regexp_extract(q, '^[^=]*')), lambda x: x <> ''), lambda x: 'q:' || x)
  ) AS ts FROM h),
l AS (SELECT page_id, coalesce(quality = 0 OR toxic = 1, false) AS bad FROM labels JOIN t ON doc_id = page_id),
e AS (SELECT page_id, unnest(ts) AS x FROM t),
b AS (SELECT e.page_id, x FROM e JOIN l USING (page_id) WHERE bad),
often1 AS (SELECT x FROM b GROUP BY x HAVING count(*) >= 5),
bt AS (SELECT page_id, list(x ORDER BY x) AS ts FROM b JOIN often1 USING (x) GROUP BY page_id),
subsets AS (SELECT ts, unnest(range(1, CAST(2 ** len(ts) AS BIGINT))) AS mask FROM bt),
often AS (SELECT list_filter(ts, lambda x, i: (mask >> CAST(i - 1 AS INT)) & 1 = 1) AS s, count(*) AS c FROM subsets GROUP BY 1 HAVING count(*) >= 5),
conf AS (SELECT s, c, (SELECT count(*) FROM l JOIN t USING (page_id) WHERE list_has_all(ts, s)) AS n FROM often),
good AS (SELECT s FROM conf WHERE c >= 0.8::DOUBLE * n),
m AS (SELECT DISTINCT page_id FROM t JOIN good ON list_has_all(ts, s))
SELECT h.page_id, host, path, rule, coalesce(verdict, CASE WHEN m.page_id IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN (SELECT * FROM f WHERE n = 1) f ON h.page_id = f.page_id LEFT JOIN m ON h.page_id = m.page_id
""",
)
def op8(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    return urls.judge(pages, table(spark, d, "labels"), URL_RULES)


def _words_sql(text: str, apart: str) -> str:
    """The words of a text in DuckDB, A-Z in lower case; ``apart`` is what no word holds."""
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"list_filter(regexp_split_to_array({lower}, '{apart}+'), lambda x: x <> '')"


_NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]"


@query(
    "op11_importance",
    rf"""
WITH d AS (SELECT doc_id, {_words_sql("text", _NO_WORD)} AS ws FROM documents),
dw AS (SELECT doc_id, unnest(ws) AS w FROM d),
bw AS (SELECT unnest({_words_sql("text", _NO_WORD)}) AS w FROM benchmark),
tbl AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS i))),
words AS (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM bw)),
bytes AS (SELECT w, list_transform(range(CAST(octet_length(encode(w)) AS BIGINT)), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT)) AS bs FROM words),
crc AS (SELECT w, xor(list_reduce(list_concat([4294967295], bs), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, tbl),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN crc USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN crc USING (w) GROUP BY bucket),
g AS (SELECT s.bucket, CAST(floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT count(*) FROM dw) + 10000))::DOUBLE / ((s + 1) * ((SELECT count(*) FROM bw) + 10000))::DOUBLE)) AS BIGINT) AS gain
  FROM s LEFT JOIN t ON s.bucket = t.bucket),
w AS (SELECT doc_id, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM dw JOIN crc USING (w) JOIN g USING (bucket) GROUP BY doc_id),
f AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
  CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN w ON d.doc_id = w.doc_id),
e AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM f),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM e WHERE n_features >= 20)
SELECT e.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM e LEFT JOIN r ON e.doc_id = r.doc_id
""",
)
def op11(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return importance.resample(docs, table(spark, d, "benchmark")).withColumnRenamed("id", "doc_id")


_NO_TERM = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"


@query(
    "op12_lexical_search",
    rf"""
WITH d AS (SELECT doc_id, {_words_sql("text", _NO_TERM)} AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS t FROM d),
c AS (SELECT doc_id, t, count(*) AS tf FROM w GROUP BY doc_id, t),
a AS (SELECT count(*) AS docs, CAST(sum(len(ws)) AS BIGINT) AS words FROM d WHERE len(ws) > 0),
m AS (SELECT doc_id, 25 + (75 * len(ws) * docs) // words AS m FROM d, a WHERE len(ws) > 0),
i AS (SELECT item_id, unnest({_words_sql("text", _NO_TERM)}) AS t FROM benchmark),
f AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM c, a GROUP BY t, docs),
s AS (SELECT item_id, c.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN f USING (t) JOIN c USING (t) JOIN m ON c.doc_id = m.doc_id GROUP BY item_id, c.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= 10
""",
)
def op12(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return lexical.search(docs, table(spark, d, "benchmark")).withColumnRenamed("id", "doc_id")


@query(
    "op13_minhash",
    rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_BLANKS_SQL}+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) BETWEEN 1 AND 2 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS node, doc_id AS root FROM d UNION SELECT l.b, r.root FROM r JOIN l ON r.node = l.a)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, min(root) AS component_id, s.doc_id = min(root) AS kept
FROM s JOIN r ON s.doc_id = r.node GROUP BY s.doc_id, g
""",
)
def op13(spark, d):
    out = minhash.near_sets(table(spark, d, "documents").select("doc_id", "text"))
    return out.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )
