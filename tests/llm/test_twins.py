"""Each query of the pipeline operators against its SQL twin or a brute-force version, whole tables."""

import base64
import collections
import hashlib
import itertools
import math
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash

from quarry.llm import secrets
from quarry.llm.queries import QUERIES, SQL, URL_RULES  # noqa: F401

TABLES = "documents labels pages benchmark".split()
BLANK = " \t\n\x0b\f\r"


@pytest.fixture(scope="module")
def duck(data_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data_dir}/{t}.parquet'")
    return con


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_twin(spark, duck, data_dir, name):
    df = QUERIES[name](spark, data_dir)
    cols = sorted(df.columns)
    cur = duck.execute(SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    want = sorted((tuple(r[names.index(c)] for c in cols) for r in cur.fetchall()), key=str)
    assert rows_of(df.select(*cols)) == want


def test_every_query_has_a_check():
    assert set(QUERIES) == set(SQL) | {"op4_simhash", "op6_decontamination", "op9_token_counts", "op10_secret_scan"}


def simhash_of(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > n)


def groups_of(prints, radius):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in prints}


def test_simhash_against_all_pairs(spark, duck, data_dir):
    docs = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    prints = {i: simhash_of(t) for i, t in docs}
    group = groups_of(prints, 4)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op4_simhash"](spark, data_dir).collect()}
    assert got == {i: (f"{prints[i]:016x}", group[i]) for i in prints}


def test_warc_round_trip(spark, duck, data_dir):
    pages = duck.execute("SELECT page_id, coalesce(html, '') FROM pages").fetchall()
    first = {}
    for i, h in pages:
        first[h] = max(i, first.get(h, i))
    want = []
    for i, h in pages:
        body = h.encode()
        again = first[h] != i
        want.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", first[h] if again else None))
    assert rows_of(QUERIES["op7_warc"](spark, data_dir)) == sorted(want, key=str)


def test_token_counts_are_the_library_s(spark, duck, data_dir):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for i, t in duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall():
        n = len(sp.encode(t))
        want.append((i, len(t.encode()), n, n > 4096))
    assert rows_of(QUERIES["op9_token_counts"](spark, data_dir)) == sorted(want, key=str)


def known_shapes(text):
    out = [(0, *m.span()) for m in re.finditer(secrets.ASSIGN, text, re.I | re.A) if len(m[2]) >= 8]
    out += [(1, *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(2, *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda x: (x[1], x[0]))


def test_secret_scan_base(spark, duck, data_dir):
    got = {r["doc_id"]: r for r in QUERIES["op10_secret_scan"](spark, data_dir).collect()}
    docs = duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()
    assert len(got) == len(docs)
    for i, t in docs:
        base = known_shapes(t)
        spelled = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for k, s, e in base)
        r = got[i]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(b[0] == k for b in base) for k in range(3))
        assert r["base_sha256"] == hashlib.sha256(spelled.encode()).hexdigest()
        assert set(filter(None, spelled.split(","))) <= set(r["spans"].split(","))


def test_secret_scan_random(spark, duck, data_dir):
    """All spans against plain Python over the whole table: pieces, letters of the corpus, step-up control."""
    docs = duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()
    counts = collections.Counter(c for _, t in docs for c in t)
    sizes = [20, 32, 48, 64, 128]

    def p_of(body, alphabet):
        among = secrets.ALPHABETS[9] if alphabet == secrets.ALPHABETS[0] else alphabet
        total = sum(counts[c] + 1 for c in among)
        log = {c: math.log((counts[c] + 1) / total) for c in among}
        mean = sum(math.exp(x) * x for x in log.values())
        sd = math.sqrt(sum(math.exp(x) * (x - mean) ** 2 for x in log.values()))
        return 0.5 * math.erfc((mean * len(body) - sum(log[c] for c in body)) / (sd * math.sqrt(2 * len(body))))

    tests = []
    for i, t in docs:
        known = known_shapes(t)
        for run in re.finditer(r"[A-Za-z0-9+/_=-]+", t):
            for m in re.finditer("[^=]+(=+$)?", run[0]):
                s, e, body = run.start() + m.start(), run.start() + m.end(), m[0].rstrip("=")
                if len(body) < 20 or any(a <= s and e <= b for _, a, b in known):
                    continue
                alphabet = next(a for a in secrets.ALPHABETS if set(body) <= set(a))
                values = np.array([alphabet.index(c) for c in body])
                step = math.floor(-math.log10(max(p_of(body, alphabet), 1e-300)) * 100)
                random = 3 * min(secrets.battery(values, alphabet)) >= 0.01
                tests.append((sum(len(body) >= z for z in sizes), step, random, i, s, e))
    want = collections.defaultdict(list)
    for k in range(1, 6):
        own = sorted((x for x in tests if x[0] == k), key=lambda x: -x[1])
        good = [x[1] for n, x in enumerate(own, 1) if 10 ** (-x[1] / 100) <= 0.01 * n / len(own)]
        for _, step, random, i, s, e in own:
            if random and good and step >= min(good):
                want[i].append((3, s, e))
    got = {r["doc_id"]: r["spans"] for r in QUERIES["op10_secret_scan"](spark, data_dir).collect()}
    for i, t in docs:
        every = sorted(known_shapes(t) + want[i], key=lambda x: (x[1], x[0]))
        assert got[i] == ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for k, s, e in every)


def local_alignment(a, b):
    """Best score of aligning two word lists, cell by cell."""
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            same = 2 if a[i - 1] == b[j - 1] else -1
            h[i][j] = max(0, h[i - 1][j - 1] + same, h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h), default=0)


def test_decontamination_against_whole_alignment(spark, duck, data_dir):
    """Every document is aligned in full with every item it shares a three-word run with."""
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    items = {i: words(t) for i, t in duck.execute("SELECT item_id, text FROM benchmark").fetchall()}
    runs = {i: set(zip(w, w[1:], w[2:])) for i, w in items.items()}
    want = {}
    for d, t in duck.execute("SELECT doc_id, text FROM documents").fetchall():
        w = words(t)
        have = set(zip(w, w[1:], w[2:]))
        for i, own in runs.items():
            if len(own & have) >= 3:  # at a similarity of 0.5, fewer in common is out of reach here
                s = local_alignment(items[i], w) / (2 * len(items[i]))
                if s >= 0.5:
                    want[d, i] = round(s, 6)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in QUERIES["op6_decontamination"](spark, data_dir).collect()}
    assert got == want and want
