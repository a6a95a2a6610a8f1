"""Importance resampling and ranked search: tables of every kind, blocks, ties and long words."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from quarry.llm import bytewords, importance, lexical

CLASH = "id t n n_words n_features weight score rank place down last bucket row_index bag m h nth ids item term x".split()
NOT_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(NOT_LETTERS, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def features(text, sizes):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, sizes + 1) for i in range(len(w) - n + 1)]


def some_rows(seed=4, n=60):
    rng = random.Random(seed)
    vocabulary = [f"{rng.choice(['Wort', 'mot', 'ñandú', '漢字', 'x'])}{rng.randrange(12)}" for _ in range(40)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))) for i in range(n)]
    rows += [(100, rows[3][1]), (101, rows[3][1].upper()), (101, rows[3][1]), (102, None), (103, ""), (104, ". , -"), (None, rows[5][1])]
    return rows + [(105, "w" * 300 + " " + "é" * 100 + " x1 x2 " * 20)]


def table(spark, rows, name="doc_id"):
    df = spark.createDataFrame(rows, f"{name} long, text string")
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASH])


def test_crc_of_spans(monkeypatch):
    crc = bytewords.Crc()
    rng = random.Random(1)
    texts = [None, "", "a" * 200, "é" * 33 + " x", "   ", "z" * 64, "z" * 65, "z" * 128, "z" * 129]
    texts += ["".join(rng.choice("abzXYZ019 .,\n-é漢ñ") for _ in range(rng.choice([1, 5, 70, 300, 3000]))) for _ in range(100)]
    for part, span in ((1 << 22, 1 << 20), (100, 100), (1, 1)):
        monkeypatch.setattr(bytewords, "SPAN_BYTES", span)
        for size in (1, 2, 3):
            got = {}
            for row, body, offsets in bytewords.texts(pa.array(texts), part):
                body = bytewords.LOWERED[body]
                joined, at, n, own = bytewords.runs(body, *bytewords.word_spans(body, offsets), size)
                found, ends = crc(joined, at, n), own.cumsum()
                got |= {row + k: found[e - m : e].tolist() for k, (e, m) in enumerate(zip(ends, own))}
            for i, t in enumerate(texts):
                w = words(t)
                assert got[i] == [zlib.crc32(" ".join(w[k : k + size]).encode()) for k in range(len(w) - size + 1)]


def resampled(rows, targets, sizes, buckets, least, percent, seed):
    place = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(map(place, features(x, sizes)))
    for _, x in targets:
        t.update(map(place, features(x, sizes)))
    total = [sum(c.values()) + buckets for c in (s, t)]
    gain = [math.floor(1000 * math.log((t[b] + 1) * total[0] / ((s[b] + 1) * total[1]))) for b in range(buckets)]
    out = []
    for i, x in rows:
        f = features(x, sizes)
        weight = sum(gain[place(y)] for y in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(x))))
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = fit[: len(fit) * percent // 100]
    ranks = Counter()
    got = []
    for k, r in enumerate(drawn):
        got.append((*r[:4], k + 1))
        ranks[r] += 1
    for r in out:
        if ranks[r]:
            ranks[r] -= 1
        else:
            got.append((*r[:4], None))
    return sorted(got, key=str)


def test_importance(spark):
    rows, targets = some_rows(), some_rows(9, 12)
    docs, wanted = table(spark, rows), table(spark, targets, "item_id")
    for sizes, least, percent in ((1, 20, 10), (2, 0, 60), (3, 5, 100)):
        got = importance.resample(docs, wanted, sizes=sizes, buckets=50, least_words=least, percent=percent)
        assert got.columns == ["id", "n_features", "weight", "score", "rank"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == resampled(rows, targets, sizes, 50, least, percent, 2024)
    assert importance.resample(docs.filter("false"), wanted).count() == 0
    assert importance.resample(docs, wanted.filter("false")).count() == len(rows)


def ranked(rows, items, top=10):
    own = [words(t) for _, t in rows]
    docs, total = sum(map(bool, own)), sum(map(len, own))
    df = Counter(t for w in own for t in set(w))
    out = []
    for item, text in items:
        found = []
        for (i, _), w in zip(rows, own):
            if not w:
                continue
            m, tf, score = 25 + (75 * len(w) * docs) // total, Counter(w), 0
            for t in words(text):
                if tf[t]:
                    score += math.floor(1000 * math.log((2 * docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score:
                found.append((score, i))
        found.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, k + 1, i, s) for k, (s, i) in enumerate(found[:top])]
    return sorted(out, key=str)


def test_search(spark, monkeypatch):
    rows = some_rows() + [(200 + i, "x1 x2 tie") for i in range(25)]
    items = some_rows(9, 12)[:20] + [(50, "tie tie absent"), (50, "nowhere"), (None, "x1 x2"), (51, "w" * 300)]
    docs, tests = table(spark, rows), table(spark, items, "item_id")
    want = ranked(rows, items)
    names = ["item_id", "rank", "id", "score"]
    got = lexical.search(docs, tests)
    assert got.columns == names and dict(got.dtypes)["rank"] == "int"
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    # small blocks, sheets and products
    monkeypatch.setattr(lexical, "SHEET_ITEMS", 3)
    monkeypatch.setattr(lexical, "SHEET_CELLS", 64)
    got = lexical.search(docs.repartition(3), tests, block_words=400)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert lexical.search(docs.filter("false"), tests).count() == 0
    none = lexical.search(docs, tests.filter("false"))
    assert none.count() == 0 and none.columns == names


def test_search_by_string_ids(spark):
    docs = spark.createDataFrame([("b", "red fox"), ("a", "red fox"), (None, "red fox"), ("c", "blue")], "doc_id string, text string")
    tests = spark.createDataFrame([("q", "fox")], "item_id string, text string")
    got = [(r["item_id"], r["rank"], r["id"]) for r in lexical.search(docs, tests).orderBy("rank").collect()]
    assert got == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, None)]
