"""MinHash near-dedup against all pairs: crowds, tiles, chains and rows of every kind."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import minhash


def shingles(text, size=3):
    w = (text or "").lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def groups(rows, percent=85):
    """Component of every row by brute force, rows as (id, text)."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [shingles(t) for _, t in rows]
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(b)] = find(a)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)]


def edited(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(words)), n):
        out[at] = f"x{rng.randrange(10**6)}"
    return out


def crowd():
    """A text with copies near and just beyond the limit, copies of copies, pairs, and texts of one phrase."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**5)}"
    centre = [word() for _ in range(120)]
    texts = [centre]
    for _ in range(60):
        near = edited(rng, centre, rng.choice([1, 2, 3, 4]))
        texts += [near, edited(rng, near, 2)]
    phrase = [word() for _ in range(90)]
    texts += [phrase + [word() for _ in range(rng.choice([8, 30, 60]))] for _ in range(30)]
    for _ in range(30):
        own = [word() for _ in range(rng.choice([3, 20, 60, 200]))]
        texts += [own, edited(rng, own, max(1, len(own) // 40))]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_crowd(spark):
    rows = crowd()
    got = minhash.near_sets(table(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(groups(rows))


def test_small_tiles(spark, monkeypatch):
    """Keys and groups cut into many tiles give the same components."""
    monkeypatch.setattr(minhash, "TILE_ROWS", 6)
    monkeypatch.setattr(minhash, "TILE_SHINGLES", 3000)
    monkeypatch.setattr(minhash, "CELLS", 1 << 12)
    rows = crowd()
    assert sorted(map(tuple, minhash.near_sets(table(spark, rows)).collect())) == sorted(groups(rows))


def test_second_round_alone(spark, monkeypatch):
    """Without leaders, signatures and sets of the tiles find the same links."""
    monkeypatch.setattr(minhash, "TILE_ROWS", 6)
    monkeypatch.setattr(minhash, "TILE_SHINGLES", 3000)
    real = minhash._with_leader
    monkeypatch.setattr(minhash, "_with_leader", lambda *a: real(*a).filter("false"))
    rows = crowd()
    assert sorted(map(tuple, minhash.near_sets(table(spark, rows)).collect())) == sorted(groups(rows))


def test_rows_of_every_kind(spark):
    long = " ".join(f"long{i}" for i in range(150_000))
    rows = [
        (1, "One two three four"),
        (2, "one TWO\tthree\n four"),
        (2, "one TWO\tthree\n four"),
        (2, "another text of the same id altogether"),
        (None, "another text of the same id altogether"),
        (None, "only nulls hold this text of words"),
        (3, None),
        (4, ""),
        (4, " \n\t"),
        (5, "two words"),
        (6, "Two words"),
        (7, "word"),
        (8, "İ ſ K É"),
        (9, "i̇ s k é"),
        (10, long),
        (11, long + " more"),
        (12, "w" * 500 + " of many letters"),
        (13, "w" * 500 + " of many letters"),
    ]
    clash = "id rk t n digest keys sig node s comp root group side k key crowd best leader a b".split()
    df = table(spark, rows).select("*", *[F.lit(f"extra {c}").alias(c) for c in clash])
    got = sorted((tuple(r) for r in minhash.near_sets(df).collect()), key=key)
    want = {tuple(x) for x in groups([r for r in rows if r[0] not in (8, 9)])}
    assert set(got) == want | {(8, 2, 8), (9, 2, 9)}  # only A-Z fold
    assert len(got) == len(rows)
    empty = minhash.near_sets(df.filter("false"))
    assert empty.count() == 0 and empty.columns == ["id", "n_shingles", "component"]


def test_string_ids(spark):
    df = spark.createDataFrame([("b", "one two three four"), ("a", "one two three four"), ("c", None)], "doc_id string, text string")
    assert sorted(map(tuple, minhash.near_sets(df).collect())) == [("a", 2, "a"), ("b", 2, "a"), ("c", 0, "c")]


def test_minima_agree_as_often_as_sets():
    rng = np.random.default_rng(1)
    minima = minhash.Minima()
    for share in (0.3, 0.85):
        hits = []
        for _ in range(40):
            both = rng.integers(0, 1 << 63, 600, np.uint64)
            cut = round(600 * (1 - share) / 2)
            sig = minima(np.concatenate([both[cut:], both[: 600 - cut]]), np.array([600 - cut] * 2))
            hits.append((sig[0] == sig[1]).mean())
        assert np.mean(hits) == pytest.approx(share, abs=0.03)
    assert minhash.least_agreement(85) == 82


def test_sets_in_parts(monkeypatch):
    texts = [None, "a b c d", "", "A b", "x " * 50, "É a b"] * 3
    want = [len(shingles(t)) for t in texts]
    for size in (1 << 19, 1):
        monkeypatch.setattr(minhash, "PART_BYTES", size)
        got = [0] * len(texts)
        for row, held, sizes in minhash.ShingleSets(3)(pa.array(texts)):
            assert len(held) == sizes.sum()
            got[row : row + len(sizes)] = sizes.tolist()
        assert got == want
