import itertools

import numpy as np
import pandas as pd
import pytest

from quarry.operators import approximate, describe, folds, pairs, reduce, similarity, text
from test_pairs import cloud, frame


def recall(spark, df, k=5, **options):
    want = {(r["query_id"], r["neighbor_id"]) for r in pairs.nearest_neighbours(df, df, k, include_self=False).collect()}
    rows = approximate.approximate_neighbours(df, df, k, include_self=False, **options).collect()
    got = {(r["query_id"], r["neighbor_id"]): r for r in rows}
    assert len(got) == len(rows) and max(r["rank"] for r in rows) <= k
    return len(want & set(got)) / len(want), rows


def test_recall_on_vectors_without_structure(spark):
    e = pd.read_parquet("/root/testdata/sf0.01/embeddings.parquet")
    x = np.array(e.embedding.tolist(), float)
    share, rows = recall(spark, frame(spark, x))
    assert share >= 0.9
    for r in rows[:200]:  # distances are measured, not estimated
        assert r["distance"] == pytest.approx(np.linalg.norm(x[r["query_id"]] - x[r["neighbor_id"]]))


@pytest.mark.parametrize("kind", ["blobs", "copies"])
def test_recall_in_cut_groups(spark, tiny_broadcast, kind):
    """A third of all rows in one bucket: the group is cut on both sides, nothing is lost."""
    x = cloud(kind, 260)
    share, rows = recall(spark, frame(spark, x), tables=6, probes=16)
    if kind == "copies":  # equal distances: compare these instead of ids
        d = np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) + np.diag(np.full(len(x), np.inf)), axis=1)
        share = np.mean([r["distance"] <= d[r["query_id"], r["rank"] - 1] + 1e-9 for r in rows])
    assert share >= 0.9


@pytest.mark.parametrize("blocks", [1, 16])
def test_a_query_travels_once_to_a_group(spark, tiny_broadcast, monkeypatch, blocks):
    """The same rows whatever the groups; fewer copies of a query than it has probes."""
    monkeypatch.setattr(pairs, "CHUNK", 1_600)  # pieces of 100 rows
    df = frame(spark, cloud("blobs", 260))
    written, cut = {}, approximate.cut_lineage

    def counted(rows, stem):
        done = cut(rows, stem)
        written[stem] = done.count()
        return done

    monkeypatch.setattr(approximate, "cut_lineage", counted)
    monkeypatch.setattr(approximate, "GROUP_BLOCKS", blocks)
    rows = approximate.approximate_neighbours(df, df, 5, include_self=False, tables=6, probes=16).collect()
    monkeypatch.setattr(approximate, "GROUP_BLOCKS", 1_000)  # no group is cut
    whole = approximate.approximate_neighbours(df, df, 5, include_self=False, tables=6, probes=16).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, whole))
    assert written["buckets"] == 260 * 6 and written["probes"] == 260 * 6  # one group a table
    monkeypatch.setattr(approximate, "GROUP_BLOCKS", blocks)
    list(approximate.approximate_neighbours(df, df, 5, tables=6, probes=16).limit(1).collect())
    assert written["probes"] <= 260 * 6 * (16 if blocks == 1 else 2) and (blocks > 1 or written["probes"] < 260 * 6 * 12)


def test_repeated_rows_crowd_nothing_out(spark):
    x = cloud("flat", 60)
    df = frame(spark, x)
    rows = approximate.approximate_neighbours(df.union(df), df.union(df), 5, bits=1, probes=2, tables=1).collect()
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], {})[r["rank"]] = r["neighbor_id"]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    assert all(got[i] == dict(enumerate(np.argsort(d[i], kind="stable")[:5], 1)) for i in range(60))


def test_approximate_edges(spark):
    one = frame(spark, [[1.0, 2.0]])
    assert [tuple(r) for r in approximate.approximate_neighbours(one, one, 3).collect()] == [(0, 1, 0, 0.0)]
    assert approximate.approximate_neighbours(one, one.filter("false"), 3).count() == 0
    same = frame(spark, [[1.0, 1.0]] * 30)
    assert approximate.approximate_neighbours(same, same, 2).count() == 60


def test_similar_sets(spark):
    rng = np.random.default_rng(2)
    sets = {}
    for i in range(60):
        base = [f"t{v}" for v in rng.integers(0, 5_000, 40)]
        sets[f"a{i:02}"], other = set(base), list(base)
        for at in rng.choice(40, rng.integers(0, 9), replace=False):
            other[at] = f"n{rng.integers(0, 10**6)}"
        sets[f"b{i:02}"] = set(other)
    rows = [(k, t) for k, s in sets.items() for t in s] * 2 + [("a00", None), (None, "t1")]
    df = spark.createDataFrame(rows, "doc string, word string")
    for limit in (80, 95):
        got = {(r["a"], r["b"]): r["sim"] for r in approximate.similar_sets(df, limit, "doc", "word").collect()}
        want = {}
        for a, b in itertools.combinations(sorted(sets), 2):
            both, whole = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if 100 * both >= limit * whole:
                want[a, b] = both / whole
        assert want and got == pytest.approx(want)
    assert approximate.similar_sets(df.filter("false"), 80, "doc", "word").count() == 0


def test_similar_sets_of_many_copies(spark, monkeypatch):
    """Equal sets are compared as one, near ones in blocks that a set travels to once; all pairs come out."""
    sets = {i: {f"t{v}" for v in range(30)} for i in range(40)}
    sets |= {100 + i: {f"t{v}" for v in range(30)} - {f"t{i}"} for i in range(12)}
    sets |= {200 + i: {f"u{i}-{v}" for v in range(9)} for i in range(4)} | {300 + i: {f"u{i}-{v}" for v in range(9)} for i in range(4)}
    df = spark.createDataFrame([(k, t) for k, s in sets.items() for t in s], "doc long, word string")
    compared, write = [], approximate.cut_lineage
    monkeypatch.setattr(approximate, "SET_BLOCK", 5, raising=False)
    monkeypatch.setattr(approximate, "cut_lineage", lambda x, stem: compared.append(x.count() if stem == "maybe" else 0) or write(x, stem))
    got = {(r["a"], r["b"]): r["sim"] for r in approximate.similar_sets(df, 80, "doc", "word").collect()}
    want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(sorted(sets), 2)}
    assert got == pytest.approx({k: v for k, v in want.items() if v >= 0.8})
    assert sum(compared) <= 13 * 12 // 2


def test_similar_sets_write_no_table_of_pairs(spark, monkeypatch):
    """A crowd of near copies: no working table grows with its pairs, and all of them come out, by products and one by one."""
    sets = {i: {f"t{v}" for v in range(60)} - {f"t{i % 60}"} | {f"own{i}"} for i in range(200)}
    sets |= {300 + i: {f"t{v}" for v in range(40)} | {f"u{i}"} for i in range(3)}  # too small to be alike, bands shared
    df = spark.createDataFrame([(k, t) for k, s in sets.items() for t in s], "doc long, word string")
    rows, write = [], approximate.cut_lineage

    def watch(x, stem):
        out = write(x, stem)
        rows.append(out.count())
        return out

    monkeypatch.setattr(approximate, "cut_lineage", watch)
    monkeypatch.setattr(approximate, "SET_BLOCK", 90)
    monkeypatch.setattr(approximate, "SET_COLUMNS", 16, raising=False)
    got = {(r["a"], r["b"]): r["sim"] for r in approximate.similar_sets(df, 80, "doc", "word").collect()}
    want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(sorted(sets), 2)}
    want = {k: v for k, v in want.items() if v >= 0.8}
    assert got == pytest.approx(want) and len(want) > 19_000
    assert max(rows) < 2 * approximate.BANDS * len(sets) < len(want)


@pytest.mark.parametrize("method", ["cos", "cor"])
def test_similar_pairs_in_cells(spark, tiny_broadcast, method):
    x = np.vstack([cloud("blobs", 120), [[0, 0, 0]], [[2, 2, 2]]])
    df = frame(spark, x)
    c = x - x.mean(1, keepdims=True) if method == "cor" else x
    with np.errstate(invalid="ignore"):
        u = c / np.linalg.norm(c, axis=1)[:, None]
    sim = u @ u.T
    got = {(r["x_id"], r["y_id"]): r["sim"] for r in similarity.similar_pairs(df, df, 0.97, method).collect()}
    sure = {(i, j) for i, j in zip(*np.nonzero(sim >= 0.97 + 1e-9))}
    assert sure <= set(got) and len(got) - len(sure) <= (sim >= 0.97 - 1e-9).sum() - len(sure)
    assert all(s == pytest.approx(sim[p], abs=1e-9) for p, s in got.items())
    best = similarity.most_similar(df, df, 2, method).collect()
    assert {r["x_id"] for r in best} == {i for i in range(len(x)) if np.isfinite(u[i]).all()}
    for r in best:
        assert r["sim"] == pytest.approx(np.sort(sim[r["x_id"]][np.isfinite(sim[r["x_id"]])])[-r["rank"]], abs=1e-9)
    with pytest.raises(ValueError):
        similarity.similar_pairs(df, df, 0.5, "jaccard")


def test_values_without_a_bin(spark):
    df = spark.createDataFrame([(0.0, 1.0), (4.0, 3.0), (float("nan"), 2.0), (None, 2.0), (1.0, None)], "a double, b double")
    got = [(r["bin"], r["left_edge"], r["cnt"]) for r in describe.histogram(df, "a", 4).orderBy("bin").collect()]
    assert got == [(0, 0.0, 1), (1, 1.0, 1), (2, 2.0, 0), (3, 3.0, 1)]
    assert describe.histogram2d(df.filter("false"), "a", "b", 3).count() == 0
    assert sum(r["cnt"] for r in describe.histogram2d(df, "a", "b", 3).collect()) == 2


def test_null_ids_are_in_a_fold(spark):
    df = spark.createDataFrame([(i,) for i in range(9)] + [(None,)], "id long")
    assert folds.kfold_shuffled(df, 3, "id").filter("fold is null").count() == 0
    assert folds.holdout(df, 0.5, "id").filter("is_test is null").count() == 0
    assert folds.repeated_holdout(df, 0.5, 2, "id").filter("is_test is null").count() == 0


def test_a_query_without_weight(spark):
    bag = spark.createDataFrame([(1, "a", 2), (2, "b", 0)], "doc_id long, term string, cnt long")
    assert {r["sim"] for r in text.rank_documents(bag, {"a": 0.0}).collect()} == {None}
    got = {r["doc_id"]: r["sim"] for r in text.rank_documents(bag, ["a"]).collect()}
    assert got == {1: 1.0, 2: None}


def test_the_sweep_projects_by_matrix(spark, monkeypatch):
    """Projection as expressions, one per component and column, took longer than the search."""
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (120, 6)) * [5, 4, 3, 1, 1, 1]
    rows = [(i, int(v[0] > 0), [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, label int, features array<double>")
    monkeypatch.setattr(reduce.Components, "project", None)
    got = {r["k"]: r["error"] for r in reduce.sweep_components(df.filter("id >= 40"), df.filter("id < 40"), [1, 6], "label", "id").collect()}
    near = 40 + ((x[:40, None] - x[None, 40:]) ** 2).sum(2).argmin(1)
    assert got[6] == pytest.approx(((x[near, 0] > 0) != (x[:40, 0] > 0)).mean())
    assert set(got) == {1, 6}
