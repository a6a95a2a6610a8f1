import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import density, hierarchy, pairs, similarity


def frame(spark, x, start=0):
    rows = [(i + start, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, features array<double>").repartition(5)


def cloud(kind, n=300):
    rng = np.random.default_rng(4)
    if kind == "blobs":
        c = rng.normal(0, 30, (6, 3))
        return c[rng.integers(0, 6, n)] + rng.normal(0, 1, (n, 3))
    if kind == "copies":  # a third of all rows is one point, far from the origin
        x = rng.integers(0, 5, (n, 2)).astype(float) + 1000
        x[: n // 3] = 1002.0
        return x
    return rng.normal(0, 1, (n, 8))


def brute(x, k, skip):
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    out = {}
    for i in range(len(x)):
        order = sorted((d2[i, j], j) for j in range(len(x)) if not (skip and i == j))[:k]
        out[i] = [(j, d) for d, j in order]
    return out


@pytest.mark.parametrize("kind", ["blobs", "copies", "flat"])
@pytest.mark.parametrize("skip", [False, True])
def test_neighbours_on_shuffled_plan(spark, tiny_broadcast, kind, skip):
    x = cloud(kind)
    df = frame(spark, x)
    got = {}
    for r in pairs.nearest_neighbours(df, df, 4, include_self=not skip).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["neighbor_id"], r["distance"] ** 2)
    want = brute(x, 4, skip)
    for i in range(len(x)):
        assert [got[i][r][0] for r in (1, 2, 3, 4)] == [j for j, _ in want[i]]
        np.testing.assert_allclose([got[i][r][1] for r in (1, 2, 3, 4)], [d for _, d in want[i]], atol=1e-9)


def test_plans_agree_for_new_queries(spark, tiny_broadcast):
    x, q = cloud("blobs", 200), cloud("flat", 50)[:, :3]
    a = pairs.nearest_neighbours(frame(spark, q), frame(spark, x), 6).collect()
    spark.conf.unset("quarry.broadcast.bytes")
    b = pairs.nearest_neighbours(frame(spark, q), frame(spark, x), 6).collect()
    key = lambda r: (r["query_id"], r["rank"])
    assert [(r["query_id"], r["neighbor_id"]) for r in sorted(a, key=key)] == [
        (r["query_id"], r["neighbor_id"]) for r in sorted(b, key=key)
    ]


@pytest.mark.parametrize("skip", [False, True])
def test_few_columns_go_by_cells(spark, monkeypatch, skip):
    """Rows that fit a copy are still not all measured against all: cells rule most of them out."""
    x = np.concatenate([np.random.default_rng(3).uniform(0, 100, (1_000, 2)), np.full((60, 2), 7.0)])
    df = frame(spark, x)
    monkeypatch.setattr(pairs, "BLOCK_ROWS", 40)
    met = []
    visit = pairs.visit_blocks

    def watched(queries, placed, cells, within, *rest, **named):
        dq = cells.distances(x)
        met.append((cells.reachable(dq, within(dq, None)) * cells.count).sum())
        return visit(queries, placed, cells, within, *rest, **named)

    monkeypatch.setattr(pairs, "visit_blocks", watched)
    got = {}
    for r in pairs.nearest_neighbours(df, df, 4, include_self=not skip).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["neighbor_id"], r["distance"])
    assert sum(met) and sum(met) < len(x) ** 2 / 3
    for i, want in brute(x, 4, skip).items():
        assert [got[i][k + 1][0] for k in range(4)] == [j for j, _ in want]
        np.testing.assert_allclose([got[i][k + 1][1] ** 2 for k in range(4)], [d for _, d in want], atol=1e-9)


@pytest.mark.parametrize("skip", [False, True])
def test_rows_closer_than_single_precision_tells(skip):
    rng = np.random.default_rng(8)
    base = rng.normal(0, 1, (6, 4))
    x = base[rng.integers(0, 6, 900)] + rng.normal(0, 1e-9, (900, 4))
    x[300:500] = x[300]  # a crowd: ties fall to the smaller id
    ids = rng.permutation(900)
    r, c, dist = pairs.block_nearest(ids[:200], x[:200] * 1.0, ids, x, 4, skip)
    for i in range(200):
        d = np.sqrt(((x[i] - x) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if not (skip and j == i)][:4]
        assert list(ids[c[r == i]]) == list(ids[order])
        np.testing.assert_array_equal(dist[r == i], d[order])


def test_a_crowd_is_settled_in_parts(monkeypatch):
    """Rows as near as the k-th are not all held to the end."""
    monkeypatch.setattr(pairs, "SLAB", 50)
    monkeypatch.setattr(pairs, "CHUNK", 1_000)
    seen, settle = [], pairs._truly_nearest
    monkeypatch.setattr(pairs, "_truly_nearest", lambda q, x, xid, r, c, k: seen.append(len(r)) or settle(q, x, xid, r, c, k))
    x, ids = np.ones((3_000, 2)), np.arange(3_000)[::-1]
    r, c, dist = pairs.block_nearest(ids[:30], x[:30], ids, x, 3, False)
    assert [sorted(ids[c[r == i]]) for i in range(30)] == [[0, 1, 2]] * 30 and not dist.any()
    assert max(seen) <= 3_000


def test_queries_of_one_file_go_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(pairs, "WORK_PER_TASK", 10_000)
    x, q = cloud("flat", 200), cloud("flat", 120)
    one = frame(spark, q, 1_000).coalesce(1)
    found = pairs.nearest_neighbours(one, frame(spark, x), 2)
    assert found.rdd.getNumPartitions() > 4
    assert found.count() == 240


def test_more_neighbours_than_rows(spark):
    df = frame(spark, cloud("flat", 5))
    assert pairs.nearest_neighbours(df, df, 9).count() == 25


def test_cells_skip_work(spark, tiny_broadcast):
    x = cloud("blobs")
    df = pairs.slim(frame(spark, x), "id", "features")
    _, cells = pairs.build_cells(df, len(x), 3, 3)
    dq = cells.distances(x)
    hit = cells.reachable(dq, cells.upper_bound(dq, 3))
    assert hit.mean() < 0.6


@pytest.mark.parametrize("kind", ["blobs", "copies"])
def test_kernel_density_on_shuffled_plan(spark, tiny_broadcast, kind):
    x = cloud(kind, 150)
    widths = [0.01, 0.5, 20.0]
    got = {(r["id"], r["width"]): r["log_density"] for r in density.kernel_density(frame(spark, x), widths).collect()}
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    np.fill_diagonal(d2, np.inf)
    for w in widths:
        e = -d2 / (2 * w)
        top = e.max(1)
        want = top + np.log(np.exp(e - top[:, None]).sum(1)) - np.log(len(x) - 1) - x.shape[1] / 2 * np.log(2 * np.pi * w)
        np.testing.assert_allclose([got[(i, w)] for i in range(len(x))], want, atol=1e-6)


@pytest.mark.parametrize("kind", ["normal", "heavy", "copies"])
def test_kernel_sums_on_the_line(spark, monkeypatch, kind):
    """Many rows of one column: no pair is measured, the sums are those of all pairs."""
    rng = np.random.default_rng(7)
    n = 3_000
    x = {"normal": rng.normal(4e5, 300, n), "heavy": rng.standard_cauchy(n), "copies": np.repeat(rng.normal(0, 1, 10), n // 10)}[kind]
    monkeypatch.setattr(pairs, "BLOCK_ROWS", 100)

    def refuse(*_):
        raise AssertionError("pairs were measured")

    monkeypatch.setattr(pairs, "block_kernel_sums", refuse)
    widths = [0.3 * np.std(x[np.abs(x - np.median(x)) < 1e3]) ** 2, 1e-3]
    sums, rows, _ = pairs.kernel_sums(frame(spark, x[:, None]), widths, skip_self=False)
    got = {r["id"]: np.exp(r["shift"]) * np.array(r["total"]) for r in sums.collect()}
    assert rows == n and len(got) == n
    for i in range(0, n, 7):
        want = [np.exp(-((x - x[i]) ** 2) / (2 * w)).sum() for w in widths]
        np.testing.assert_allclose(got[i], want, rtol=1e-9)


@pytest.mark.parametrize("kind", ["flat", "blobs"])
def test_a_row_travels_to_tiles(spark, tiny_broadcast, monkeypatch, kind):
    """Without structure a row goes to each of few tiles, not to each of many cells; far blobs still do not meet."""
    x = cloud(kind, 600)
    df = frame(spark, x)
    moved = []
    visit = pairs.visit_blocks

    def watched(*args, **named):
        blocks = visit(*args, **named)
        moved.append(sum(g._df.count() for g in (blocks._gd1, blocks._gd2)))
        return blocks

    monkeypatch.setattr(pairs, "visit_blocks", watched)
    got = {}
    for r in pairs.nearest_neighbours(df, df, 4).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["neighbor_id"]
    assert moved[0] <= 2 * len(x) * 10
    for i, want in brute(x, 4, False).items():
        assert [got[i][k + 1] for k in range(4)] == [j for j, _ in want]


def test_kernel_sums_of_halved_widths(monkeypatch):
    """Widths that halve cost one exponential a pair; the sums are those of each width by itself."""
    rng = np.random.default_rng(8)
    q, x = rng.normal(0, 1, (50, 6)), rng.normal(0, 1, (9_000, 6))
    widths = [0.7 * 2.0**p for p in range(-10, 3)]
    calls = []
    exp = np.exp
    monkeypatch.setattr(np, "exp", lambda v, **out: calls.append(np.size(v)) or exp(v, **out))
    top, got = pairs.block_kernel_sums(np.arange(50), q, np.arange(100, 9_100), x, widths, None, True)
    assert sum(calls) <= len(q) * len(x)
    d2 = ((q[:, None, :] - x[None, :, :]) ** 2).sum(2)
    for i, w in enumerate(widths):
        np.testing.assert_allclose(np.log(got[:, i]) + top[:, i], np.log(exp(-(d2 - d2.min(1)[:, None]) / (2 * w)).sum(1)) - d2.min(1) / (2 * w), rtol=1e-9)


@pytest.mark.parametrize("halved", [True, False])
def test_kernel_terms_that_change_nothing_are_not_carried_on(monkeypatch, halved):
    """On narrow widths only near pairs are still multiplied; blocks given a shift and blocks without give the same sums."""
    rng = np.random.default_rng(3)
    q, x = rng.normal(0, 1, (200, 32)), rng.normal(0, 1, (5_000, 32))
    x[:40] = q[:40] + 1e-3 * rng.normal(0, 1, (40, 32))  # near copies
    widths = [4.0 * (2.0 if halved else 2.2) ** p for p in range(-10, 3)]
    made, multiply = [], np.multiply
    monkeypatch.setattr(np, "multiply", lambda a, b, **out: made.append(np.size(a)) or multiply(a, b, **out))
    ids = np.arange(200), np.arange(100, 5_100)  # half of the queries stand in x under their id, and are left out
    top, got = pairs.block_kernel_sums(ids[0], q, ids[1], x, widths, None, True)
    assert sum(made) <= 7 * q.shape[0] * x.shape[0]
    d2 = ((q[:, None, :] - x[None, :, :]) ** 2).sum(2)
    d2[ids[0][:, None] == ids[1][None, :]] = np.inf
    near = d2.min(1)
    given = -near[:, None] / np.array([2 * w for w in widths])[None, :]
    halves = [pairs.block_kernel_sums(ids[0], q, ids[1][c], x[c], widths, given, True)[1] for c in (slice(0, 2_500), slice(2_500, None))]
    for i, w in enumerate(widths):
        want = np.log(np.exp(-(d2 - near[:, None]) / (2 * w)).sum(1)) + given[:, i]
        np.testing.assert_allclose(np.log(got[:, i]) + top[:, i], want, rtol=1e-8, atol=1e-8)
        np.testing.assert_allclose(np.log(halves[0][:, i] + halves[1][:, i]) + given[:, i], want, rtol=1e-8, atol=1e-8)


def test_kernel_sums_look_for_no_neighbours_where_all_rows_count(spark, tiny_broadcast, monkeypatch):
    """Beyond the copy bound, widths that reach every row need no nearest rows first; narrow ones are summed beside them."""
    rng = np.random.default_rng(12)
    x = rng.normal(0, 1, (150, 12))
    x[:9] = x[20:29] + 1e-3
    widths = [1.0 * 2.0**p for p in range(-10, 3)]

    def refuse(*_, **__):
        raise AssertionError("nearest rows were looked for")

    monkeypatch.setattr(pairs, "nearest_neighbours", refuse)
    got = {(r["id"], r["width"]): r["log_density"] for r in density.kernel_density(frame(spark, x), widths).collect()}
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    np.fill_diagonal(d2, np.inf)
    for w in widths:
        e = -d2 / (2 * w)
        top = e.max(1)
        want = top + np.log(np.exp(e - top[:, None]).sum(1)) - np.log(len(x) - 1) - 6 * np.log(2 * np.pi * w)
        np.testing.assert_allclose([got[(i, w)] for i in range(len(x))], want, atol=1e-8)


def test_similarity_on_shuffled_plan(spark, tiny_broadcast):
    x, y = cloud("flat", 60), cloud("flat", 70)[10:]
    got = {(r["x_id"], r["y_id"]): r["sim"] for r in similarity.similarity(frame(spark, x), frame(spark, y), "cos").collect()}
    want = (x @ y.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(y, axis=1)[None, :]
    assert len(got) == want.size
    np.testing.assert_allclose([got[(i, j)] for i in range(60) for j in range(60)], want.ravel(), atol=1e-12)


def test_invariances(spark):
    """Extended Jaccard, cosine and correlation under scaling and translation."""
    x = np.abs(cloud("flat", 4)) + 1
    y = np.abs(cloud("flat", 9)[4:]) + 1
    run = lambda a, b, m: np.array([r["sim"] for r in similarity.similarity(frame(spark, a), frame(spark, b), m).orderBy("x_id", "y_id").collect()])
    assert np.allclose(run(x, y, "cos"), run(2 * x, y, "cos"))
    assert not np.allclose(run(x, y, "ext"), run(2 * x, y, "ext"))
    assert np.allclose(run(x, y, "cor"), run(2 * x, y, "cor"))
    assert np.allclose(run(x, y, "cor"), run(x + 3, y, "cor"))
    assert not np.allclose(run(x, y, "cos"), run(x + 3, y, "cos"))


def test_zero_over_zero_is_null(spark):
    z = frame(spark, [[0.0, 0.0]])
    assert similarity.similarity(z, frame(spark, [[1.0, 2.0]]), "cos").first()["sim"] is None


def _single_link(x, t):
    d = np.sqrt(((x[:, None] - x[None, :]) ** 2).sum(2))
    groups = [{i} for i in range(len(x))]
    heights = []
    while len(groups) > 1:
        best = min((min(d[a, b] for a in g for b in h), i, j) for i, g in enumerate(groups) for j, h in enumerate(groups) if i < j)
        heights.append(best[0])
        if len(groups) == t:
            cut = [frozenset(g) for g in groups]
        groups[best[1]] |= groups.pop(best[2])
    return heights, set(cut)


@pytest.mark.parametrize("forced, kind", [(False, "blobs"), (True, "blobs"), (True, "copies"), (True, "flat")])
def test_single_linkage(spark, forced, kind, request):
    if forced:
        request.getfixturevalue("tiny_broadcast")
    x = cloud(kind, 130)
    heights, want = _single_link(x, 4)
    tree = hierarchy.spanning_tree(frame(spark, x))
    got = [r["height"] for r in hierarchy.linkage_table(tree).orderBy("merge").collect()]
    np.testing.assert_allclose(got, heights, atol=1e-9)
    sets = {}
    for r in hierarchy.cut_tree(frame(spark, x), tree, 4).collect():
        sets.setdefault(r["cluster"], set()).add(r["id"])
    if kind != "copies":  # equal heights may be cut in any order
        assert {frozenset(s) for s in sets.values()} == want


@pytest.mark.parametrize("kind", ["spread", "copies", "one", "close"])
def test_single_linkage_on_the_line(spark, tiny_broadcast, monkeypatch, kind):
    """Rows of one column: trees of intervals and their borders are the tree, without rounds over its edges."""
    rng = np.random.default_rng(5)
    x = {
        "spread": rng.normal(0, 50, 300) ** 3,
        "copies": rng.integers(0, 60, 300) / 7.0,
        "one": np.full(300, -3.5),
        "close": 1e8 + rng.permutation(300) * 2.0**-20 * np.repeat([1, 5], 150),
    }[kind]

    def refuse(*_):
        raise AssertionError("the tree needs no rounds")

    monkeypatch.setattr(hierarchy, "contract", refuse)
    got = sorted((r["height"], r["a"], r["b"]) for r in hierarchy.spanning_tree(frame(spark, x[:, None])).collect())
    a, b, h = hierarchy._tree_of_block(np.arange(300), x[:, None])
    assert got == sorted(zip(h, a, b))


@pytest.mark.parametrize("kind", ["normal", "copies", "far"])
def test_tree_of_a_block_measures_few_pairs(monkeypatch, kind):
    """The tree of scanning all pairs, ties included, though few pairs are measured from differences."""
    rng = np.random.default_rng(9)
    v = rng.normal(size=(500, 16))
    v = {"normal": v, "copies": np.round(v[rng.integers(0, 90, 500)]), "far": 1e6 + v * 1e-3}[kind]
    ids = rng.permutation(2_000)[:500]
    d = ((v[:, None] - v[None]) ** 2).sum(2)
    i, j = np.triu_indices(500, 1)
    lo, hi = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
    root, want = {int(k): int(k) for k in ids}, []

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for e in np.lexsort((hi, lo, d[i, j])):
        x, y = find(int(lo[e])), find(int(hi[e]))
        if x != y:
            root[y] = x
            want.append((lo[e], hi[e], np.sqrt(d[i[e], j[e]])))
    looked, least = [], hierarchy._least_squares_of_pairs
    monkeypatch.setattr(hierarchy, "_least_squares_of_pairs", lambda v: looked.append(least(v)) or looked[0])
    got = sorted(zip(*hierarchy._tree_of_block(ids, v)))
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want)]
    np.testing.assert_allclose([g[2] for g in got], [w[2] for w in sorted(want)], rtol=1e-12)
    low, unit = looked[0]
    assert (low <= unit * d).all()


@pytest.mark.parametrize("kind", ["normal", "copies", "groups"])
def test_tree_of_many_columns_sends_no_rows_to_cells(spark, tiny_broadcast, monkeypatch, kind):
    """The tree of one block, ties included, from copies that pass by; rows no longer visit cells."""
    rng = np.random.default_rng(4)
    v = rng.normal(size=(130, 12))
    far = v * 0.1 + 5 * rng.normal(size=(6, 12))[np.arange(130) % 6]  # more rows in a group than known neighbours
    v = {"normal": v, "copies": np.round(v[rng.integers(0, 40, 130), :]), "groups": far}[kind]

    def refuse(*_):
        raise AssertionError("rows sent to cells")

    monkeypatch.setattr(hierarchy, "cross_visits", refuse)
    got = sorted((r["a"], r["b"], r["height"]) for r in hierarchy.spanning_tree(frame(spark, v)).collect())
    want = sorted(zip(*hierarchy._tree_of_block(np.arange(130), v)))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    np.testing.assert_allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-12)


def test_rounds_in_one_task_equal_rounds_of_jobs(spark):
    """Edges that fit go to one task; names of any type, picked edges and groups as by rounds over tables."""
    rng = np.random.default_rng(6)
    ends = rng.integers(0, 60, (150, 2))
    rows = [(int(min(e)), int(max(e)), float(h)) for e, h in zip(ends, rng.integers(0, 30, 150))]
    edges = spark.createDataFrame(rows, "a long, b long, height double")
    nodes = spark.range(62).withColumnRenamed("id", "node")
    name = lambda c: F.format_string("row%03d", c).alias(c)
    found = []
    for e, n in ((edges, nodes), (edges.select(name("a"), name("b"), "height"), nodes.select(name("node")))):
        for limit in (str(64 * 1024 * 1024), "400"):
            spark.conf.set("quarry.broadcast.bytes", limit)
            picked, label = hierarchy.contract(e, n)
            groups = {}
            for r in label.collect():
                groups.setdefault(r["cluster"], set()).add(int(str(r["node"]).removeprefix("row")))
            spark.conf.unset("quarry.broadcast.bytes")
            tree = sorted((r["height"], *(int(str(r[c]).removeprefix("row")) for c in "ab")) for r in picked.collect())
            found.append((tree, sorted(map(sorted, groups.values()))))
    assert found[0] == found[1] == found[2] == found[3]


def test_far_cells_never_meet(spark, tiny_broadcast):
    """On groups far apart the rows sent to other cells stay below n times its root."""
    x = cloud("blobs", 1_000)
    df = pairs.slim(frame(spark, x), "id", "features")
    placed, cells = pairs.build_cells(df, len(x), 3, 1)
    most = hierarchy.bottlenecks(cells, cells.radius)
    sent = hierarchy.cross_visits(placed, cells, most).count()
    assert sent < len(x) ** 1.5 < len(x) * len(cells.count)


@pytest.mark.parametrize("forced", [False, True])
def test_ids_of_any_type(spark, forced, request):
    """Names instead of numbers give the same results under those names, ties by the smaller name."""
    from quarry.operators import approximate, neighbours

    if forced:
        request.getfixturevalue("tiny_broadcast")
    x = cloud("copies", 60)
    df = frame(spark, x)
    named = df.selectExpr("format_string('row%03d', id) AS id", "features")
    name = lambda i: f"row{i:03}"
    both = lambda op: (op(df).collect(), op(named).collect())
    a, b = both(lambda t: pairs.nearest_neighbours(t, t, 3))
    assert {(name(r[0]), r[1], name(r[2])) for r in a} == {(r[0], r[1], r[2]) for r in b}
    a, b = both(lambda t: density.kernel_density(t, [0.5]))
    assert {name(r["id"]): round(r["log_density"], 9) for r in a} == {r["id"]: round(r["log_density"], 9) for r in b}
    a, b = both(lambda t: pairs.within_radius(t, t, 1.0, include_self=False))
    assert {(name(r[0]), name(r[1])) for r in a} == {(r[0], r[1]) for r in b}
    if forced:
        return
    a, b = both(lambda t: similarity.similarity(t, t, "cos"))
    assert {(name(r[0]), name(r[1])) for r in a} == {(r[0], r[1]) for r in b}
    a, b = both(lambda t: hierarchy.cut_tree(t, hierarchy.spanning_tree(t), 3))
    assert {(name(r["id"]), r["cluster"]) for r in a} == {(r["id"], r["cluster"]) for r in b}
    got = neighbours.leave_one_out_sweep(named.selectExpr("*", "CAST(features[0] AS int) AS label"), [1], "label")
    assert got.first()["error"] is not None
    assert approximate.approximate_neighbours(named, named, 1).filter("rank = 1").count() == 60
