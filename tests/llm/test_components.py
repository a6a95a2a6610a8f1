"""Components of links: chains, hot nodes, random graphs, and the shuffles that they take."""

import random

import pytest

from quarry.llm import components


def roots(links):
    """The least node reachable, of each node that has a link to another."""
    root = {x: x for a, b in links if a != b for x in (a, b)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    return {x: find(x) for x in root}


def graphs():
    rng = random.Random(5)
    mixed = rng.sample(range(1000, 2000), 300)
    yield "path", [(k, k + 1) for k in range(150)]
    yield "mixed path", list(zip(mixed, mixed[1:]))
    yield "hub of the largest", [(900, k) for k in range(200)] + [(k, k + 1000) for k in range(200)]
    yield "random", [(rng.randrange(400), rng.randrange(400)) for _ in range(230)]
    yield "repeated, reversed and own", [(3, 1), (1, 3), (3, 1), (7, 7), (5, 3), (9, 8)]


@pytest.mark.parametrize("copies", [1 << 17, 0])
@pytest.mark.parametrize("links", [x for _, x in graphs()], ids=[n for n, _ in graphs()])
def test_least_node_reachable(spark, monkeypatch, links, copies):
    monkeypatch.setattr(components, "COPY_ROWS", copies)  # with 0 every name is shuffled
    df = spark.createDataFrame(links, "a long, b long")
    got = components.components(df).collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["root"] for r in got} == roots(links)


def test_names_and_nothing(spark):
    df = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", None)], "a string, b string")
    assert sorted(map(tuple, components.components(df).collect())) == [("a", "a"), ("b", "a"), ("c", "a")]
    assert components.components(df.filter("false")).count() == 0


def test_links_added_later(spark):
    """Contracted links and renamed roots give the components of all links."""
    rng = random.Random(6)
    first, more = ([(rng.randrange(300), rng.randrange(300)) for _ in range(n)] for n in (120, 90))
    frame = lambda links: spark.createDataFrame(links, "a long, b long")
    names = components.components(frame(first))
    later = components.components(components.between(frame(more), names))
    got = {r["node"]: r["root"] for r in components.renamed(names, later).collect()}
    tops = {r["node"]: r["root"] for r in later.collect()}
    want = roots(first + more)
    assert all(want[x] == r for x, r in got.items())
    assert all(want[x] == r for x, r in tops.items())
    assert set(got) | set(tops) == set(want)


def test_few_shuffles(spark, monkeypatch):
    """Overlapping stars, as tasks emit them, take a shuffle or two a round: each costs a task per
    partition, however few the links."""
    shuffles = []

    def written(df, stem, real=components.written):
        shuffles.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return real(df, stem)

    monkeypatch.setattr(components, "written", written)
    links = [(100 * k, 100 * k + j) for k in range(5) for j in range(1, 40)] + [(7, 107), (230, 310)]
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["root"] for r in got.collect()} == roots(links)
    assert sum(shuffles) <= 6
