"""Every registered query against its SQL twin on the smallest tables; the rest must give rows."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from quarry.plans import all_queries, all_sql

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
# the queries of the pipeline operators have tests of their own
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck(data_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, list):
        return tuple(plain(x) for x in v)
    return v


def key(row):
    return tuple(str(v) for v in row)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, data_dir, name):
    df = QUERIES[name](spark, data_dir)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=key)
    if name not in SQL:
        assert got
        return
    cur = duck.execute(SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            assert x == y or (isinstance(x, float) and isinstance(y, (int, float)) and x == pytest.approx(y, abs=2e-6))


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["antecedent", "consequent", "confidence", "support", "lift"]
    assert df.count() > 0


def test_adam_networks_score_written_rows(spark, data_dir, monkeypatch):
    """The texts are not read again for each of the networks."""
    from quarry.operators import networks

    train, predict, read = networks.train_adam, networks.predict_by_fold, []
    monkeypatch.setattr(networks, "train_adam", lambda *a, **k: train(*a, **k | {"epochs": 1}))
    monkeypatch.setattr(networks, "predict_by_fold", lambda x, net: read.extend(x.inputFiles()) or predict(x, net))
    assert entry_point.queries()["l16_network_adam"](spark, data_dir).count() == 48
    assert read and not any("documents" in f for f in read)
