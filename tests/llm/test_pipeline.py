"""The pipeline, stage by stage, against brute-force versions on whole tables."""

import re

import duckdb
import pandas as pd

import corpus_pipeline
from quarry.llm.queries import SQL
from quarry.session import shared_path
from test_twins import groups_of, local_alignment, simhash_of


def sql_over(docs: pd.DataFrame, name: str) -> pd.DataFrame:
    con = duckdb.connect()
    con.register("documents", docs)
    return con.execute(SQL[name]).fetch_df()


def cleaned(docs: pd.DataFrame) -> dict[int, str]:
    key = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s.strip(" \t\n\x0b\f\r"))
    first, holders = {}, {}
    for i, t in zip(docs.doc_id, docs.text):
        for s in (t or "").split("\n"):
            first[key(s)] = min(i, first.get(key(s), i))
            holders.setdefault(key(s), set()).add(i)
    gone = lambda i, s: len(key(s)) >= 10 and len(holders[key(s)]) > 1 and first[key(s)] != i
    return {i: "\n".join(s for s in (t or "").split("\n") if not gone(i, s)) for i, t in zip(docs.doc_id, docs.text)}


def first_of_groups(docs: pd.DataFrame) -> set[int]:
    prints = {i: simhash_of(t) for i, t in zip(docs.doc_id, docs.text)}
    return set(groups_of(prints, 4).values())


def contaminated(docs: pd.DataFrame, items: pd.DataFrame) -> set[int]:
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    tests = [words(t) for t in items.text]
    out = set()
    for i, t in zip(docs.doc_id, docs.text):
        w = words(t)
        have = set(zip(w, w[1:], w[2:]))
        for item in tests:
            if sum(g in have for g in zip(item, item[1:], item[2:])) >= 3 and local_alignment(item, w) >= len(item):
                out.add(i)
    return out


def test_each_stage(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    items = pd.read_parquet(f"{data_dir}/benchmark.parquet")
    before = docs.toPandas()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, data_dir)
        out.write.parquet(path := shared_path(spark, "test-stage"))
        docs = spark.read.parquet(path)
        after = docs.toPandas()
        kept = after.doc_id.tolist()
        assert len(set(kept)) == len(kept)
        text = dict(zip(before.doc_id, before.text))
        if name == "quality rules":
            want = sql_over(before, "op3_quality_rules")
            assert set(kept) == set(want.doc_id[want.kept])
        elif name == "line dedup":
            text = cleaned(before)
            assert set(kept) == set(text) and dict(zip(kept, after.text)) == text
            assert (after.n_chars == after.text.str.len()).all()
        elif name == "simhash near-dedup":
            assert set(kept) == first_of_groups(before)
        elif name == "benchmark decontamination":
            bad = contaminated(before, items)
            assert bad and set(kept) == set(text) - bad
        else:
            want = sql_over(before, "op1_mixing")
            want = want[want.taken > 0]
            sized = after[after.text.str.strip() != ""]
            assert dict(zip(sized.doc_id, sized.copies)) == dict(zip(want.doc_id, want.taken // want["size"]))
        assert dict(zip(kept, after.text)) == {i: text[i] for i in kept}
        if name != "mixing":
            assert list(after.columns) == list(before.columns)
        before = after
    run = corpus_pipeline.run(spark, data_dir).toPandas()
    assert sorted(zip(run.doc_id, run.copies)) == sorted(zip(before.doc_id, before.copies))
