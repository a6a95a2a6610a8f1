"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import decontaminate, licenses, lines, mixing, quality, secrets, simhash, tokens, urls, warc
from quarry.session import shared_path

CLASH = "id tk key pos line row dropped h1 h2 first_id n_lines n_dropped gone_id gone_tk h host kept n_words text_key f0 component node root copies size group target order whole p g u taken begin end item item_id similarity code n base runs spans tests counts n_bytes n_tokens over_limit license dice rule verdict path url2 m v e t w x".split()
LONG = "\n".join(f"line number {i} of a text of many words" for i in range(30_000))
WORDS = " ".join(f"word{i}" for i in range(80))

ROWS = [
    (1, WORDS, "a"),
    (2, WORDS, "a"),
    (2, WORDS, "a"),  # repeated in full
    (3, None, "a"),
    (4, "", None),
    (5, "   \n\t \n", "b"),
    (None, "a text without an id, a text of some words", "b"),
    (None, None, None),
    (6, LONG, "b"),
    (7, LONG, None),
    (8, "one", "c"),
    (9, "Shared line of text\nshared LINE of text  \nown words here now", "c"),
    (10, "x\n  shared line of text", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASH]).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, " ".join(f"word{i}" for i in range(20, 50))), (2, None), (3, "two words"), (None, "no such passage is anywhere here")]
    return spark.createDataFrame(rows, "item_id long, text string")


def one(df, where):
    found = df.filter(where).collect()
    assert found
    return found[0]


def test_lines(docs, empty):
    out = lines.dedup_lines(docs)
    assert sorted(out.columns) == sorted(docs.columns)  # n_lines and n_dropped replace columns of their name
    assert out.count() == len(ROWS)
    got = one(out, "doc_id = 10")
    assert (got["n_lines"], got["n_dropped"], got["text"]) == (2, 1, "x")
    assert one(out, "doc_id = 9")["n_dropped"] == 0  # the first holder keeps its own repeats
    assert one(out, "doc_id = 3")["text"] == "" and one(out, "doc_id = 3")["n_lines"] == 1
    assert one(out, "doc_id = 7")["n_dropped"] == 30_000 and one(out, "doc_id = 7")["text"] == ""
    assert one(out, "doc_id = 2")["text"] == ""  # all of it is in document 1
    assert lines.dedup_lines(empty).count() == 0
    assert lines.clean_lines(docs).columns == docs.columns
    three = lines.dedup_lines(docs, min_docs=3)
    assert one(three, "doc_id = 10")["n_dropped"] == 0


def test_null_ids_are_one_last_document(spark):
    df = spark.createDataFrame([(None, "same line here"), (None, "same line here"), (5, "same line here")], "doc_id long, text string")
    got = lines.dedup_lines(df).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == [(0, ""), (0, ""), (5, "same line here")]


def test_quality(docs, empty):
    out = quality.judge(docs)
    assert out.count() == len(ROWS)
    for i in (3, 4, 5):
        r = one(out, f"doc_id = {i}")
        assert (r["n_words"], r["word_chars"], r["base_failed"], r["kept"]) == (0, 0, True, False)
    assert one(out, "doc_id = 1")["kept"]
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == [1, 2, 2]
    assert quality.judge(empty).count() == 0 and quality.keep_good(empty).count() == 0


def test_quality_counts(spark):
    text = "a b c a b c a\n# x\n# x\n \n \n" + " ".join(f"w{i}" for i in range(60))
    r = quality.judge(spark.createDataFrame([(1, text, "h")], "doc_id long, text string, source string")).first()
    # a b c a b c a holds abc twice, bca twice; "# x # x" holds no window twice
    assert (r["n_words"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (71, 2, 1, 7)


def test_a_bad_host_goes_and_a_clean_one_stays(spark):
    junk = " ".join(f"w{i}##$%" for i in range(60))
    clean = " ".join(f"word{i}" for i in range(60))
    rows = [(i, junk, "bad") for i in range(200)] + [(1000 + i, clean, "good") for i in range(200)] + [(5000, clean, "bad")]
    rows += [(2000 + i, clean, f"small{i}") for i in range(20)]
    out = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r["doc_id"] for r in out.filter("kept").collect()}
    assert kept == {r[0] for r in rows if r[2] != "bad"}


def test_rare_and_common_soup_go_alike(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    soup = " ".join(f"w{i}##$%|<" for i in range(60))
    slight = " ".join(f"w{i}#" for i in range(60)) + " ##"  # just beyond the limit
    for share in (10, 30):
        rows = [(i, soup if i < share else clean, f"host{i % 3}") for i in range(1000)]
        rows += [(5000, slight, "host1")] + [(6000 + i, slight, "odd") for i in range(20)] + [(7000 + i, clean, "odd") for i in range(20)]
        out = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
        gone = {r["doc_id"] for r in out.filter("not kept").collect()}
        assert {i for i in gone if i < 5000 or i >= 7000} == set(range(share))
        assert 5000 not in gone  # slight, on a host where it is rare


def test_simhash(docs, empty):
    out = simhash.near_groups(docs)
    assert out.count() == len(ROWS)
    blank = out.filter("f0 = 0").collect()
    assert sorted((r["id"] or 0) for r in blank) == [0, 3, 4, 5] and {r["component"] for r in blank} == {3}
    assert {r["component"] for r in out.filter("id in (1, 2)").collect()} == {1}
    assert {r["component"] for r in out.filter("id in (6, 7)").collect()} == {6}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.select("doc_id").collect()) == [0, 1, 3, 6, 8, 9, 10]
    assert simhash.near_groups(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_simhash_rows_of_one_id(spark):
    """An id with two texts stands for both groups; a null and an empty text are one."""
    other = " ".join(f"other{i}" for i in range(60))
    rows = [(1, WORDS, 0), (1, other, 1), (2, other, 2), (3, None, 3), (3, "", 4), (None, WORDS, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __key int").withColumn("__mark", F.lit("own"))
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    got = sorted((r["doc_id"], r["text"] or "") for r in kept.collect())
    assert got == sorted([(1, WORDS), (1, other), (3, "")])


def test_simhash_tiles(spark, monkeypatch):
    """Crowded keys cut into tiles give the components of all pairs."""
    import itertools
    import random

    rng = random.Random(5)
    centre = rng.getrandbits(64)
    prints = {centre}
    for _ in range(150):
        x = centre
        for b in rng.sample(range(64), rng.choice([1, 2, 3, 6, 9])):
            x ^= 1 << b
        prints.add(x)
    prints |= {rng.getrandbits(64) for _ in range(150)}
    prints = sorted(prints)
    monkeypatch.setattr(simhash, "TILE_ROWS", 8)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    df = spark.createDataFrame([(x,) for x in signed], "f0 long")
    from quarry.llm.components import components

    found = simhash.links(df, ["f0"], 4, simhash.block_masks(4, 2)).selectExpr("a0 as a", "b0 as b")
    root = {r["node"]: r["root"] for r in components(found).collect()}
    want = {x: x for x in signed}

    def find(x):
        while want[x] != x:
            x = want[x]
        return x

    for a, b in itertools.combinations(signed, 2):
        if bin((a ^ b) & (2**64 - 1)).count("1") <= 4:
            lo, hi = sorted((find(a), find(b)))
            want[hi] = lo
    assert {x: root.get(x, x) for x in signed} == {x: find(x) for x in signed}


def test_mixing(spark, docs, empty):
    w = mixing.cyclic_weights(docs)
    assert {r["group"]: r["weight"] for r in w.collect()} == {"a": 5.0, "b": 2.0, "c": 1.0, None: 5.0}
    out = mixing.pareto_mix(docs, w)
    assert out.count() == len(ROWS)
    assert out.filter("copies > 2 or copies < 0").count() == 0
    mixed = mixing.mix(docs, w)
    assert mixed.columns == [c for c in docs.columns if c != "copies"] + ["copies"]
    assert sorted(map(str, out.collect())) == sorted(map(str, mixing.pareto_mix(docs, w).collect()))
    assert mixing.pareto_mix(empty, w).count() == 0 and mixing.mix(empty, mixing.cyclic_weights(empty)).count() == 0


def test_mixing_meets_targets_with_unequal_odds(spark):
    df = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("w "), (F.col("id") % 50 + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        (F.col("id") % 5 + 1).cast("double").alias("appeal"),
    )
    w = mixing.cyclic_weights(df)
    for appeal in (None, "appeal"):
        out = mixing.pareto_mix(df, w, appeal_col=appeal)
        per = out.groupBy("group").agg(F.sum(F.col("size") * F.col("copies")).alias("got"), F.max("target").alias("want"), F.max("group_size").alias("all")).collect()
        assert abs(sum(r["want"] for r in per) - 1.5 * sum(r["all"] for r in per)) < 1e-3
        for r in per:
            assert abs(r["got"] - r["want"]) <= 50 and r["want"] <= 2 * r["all"] + 1e-6
    mean = {r[0]: r[1] for r in out.filter("`group` = 's1'").join(df, F.col("id") == F.col("doc_id")).groupBy("appeal").agg(F.avg("copies")).collect()}
    assert mean[5.0] > mean[1.0]


def test_decontamination(docs, empty, items):
    out = decontaminate.matches(docs, items)
    assert sorted((r["id"], r["item_id"], r["similarity"]) for r in out.collect()) == [(1, 1, 1.0), (2, 1, 1.0), (2, 1, 1.0)]
    r = out.filter("id = 1").first()
    assert WORDS[r["begin"] : r["end"]] == " ".join(f"word{i}" for i in range(20, 50))
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 3
    assert decontaminate.matches(empty, items).count() == 0
    assert decontaminate.matches(docs, items.filter("false")).count() == 0
    assert decontaminate.matches(docs, items, block_words=10).count() == 3  # in several blocks


def test_decontamination_of_edited_copies(spark):
    import random

    rng = random.Random(3)
    item = [f"term{i}" for i in range(40)]
    rows, clean = [], []
    for k in range(60):
        w = list(item)
        for _ in range(8):  # a fifth of the words replaced, dropped or added
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice([["other"], [], [w[at], "more"]])
        before = [f"pre{rng.randrange(900)}" for _ in range(200)]
        rows.append((k, " ".join(before + w + before)))
        mixed = list(item)
        rng.shuffle(mixed)
        clean.append((1000 + k, " ".join(before + mixed + before)))
    df = spark.createDataFrame(rows + clean, "doc_id long, text string")
    got = {r["id"] for r in decontaminate.matches(df, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()}
    assert got == {k for k, _ in rows}


def test_decontamination_of_parts_short_items_and_unspaced_scripts(spark):
    import random

    rng = random.Random(4)
    long = [f"term{i}" for i in range(400)]
    han = "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(40))
    short = [f"q{i}" for i in range(12)]
    items = [(1, " ".join(long)), (2, han), (3, " ".join(short))]
    pad = [f"pre{i}" for i in range(300)]
    put = lambda words: " ".join([*pad, *words, *pad])
    rows = [(k, put(long[a : a + 150])) for k, a in enumerate((0, 37, 131, 250))]
    rows += [(10 + k, put(long[a : a + 48])) for k, a in enumerate((0, 17, 20, 31, 352))]
    rows += [(20, "他們說" + han + "這是其他內容"), (21, han[:30])]
    rows += [(30, put(["q0", "q1", "x", "q3", "q4", "q5", "y", "q7", "z", "q9", "q10", "u"]))]
    clean = [(100, put(long[50:60])), (101, han[::-1]), (102, "這是其他內容他們說"), (103, put(short[:3])), (104, "\U0001f600 é"), (105, put([]))]
    df = spark.createDataFrame(rows + clean, "doc_id long, text string")
    out = decontaminate.matches(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["id"], r["item_id"]) for r in out} == {(i, 1 if i < 20 else 2 if i < 30 else 3) for i, _ in rows}
    r = next(r for r in out if r["id"] == 20)
    assert rows[9][1][r["begin"] : r["end"]] == han and r["similarity"] == 1.0


def test_tokens(docs, empty):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    path = public_tokenizers.path("piece_bpe_32k.model")
    out = tokens.token_counts(docs, path)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and out.count() == len(ROWS)
    assert {(r["n_bytes"], r["n_tokens"]) for r in out.filter("doc_id in (3, 4)").collect()} == {(0, 0)}
    assert tokens.token_counts(empty, path).count() == 0
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = ["", " ", "  ", "a ", " a", "a  b", "\n", "\n\n a", " \n ", "a\n", "a \n b", "▁", "a▁b ▁ c", "<s> </s><unk>", "\u00a0x \u2003y", "ab\u0000c", "日本 語\n\n語", "e\u0301 ﬁ ² ½", "\t\ta\t", "x" * 3000, "a" + " " * 50 + "b", "😀 😀\n😀", "\r\n a\r\nb", "a\n b\n  c\n▁d"]
    c = tokens.counter(path)
    assert isinstance(c, tokens.Pieces)
    assert c.count(odd) == [len(x) for x in sp.encode(odd)]
    assert c.count(odd) == [len(x) for x in sp.encode(odd)]  # from memory
    file = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(file)
    assert tokens.counter(file).count(odd) == [len(t.encode(x, add_special_tokens=False)) for x in odd]


def test_secrets(spark, docs, empty):
    out = secrets.scan(docs)
    assert out.count() == len(ROWS) and out.filter("size(spans) > 0").count() == 0
    assert secrets.scan(empty).count() == 0
    key = "AKIA" + "Q7" * 8
    noise = [hashlib.sha512(str(i).encode()) for i in range(40)]
    import base64

    rows = [
        (0, f"é token= short and API_KEY : 'abcdefgh1' {key} 😀 {noise[0].hexdigest()}"),
        (1, "ſecret=abcdefghij to\u212aen=abcdefghij"),  # letters that only fold to ASCII
        (2, "token=secret:longvalue123"),
    ]
    prose = "the quick brown fox jumps over the lazy dog and runs home again. " * 50
    rows += [(10 + i, prose + base64.b64encode(h.digest()[:30]).decode() + " end") for i, h in enumerate(noise)]
    rows += [(100 + i, prose + "aaaaaaaaaaaaaaaaaaaaaaaa1 version-1-of-the-long-page-name") for i in range(40)]
    got = {r["doc_id"]: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = rows[0][1]
    base = [(s["kind"], text[s["start"] : s["end"]]) for s in got[0]["base"]]
    assert base == [(0, "API_KEY : 'abcdefgh1"), (1, key), (2, noise[0].hexdigest())]
    assert not got[1]["base"]
    assert not got[2]["base"]  # the value "secret" is too short, and what it took is not read again
    found = [i for i in range(40) if any(s["kind"] == 3 for s in got[10 + i]["spans"])]
    assert len(found) >= 38
    assert not any(got[100 + i]["spans"] for i in range(40))


def test_secrets_without_digits_and_behind_names(spark):
    import random

    rng = random.Random(5)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    prose = "the quick brown fox jumps over the lazy dog and runs home again in 2024. " * 50
    kinds = [
        lambda: "k=" + draw(lower + upper + digits, 40),
        lambda: "AWS_KEY=" + draw(lower + upper + digits + "+/", 39) + "=",
        lambda: draw(lower + upper, 40),
        lambda: draw(lower, 40),
        lambda: draw(digits, 28),  # from 32 on a known shape
    ]
    rows = [(100 * k + i, f"{prose}{make()} end") for k, make in enumerate(kinds) for i in range(30)]
    plain = ["version-1-of-the-long-page-name", "theoverfoxjumpsandrunshomeagain", "usr/share/the/lazy/dog/and/fox", "00000000000000000000000000", "fox=jumps=over=the=lazy=dog=again"]
    rows += [(1000 + 100 * k + i, f"{prose}{t} end") for k, t in enumerate(plain) for i in range(30)]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = dict(rows)
    found = {r["doc_id"]: [text[r["doc_id"]][s["start"] : s["end"]] for s in r["spans"] if s["kind"] == 3] for r in got}
    for k in range(len(kinds)):
        assert sum(bool(found[100 * k + i]) for i in range(30)) >= 28, k
    assert {len(x[0]) for i, x in found.items() if i < 400 and x} == {40}
    assert {i: x for i, x in found.items() if i >= 1000 and x} == {}


def test_licenses(docs, empty, spark):
    assert licenses.scan(docs).count() == 0 and licenses.scan(empty).count() == 0
    rows = [(1, "x\nLICENSED under the Apache License -- Version 2.0!"), (1, "x\nLICENSED under the Apache License -- Version 2.0!"), (None, "Released under the MIT License\nnow")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((r["doc_id"] or 0, r["line"], r["license"], round(r["dice"], 6), r["begin"], r["n_words"]) for r in got)
    assert found == [(0, 0, "MIT", 1.0, 0, 5), (1, 1, "Apache-2.0", 1.0, 1, 8)]
    assert licenses.scan(docs, templates=[]).count() == 0


def _all_license_windows(text, templates=licenses.TEMPLATES, threshold=0.8):
    """Every window of words against every template, without any pruning but the sizes."""
    words = [(w, n) for n, t in enumerate(text.split("\n")) for w in re.split("[^a-z0-9]+", t.lower()) if w]
    grams = [f"{a} {b}" for (a, _), (b, _) in zip(words, words[1:])]
    begins = {}
    for name, template in templates:
        own = set(licenses.bigrams_of(template))
        low, high = licenses.sizes(len(own), threshold)
        for p, first in enumerate(grams):
            for q in range(p + low - 1, min(len(grams), p + high)):
                part = set(grams[p : q + 1])
                dice = 2 * len(part & own) / (len(part) + len(own))
                if dice >= threshold and first in own and grams[q] in own:
                    begins.setdefault(p, []).append((-dice, name, q))
    lines = {}
    for p, found in begins.items():
        d, name, q = min(found)
        lines.setdefault((words[p][1], name), []).append((d, p, q))
    best = [(line, name, *min(v)) for (line, name), v in lines.items()]
    return sorted(
        (line, name, round(-d, 9), p, q - p + 2)
        for line, name, d, p, q in best
        if not all(any(n == name and e < d and a <= w <= z + 1 for _, n, e, a, z in best) for w in range(p, q + 2))
    )


def test_licences_wrapped_inline_and_side_by_side(spark):
    apache = licenses.TEMPLATES[2][1]
    mit = licenses.TEMPLATES[16][1]
    texts = [
        "Some words first. Licensed under the Apache\nLicense, Version 2.0 and then\nmuch more text follows here",
        f"one two three four five six. {mit}, to deal in the Software without restriction and so on for long",
        "Copyright\n" + "\n".join(apache.split(" ")) + "\nend",  # a word on each line
        "Licensed under CC BY 4.0 Licensed under CC BY-NC 4.0 Released under the MIT License Released under the MIT License",
        "Released under the\nMIT License\n" * 50,
        "under the the the under the License of the work under the",
        "Licensed under the GNU Affero General Public License, version 3\nThis work is licensed under the GNU General Public License, version 2",
        "Released under MIT License",
    ]
    rows = list(enumerate(texts))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], []).append((r["line"], r["license"], round(r["dice"], 9), r["begin"], r["n_words"]))
    for i, text in rows:
        assert sorted(found.get(i, [])) == _all_license_windows(text), i
    assert found[0] == [(0, "Apache-2.0", 1.0, 3, 8)]
    assert {f[1] for f in found[1]} == {"MIT"} and {f[1] for f in found[2]} == {"Apache-2.0"}
    assert {f[1] for f in found[3]} == {"CC-BY-4.0", "CC-BY-NC-4.0", "MIT"}
    assert len(found[4]) == 50 and 5 not in found


PAGES = [
    (1, "http://a.example.net/en/1", "<p>x</p>"),
    (2, "HTTP://A.EXAMPLE.NET", "<p>x</p>"),
    (2, "HTTP://A.EXAMPLE.NET", "<p>x</p>"),
    (3, None, None),
    (4, "no scheme", ""),
    (None, "http://x.net/a\nb", "<p>x</p>"),
    (5, "http://b.org/fr/\u00e9?q=1#f", "long " * 300_000),
    (None, "x://", None),
]


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return df.select("*", *[F.lit("extra").alias(c) for c in CLASH]).cache()


def test_urls(spark, pages):
    labels = spark.createDataFrame([(1, 0, 0), (1, None, None), (None, 0, 1), (4, None, 1)], "doc_id long, quality int, toxic int")
    rules = [("block", "net/"), ("allow", "example.net/en/"), ("allow", "org/fr/")]
    out = urls.judge(pages, labels, rules)
    assert out.count() == len(PAGES)
    r = one(out, "page_id = 1")
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == ("a.example.net", "/en/1", "example.net/en/", "allow")
    r = one(out, "page_id = 2")
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == ("a.example.net", "", None, "allow")
    assert one(out, "page_id is null and host = 'x.net'")["verdict"] == "block"
    for i in (3, 4):
        r = one(out, f"page_id = {i}")
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == ("", "", None, "allow")
    assert urls.judge(pages.filter("false"), labels, rules).count() == 0
    assert urls.judge(pages, labels.filter("false"), []).filter("verdict = 'block'").count() == 0


def test_mined_rules_block(spark):
    rows = [(i, f"http://h{i}.casino-win.org/en/{i}") for i in range(40)] + [(100 + i, f"http://h{i}.news.org/en/{i}") for i in range(60)]
    pages = spark.createDataFrame(rows + [(999, "http://new.casino-win.org/x")], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i >= 100), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    out = urls.judge(pages, labels, [])
    assert {r["page_id"] for r in out.filter("verdict = 'block'").collect()} == {*range(40), 999}


def test_mined_rules_of_any_length(spark):
    """Four parts mark bad URLs, any three of them do not; rows of a rare bad host are found too."""
    four = ["pay", "win", "now", "big"]
    rows = [(i, f"http://site{i}.org/" + "/".join(four), 0) for i in range(40)]
    for k in range(4):
        rest = "/".join(four[:k] + four[k + 1 :])
        rows += [(1000 + 100 * k + i, f"http://good{k}x{i}.org/{rest}", 1) for i in range(40)]
    rows += [(5000 + i, f"http://z{i}.rare.org/q{i}", 0) for i in range(5)]
    rows += [(10_000 + i, f"http://spam.net/n{i}", 0) for i in range(2000)]
    pages = spark.createDataFrame([r[:2] for r in rows] + [(9, "http://new.org/big/now/pay/win")], "page_id long, url string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows if i != 9], "doc_id long, quality int, toxic int")
    blocked = {r["page_id"] for r in urls.judge(pages, labels, []).filter("verdict = 'block'").collect()}
    assert blocked == {i for i, _, q in rows if not q} | {9}


@pytest.mark.parametrize("packed", ["none", "gzip"])
def test_warc(spark, pages, packed):
    path = shared_path(spark, "archives")
    warc.archive(pages, path, compression=packed)
    back = {}
    for r in warc.read_warc(spark, path).collect():
        back.setdefault(r["record_id"], []).append(r)
    assert sum(map(len, back.values())) == len(PAGES)
    assert [r["record_type"] for r in back["urn:page:2"]] == ["response"] * 2
    assert back["urn:page:1"][0]["refers_to"] == "urn:page:2" and back["urn:page:1"][0]["payload"] is None
    assert back["urn:page:3"][0]["refers_to"] == "urn:page:4" and back["urn:page:4"][0]["payload"] == b""
    assert back["urn:page:5"][0]["payload"] == PAGES[6][2].encode()
    assert any(r["target_uri"] == "http://x.net/a%0Ab" for rs in back.values() for r in rs)
    only = warc.read_warc(spark, path, payload=False).filter("record_type = 'response' and target_uri like 'http://b%'")
    got = only.collect()
    assert len(got) == 1 and got[0]["payload"] is None and got[0]["payload_length"] == 1_500_000
    assert warc.read_warc(spark, path).filter("record_type <> 'revisit' and refers_to is not null").count() == 0
    nothing = shared_path(spark, "archives")
    warc.archive(pages.filter("false"), nothing)
    assert warc.read_warc(spark, nothing).count() == 0


def test_warc_skips_unwanted_payloads():
    """A record that a predicate excludes is passed over without reading its block."""
    import io

    from pyspark.sql.datasource import EqualTo

    class Counting(io.BytesIO):
        largest = 0

        def read(self, n=-1):
            Counting.largest = max(Counting.largest, n)
            return super().read(n)

    made = b"".join(warc.record_bytes({"record_id": f"r{i}", "record_type": "response", "payload": b"z" * 1000 * (1 + i)}) for i in range(3))
    rows = list(warc.records(Counting(made), [EqualTo(("record_id",), "r0")], True))
    assert [r["record_id"] for r in rows] == ["r0"] and Counting.largest < 1200
    damaged = made.replace(b"z" * 1000 + b"\r\n", b"y" * 1000 + b"\r\n", 1)
    with pytest.raises(ValueError, match="digest"):
        list(warc.records(io.BytesIO(damaged), [], True))


def test_stages_keep_columns(spark, docs, data_dir):
    plain = docs.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars"), "id", "key")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, plain, data_dir).columns == plain.columns
        assert stage(spark, plain.filter("false"), data_dir).count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, plain, data_dir).columns == [*plain.columns, "copies"]
    assert last(spark, plain.filter("false"), data_dir).count() == 0
