import pytest

from quarry.functions.stem import stem_column
from quarry.operators import text
from quarry.sources import text as sources

# published examples of the Porter algorithm and of its common later departures
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat",
    "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss",
    "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat",
    "conditional": "condit", "rational": "ration", "valenci": "valenc", "digitizer": "digit", "radicalli": "radic",
    "differentli": "differ", "vileli": "vile", "analogousli": "analog", "vietnamization": "vietnam", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formaliti": "formal",
    "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "formalize": "formal",
    "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good", "revival": "reviv",
    "allowance": "allow", "inference": "infer", "airliner": "airlin", "adjustable": "adjust", "replacement": "replac",
    "adoption": "adopt", "communism": "commun", "effective": "effect", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controll": "control", "roll": "roll", "dying": "die", "news": "news", "enjoy": "enjoy", "by": "by", "matrix": "matrix",
    "ranking": "rank", "pages": "page", "webpage": "webpag", "internet": "internet", "died": "die", "spied": "spi",
}


def test_stems(spark):
    df = spark.createDataFrame([(w,) for w in STEMS], "word string")
    got = {r["word"]: r["stem"] for r in stem_column(df, "word", "stem").collect()}
    assert {w: got[w] for w in STEMS} == STEMS


@pytest.mark.parametrize(
    "raw, want",
    [
        ("They'll save and invest more.", "They 'll save and invest more ."),
        ("hi, my name can't hello,", "hi , my name ca n't hello ,"),
        ('Good muffins cost $3.88 in New York. Please buy me two of them.', "Good muffins cost $ 3.88 in New York. Please buy me two of them ."),
        ('"We cannot wait--really?" he said...', "`` We can not wait -- really ? '' he said ..."),
        ("A (small) dog's [bone]; 5:30", "A ( small ) dog 's [ bone ] ; 5:30"),
    ],
)
def test_tokens(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "text string")
    assert df.select(text.tokens(df["text"]).alias("t")).first()["t"] == want.split(" ")


DOCS = [
    "The Google matrix P is a model of the internet",
    "P_ij is nonzero if there is a link from webpage i to j",
    "The Google matrix is used to rank all Web pages",
    "The ranking is done by solving a matrix eigenvalue problem",
    "England dropped out of the top 10 in the FIFA ranking",
]
STOP = ["the", "is", "a", "of", "if", "there", "from", "to", "i", "j", "used", "all", "by", "out", "in"]


def test_bag_of_documents(spark, tmp_path):
    (tmp_path / "docs.txt").write_text("\n\n\n".join(DOCS))
    docs = sources.read_lines(spark, str(tmp_path / "docs.txt"))
    assert docs.count() == 5
    bag = text.bag_of_words(docs, stop=STOP, stem=True).cache()
    terms = [r["term"] for r in text.vocabulary(bag).orderBy("idx").collect()]
    assert terms == sorted(terms) and "rank" in terms and "ranking" not in terms
    ranked = text.rank_documents(bag, ["googl", "matrix", "rank"]).collect()
    best = docs.filter(docs["doc_id"] == ranked[0]["doc_id"]).first()["text"]
    assert best == DOCS[2]
    vec, vocab = text.bag_vectors(bag)
    assert [r["term"] for r in vocab.orderBy("idx").collect()] == terms
    place = {t: i for i, t in enumerate(terms)}
    counts = {(r["doc_id"], place[r["term"]]): r["cnt"] for r in bag.collect()}
    assert {(r["doc_id"], int(i)): v for r in vec.collect() for i, v in zip(r["features"].indices, r["features"].values)} == counts
    assert {r["features"].size for r in vec.collect()} == {len(terms)}
    assert sum(r["features"].values.sum() for r in vec.collect()) == bag.groupBy().sum("cnt").first()[0]


def test_filter_order(spark):
    """Stop words go before stemming, the length test after it."""
    df = spark.createDataFrame([(1, "Rankings rank, running. as ties")], "doc_id long, text string")
    bag = {r["term"]: r["cnt"] for r in text.bag_of_words(df, stop=["rank"], stem=True).collect()}
    assert bag == {"rank": 1, "run": 1, "tie": 1}


def test_vocabulary_order_beyond_latin(spark):
    words = ["zebra", "ёлка", "яб", "бя", "abc", "ab", "数据", "éclair", "яа", "abcd"]
    df = spark.createDataFrame([(1, w, 1) for w in words], "doc_id long, term string, cnt long")
    got = [r["term"] for r in text.vocabulary(df).orderBy("idx").collect()]
    assert got == sorted(words, key=lambda w: w.encode())


def test_vocabulary_order_in_buckets(spark, monkeypatch):
    from quarry.functions import ranking

    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 2)
    test_vocabulary_order_beyond_latin(spark)
