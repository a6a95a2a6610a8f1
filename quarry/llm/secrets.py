"""Secret scans: known shapes, and a battery of randomness tests under false-discovery control."""

from __future__ import annotations

import math
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import quoted, text_of, written

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEYWORDS = ("passw", "secret", "token", "api")  # each keyword of ASSIGN holds one of these
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
RANDOM_LEAST = 20

#: Encodings from the narrowest alphabet to the widest; a run belongs to the first that holds it.
ALPHABETS = (
    string.digits,
    string.ascii_lowercase,
    string.ascii_uppercase,
    string.ascii_letters,
    string.digits + "abcdef",
    string.digits + "ABCDEF",
    string.ascii_uppercase + "234567",
    string.digits + string.ascii_lowercase,
    string.digits + string.ascii_uppercase,
    string.digits + string.ascii_letters,
    string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/",
    string.ascii_uppercase + string.ascii_lowercase + string.digits + "-_",
    string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/-_",
)
STRATA = (20, 32, 48, 64, 128)  # lengths at which a new stratum begins
BINS, BIN = 30_000, 0.01  # p-values as steps of -log10 p, at most 300

PIECE = re.compile("[^=]+(?:=+$)?")  # of a run: cut at inner equals signs, final ones are padding

RUN_BYTES = np.zeros(256, bool)
RUN_BYTES[list((string.ascii_letters + string.digits + "+/_=-").encode())] = True


def _tail(z: float) -> float:
    """P(Z > z) of the standard normal distribution."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def _fit(classes: np.ndarray, expected: np.ndarray) -> float:
    """p-value of the chi-squared test, its tail by the cube-root normal approximation."""
    x2 = float(((np.bincount(classes, minlength=len(expected)) - expected) ** 2 / expected).sum())
    df = len(expected) - 1
    return _tail(((x2 / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))


def battery(values: np.ndarray, letters: str) -> tuple[float, float, float]:
    """p-values, under uniform random places 0.. in the alphabet ``letters``, of three tests.

    Chi-squared uniformity (over as many equal classes as have at least five expected letters,
    and, where an alphabet has several, over small letters, capitals and all others: twice the
    lesser p-value), runs above and below the middle, and serial correlation at lag one, the
    last two two-sided.
    """
    n, size = len(values), len(letters)
    classes = max(2, min(size, n // 5))
    uniform = _fit(values * classes // size, n * np.bincount(np.arange(size) * classes // size, minlength=classes) / size)
    kind = np.array([0 if c in string.ascii_lowercase else 1 if c in string.ascii_uppercase else 2 for c in letters])
    names, kind = np.unique(kind, return_inverse=True)
    if len(names) > 1:  # words joined by signs lie in one of them
        uniform = min(1.0, 2 * min(uniform, _fit(kind[values], n * np.bincount(kind) / size)))
    high = values * 2 >= size
    n1 = int(high.sum())
    n0 = n - n1
    if not n0 or not n1:
        return uniform, 0.0, 0.0
    mean = 2 * n0 * n1 / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    runs = 1 + int((high[1:] != high[:-1]).sum())
    by_runs = 2 * _tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 0.0
    d = values - values.mean()
    r = float((d[1:] * d[:-1]).sum() / (d * d).sum())
    return uniform, by_runs, 2 * _tail(abs(r + 1 / n) * math.sqrt(n))


def _alphabet(token: str) -> int | None:
    letters = set(token)
    return next((i for i, a in enumerate(ALPHABETS) if letters <= set(a)), None)


class Language:
    """Letters of the corpus: how likely a run is as written words."""

    def __init__(self, counts: list[int]):
        self.log, self.mean, self.spread = [], [], []
        for a in ALPHABETS:
            # digits of numbers come alike often; what is odd is a long run of them among letters
            among = string.digits + string.ascii_letters if a == string.digits else a
            c = np.array([counts[ord(x)] for x in among], float) + 1
            q = c / c.sum()
            self.log.append(np.log(q[: len(a)]))
            m = float((q * np.log(q)).sum())
            self.mean.append(m)
            self.spread.append(math.sqrt(max(float((q * np.log(q) ** 2).sum()) - m * m, 1e-12)))

    def p_value(self, values: np.ndarray, alphabet: int) -> float:
        """P(letters as unlikely as these) if letters came with the frequencies of the corpus."""
        n = len(values)
        z = (float(self.log[alphabet][values].sum()) - n * self.mean[alphabet]) / (self.spread[alphabet] * math.sqrt(n))
        return _tail(-z)


def judged(token: str, language: Language, pass_at: float) -> tuple[int, int, bool] | None:
    """(stratum, bin of the p-value under the language, whether the battery lets it pass as random)."""
    body = token.rstrip("=")
    a = _alphabet(body)
    if a is None or len(body) < RANDOM_LEAST:
        return None
    place = {c: i for i, c in enumerate(ALPHABETS[a])}
    values = np.array([place[c] for c in body], np.int64)
    p = language.p_value(values, a)
    bin_ = min(BINS, int(-math.log10(max(p, 1e-300)) / BIN))  # rounds p up
    random = min(1.0, 3 * min(battery(values, ALPHABETS[a]))) >= pass_at
    return sum(len(body) >= s for s in STRATA) - 1, bin_, random


def base_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the known shapes, leftmost and without overlap in each kind.

    ``runs`` are the runs of letters, digits and ``+/_=-`` of at least 16 characters; keys and
    hexadecimal numbers lie within one.
    """
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        for m in _PATTERNS[0].finditer(text):
            if len(m[2]) >= ASSIGN_LEAST:
                out.append((0, *m.span()))
    for s, e in runs:
        for kind, pattern, least in ((1, _PATTERNS[1], ACCESS_LEAST), (2, _PATTERNS[2], HEX_LEAST)):
            for m in pattern.finditer(text, s, e):
                if m.end() - m.start() >= least:
                    out.append((kind, *m.span()))
    return sorted(out, key=lambda x: (x[1], x[0]))


# ASCII: with other letters, ignoring case would match more than A-Z
_PATTERNS = (re.compile(ASSIGN, re.IGNORECASE | re.ASCII), re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+"))

SPAN = T.StructType([T.StructField(n, T.IntegerType()) for n in ("kind", "start", "end")])
RUN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("token", T.StringType())])


def _runs(data: np.ndarray, offsets: np.ndarray, least: int) -> list[list[tuple[int, int]]]:
    """Per text the runs of at least ``least`` bytes, in code points."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = RUN_BYTES[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points begun before a byte
    starts, ends = edge[::2], edge[1::2]
    # a run that goes on into the next text is cut there
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(offsets) - 1)]
    row = np.searchsorted(offsets, starts, "right") - 1
    last = np.searchsorted(offsets, ends, "left") - 1
    for s, e, r, q in zip(*(x[(ends - starts >= least)].tolist() for x in (starts, ends, row, last))):
        for k in range(r, q + 1):
            a, b = max(s, int(offsets[k])), min(e, int(offsets[k + 1]))
            if b - a >= least:
                at = int(before[a] - before[offsets[k]])
                out[k].append((at, at + b - a))
    return out


def _first_pass(docs: DataFrame) -> DataFrame:
    """Per document its known shapes and the other runs; per batch one row of byte counts."""
    schema = T.StructType(
        [
            docs.schema["id"],
            T.StructField("counts", T.ArrayType(T.LongType())),
            T.StructField("base", T.ArrayType(SPAN)),
            T.StructField("runs", T.ArrayType(RUN)),
        ]
    )
    span = pa.struct([(n, pa.int32()) for n in ("kind", "start", "end")])
    run = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("token", pa.string())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            column = b.column("text").cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            raw = column.buffers()[2]
            data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
            data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
            places = _runs(data, offsets, ACCESS_LEAST)
            base, runs = [], []
            for text, own in zip(b.column("text"), places):
                text = text.as_py()
                known = base_spans(text, own)
                base.append([dict(zip(("kind", "start", "end"), x)) for x in known])
                pieces = ((s + m.start(), s + m.end()) for s, e in own for m in PIECE.finditer(text[s:e]))
                free = [(s, e) for s, e in pieces if e - s >= RANDOM_LEAST and not any(k[1] <= s and e <= k[2] for k in known)]
                runs.append([{"start": s, "end": e, "token": text[s:e]} for s, e in free])
            counts = np.bincount(data, minlength=256).tolist()
            ids = pa.concat_arrays([b.column("id"), pa.nulls(1, b.column("id").type)])
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([None] * b.num_rows + [counts], pa.list_(pa.int64())),
                    pa.array([*base, None], pa.list_(span)),
                    pa.array([*runs, None], pa.list_(run)),
                ],
                schema.names,
            )

    return docs.mapInArrow(find, schema)


def _thresholds(tested: DataFrame, rate: float) -> list[int | None]:
    """Per stratum the least bin that the step-up procedure of Benjamini and Hochberg accepts."""
    bins = tested.select(F.explode("tests").alias("t")).filter("t.stratum is not null").groupBy("t.stratum", "t.bin")
    bins = bins.agg(F.count("*").alias("n"))
    up = W.partitionBy("stratum").orderBy(F.col("bin").desc()).rowsBetween(W.unboundedPreceding, 0)
    ranked = bins.select("stratum", "bin", F.sum("n").over(up).alias("rank"), F.sum("n").over(W.partitionBy("stratum")).alias("m"))
    good = ranked.filter(F.pow(F.lit(10.0), F.col("bin") * F.lit(-BIN)) <= rate * F.col("rank") / F.col("m"))
    found = {r[0]: r[1] for r in good.groupBy("stratum").agg(F.min("bin")).collect()}  # a row per stratum
    return [found.get(i) for i in range(len(STRATA))]


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.01, pass_at: float = 0.01) -> DataFrame:
    """``id_col``, ``base`` and ``spans``; one row per row.

    Both are arrays of (kind, start, end) in code points, by start, then kind: 0 an assignment
    to a name such as ``token``, 1 an access key, 2 a hexadecimal number, and in ``spans`` also
    3, a run of letters, digits and ``+/_=-`` that looks random. Runs are cut at inner ``=``, so
    that a value is judged without its name; final ``=`` are padding. A piece has 20 characters or
    more besides padding and lies in no known shape. Its encoding is the narrowest alphabet that
    holds it, of digits or of letters alone too. It must pass as uniform over that alphabet (three
    tests, the least p-value times three at least ``pass_at``), and be a discovery against the
    null hypothesis that its letters come as often as in the corpus (digits: as often as among all
    letters and digits): within each class of lengths, expected false discoveries stay within
    ``rate`` of all. The control stands on that hypothesis and not on the battery, since a small
    p-value of the battery speaks against a secret, and failing to reject is no discovery.

    Null and empty texts hold nothing. Repeated rows and null ids are rows like any other and
    count as tests. An empty table gives an empty table.

    Plan: the texts are read once, in Arrow batches; spans, free runs and byte counts are
    written. Runs are then tested where they are; only counts per class of lengths and p-value
    step (at most 150,000 rows) are shuffled, and a threshold per class comes to the driver.
    """
    docs = df.select(F.col(quoted(id_col)).alias("id"), text_of(text_col).alias("text"))
    first = written(_first_pass(docs), "runs")
    sums = first.filter("counts is not null").select(F.posexplode("counts")).groupBy("pos").agg(F.sum("col").alias("n"))
    counts = [0] * 256
    for r in sums.collect():  # one row per byte value
        counts[r["pos"]] = r["n"]
    language = Language(counts)
    rows = first.filter("counts is null").select("id", "base", "runs")
    test = T.StructType([T.StructField("stratum", T.IntegerType()), T.StructField("bin", T.IntegerType()), T.StructField("random", T.BooleanType())])
    schema = T.StructType([*rows.schema.fields, T.StructField("tests", T.ArrayType(test))])

    def tests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("stratum", pa.int32()), ("bin", pa.int32()), ("random", pa.bool_())]))
        for b in batches:
            out = []
            for runs in b.column("runs").to_pylist():
                found = (judged(r["token"], language, pass_at) for r in runs)
                out.append([dict(zip(("stratum", "bin", "random"), f or (None, None, None))) for f in found])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, kind)], [*b.schema.names, "tests"])

    tested = written(rows.mapInArrow(tests, schema), "tests")
    limit = F.array(*[F.lit(x).cast("int") for x in _thresholds(tested, rate)])
    pairs = F.arrays_zip("runs", "tests")
    hit = F.filter(
        pairs,
        lambda x: F.coalesce(x["tests"]["random"] & (x["tests"]["bin"] >= F.get(limit, x["tests"]["stratum"])), F.lit(False)),
    )
    added = F.transform(hit, lambda x: F.struct(F.lit(3).alias("kind"), x["runs"]["start"].alias("start"), x["runs"]["end"].alias("end")))
    every = F.sort_array(F.transform(F.concat("base", added), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    spans = F.transform(every, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return tested.select(F.col("id").alias(id_col), "base", spans.alias("spans"))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
