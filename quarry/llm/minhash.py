"""MinHash near-dedup: banded minima find candidates, whole shingle sets confirm every link."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.bytewords import LOWERED, NO_BLANK, SpanHash, texts, word_spans
from quarry.llm.common import quoted, text_of, written
from quarry.llm.components import between, components, renamed

BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
PART_BYTES = 1 << 19  # texts that are signed at a time
TILE_ROWS = 2048  # signatures of one key that are compared in one task
TILE_SHINGLES = 1 << 18  # shingles whose sets are confirmed together
SET_WEIGHT = 512  # what a set counts for beside its shingles
CELLS = 1 << 21


def _mixed(z: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class ShingleSets:
    """The distinct shingle hashes of many texts, each text's in ascending order."""

    def __init__(self, size: int):
        self.size, self.hash = size, SpanHash(7)
        self.place = np.random.default_rng(8).integers(0, 1 << 63, size, np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Parts of the column: first row, hashes of all its texts and the size of each set."""
        for row, body, offsets in texts(column, PART_BYTES):
            body = LOWERED[body]
            starts, lengths, counts = word_spans(body, offsets, NO_BLANK)
            word = self.hash(body, starts, lengths)
            text = np.repeat(np.arange(len(counts)), counts)
            ends = np.cumsum(counts)
            # a text of fewer words than a shingle is one shingle
            size = np.minimum(self.size, counts)[text]
            at = np.flatnonzero(np.arange(len(word)) + size <= ends[text])
            size, text = size[at], text[at]
            held = np.zeros(len(at), np.uint64)
            with np.errstate(over="ignore"):
                for k in range(self.size):
                    more = np.flatnonzero(size > k)
                    held[more] += word[at[more] + k] * self.place[k]
            held = _mixed(held)
            order = np.lexsort([held, text])
            held, text = held[order], text[order]
            new = np.r_[True, (held[1:] != held[:-1]) | (text[1:] != text[:-1])] if len(held) else np.zeros(0, bool)
            yield row, held[new], np.bincount(text[new], minlength=len(counts))


class Minima:
    """Signatures of sets: the least values of universal hash functions a x + b modulo 2^64, a odd."""

    def __init__(self, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.a = draw.integers(0, 1 << 63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = draw.integers(0, 1 << 64, MINIMA, np.uint64)
        self.mark = draw.integers(0, 1 << 64, (BANDS, ROWS + 1), np.uint64)

    def __call__(self, held: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """One row per set that is not empty."""
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        out = np.empty((len(starts), MINIMA), np.uint64)
        room = np.empty_like(held)
        if len(starts):
            for k in range(MINIMA):
                np.multiply(held, self.a[k], out=room)
                np.add(room, self.b[k], out=room)
                out[:, k] = np.minimum.reduceat(room, starts)
        return out

    def keys(self, minima: np.ndarray) -> np.ndarray:
        """A hash of the minima of each band."""
        rows = minima.reshape(len(minima), BANDS, ROWS)
        total = np.broadcast_to(self.mark[:, ROWS], rows.shape[:2]).copy()
        for k in range(ROWS):
            total = _mixed(total + _mixed(rows[:, :, k] ^ self.mark[:, k]))
        return total

    @staticmethod
    def bytes_of(minima: np.ndarray) -> np.ndarray:
        """A byte of each minimum: equal minima agree, others by one chance in 256."""
        return (_mixed(minima) & np.uint64(255)).astype(np.uint8)


def least_agreement(percent: int) -> int:
    """Agreeing minima below which a pair is passed over: 6.5 standard deviations below those of
    a pair at the limit, which one such pair in ten thousand million does not reach."""
    p = percent / 100
    return math.floor(MINIMA * p - 6.5 * math.sqrt(MINIMA * p * (1 - p)))


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(quoted(id_col)), F.xxhash64(text_of(text_col)))


def signed(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Per row ``id``, ``rk`` (hash of id and text), ``n`` (set size), ``digest`` of the set, ``keys``
    of its bands and ``sig`` (a byte of each minimum); the last three are null for empty sets."""
    rows = df.select(
        F.col(quoted(id_col)).alias("id"), _row_key(id_col, text_col).alias("rk"), text_of(text_col).alias("t")
    )
    schema = T.StructType(
        [
            rows.schema["id"],
            T.StructField("rk", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("keys", T.ArrayType(T.LongType())),
            T.StructField("sig", T.BinaryType()),
        ]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, minima = ShingleSets(shingle), Minima()
        for b in batches:
            n = np.zeros(b.num_rows, np.int64)
            digest, keys, sig = [], [], []
            for row, held, sizes in sets(b.column("t")):
                n[row : row + len(sizes)] = sizes
                least = minima(held, sizes)
                own, mark = iter(minima.keys(least).view(np.int64)), iter(minima.bytes_of(least))
                ends = np.cumsum(sizes)
                for a, e in zip((ends - sizes).tolist(), ends.tolist()):
                    digest.append(xxhash.xxh3_128_digest(held[a:e].tobytes()) if e > a else None)
                    keys.append(next(own) if e > a else None)
                    sig.append(next(mark).tobytes() if e > a else None)
            cols = [pa.array(n), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sig, pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("rk"), *cols], schema.names)

    return rows.mapInArrow(sign, schema)


def sets_of(df: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``node`` and ``s`` (its shingle hashes); ``wanted`` names a row (``rep``) and the digest per node."""
    rows = df.select(_row_key(id_col, text_col).alias("rk"), text_of(text_col).alias("t"))
    # the names grow with the texts: they are never copied, and the plan is the same at every size
    names = written(wanted.select("node", "rep", "digest"), "wanted").hint("merge")
    found = rows.join(names, F.col("rk") == F.col("rep")).select("node", "digest", "t")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = ShingleSets(shingle)
        for b in batches:
            digest, node = b.column("digest").to_pylist(), b.column("node")
            for row, held, sizes in sets(b.column("t")):
                ends = np.cumsum(sizes)
                own = [held[a:e] for a, e in zip((ends - sizes).tolist(), ends.tolist())]
                # another row may share the 64 bits of the name, not those of the set
                right = [k for k, s in enumerate(own) if xxhash.xxh3_128_digest(s.tobytes()) == digest[row + k]]
                lists = pa.array([own[k].view(np.int64) for k in right], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([node.take(pa.array([row + k for k in right], pa.int64())), lists], ["node", "s"])

    return found.mapInArrow(whole, "node long, s array<long>")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Blocks of whole groups of rows that come sorted by ``group``."""
    rest = None
    for b in batches:
        if not b.num_rows:
            continue
        block = pa.Table.from_batches([b])
        if rest is not None:
            block = pa.concat_tables([rest, block])
        group = block["group"].to_numpy()
        cut = int(np.searchsorted(group, group[-1], "left"))
        if cut:
            yield block.slice(0, cut)
        rest = block.slice(cut)
    if rest is not None:
        yield rest


def _stars(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from the least row of each component of the links (a, b) to its other rows."""
    label = np.arange(n)
    while True:
        low = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(low, a, least)
        np.minimum.at(low, b, least)
        low = low[low]
        if (low == label).all():
            break
        label = low
    leaf = np.flatnonzero(label != np.arange(n))
    return label[leaf], leaf


def placed(rows: DataFrame, most: int) -> DataFrame:
    """Rows (``group``, ``node``, ``comp``, ``weight``, ...) with the ``group`` and ``side`` they are compared in.

    A group within ``most`` stays one. A heavier one is cut into tiles: a component beyond
    ``most`` has tiles of its own, all others share theirs; each row goes to one new group per
    pair of tiles that holds its own, on side 0 or 1. Tiles of one component never meet.
    """
    heavy = written(rows.groupBy("group").agg(F.sum("weight").alias("all")).filter(F.col("all") > most).select("group"), "heavy")
    per = rows.join(heavy, "group", "left_semi").groupBy("group", "comp").agg(F.sum("weight").alias("w"))
    cls = F.when(F.col("w") > most, F.col("comp")).otherwise(F.lit(-1).cast("long"))
    sums = per.select("group", cls.alias("cls"), "w").groupBy("group", "cls")
    parts = sums.agg(F.ceil(F.sum("w") / most).cast("int").alias("parts"))
    tiles = parts.groupBy(F.col("group").alias("heavy")).agg(F.collect_list(F.struct("cls", "parts")).alias("classes"))
    joined = rows.join(written(tiles, "tiles"), F.col("group") == F.col("heavy"), "left")
    own = F.when(F.exists("classes", lambda c: c["cls"] == F.col("comp")), F.col("comp")).otherwise(F.lit(-1).cast("long"))
    joined = joined.withColumn("own", own)
    count = F.get(F.filter("classes", lambda c: c["cls"] == F.col("own")), F.lit(0))["parts"]
    joined = joined.withColumn("mine", F.struct(F.col("own").alias("cls"), F.pmod(F.hash("node"), count).alias("part")))
    others = F.filter("classes", lambda c: (c["cls"] != F.col("own")) | (F.col("own") == -1))
    all_tiles = F.flatten(
        F.transform(
            others,
            lambda c: F.transform(
                F.sequence(F.lit(0), c["parts"] - 1),
                lambda k: F.struct(c["cls"].alias("cls"), k.cast("int").alias("part")),
            ),
        )
    )

    def place(t: Column) -> Column:
        lo, hi = F.least(t, F.col("mine")), F.greatest(t, F.col("mine"))
        return F.struct(
            F.xxhash64("group", lo["cls"], lo["part"], hi["cls"], hi["part"]).alias("group"),
            F.when(t < F.col("mine"), 1).otherwise(0).alias("side"),
        )

    alone = F.array(F.struct(F.col("group").alias("group"), F.lit(0).alias("side")))
    places = F.when(F.col("heavy").isNull(), alone).otherwise(F.transform(all_tiles, place))
    rest = [c for c in rows.columns if c != "group"]
    return joined.select(F.explode(places).alias("to"), *rest).select("to.group", "to.side", *rest)


def _close(n: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])


def candidates(tiles: DataFrame, percent: int) -> DataFrame:
    """Links ``a``, ``b`` as stars between nodes of different components that meet in a group and
    whose sizes and signatures allow the similarity."""
    rows = tiles.select("group", "side", "node", "comp", "n", "sig")
    rows = rows.repartition("group").sortWithinPartitions("group", "side")
    enough = least_agreement(percent)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _whole_groups(batches):
            group, side, node, comp, n = (block[c].to_numpy() for c in ("group", "side", "node", "comp", "n"))
            sig = np.frombuffer(b"".join(block["sig"].to_pylist()), np.uint8).reshape(len(group), -1)
            held_a, held_b = [], []

            def keep(i, j):
                fit = (comp[i] != comp[j]) & _close(n, i, j, percent)
                i, j = i[fit], j[fit]
                for lo in range(0, len(i), CELLS // MINIMA):
                    x, y = i[lo : lo + CELLS // MINIMA], j[lo : lo + CELLS // MINIMA]
                    agree = (sig[x] == sig[y]).sum(axis=1) >= enough
                    held_a.append(x[agree])
                    held_b.append(y[agree])

            heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            sizes = np.diff(np.r_[heads, len(group)])
            two = np.add.reduceat(side, heads) > 0
            small = ~two & (sizes <= 64)
            at, k = np.flatnonzero(np.repeat(small & (sizes > 1), sizes)), 1
            while len(at):
                at = at[at + k < len(group)]
                at = at[group[at] == group[at + k]]
                keep(at, at + k)
                k += 1
            for h, m, cross in zip(heads[~small].tolist(), sizes[~small].tolist(), two[~small].tolist()):
                mid = h + int((side[h : h + m] == 0).sum()) if cross else h + m
                for i in range(h, mid):
                    j = np.arange(mid if cross else i + 1, h + m)
                    keep(np.full(len(j), i), j)
            a = np.concatenate(held_a) if held_a else np.zeros(0, np.int64)
            b = np.concatenate(held_b) if held_b else np.zeros(0, np.int64)
            nodes, place = np.unique(node, return_inverse=True)  # a node may stand in many groups
            centre, leaf = _stars(place[a], place[b], len(nodes))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[centre]), pa.array(nodes[leaf])], ["a", "b"])

    return rows.mapInArrow(compare, "a long, b long")


def _shared(values: np.ndarray, sizes: np.ndarray, first: int) -> np.ndarray:
    """Sizes of the intersections of the first ``first`` sets with the others, or of all pairs if there are none."""
    cross = first < len(sizes)
    _, col, times = np.unique(values, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    some = times[col] > 1
    row, col = row[some], np.unique(col[some], return_inverse=True)[1]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((first, len(sizes) - first if cross else first))
    step = max(1, CELLS // len(sizes))
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, step):
        a, b = np.searchsorted(col, [lo, lo + step])
        cells = np.zeros((len(sizes), min(step, int(col[-1]) + 1 - lo)), np.float32)
        cells[row[a:b], col[a:b] - lo] = 1
        out += cells[:first] @ (cells[first:] if cross else cells).T
    return out


def confirmed(places: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a``, ``b`` as stars: nodes that meet in a group (``node``, ``group``, ``side``) and whose
    whole sets are similar enough."""
    rows = places.select("node", "group", "side").join(sets, "node")
    rows = rows.repartition("group").sortWithinPartitions("group", "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _whole_groups(batches):
            group, side, node = (block[c].to_numpy() for c in ("group", "side", "node"))
            lists = block["s"].combine_chunks()
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            held_a, held_b = [], []
            for h, e in zip(heads.tolist(), np.r_[heads[1:], len(group)].tolist()):
                first = int((side[h:e] == 0).sum())
                if e - h < 2 or not first:
                    continue
                sizes = np.diff(at[h : e + 1]).astype(np.int64)
                both = _shared(values[at[h] : at[e]], sizes, first)
                x, y = sizes[:first, None], sizes[None, first:] if first < e - h else sizes[None, :]
                i, j = np.nonzero((100 + percent) * both >= percent * (x + y))
                held_a.append(i + h)
                held_b.append(j + h + (first if first < e - h else 0))
            a = np.concatenate(held_a) if held_a else np.zeros(0, np.int64)
            b = np.concatenate(held_b) if held_b else np.zeros(0, np.int64)
            nodes, place = np.unique(node, return_inverse=True)
            centre, leaf = _stars(place[a], place[b], len(nodes))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[centre]), pa.array(nodes[leaf])], ["a", "b"])

    return rows.mapInArrow(compare, "a long, b long")


def _with_leader(met: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``node`` and ``leader``: for each node the one it shares most bands with, among the nodes
    that stand first in its keys by the crowd they meet, if sizes and signatures allow it."""
    crowd = written(met.groupBy(F.col("node").alias("k")).agg(F.sum("crowd").alias("crowds")), "crowds")
    ahead = met.join(crowd, F.col("node") == F.col("k")).groupBy(F.col("key").alias("own_key"))
    ahead = written(ahead.agg(F.max(F.struct("crowds", "node")).alias("top")), "leaders")
    edges = met.join(ahead, F.col("key") == F.col("own_key")).select("node", F.col("top.node").alias("leader"))
    edges = edges.filter("node <> leader").groupBy("node", "leader").agg(F.count("*").alias("bands"))
    best = edges.groupBy("node").agg(F.max(F.struct("bands", "leader")).alias("best"))
    marks = nodes.select(F.col("node").alias("k"), "n", "sig")
    pairs = best.select("node", F.col("best.leader").alias("leader")).join(marks, F.col("node") == F.col("k")).drop("k")
    theirs = marks.select("k", F.col("n").alias("n2"), F.col("sig").alias("sig2"))
    pairs = pairs.join(theirs, F.col("leader") == F.col("k")).select("node", "leader", "n", "n2", "sig", "sig2")
    enough = least_agreement(percent)

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("sig", "sig2"))
            n = np.concatenate([b.column("n").to_numpy(), b.column("n2").to_numpy()])
            i = np.arange(b.num_rows)
            fit = _close(n, i, i + b.num_rows, percent) & ((x == y).sum(axis=1) >= enough)
            yield b.select(["node", "leader", "n"]).filter(pa.array(fit))

    return pairs.mapInArrow(agree, "node long, leader long, n long")


def _around_leaders(edges: DataFrame) -> DataFrame:
    """``node``, ``group`` and ``side``: each leader with its nodes, many nodes in several groups."""
    sums = edges.groupBy(F.col("leader").alias("k")).agg(F.sum(F.col("n") + SET_WEIGHT).alias("w"))
    parts = written(sums.select("k", F.ceil(F.col("w") / TILE_SHINGLES).cast("int").alias("parts")), "leader-parts")
    own = F.xxhash64("k", F.pmod(F.hash("node"), F.col("parts")))
    nodes = edges.join(parts, F.col("leader") == F.col("k")).select("node", own.alias("group"), F.lit(1).alias("side"))
    every = parts.select("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return nodes.unionByName(every.select(F.col("k").alias("node"), F.xxhash64("k", "part").alias("group"), F.lit(0).alias("side")))


def near_sets(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 85
) -> DataFrame:
    """One row per row: ``id``, ``n_shingles`` and ``component``, the smallest id reachable by links.

    A text's set holds its distinct shingles of ``shingle`` words (A-Z in lower case; fewer
    words are one shingle). Rows are linked if 100 times the intersection of their sets is at
    least ``percent`` times the union.

    Null and empty texts and texts without words have the empty set and stand alone: their
    component is their own id. Repeated rows and equal sets fall together. Null ids take part
    but name a component only if it has no other ids. An empty table gives an empty table;
    other columns are not read. Shingles are told apart by 64-bit hashes, sets by 128 bits.

    Method: 128 minima of universal hashes in 32 bands of 4. Two sets at 0.85 share no band by
    a chance of (1 - 0.85^4)^32, 6 in 10^11. Sets that share a band are compared by signature,
    those that may be similar by their whole sets: no link stands on a signature.

    Plan: equal sets are one node. First each node is confirmed with one leader, that of its
    keys which meets the largest crowd, so a crowd around one text becomes one component in
    linear work. Then nodes of different components that still meet under a key are compared
    by signature in tiles; what remains is grouped and its sets are intersected in tiles, by
    products of 0/1 matrices. Tiles of one component never meet. A key or group of any size is
    cut by measured weight, tasks emit stars, not pairs, and components come from rounds
    of contraction to least neighbours. Texts are shuffled only for sets that have a candidate.
    """
    rows = written(signed(df, id_col, text_col, shingle), "signed-sets")
    first = [F.first(c).alias(c) for c in ("n", "keys", "sig")]
    nodes = rows.filter("n > 0").groupBy("digest").agg(F.min("id").alias("least_id"), F.min("rk").alias("rep"), *first)
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "sets")
    entries = nodes.select("node", F.explode("keys").alias("key"))
    crowds = entries.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("crowd")).filter("crowd > 1")
    met = written(entries.join(crowds, F.col("key") == F.col("k")).select("key", "node", "crowd"), "met")

    edges = written(_with_leader(met, nodes, percent), "leader-links")
    ends = edges.select("node").unionByName(edges.select(F.col("leader").alias("node"))).distinct()
    sets = written(sets_of(df, nodes.join(ends, "node", "left_semi"), id_col, text_col, shingle), "leader-sets")
    near = written(confirmed(_around_leaders(edges), sets, percent), "near-leaders")
    roots = components(near)
    comps = roots.select(F.col("node").alias("k"), F.col("root").alias("comp"))

    apart = met.join(comps, F.col("node") == F.col("k"), "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    apart = written(apart, "met-components")
    mixed = apart.groupBy(F.col("key").alias("k")).agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y")
    apart = apart.join(mixed.select("k"), F.col("key") == F.col("k"), "left_semi").withColumnRenamed("key", "group")
    tiles = placed(written(apart.withColumn("weight", F.lit(1).cast("long")), "apart"), TILE_ROWS)
    maybe = written(candidates(tiles.join(nodes.select("node", "n", "sig"), "node"), percent), "candidates")
    crowd = components(maybe)
    if not crowd.isEmpty():
        members = crowd.join(comps, F.col("node") == F.col("k"), "left").join(nodes.select("node", "n", "rep", "digest"), "node")
        members = members.select(
            F.col("root").alias("group"),
            "node",
            F.coalesce("comp", "node").alias("comp"),
            (F.col("n") + SET_WEIGHT).alias("weight"),
            "rep",
            "digest",
        )
        members = written(members, "candidate-members")
        sets = written(sets_of(df, members, id_col, text_col, shingle), "candidate-sets")
        places = placed(members.select("group", "node", "comp", "weight"), TILE_SHINGLES)
        more = components(between(confirmed(places, sets, percent), roots))
        # components of the first round that are linked now, and nodes that had no link before
        own = roots.select(F.col("node").alias("k"))
        alone = more.join(own, F.col("node") == F.col("k"), "left_anti")
        roots = written(renamed(roots, more).unionByName(alone), "last-components")
        comps = roots.select(F.col("node").alias("k"), F.col("root").alias("comp"))

    known = nodes.select("node", "digest", "least_id").join(comps, F.col("node") == F.col("k"), "left")
    known = known.withColumn("top", F.coalesce("comp", "node"))
    named = written(known.groupBy(F.col("top").alias("r")).agg(F.min("least_id").alias("component")), "named")
    classes = known.join(named, F.col("top") == F.col("r")).select(F.col("digest").alias("d"), "component")
    out = rows.select("id", "n", "digest").join(written(classes, "classes"), F.col("digest") == F.col("d"), "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select("id", F.col("n").alias("n_shingles"), component.alias("component"))
