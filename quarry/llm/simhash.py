"""SimHash near-dedup: fingerprints compared in tiles by exclusive-or and bit counts."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import fresh, quoted, text_of, written
from quarry.llm.components import components
from quarry.llm.shingles import distance, fingerprint

TILE_ROWS = 2048
PAIRS_AT_ONCE = 1 << 21


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int, words: int) -> DataFrame:
    """One row per row: ``id``, ``tk`` (hash of the text) and the columns ``f0``, ``f1``, ..."""
    rows = df.select(
        F.col(quoted(id_col)).alias("id"), F.xxhash64(text_of(text_col)).alias("tk"), text_of(text_col).alias("t")
    )
    names = [f"f{k}" for k in range(words)]
    schema = T.StructType(
        [rows.schema["id"], T.StructField("tk", T.LongType()), *[T.StructField(n, T.LongType()) for n in names]]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.zeros((b.num_rows, words), np.uint64)
            for i, t in enumerate(b.column("t").cast(pa.large_binary())):
                out[i] = fingerprint(t.as_py(), shingle, words)
            cols = [pa.array(out[:, k].view(np.int64)) for k in range(words)]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("tk"), *cols], ["id", "tk", *names])

    return rows.mapInArrow(sign, schema)


def block_masks(radius: int, agree: int) -> list[tuple[int, ...]]:
    """Masks such that two fingerprints of 64 bits within ``radius`` agree under at least one.

    The bits fall into ``radius + agree`` blocks; ``radius`` differing bits leave ``agree``
    of them untouched.
    """
    n = radius + agree
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(cuts)]
    return [(sum(c),) for c in itertools.combinations(blocks, agree)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _routed(prints: DataFrame, names: list[str], masks: list[tuple[int, ...]]) -> DataFrame:
    """Each fingerprint once per mask: ``key``, its words and ``pop`` (bits set)."""
    keys = [
        F.xxhash64(F.lit(i), *[F.col(n).bitwiseAND(F.lit(_signed(m))) for n, m in zip(names, mask)])
        for i, mask in enumerate(masks)
    ]
    pop = sum((F.bit_count(n) for n in names[1:]), F.bit_count(names[0]))
    return prints.select(F.explode(F.array(*keys)).alias("key"), *names, pop.cast("int").alias("pop"))


def _tiled(routed: DataFrame, names: list[str], radius: int) -> DataFrame:
    """``group`` and ``side``: what is compared with each other.

    Most keys are one group. A key with more than ``TILE_ROWS`` fingerprints is cut into
    tiles by bit count, then by hash; a row goes to one group for each tile whose bit count
    is within the radius, on side 0 or 1 of the pair of tiles.
    """
    classes = routed.groupBy("key", "pop").agg(F.count("*").alias("n"))
    sizes = written(classes.groupBy("key").agg(F.sum("n").alias("all")).filter(F.col("all") > TILE_ROWS), "hot-keys")
    hot = classes.join(sizes, "key", "left_semi").groupBy(F.col("key").alias("hot_key")).agg(
        F.collect_list(F.struct("pop", F.ceil(F.col("n") / TILE_ROWS).cast("int").alias("parts"))).alias("classes")
    )  # a key has at most one class per bit count
    rows = routed.join(written(hot, "tiles"), F.col("key") == F.col("hot_key"), "left")
    own = F.get(F.filter("classes", lambda c: c["pop"] == F.col("pop")), F.lit(0))["parts"]
    mine = F.struct(F.col("pop").alias("pop"), F.pmod(F.hash(*names), own).alias("part"))
    near = F.filter("classes", lambda c: F.abs(c["pop"] - F.col("pop")) <= radius)
    tiles = F.flatten(
        F.transform(
            near,
            lambda c: F.transform(
                F.sequence(F.lit(0), c["parts"] - 1),
                lambda k: F.struct(c["pop"].alias("pop"), k.cast("int").alias("part")),
            ),
        )
    )
    rows = rows.withColumn("mine", F.when(F.col("hot_key").isNotNull(), mine))

    def place(t: Column):
        lo, hi = F.least(t, F.col("mine")), F.greatest(t, F.col("mine"))
        return F.struct(
            F.xxhash64(F.col("key"), lo["pop"], lo["part"], hi["pop"], hi["part"]).alias("group"),
            F.when(t < F.col("mine"), 1).otherwise(0).alias("side"),
        )

    single = F.array(F.struct(F.col("key").alias("group"), F.lit(0).alias("side")))
    places = F.when(F.col("hot_key").isNull(), single).otherwise(F.transform(tiles, place))
    return rows.select(*names, "pop", F.explode(places).alias("g")).select("g.group", "g.side", "pop", *names)


def _tile_links(x, px, y, py, radius, same) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between two tiles sorted by bit count, as row numbers; ``same``: each pair once."""
    step = max(1, PAIRS_AT_ONCE // max(1, len(y)))
    for lo in range(0, len(x), step):
        hi = min(len(x), lo + step)
        a = np.searchsorted(py, int(px[lo]) - radius, "left")
        b = np.searchsorted(py, int(px[hi - 1]) + radius, "right")
        if same:
            a = max(a, lo)
        if a >= b:
            continue
        i, j = np.nonzero(distance(x[lo:hi, None, :], y[None, a:b, :]) <= radius)
        i, j = i + lo, j + a
        if same:
            i, j = i[i < j], j[i < j]
        yield i, j


def _stars(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The same components as the links (a, b), as stars around the least row number."""
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
    leaf = np.nonzero(label != np.arange(n))[0]
    return label[leaf], leaf


def _links_of(group: np.ndarray, side: np.ndarray, pop: np.ndarray, x: np.ndarray, radius: int):
    """Links within the groups of one block, as two arrays of fingerprints.

    Rows are sorted by group, side and bit count.
    """
    n = len(group)
    heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[heads, n])
    two = np.add.reduceat(side, heads) > 0
    small = ~two & (sizes <= 64)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0

    def keep(i, j):
        nonlocal held, count
        if len(i):
            held.append((i, j))
            count += len(i)
        if count > PAIRS_AT_ONCE:
            held = [_stars(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), n)]
            count = len(held[0][0])

    at = np.flatnonzero(np.repeat(small & (sizes > 1), sizes))
    k = 1
    while len(at):
        at = at[at + k < n]
        at = at[(group[at] == group[at + k]) & (pop[at + k] - pop[at] <= radius)]
        hit = distance(x[at], x[at + k]) <= radius
        keep(at[hit], at[hit] + k)
        k += 1
    for h, m, cross in zip(heads[~small].tolist(), sizes[~small].tolist(), two[~small].tolist()):
        mid = h + int((side[h : h + m] == 0).sum()) if cross else h
        stop = mid if cross else h + m
        for i, j in _tile_links(x[h:stop], pop[h:stop], x[mid : h + m], pop[mid : h + m], radius, not cross):
            keep(i + h, j + mid)
    if not held:
        return x[:0], x[:0]
    a, b = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
    # a fingerprint that meets others under several keys is one node, and the least of a
    # component is the centre of its star, as far as it can be the same in every block
    rows, place = np.unique(np.r_[a, b], return_inverse=True)
    nodes, node = np.unique(x[rows], axis=0, return_inverse=True)
    ends = node.ravel()[place]
    centre, leaf = _stars(ends[: len(a)], ends[len(a) :], len(nodes))
    return nodes[centre], nodes[leaf]


def links(prints: DataFrame, names: list[str], radius: int, masks: list[tuple[int, ...]]) -> DataFrame:
    """Links ``a0.., b0..`` between distinct fingerprints within ``radius`` that agree under a mask.

    Not every link is returned: those of a block of groups come as stars with the same
    components.
    """
    tiles = _tiled(_routed(prints, names, masks), names, radius)
    sorted_rows = tiles.repartition("group").sortWithinPartitions("group", "side", "pop")
    cols = [f"{s}{k}" for s in "ab" for k in range(len(names))]
    schema = T.StructType([T.StructField(c, T.LongType()) for c in cols])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def linked(part):
            group, side, pop, x = part
            ends = _links_of(group, side, pop, x.view(np.uint64), radius)
            arrays = [pa.array(e[:, k].view(np.int64)) for e in map(np.asfortranarray, ends) for k in range(x.shape[1])]
            return pa.RecordBatch.from_arrays(arrays, cols)

        for batch in batches:
            if not batch.num_rows:
                continue
            get = lambda c: batch.column(c).to_numpy()
            part = [get("group"), get("side").astype(np.int64), get("pop").astype(np.int64), np.stack([get(n) for n in names], 1)]
            if rest is not None:
                part = [np.concatenate([r, p]) for r, p in zip(rest, part)]
            # the last group may go on in the next batch
            cut = int(np.searchsorted(part[0], part[0][-1], "left"))
            if cut:
                yield linked([np.ascontiguousarray(p[:cut]) for p in part])
            rest = [p[cut:] for p in part]
        if rest is not None:
            yield linked([np.ascontiguousarray(p) for p in rest])

    return sorted_rows.mapInArrow(compare, schema)


def near_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4
) -> DataFrame:
    """One row per row: ``id``, ``tk`` (text hash), ``f0`` (fingerprint), ``root`` and ``component``.

    A fingerprint has 64 bits, each set if more than half of the hashes of the word shingles
    have it set. All fingerprints within ``radius`` bits are linked: those that share enough
    whole blocks of bits meet (see :func:`block_masks`). ``component`` is the smallest id
    reachable by links, ``root`` a fingerprint that names the group.

    A null or empty text has the fingerprint zero and is linked like any other. Null ids take
    part in their component but never name it, unless all are null. Repeated rows get equal
    results. An empty table gives an empty table.

    Plan: copies fall together as equal fingerprints before anything is compared, and none of
    the comparisons crosses two keys. A key of many fingerprints is cut into tiles, pairs of
    tiles whose bit counts differ by more than the radius never meet, and a task keeps only
    as many links as it has rows.
    """
    prints = written(fingerprints(df, id_col, text_col, shingle, 1), "fingerprints")
    nodes = written(prints.groupBy("f0").agg(F.min("id").alias("least_id")), "distinct-fingerprints")
    found = links(nodes.select("f0"), ["f0"], radius, block_masks(radius, 2))
    roots = written(components(found.select(F.col("a0").alias("a"), F.col("b0").alias("b"))), "components")
    # nodes without a link are their own component
    joined = nodes.join(roots, F.col("f0") == F.col("node"), "left")
    linked = written(
        joined.filter(F.col("node").isNotNull()).groupBy("root").agg(F.min("least_id").alias("component")), "named"
    ).withColumnRenamed("root", "r")
    named = joined.join(linked, F.col("root") == F.col("r"), "left").select(
        F.col("f0").alias("k"),
        F.coalesce("root", "f0").alias("root"),
        F.when(F.col("node").isNull(), F.col("least_id")).otherwise(F.col("component")).alias("component"),
    )
    return prints.join(written(named, "classes"), F.col("f0") == F.col("k")).select("id", "tk", "f0", "root", "component")


def hex_of() -> Column:
    """The fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex("f0")), 16, "0")


def keep_one(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4
) -> DataFrame:
    """The rows of ``df`` with one document of each group of :func:`near_groups`: that of the smallest id.

    Of rows with null ids a group keeps one (least text hash) only if it has no other ids. Of
    rows of one id with different texts in one group the one of least text hash stays; in
    different groups each stands for its group. Rows that repeat an id and text (null and
    empty are one text) count as copies, one stays.

    Plan: what goes is named by id and text hash, in a table without texts. Only rows that
    repeat an id and text are shuffled, to keep one of them.
    """
    groups = near_groups(df, id_col, text_col, shingle, radius)
    pairs = written(groups.groupBy("root", "id", "tk").agg(F.count("*").alias("n")), "pairs")
    first = pairs.groupBy(F.col("root").alias("r")).agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "tk")).alias("first")
    )
    judged = pairs.join(first, F.col("root") == F.col("r"))
    wins = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("tk") == F.col("first.tk"))
    judged = written(judged.select("id", "tk", wins.alias("wins"), "n"), "judged")
    key, mark = fresh(df, "key"), fresh(df, "mark")
    own = F.xxhash64(text_of(text_col))

    def named(rows: DataFrame) -> tuple[DataFrame, Column]:
        rows = rows.select(F.col("id").alias(key), F.col("tk").alias(mark))
        return rows, F.col(quoted(id_col)).eqNullSafe(F.col(key)) & (own == F.col(mark))

    alone = df.join(*named(judged.filter("not wins or n > 1")), "left_anti")
    repeated = df.join(*named(judged.filter("wins and n > 1")), "left_semi").withColumn(mark, own)
    return alone.unionByName(repeated.dropDuplicates([id_col, mark]).drop(mark))
