"""Pairs of rows without a pair table: neighbours, kernel sums, similarity matrices.

One side small enough to copy (its size is measured first): every task scans its
own rows against the copy. Beyond that bound the data side is cut into Voronoi
cells around pivots. A row visits only the cells that the triangle inequality
cannot rule out, large cells and crowds of visitors are split into blocks of
bounded size, and each task reduces one block against one block with a matrix
product, so no task ever holds more than two blocks and no pair leaves it
unreduced. Results are exact; pruning only skips provably irrelevant cells.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, wraps

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.ranking import with_row_index
from quarry.functions.vectors import batches_to_matrices, from_matrix, to_matrix
from quarry.session import WORK_PER_TASK, broadcast_limit, cut_lineage, spread_small

BLOCK_ROWS = 4_096
MAX_PIVOTS = 2_048
FEW_COLUMNS = 8
CROWD = 8  # visited cells per row from which on cells are put together
TILE_BYTES = 64 * 1024 * 1024
CHUNK = 2_000_000  # pair distances held at a time inside a task
SLAB = 4_096  # data rows that a search takes at a time
SUM_ROWS, SUM_SLAB = 128, 2_048  # sides of a tile of kernel terms, which stays in the cache
NO_TERM = 1e-24  # of a sum's largest term: no number of rows that fits a table adds up to a change
SLACK = 1e-9  # share of the squared norms by which an expanded product may be off
MARGIN = 1e-6  # share of the spread added to every bound before a cell is ruled out


def whole_ids(df: DataFrame, id_col: str) -> bool:
    return isinstance(df.schema[id_col].dataType, T.IntegralType)


def any_ids(*tables: str, out: tuple[str, ...]):
    """Let an operator that works on whole-number ids take ids of any type that sorts.

    Other ids are numbered in their order (so ties still fall to the smaller id), the operator
    runs on the numbers, and the columns ``out`` of its result get the ids back. Whole numbers
    pass through untouched.
    """

    def wrap(fn):
        signature = inspect.signature(fn)

        @wraps(fn)
        def run(*args, **kwargs):
            bound = signature.bind(*args, **kwargs)
            bound.apply_defaults()
            given, id_col = bound.arguments, bound.arguments["id_col"]
            frames = {id(given[t]): given[t] for t in tables}
            if all(whole_ids(f, id_col) for f in frames.values()):
                return fn(*args, **kwargs)
            ids = None
            for f in frames.values():
                part = f.select(F.col(id_col).alias("__name"))
                ids = part if ids is None else ids.unionByName(part)
            names = with_row_index(ids.distinct(), ["__name"], index="__number").select("__name", "__number")
            names = cut_lineage(names, "ids")
            for key, f in frames.items():
                rest = [F.col("__number").alias(id_col), *[c for c in f.columns if c != id_col]]
                frames[key] = f.join(names, F.col(id_col).eqNullSafe(F.col("__name"))).select(*rest)
            given.update({t: frames[id(given[t])] for t in tables})
            found = fn(*bound.args, **bound.kwargs)
            table = found[0] if isinstance(found, tuple) else found
            columns = table.columns
            for c in out:
                own = names.select(F.col("__number").alias("__n"), F.col("__name").alias("__own"))
                table = table.join(own, F.col(c) == F.col("__n")).drop(c, "__n").withColumnRenamed("__own", c)
            table = table.select(*columns)
            return (table, *found[1:]) if isinstance(found, tuple) else table

        return run

    return wrap


def slim(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))


def extent(x: DataFrame) -> tuple[int, int]:
    n, m = x.agg(F.count("*"), F.max(F.size("v"))).first()
    return n, m or 0


def fetch(x: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A measured-small table as (ids, matrix), sorted by id."""
    t = x.toArrow().combine_chunks()
    ids = t.column("id").to_numpy()
    m = to_matrix(t.column("v"))
    order = np.argsort(ids, kind="stable")
    return ids[order], m[order]


def fits(spark, n: int, m: int) -> bool:
    return n * (m + 1) * 8 <= broadcast_limit(spark)


def worth_cells(n: int, m: int) -> bool:
    """Many rows of few columns: cells spare most of the pairs that a scan of a copy would measure."""
    return m <= FEW_COLUMNS and n > 8 * BLOCK_ROWS


def spread_queries(q: DataFrame, rows: int, n: int, m: int) -> DataFrame:
    """Queries dealt to tasks by their work against ``n`` copied rows, however few files or folds they come from."""
    spark = q.sparkSession
    most = max(4 * spark.sparkContext.defaultParallelism, rows * (m + 1) * 8 // broadcast_limit(spark))
    return q.repartition(min(most, 1 + rows * n * m // WORK_PER_TASK))


# --- kernels: numpy on one block against one block -------------------------------
def squared_distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """|x|^2 - 2 x.y + |y|^2, clamped at 0."""
    d = (-2 * q) @ x.T  # in place from here on, the terms added in the same order
    d += (q * q).sum(1)[:, None]
    d += (x * x).sum(1)[None, :]
    return np.maximum(d, 0, out=d)


def _truly_nearest(q, x, xid, r, c, k: int):
    """Of the pairs (query row, data row) the k nearest of each query, measured directly: rows, data rows, squares."""
    true = np.empty(len(r))
    for s in range(0, len(r), 50_000):
        diff = q[r[s : s + 50_000]] - x[c[s : s + 50_000]]
        true[s : s + 50_000] = (diff * diff).sum(1)
    order = np.lexsort((xid[c], true, r))
    r, c, true = r[order], c[order], true[order]
    keep = np.arange(len(r)) - np.searchsorted(r, r, "left") < k
    return r[keep], c[keep], true[keep]


def _same_ids(qid, xid):
    """All (query row, data row) of one id."""
    order = np.argsort(xid, kind="stable")
    held = xid[order]
    lo, hi = np.searchsorted(held, qid, "left"), np.searchsorted(held, qid, "right")
    r = np.repeat(np.arange(len(qid)), hi - lo)
    at = np.arange(len(r)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
    return r, order[at]


def _set(test: np.ndarray, size: int) -> np.ndarray:
    """Where the first ``size`` of ``test`` are true, few as they are: eight are looked at in one."""
    test[size : -(-size // 8) * 8] = False
    at = np.flatnonzero(test[: -(-size // 8) * 8].view(np.uint64))
    at = (8 * at[:, None] + np.arange(8)).ravel()
    return at[test[at]]


def block_nearest(qid, q, xid, x, k: int, skip_self: bool):
    """k nearest of each query inside one block as (query row, data row, distance).

    A product in single precision only preselects, with room for all it may be off; survivors
    are measured directly, so that ties are true ties and fall to the smaller id.
    """
    rows, cols, dist = [], [], []
    if not len(x):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    centre = x.mean(0)
    q0, x0 = q - centre, x - centre
    qq, xx = (q0 * q0).sum(1), (x0 * x0).sum(1)
    reach = float(xx.max())
    top = max(reach, float(qq[np.isfinite(qq)].max(initial=0.0)))
    kind = np.float32 if np.isfinite(top) else np.float64
    unit = 1 / np.sqrt(top) if 0 < top < np.inf else 1.0  # lengths up to 1: squares neither overflow nor vanish
    # conversion, products and sums of m + 1 terms, for both ends of a comparison, twice over
    loose = SLACK + 4 * (x.shape[1] + 8) * float(np.finfo(kind).eps)
    # |x|^2 - 2 q.x in one product; |q|^2 is the same for all rows of a query
    left = np.concatenate([-2 * unit * q0, np.ones((len(q), 1))], axis=1).astype(kind)
    right = np.concatenate([unit * x0, (unit * unit * xx)[:, None]], axis=1).astype(kind)
    slabs = [np.ascontiguousarray(right[s : s + SLAB].T) for s in range(0, len(x), SLAB)]
    slack = loose * unit * unit * (qq + 2 * reach)
    step = max(1, CHUNK // min(len(x), SLAB))
    space = np.empty(step * min(len(x), SLAB), kind)  # written anew for each slab
    test = np.zeros(-(-len(space) // 8) * 8, bool)
    own_r, own_c = _same_ids(qid, xid) if skip_self else (np.zeros(0, int), np.zeros(0, int))
    for a in range(0, len(q), step):
        part, room = left[a : a + step], slack[a : a + step]
        lo, hi = np.searchsorted(own_r, [a, a + step])
        mine_r, mine_c = own_r[lo:hi] - a, own_c[lo:hi]
        best = np.full((len(part), k), np.inf)  # the k smallest so far
        held, many = [], 0
        for s, slab in zip(range(0, len(x), SLAB), slabs):
            width = slab.shape[1]
            d = np.matmul(part, slab, out=space[: len(part) * width].reshape(len(part), width))
            here = (mine_c >= s) & (mine_c < s + SLAB)
            d[mine_r[here], mine_c[here] - s] = np.inf
            if not s:
                first = np.partition(d, k - 1, axis=1)[:, :k] if width > k else d
                best[:, : first.shape[1]] = np.where(np.isnan(first), np.inf, first)
                best.sort(axis=1)
            limit = (best[:, -1] + room).astype(kind)[:, None]  # the room is far above a rounding
            np.less_equal(d, limit, out=test[: d.size].reshape(d.shape))
            at = _set(test, d.size)
            at = at[np.isfinite(d.ravel()[at])]
            r, value = at // width, d.ravel()[at].astype(float)
            if s:
                some, pos = np.unique(r, return_inverse=True)
                pos, old = np.concatenate([pos, np.repeat(np.arange(len(some)), k)]), best[some].ravel()
                order = np.lexsort((np.concatenate([value, old]), pos))
                pos, merged = pos[order], np.concatenate([value, old])[order]
                best[some] = merged[np.arange(len(pos)) - np.searchsorted(pos, pos, "left") < k].reshape(-1, k)
            held.append((r, at % width + s, value))
            many += len(r)
            if many > CHUNK:  # crowds of rows as near as the k-th
                r, c, value = (np.concatenate(h) for h in zip(*held))
                near = value <= (best[:, -1] + room)[r]
                r, c, _ = _truly_nearest(q[a : a + step], x, xid, r[near], c[near], k)
                held, many = [(r, c, np.full(len(r), -np.inf))], 0
        r, c, value = (np.concatenate(h) for h in zip(*held))
        near = value <= (best[:, -1] + room)[r]
        r, c, true = _truly_nearest(q[a : a + step], x, xid, r[near], c[near], k)
        rows.append(a + r)
        cols.append(c)
        dist.append(np.sqrt(true))
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(dist)


def block_kernel_sums(qid, q, xid, x, widths, shift, skip_self: bool):
    """Per query and width: (exponent shift, sum of exp(-d2 / 2w - shift)).

    The shift makes the term of the nearest row 1. One product gives the exponents of the widest width; widths that
    halve cost a multiplication a pair, and pairs whose terms cannot change a sum are not carried on to narrower widths.
    """
    nw = len(widths)
    out = np.zeros((len(q), nw))
    if not nw or not len(x):
        return np.full((len(q), nw), -np.inf) if shift is None else shift, out
    order = sorted(range(nw), key=lambda i: -widths[i])
    steps = list(zip(order, order[1:]))
    scale = np.array([-0.5 / w for w in widths])
    wide = scale[order[0]]
    halving = all(widths[i] == 2 * widths[j] for i, j in steps)
    if shift is not None:
        given = np.where(np.isfinite(shift), shift, 0.0)
        halving = halving and all((2 * given[:, i] == given[:, j]).all() for i, j in steps)
    near = np.full(len(q), np.inf)  # the nearest so far
    centre = x.mean(0)
    q0, x0 = q - centre, x - centre
    qq, xx = (q0 * q0).sum(1), (x0 * x0).sum(1)
    left = np.concatenate([-2 * wide * q0, np.ones((len(q), 1)), wide * qq[:, None]], axis=1)
    if shift is not None:
        left[:, -1] -= given[:, order[0]]
    right = np.concatenate([x0, wide * xx[:, None], np.ones((len(x), 1))], axis=1)
    slabs = [(s, np.ascontiguousarray(right[s : s + SUM_SLAB].T)) for s in range(0, len(x), SUM_SLAB)]
    own_r, own_c = _same_ids(qid, xid) if skip_self else (np.zeros(0, int), np.zeros(0, int))
    space = np.empty(SUM_ROWS * SUM_SLAB)  # written anew for each tile
    first = 0  # the width after which terms fell away in the last tile
    for a in range(0, len(q), SUM_ROWS):
        rows = slice(a, a + SUM_ROWS)
        lo, hi = np.searchsorted(own_r, [a, a + SUM_ROWS])
        mine_r, mine_c = own_r[lo:hi] - a, own_c[lo:hi]
        for s, slab in slabs:
            size = (len(left[rows]), slab.shape[1])
            z = np.matmul(left[rows], slab, out=space[: size[0] * size[1]].reshape(size))
            here = (mine_c >= s) & (mine_c < s + SUM_SLAB)
            z[mine_r[here], mine_c[here] - s] = -np.inf
            if shift is None:
                old = near[rows]
                ref = np.where(np.isfinite(old), old, 0.0)
                now = np.maximum(ref + z.max(1) / wide, 0)
                at = np.flatnonzero(~(now >= old))
                if len(at):  # what was summed so far, seen from the nearer row
                    z[at] -= (wide * (now - ref))[at, None]
                    out[a + at] *= np.exp2((old - now)[at, None] * (scale / np.log(2)))
                    near[a + at] = now[at]
                    left[a + at, -1] = wide * (qq[a + at] - now[at])
            shifts = None if shift is None or halving else given[rows]
            first = _add_terms(out[rows], z, order, scale, halving, shifts, first)
    return near[:, None] * scale if shift is None else shift, out


def _add_terms(out, z, order, scale, halving, given, first: int) -> int:
    """Add the terms of one tile to the sums, widest first; ``z`` are the exponents of the widest and is overwritten.

    Terms are looked through from one width before ``first``, and the first of this tile is given back.
    """
    e, at, wide, columns, fell = None, None, order[0], z.shape[1], len(order)
    for k, i in enumerate(order):
        if halving:
            e = np.exp(z, out=z) if e is None else np.multiply(e, e, out=e)  # half the width: the square
        else:
            ratio = scale[i] / scale[wide]
            e = z * ratio
            if given is not None:
                rest = ratio * given[:, wide] - given[:, i]
                e += rest[:, None] if at is None else rest[at]
            np.exp(e, out=e)
        out[:, i] += e.sum(1) if at is None else np.bincount(at, e, len(out))
        if k + 1 == len(order) or k + 1 < first < len(order):
            continue
        # what a term is now if it is nothing at the next width
        test = ~(e <= (NO_TERM if given is not None else NO_TERM ** (scale[i] / scale[order[k + 1]])))
        many = np.count_nonzero(test)
        if not many:
            return min(fell, k)
        if 8 * many < e.size:
            fell = min(fell, k)
            keep = np.flatnonzero(test.ravel())
            at = keep // columns if at is None else at[keep]
            e, z = e.ravel()[keep], z if halving else z.ravel()[keep]
    return fell


# --- Voronoi cells ---------------------------------------------------------------
@dataclass
class Cells:
    pivots: np.ndarray
    count: np.ndarray
    radius: np.ndarray
    kth: np.ndarray

    @cached_property
    def gaps(self) -> np.ndarray:
        """Distances between pivots."""
        return self.distances(self.pivots)

    def distances(self, q: np.ndarray) -> np.ndarray:
        c = self.pivots.mean(0)
        return np.sqrt(squared_distances(q - c, self.pivots - c))

    def upper_bound(self, dq: np.ndarray, k: int) -> np.ndarray:
        """No row's k-th neighbour is farther than this."""
        a = (dq + self.kth[None, :]).min(1)
        reach = dq + self.radius[None, :]
        order = np.argsort(reach, axis=1)
        have = np.cumsum(self.count[order], axis=1)
        pos = (have >= k).argmax(1)
        b = np.take_along_axis(reach, order, 1)[np.arange(len(dq)), pos]
        b = np.where(have[:, -1] >= k, b, np.inf)
        return np.minimum(a, b)

    def reachable(self, dq: np.ndarray, within: np.ndarray) -> np.ndarray:
        """Boolean (row, cell): the cell may hold a row closer than ``within`` (per row or per row and cell)."""
        within = within if within.ndim == 2 else within[:, None]
        lower = dq - self.radius[None, :]
        own = dq.argmin(1)
        gap = self.gaps[own]
        spread = dq.max(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (dq**2 - dq.min(1)[:, None] ** 2) / (2 * gap)
        plane = np.where(gap > MARGIN * spread[:, None], plane, -np.inf)
        limit = within + MARGIN * (within + spread[:, None])
        return (np.maximum(lower, plane) <= limit) & (self.count[None, :] > 0)


def nearest_on_line(v: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each value and its distance; cells are intervals that do not overlap, to the last bit."""
    order = np.argsort(pivots, kind="stable")
    line = pivots[order]
    at = np.searchsorted(line[:-1] + np.diff(line) / 2, v, "left")
    at = np.searchsorted(line, line[at], "left")  # of equal pivots the first has the rows
    cell = np.where(np.isnan(v), 0, order[at])
    return cell, np.abs(v - pivots[cell])


def build_cells(x: DataFrame, n: int, m: int, k: int, carry: tuple[str, ...] = ()) -> tuple[DataFrame, Cells]:
    """Assign rows to their nearest pivot; measure every cell (at most MAX_PIVOTS rows).

    ``carry`` names columns of doubles that stay with the rows.
    """
    spark = x.sparkSession
    p = max(1, min(MAX_PIVOTS, 4 * -(-n // BLOCK_ROWS), max(1, broadcast_limit(spark) // (8 * m))))
    _, pivots = fetch(x.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(p))
    shared = spark.sparkContext.broadcast(pivots)

    def assign(batches):
        for b, v in batches_to_matrices(batches, "v"):
            if m == 1:
                cell, far = nearest_on_line(v[:, 0], shared.value[:, 0])
            else:
                c = shared.value.mean(0)
                d2 = squared_distances(v - c, shared.value - c)
                cell = d2.argmin(1)
                far = np.sqrt(d2[np.arange(len(v)), cell])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("v"), pa.array(cell.astype(np.int32)), pa.array(far), *[b.column(c) for c in carry]],
                names=["id", "v", "cell", "pd", *carry],
            )

    schema = "id long, v array<double>, cell int, pd double" + "".join(f", {c} double" for c in carry)
    placed = cut_lineage(x.mapInArrow(assign, schema), "cells")
    # one ranked pass; the row_number limit is pushed below the shuffle by Spark
    near = W.partitionBy("cell").orderBy("pd", "id")
    kth = (
        placed.select("cell", "pd", "id")
        .withColumn("r", F.row_number().over(near))
        .filter(F.col("r") <= k)
        .groupBy("cell")
        .agg(F.max(F.when(F.col("r") == k, F.col("pd"))).alias("kth"))
    )
    size = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("pd").alias("r"))
    cells = Cells(pivots, np.zeros(len(pivots), np.int64), np.zeros(len(pivots)), np.full(len(pivots), np.inf))
    for row in size.join(kth, "cell", "left").collect():
        cells.count[row["cell"]] = row["n"]
        cells.radius[row["cell"]] = row["r"]
        if row["kth"] is not None:
            cells.kth[row["cell"]] = row["kth"]
    return placed, cells


def _load(visits: DataFrame, cells: int) -> np.ndarray:
    """The number of visitors of each cell."""
    out = np.zeros(cells, np.int64)
    for r in visits.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return out


def _tile_rows(n: int, m: int) -> int:
    """An eighth of the rows, so that a row travels some eight times, in bounded memory."""
    return max(BLOCK_ROWS, min(-(-n // 8), TILE_BYTES // (8 * max(1, m))))


def _tiles(cells: Cells, rows: int) -> np.ndarray:
    """A tile for each cell: cells side by side along the pivots' longest axis, up to ``rows`` rows together."""
    spread = cells.pivots - cells.pivots.mean(0)
    _, axes = np.linalg.eigh(spread.T @ spread)
    tile, now, filled = np.zeros(len(cells.count), np.int32), 0, 0
    for c in np.argsort(spread @ axes[:, -1], kind="stable"):
        if filled and filled + cells.count[c] > rows:
            now, filled = now + 1, 0
        tile[c] = now
        filled += cells.count[c]
    return tile


def _coarsen(tile: np.ndarray):
    """Lists of cells become lists of their tiles, each once."""

    def run(batches):
        for b in batches:
            lists = b.column("cells")
            sizes = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(b.num_rows), sizes)
            at = np.unique(row * np.int64(len(tile)) + tile[lists.flatten().to_numpy()])
            off = np.searchsorted(at, np.arange(b.num_rows + 1) * np.int64(len(tile))).astype(np.int32)
            tiles = pa.ListArray.from_arrays(pa.array(off), pa.array((at % len(tile)).astype(np.int32)))
            cols = [tiles if n == "cells" else b.column(n) for n in b.schema.names]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return run


def visit_blocks(
    queries: DataFrame,
    placed: DataFrame,
    cells: Cells,
    within: Callable[[np.ndarray, np.ndarray], np.ndarray],
    extra: str = "",
    carry: tuple[str, ...] = (),
):
    """Grouped (query side, data side) pair keyed by (cell, data block, query block).

    ``within(dq, extra values)`` bounds how far each query row has to look.
    ``extra`` names a double column of the query side that travels along, ``carry`` columns of
    the data side. Where a row visits many cells, cells are put together to tiles, and the row
    travels once to each tile of which it visits a cell, unless that would double the pairs to measure.
    """
    spark = placed.sparkSession
    shared = spark.sparkContext.broadcast((cells.pivots, cells.count, cells.radius, cells.kth))

    def chunks(batches):
        step = max(1, CHUNK // max(1, len(shared.value[0])))
        for b in batches:
            for a in range(0, b.num_rows, step):
                yield from batches_to_matrices([b.slice(a, step)], "v")

    def targets(batches):
        c = Cells(*shared.value)
        for b, v in chunks(batches):
            dq = c.distances(v)
            far = within(dq, b.column(extra).to_numpy(zero_copy_only=False) if extra else None)
            hit = c.reachable(dq, far)
            r, cell = np.nonzero(hit)
            off = np.concatenate([[0], np.cumsum(hit.sum(1))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(off), pa.array(cell.astype(np.int32)))
            cols = [b.column("id"), b.column("v"), lists] + ([b.column(extra)] if extra else [])
            yield pa.RecordBatch.from_arrays(cols, names=["id", "v", "cells"] + ([extra] if extra else []))

    schema = "id long, v array<double>, cells array<int>" + (f", {extra} double" if extra else "")
    visits = cut_lineage(queries.mapInArrow(targets, schema), "visits")
    size, load, block = cells.count, _load(visits, len(cells.count)), BLOCK_ROWS
    if load.sum() > CROWD * visits.count():
        rows = _tile_rows(int(size.sum()), cells.pivots.shape[1])
        tile = _tiles(cells, rows)
        coarse = visits.mapInArrow(_coarsen(tile), schema)
        tile_size = np.bincount(tile, size, len(size)).astype(np.int64)
        tile_load = _load(coarse, len(size))
        if (tile_load * tile_size).sum() <= 2.0 * (load * size).sum():
            visits, size, load, block = coarse, tile_size, tile_load, rows
            dim = spark.createDataFrame([(c, int(t)) for c, t in enumerate(tile)], "cell int, tile int")
            placed = placed.join(F.broadcast(dim), "cell").drop("cell").withColumnRenamed("tile", "cell")
    split = spark.createDataFrame(
        [(int(c), int(-(-size[c] // block)), int(-(-load[c] // block))) for c in np.flatnonzero(load)],
        "cell int, nd int, nq int",
    )
    split = F.broadcast(split)  # at most MAX_PIVOTS rows
    h = lambda parts: F.pmod(F.xxhash64("id"), F.col(parts)).cast("int")
    upto = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    left = visits.withColumn("cell", F.explode("cells")).drop("cells").join(split, "cell")
    left = left.withColumn("qb", h("nq")).withColumn("db", upto("nd")).drop("nd", "nq")
    right = placed.select("id", "v", "cell", *carry).join(split, "cell")
    right = right.withColumn("db", h("nd")).withColumn("qb", upto("nq")).drop("nd", "nq")
    keys = ["cell", "db", "qb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys))


def _unpack(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = t.column("id").to_numpy()
    v = to_matrix(t.column("v"))
    order = np.argsort(ids, kind="stable")
    return ids[order], v[order]


# --- public operators ------------------------------------------------------------
NEIGHBOURS = "query_id long, neighbor_id long, distance double"


@any_ids("queries", "data", out=("query_id", "neighbor_id"))
def nearest_neighbours(
    queries: DataFrame,
    data: DataFrame,
    k: int,
    id_col: str = "id",
    vec_col: str = "features",
    include_self: bool = True,
) -> DataFrame:
    """Exact k nearest rows of ``data``: (query_id, rank, neighbor_id, distance).

    A row that is in both tables finds itself at distance 0 unless
    ``include_self`` is False. Ties fall to the smaller id.
    """
    spark = data.sparkSession
    x, q = slim(data, id_col, vec_col), slim(queries, id_col, vec_col)
    n, m = extent(x)
    if n == 0:
        return spark.createDataFrame([], "query_id long, rank int, neighbor_id long, distance double")
    skip = not include_self

    def emit(qid, xid, hit):
        r, c, dist = hit
        return [pa.array(qid[r]), pa.array(xid[c]), pa.array(dist)]

    names = ["query_id", "neighbor_id", "distance"]
    if fits(spark, n, m) and not worth_cells(n, m):
        shared = spark.sparkContext.broadcast(fetch(x))

        def scan(batches):
            # a query meets all rows here, so its neighbours come complete and in order
            xid, xv = shared.value
            for b, v in batches_to_matrices(batches, "v"):
                qid = b.column("id").to_numpy()
                r, c, dist = block_nearest(qid, v, xid, xv, k, skip)
                rank = np.arange(len(r)) - np.searchsorted(r, r, "left") + 1
                arrays = [pa.array(qid[r]), pa.array(rank.astype(np.int32)), pa.array(xid[c]), pa.array(dist)]
                yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "rank", "neighbor_id", "distance"])

        dealt = spread_queries(q, n if queries is data else q.count(), n, m)
        return dealt.mapInArrow(scan, "query_id long, rank int, neighbor_id long, distance double")
    else:
        look = k + 1 if skip else k
        placed, cells = build_cells(x, n, m, look)

        def match(left, right):
            if not left.num_rows or not right.num_rows:
                return pa.table({c: pa.array([], t) for c, t in zip(names, (pa.int64(), pa.int64(), pa.float64()))})
            qid, qv = _unpack(left)
            xid, xv = _unpack(right)
            return pa.Table.from_arrays(emit(qid, xid, block_nearest(qid, qv, xid, xv, k, skip)), names=names)

        bound = lambda dq, _: cells.upper_bound(dq, look)
        found = visit_blocks(q, placed, cells, bound).applyInArrow(match, NEIGHBOURS)
    w = W.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return (
        found.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "neighbor_id", "distance")
    )


def _block_within(qid, q, xid, x, radius: float, skip_self: bool):
    """All rows of one block within the radius of each query, measured directly."""
    centre = x.mean(0)
    q0, x0 = q - centre, x - centre
    reach = float((x0 * x0).sum(1).max())
    out = []
    step = max(1, CHUNK // len(x))
    for a in range(0, len(q), step):
        part = q0[a : a + step]
        slack = SLACK * ((part * part).sum(1) + reach)
        r, c = np.nonzero(squared_distances(part, x0) <= (radius * radius + slack)[:, None])
        for s in range(0, len(r), 50_000):
            i, j = a + r[s : s + 50_000], c[s : s + 50_000]
            diff = q[i] - x[j]
            d = np.sqrt((diff * diff).sum(1))
            keep = (d <= radius) & ((qid[i] != xid[j]) | (not skip_self))
            out.append((qid[i[keep]], xid[j[keep]], d[keep]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(col) for col in zip(*out))


@any_ids("queries", "data", out=("query_id", "neighbor_id"))
def within_radius(
    queries: DataFrame,
    data: DataFrame,
    radius: float,
    id_col: str = "id",
    vec_col: str = "features",
    include_self: bool = True,
) -> DataFrame:
    """All rows of ``data`` within ``radius`` of each query: (query_id, neighbor_id, distance), exact.

    Only pairs within the radius leave a task. Beyond the copy bound a query visits the cells
    that the radius can reach, as in :func:`nearest_neighbours`.
    """
    spark = data.sparkSession
    x, q = slim(data, id_col, vec_col), slim(queries, id_col, vec_col)
    n, m = extent(x)
    names, skip = ["query_id", "neighbor_id", "distance"], not include_self
    if n == 0:
        return spark.createDataFrame([], NEIGHBOURS)

    def table_of(found):
        return [pa.array(f, t) for f, t in zip(found, (pa.int64(), pa.int64(), pa.float64()))]

    if fits(spark, n, m):
        shared = spark.sparkContext.broadcast(fetch(x))

        def scan(batches):
            for b, v in batches_to_matrices(batches, "v"):
                found = _block_within(b.column("id").to_numpy(), v, *shared.value, radius, skip)
                yield pa.RecordBatch.from_arrays(table_of(found), names=names)

        return spread_small(q, n, m, n * m).mapInArrow(scan, NEIGHBOURS)
    placed, cells = build_cells(x, n, m, 1)

    def match(left, right):
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        some = left.num_rows and right.num_rows
        found = _block_within(*_unpack(left), *_unpack(right), radius, skip) if some else none
        return pa.Table.from_arrays(table_of(found), names=names)

    reach = lambda dq, _: np.full(len(dq), float(radius))
    return visit_blocks(q, placed, cells, reach).applyInArrow(match, NEIGHBOURS)


SUMS = "id long, shift array<double>, total array<double>"
BOX = 0.5  # width of a box on the line, in bandwidths
TERMS = 24  # of the series around a box's middle: what is left out is below 1e-20 of a row


def _powers(s: np.ndarray) -> np.ndarray:
    """s^q / q! for q < TERMS, a column each."""
    out = np.ones((len(s), TERMS))
    for q in range(1, TERMS):
        out[:, q] = out[:, q - 1] * s / q
    return out


def _box_sums(x: np.ndarray, sigma: float, boxes: np.ndarray, moments: np.ndarray, reach: int) -> np.ndarray:
    """Sums of exp(-(x - y)^2 / 2 sigma^2) over all rows y, from the moments of the boxes within ``reach``."""
    out = np.zeros(len(x))
    if not len(boxes):
        return out
    own = np.floor(x / (BOX * sigma))
    for off in range(-reach, reach + 1):
        at = np.minimum(np.searchsorted(boxes, own + off), len(boxes) - 1)
        hit = np.flatnonzero(boxes[at] == own + off)
        if not len(hit):
            continue
        m = moments[at[hit]]
        t = x[hit] / sigma - (own[hit] + off + 0.5) * BOX
        before, now = np.zeros(len(t)), np.ones(len(t))  # Hermite polynomials by their recurrence
        series = m[:, 0].copy()
        for q in range(1, TERMS):
            before, now = now, t * now - (q - 1) * before
            series += m[:, q] * now
        out[hit] += series * np.exp(-0.5 * t * t)
    return out


def line_sums(x: DataFrame, n: int, widths: list[float]) -> DataFrame | None:
    """Kernel sums of rows with one column over all rows, themselves included, in linear work.

    The line is cut into boxes of half a bandwidth. Rows of a box enter as the moments around its
    middle, and exp(-(t - s)^2 / 2) is the sum over q of s^q / q! He_q(t) exp(-t^2 / 2): with
    |s| <= 1/4 the terms fall faster than 4^-q / sqrt(q!), so the sums are exact to rounding. None
    where the boxes that hold rows are too many to copy, or a bandwidth or value has no box.
    """
    spark = x.sparkSession
    sigmas = [float(np.sqrt(w)) for w in widths]
    if not n or not all(s > 0 and np.isfinite(s) for s in sigmas):
        return None
    far = np.sqrt(2 * (np.log(max(2, n)) + 45))  # as in the plan by cells: e^-45 of the largest term, over all rows
    reach = int(np.ceil(far / BOX)) + 1

    def gather(batches):
        for b, v in batches_to_matrices(batches, "v"):
            for i, sigma in enumerate(sigmas):
                box, at = np.unique(np.floor(v[:, 0] / (BOX * sigma)), return_inverse=True)
                terms = _powers(v[:, 0] / sigma - (box[at] + 0.5) * BOX)
                m = np.stack([np.bincount(at, terms[:, q], len(box)) for q in range(TERMS)], axis=1)
                cols = [pa.array(np.full(len(box), i, np.int32)), pa.array(box), *[pa.array(m[:, q]) for q in range(TERMS)]]
                yield pa.RecordBatch.from_arrays(cols, names=["i", "box", *[f"m{q}" for q in range(TERMS)]])

    schema = "i int, box double, " + ", ".join(f"m{q} double" for q in range(TERMS))
    # little work a row: the rows stay where they are read
    per = x.mapInArrow(gather, schema).groupBy("i", "box").agg(*[F.sum(f"m{q}").alias(f"m{q}") for q in range(TERMS)])
    per = cut_lineage(per, "boxes")
    if not fits(spark, per.count(), TERMS + 1):
        return None
    t = per.toArrow()
    i, box = t.column("i").to_numpy(), t.column("box").to_numpy()
    if not np.isfinite(box).all():
        return None
    moments = np.stack([t.column(f"m{q}").to_numpy() for q in range(TERMS)], axis=1)
    order = np.lexsort((box, i))
    cuts = np.searchsorted(i[order], np.arange(len(widths) + 1))
    parts = [(box[order][a:b], moments[order][a:b]) for a, b in zip(cuts, cuts[1:])]
    shared = spark.sparkContext.broadcast(parts)

    def scan(batches):
        for b, v in batches_to_matrices(batches, "v"):
            s = np.stack([_box_sums(v[:, 0], sigma, *part, reach) for sigma, part in zip(sigmas, shared.value)], axis=1)
            yield pa.RecordBatch.from_arrays([b.column("id"), from_matrix(np.zeros_like(s)), from_matrix(s)], names=["id", "shift", "total"])

    return spread_small(x, n, 1, TERMS * 2 * reach * len(widths)).mapInArrow(scan, SUMS)


def _radius(x: DataFrame) -> float:
    """The largest distance of a row from the mean."""
    centre = x.select(Summarizer.mean(array_to_vector("v"))).first()[0].toArray()
    shared = x.sparkSession.sparkContext.broadcast(centre)

    def measure(batches):
        for _, v in batches_to_matrices(batches, "v"):
            yield pa.RecordBatch.from_arrays([pa.array([float(((v - shared.value) ** 2).sum(1).max())])], names=["d"])

    return float(x.mapInArrow(measure, "d double").agg(F.sqrt(F.max("d"))).first()[0])


@any_ids("df", out=("id",))
def kernel_sums(
    df: DataFrame, widths, id_col: str = "id", vec_col: str = "features", skip_self: bool = True
) -> tuple[DataFrame, int, int]:
    """Gaussian kernel sums of every row over all rows, for all widths in one pass.

    Gives (id, shift, total) with sum_j exp(-d2 / 2w) = exp(shift) * total, plus
    the number of rows and columns. Beyond the copy bound a row's reach is its
    nearest distance plus what can still change the last bit of its sum; where that reaches all rows, nearest
    rows are not looked for. Many rows of
    one column that count themselves are summed by :func:`line_sums`.
    """
    spark = df.sparkSession
    widths = [float(w) for w in widths]
    x = slim(df, id_col, vec_col)
    n, m = extent(x)
    names = ["id", "shift", "total"]
    if m == 1 and not skip_self and n > BLOCK_ROWS:
        sums = line_sums(x, n, widths)
        if sums is not None:
            return sums, n, m
    if fits(spark, n, m):
        shared = spark.sparkContext.broadcast(fetch(x))

        def scan(batches):
            xid, xv = shared.value
            for b, v in batches_to_matrices(batches, "v"):
                qid = b.column("id").to_numpy()
                top, s = block_kernel_sums(qid, v, xid, xv, widths, None, skip_self)
                yield pa.RecordBatch.from_arrays([b.column("id"), from_matrix(top), from_matrix(s)], names=names)

        return spread_small(x, n, m, n * (m + 20 * len(widths))).mapInArrow(scan, SUMS), n, m

    tail = 2 * max(widths) * (np.log(max(2, n)) + 45)  # e^-45 of the largest term, over all rows
    all_meet = tail >= 4 * _radius(x) ** 2  # no two rows are farther apart: nearest distances would exclude none
    if skip_self and not all_meet:
        nn = nearest_neighbours(df, df, 1, id_col, vec_col, include_self=False)
        q = x.join(nn.select(F.col("query_id").alias("id"), F.col("distance").alias("near")), "id")
    else:
        q = x.withColumn("near", F.lit(0.0))
    placed, cells = build_cells(x, n, m, 1)
    half = np.array([2 * w for w in widths])

    def add(left, right):
        if not left.num_rows or not right.num_rows:
            none = pa.array([], pa.list_(pa.float64()))
            return pa.table({"id": pa.array([], pa.int64()), "shift": none, "total": none})
        xid, xv = _unpack(right)
        qid, qv = left.column("id").to_numpy(), to_matrix(left.column("v"))
        near = left.column("near").to_numpy()
        shift = None if all_meet else -(near**2)[:, None] / half[None, :]
        shift, s = block_kernel_sums(qid, qv, xid, xv, widths, shift, skip_self)
        return pa.Table.from_arrays([pa.array(qid), from_matrix(shift), from_matrix(s)], names=names)

    reach = lambda dq, near: np.sqrt(near**2 + tail)
    parts = visit_blocks(q, placed, cells, reach, extra="near").applyInArrow(add, SUMS)
    w = range(len(widths))
    if all_meet:  # each block has a shift of its own
        held = parts.groupBy("id").agg(F.collect_list(F.struct("shift", "total")).alias("p"))
        top = lambda i: F.array_max(F.transform("p", lambda s: F.get(s["shift"], F.lit(i))))
        held = held.select("id", "p", F.array(*[top(i) for i in w]).alias("shift"))

        def total(i):
            top = F.get("shift", F.lit(i))
            term = lambda s: F.get(s["total"], F.lit(i)) * F.exp(F.get(s["shift"], F.lit(i)) - top)
            return F.when(top > -np.inf, F.aggregate("p", F.lit(0.0), lambda t, s: t + term(s))).otherwise(0.0)

        return held.select("id", "shift", F.array(*[total(i) for i in w]).alias("total")), n, m
    out = parts.groupBy("id").agg(
        F.first("shift").alias("shift"), F.array(*[F.sum(F.get("total", F.lit(i))) for i in w]).alias("total")
    )
    return out, n, m


@any_ids("xs", "ys", out=("x_id", "y_id"))
def similarity_matrix(
    xs: DataFrame,
    ys: DataFrame,
    measure: Callable[[np.ndarray, np.ndarray], np.ndarray],
    id_col: str = "id",
    vec_col: str = "features",
) -> DataFrame:
    """The N1 x N2 matrix in long form (x_id, y_id, sim): the one operator that emits all pairs.

    ``ys`` is copied when it is small; otherwise both sides are cut into blocks
    and meet once per pair of blocks.
    """
    spark = xs.sparkSession
    x, y = slim(xs, id_col, vec_col), slim(ys, id_col, vec_col)
    ny, m = extent(y)
    names = ["x_id", "y_id", "sim"]

    def cells(xid, xv, yid, yv):
        sim = measure(xv, yv)
        flat = pa.array(sim.ravel(), from_pandas=True)  # 0/0 becomes null
        return [pa.array(np.repeat(xid, len(yid))), pa.array(np.tile(yid, len(xid))), flat]

    schema = "x_id long, y_id long, sim double"
    if fits(spark, ny, m):
        shared = spark.sparkContext.broadcast(fetch(y))

        def scan(batches):
            yid, yv = shared.value
            for b, v in batches_to_matrices(batches, "v"):
                ids = b.column("id").to_numpy()
                step = max(1, CHUNK // max(1, len(yid)))
                for a in range(0, len(v), step):
                    yield pa.RecordBatch.from_arrays(cells(ids[a : a + step], v[a : a + step], yid, yv), names=names)

        return x.mapInArrow(scan, schema)
    nx, _ = extent(x)
    rows = max(1, BLOCK_ROWS // 4)
    bx, by = max(1, -(-nx // rows)), max(1, -(-ny // rows))
    own = lambda parts: F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = x.withColumn("bx", own(bx)).withColumn("by", each(by))
    right = y.withColumn("by", own(by)).withColumn("bx", each(bx))

    def match(a, b):
        if not a.num_rows or not b.num_rows:
            return pa.table({c: pa.array([], t) for c, t in zip(names, (pa.int64(), pa.int64(), pa.float64()))})
        return pa.Table.from_arrays(cells(*_unpack(a), *_unpack(b)), names=names)

    return left.groupBy("bx", "by").cogroup(right.groupBy("bx", "by")).applyInArrow(match, schema)
