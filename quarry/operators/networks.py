"""Feed-forward networks: tanh hidden layers, trained data-parallel.

All folds and restarts train together: one pass over the cached rows returns the
loss and gradient of every network at its own trial point, and each network takes
its own L-BFGS step on the driver. The pass is a sum, so partitions may run
anywhere and again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.vectors import sum_by_slot, to_matrix
from quarry.session import cut_lineage, spread_small


@dataclass(frozen=True)
class Shape:
    """Layer sizes, input first; ``softmax`` output for classes, linear otherwise."""

    sizes: tuple[int, ...]
    softmax: bool = False

    @property
    def length(self) -> int:
        return sum((a + 1) * b for a, b in zip(self.sizes, self.sizes[1:]))

    def layers(self, w: np.ndarray):
        out, i = [], 0
        for a, b in zip(self.sizes, self.sizes[1:]):
            out.append((w[i : i + a * b].reshape(a, b), w[i + a * b : i + (a + 1) * b]))
            i += (a + 1) * b
        return out

    def start(self, rng: np.random.Generator) -> np.ndarray:
        parts = []
        for a, b in zip(self.sizes, self.sizes[1:]):
            r = np.sqrt(6.0 / (a + b))
            parts += [rng.uniform(-r, r, a * b), rng.uniform(-r, r, b)]
        return np.concatenate(parts)

    def forward(self, w: np.ndarray, x: np.ndarray):
        acts = [x]
        layers = self.layers(w)
        for i, (m, b) in enumerate(layers):
            z = acts[-1] @ m + b
            acts.append(np.tanh(z) if i < len(layers) - 1 else z)
        if self.softmax:
            z = acts[-1] - acts[-1].max(1, keepdims=True)
            e = np.exp(z)
            acts[-1] = e / e.sum(1, keepdims=True)
        return acts

    def loss_and_gradient(self, w: np.ndarray, x: np.ndarray, y: np.ndarray):
        """Summed loss (half squared error, or cross entropy) and its gradient."""
        acts = self.forward(w, x)
        if self.softmax:
            hot = np.zeros_like(acts[-1])
            hot[np.arange(len(y)), y.astype(int)] = 1
            loss = -np.log(np.maximum(acts[-1][np.arange(len(y)), y.astype(int)], 1e-300)).sum()
            delta = acts[-1] - hot
        else:
            delta = acts[-1] - y[:, None]
            loss = 0.5 * (delta * delta).sum()
        grads = []
        layers = self.layers(w)
        for i in range(len(layers) - 1, -1, -1):
            grads.append((acts[i].T @ delta, delta.sum(0)))
            if i:
                delta = (delta @ layers[i][0].T) * (1 - acts[i] ** 2)
        return loss, np.concatenate([np.concatenate([g.ravel(), b]) for g, b in reversed(grads)])


@dataclass
class _Search:
    """L-BFGS state of one network; ``trial`` is the point the next pass evaluates."""

    w: np.ndarray
    trial: np.ndarray
    fold: int
    restart: int
    loss: float = np.inf
    grad: np.ndarray | None = None
    step: np.ndarray | None = None
    size: float = 1.0
    pairs: list = field(default_factory=list)
    history: list = field(default_factory=list)
    done: bool = False

    def _direction(self) -> np.ndarray:
        q, a = self.grad.copy(), []
        for s, y, r in reversed(self.pairs):
            a.append(r * (s @ q))
            q -= a[-1] * y
        if self.pairs:
            s, y, _ = self.pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.linalg.norm(q))
        for (s, y, r), c in zip(self.pairs, reversed(a)):
            q += (c - r * (y @ q)) * s
        return -q

    def update(self, loss: float, grad: np.ndarray, goal: float, epochs: int) -> None:
        accepted = self.grad is None or loss <= self.loss + 1e-4 * self.size * (self.grad @ self.step)
        if accepted and np.isfinite(loss):
            if self.grad is not None:
                s, y = self.trial - self.w, grad - self.grad
                if s @ y > 1e-12 * np.linalg.norm(s) * np.linalg.norm(y):
                    self.pairs = [*self.pairs, (s, y, 1 / (s @ y))][-10:]
            self.w, self.loss, self.grad = self.trial, loss, grad
            self.history.append(loss)
            if loss <= goal or len(self.history) > epochs or np.abs(grad).max() < 1e-9:
                self.done = True
                return
            self.step, self.size = self._direction(), 1.0
            if self.step @ grad >= 0:
                self.pairs, self.step = [], -grad / max(1.0, np.linalg.norm(grad))
        else:
            self.size /= 4
            if self.size < 1e-8:
                self.done = True
                return
        self.trial = self.w + self.size * self.step


@dataclass(frozen=True)
class Network:
    shape: Shape
    weights: np.ndarray
    loss: float

    def transform(self, df: DataFrame, vec_col: str = "features", out: str = "prediction") -> DataFrame:
        """Real output, or the most probable class (softmax)."""
        shape, w = self.shape, self.weights

        @F.pandas_udf("double")
        def run(v: pd.Series) -> pd.Series:
            if not len(v):
                return pd.Series([], dtype=float)
            o = shape.forward(w, np.stack(v.to_numpy()).astype(float))[-1]
            return pd.Series(o.argmax(1).astype(float) if shape.softmax else o[:, 0])

        return df.withColumn(out, run(F.col(vec_col).cast("array<double>")))


@dataclass
class Trained:
    """Best network per fold (lowest final training error) and every learning curve."""

    networks: dict[int, Network]
    curve: DataFrame


def train_networks(
    df: DataFrame,
    hidden: Sequence[int],
    label: str = "label",
    vec_col: str = "features",
    fold: str | None = None,
    classes: int | None = None,
    restarts: int = 1,
    goal: float = 0.0,
    epochs: int = 100,
    l2: float = 0.0,
    seed: int = 0,
) -> Trained:
    """Mean loss per row is minimised; training stops at ``goal`` or after ``epochs`` accepted steps.

    Without ``fold`` one network (key -1) trains on all rows; with it, network k
    trains on the rows outside fold k.
    """
    spark = df.sparkSession
    slim = df.select(
        F.col(vec_col).cast("array<double>").alias("x"),
        F.col(label).cast("double").alias("y"),
        (F.col(fold).cast("int") if fold else F.lit(0)).alias("k"),
    )
    found = slim.groupBy("k").agg(F.count("*").alias("n"), F.max(F.size("x")).alias("m")).collect()
    sizes, m = {r["k"]: r["n"] for r in found}, max(r["m"] for r in found)
    weights = Shape((m, *hidden, classes or 1)).length * restarts * (len(sizes) if fold else 1)
    # read once per pass: the short plan of written rows, cached where memory allows
    slim = cut_lineage(spread_small(slim, sum(sizes.values()), m, 4 * weights), "network")
    slim = slim.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = sum(sizes.values())
        folds = sorted(sizes) if fold else [-1]
        shape = Shape((m, *hidden, classes or 1), softmax=bool(classes))
        searches = []
        for f in folds:
            for r in range(restarts):
                w = shape.start(np.random.default_rng([seed, f + 1, r]))
                searches.append(_Search(w, w, f, r))
        while True:
            live = [(i, s) for i, s in enumerate(searches) if not s.done]
            if not live:
                break
            points = [(i, s.fold, s.trial) for i, s in live]

            def kernel(batches, points=points):
                acc = {}
                for b in batches:
                    if not b.num_rows:
                        continue
                    x, y, k = to_matrix(b.column("x")), b.column("y").to_numpy(), b.column("k").to_numpy()
                    for i, f, w in points:
                        use = k != f
                        if use.any():
                            loss, g = shape.loss_and_gradient(w, x[use], y[use])
                            acc[i] = acc.get(i, 0) + np.concatenate([[loss], g])
                yield from acc.items()

            sums = sum_by_slot(slim, kernel)
            for i, s in live:
                n = total - sizes.get(s.fold, 0)
                v = sums[i]
                loss = v[0] / n + 0.5 * l2 / n * (s.trial @ s.trial)
                s.update(float(loss), v[1:] / n + l2 / n * s.trial, goal, epochs)
    finally:
        slim.unpersist()
    best = {}
    for s in searches:
        if s.fold not in best or s.loss < best[s.fold].loss:
            best[s.fold] = s
    curve = [(s.fold, s.restart, e, float(v)) for s in searches for e, v in enumerate(s.history)]
    return Trained(
        {f: Network(shape, s.w, s.loss) for f, s in best.items()},
        spark.createDataFrame(curve, "fold int, restart int, epoch int, loss double"),
    )


@dataclass
class _Walk:
    """Adam state of one network, as of the last pass."""

    shape: Shape
    fold: int
    w: np.ndarray
    m: np.ndarray
    v: np.ndarray
    steps: float
    rate: float
    best: float = np.inf
    waited: int = 0
    cuts: int = 0
    history: list = field(default_factory=list)
    done: bool = False

    def after(self, loss: float, tol: float, patience: int, cuts: int) -> None:
        """A pass is over: without progress for ``patience`` passes the rate is cut, in the end training stops."""
        self.history.append(loss)
        if not np.isfinite(loss):
            self.done = True
        elif loss < self.best - tol * abs(self.best if np.isfinite(self.best) else 0.0):
            self.best, self.waited = loss, 0
        else:
            self.waited += 1
            if self.waited >= patience:
                self.waited, self.cuts, self.rate = 0, self.cuts + 1, self.rate / 4
                self.done = self.cuts > cuts


def _adam_steps(walk: _Walk, x, y, rows: int, l2: float):
    """One Adam step per ``rows`` rows; returns the summed loss before each step."""
    total = 0.0
    for a in range(0, len(x), rows):
        part = x[a : a + rows]
        loss, g = walk.shape.loss_and_gradient(walk.w, part, y[a : a + rows])
        total += loss
        g = g / len(part) + l2 * walk.w
        walk.steps += 1
        walk.m = 0.9 * walk.m + 0.1 * g
        walk.v = 0.999 * walk.v + 0.001 * g * g
        m = walk.m / (1 - 0.9**walk.steps)
        v = walk.v / (1 - 0.999**walk.steps)
        walk.w = walk.w - walk.rate * m / (np.sqrt(v) + 1e-8)
    return total


def train_adam(
    df: DataFrame,
    layers: Sequence[Sequence[int]],
    label: str = "label",
    vec_col: str = "features",
    fold: str | None = None,
    classes: int | None = None,
    batch_rows: int = 200,
    rate: float = 1e-3,
    epochs: int = 500,
    tol: float = 1e-4,
    patience: int = 10,
    cuts: int = 4,
    l2: float = 0.0,
    seed: int = 0,
) -> dict[tuple[int, ...], Trained]:
    """Networks with the hidden ``layers`` of each entry, trained by Adam: entry -> best networks and curves.

    All entries and folds train together, one pass over the rows per epoch. In a pass every
    task walks through its rows in mini-batches of ``batch_rows``, drawn anew by (seed, epoch),
    from the weights and moments of the last pass; the driver averages weights and moments of
    the tasks by their rows. With one partition that is Adam itself, with more it is Adam with
    averaging after each epoch. A network stops when its epoch loss (mean before each step)
    has not fallen by ``tol`` for ``patience`` epochs after the rate was cut ``cuts`` times to a
    quarter, or after ``epochs``; the others go on. Network ``loss`` is that of the final weights.

    A task that runs again repeats its steps: the draw depends on the rows' place in the
    written table alone. Tasks hold one Arrow batch of rows and the networks.
    """
    spark = df.sparkSession
    slim = df.select(
        F.col(vec_col).cast("array<double>").alias("x"),
        F.col(label).cast("double").alias("y"),
        (F.col(fold).cast("int") if fold else F.lit(0)).alias("k"),
    )
    found = slim.groupBy("k").agg(F.count("*").alias("n"), F.max(F.size("x")).alias("m")).collect()
    if not found:
        raise ValueError("empty table")
    sizes, m = {r["k"]: r["n"] for r in found}, max(r["m"] for r in found)
    total = sum(sizes.values())
    entries = list(dict.fromkeys(tuple(h) for h in layers))
    walks = []
    for hidden in entries:
        shape = Shape((m, *hidden, classes or 1), softmax=bool(classes))
        for f in sorted(sizes) if fold else [-1]:
            w = shape.start(np.random.default_rng([seed, f + 1, *hidden]))
            walks.append(_Walk(shape, f, w, np.zeros_like(w), np.zeros_like(w), 0.0, rate))
    slim = cut_lineage(spread_small(slim, total, m, sum(len(w.w) for w in walks)), "network")

    def one_pass(kernel):
        return sum_by_slot(slim, kernel)

    for epoch in range(epochs):
        live = [(i, w) for i, w in enumerate(walks) if not w.done]
        if not live:
            break

        def walk_rows(batches, live=live, epoch=epoch):
            own = {i: _Walk(w.shape, w.fold, w.w, w.m, w.v, w.steps, w.rate) for i, w in live}
            rows, loss = dict.fromkeys(own, 0), dict.fromkeys(own, 0.0)
            for at, b in enumerate(batches):
                if not b.num_rows:
                    continue
                order = np.random.default_rng([seed, epoch, at]).permutation(b.num_rows)
                x, y, k = to_matrix(b.column("x"))[order], b.column("y").to_numpy()[order], b.column("k").to_numpy()[order]
                for i, w in own.items():
                    use = k != w.fold
                    if use.any():
                        loss[i] += _adam_steps(w, x[use], y[use], batch_rows, l2 / max(1, total - sizes.get(w.fold, 0)))
                        rows[i] += int(use.sum())
            for i, w in own.items():
                if rows[i]:
                    yield i, np.concatenate([[rows[i], loss[i], rows[i] * w.steps], rows[i] * w.w, rows[i] * w.m, rows[i] * w.v])

        sums = one_pass(walk_rows)
        for i, w in live:
            if i not in sums:  # no row outside its fold
                w.done = True
                continue
            n, loss = sums[i][:2]
            w.steps = sums[i][2] / n
            w.w, w.m, w.v = sums[i][3:].reshape(3, -1) / n
            w.after(float(loss / n), tol, patience, cuts)

    def measure(batches):
        acc = {}
        for b in batches:
            if b.num_rows:
                x, y, k = to_matrix(b.column("x")), b.column("y").to_numpy(), b.column("k").to_numpy()
                for i, w in enumerate(walks):
                    use = k != w.fold
                    if use.any():
                        acc[i] = acc.get(i, 0) + np.array([w.shape.loss_and_gradient(w.w, x[use], y[use])[0], use.sum()])
        yield from acc.items()

    final = one_pass(measure)
    out = {}
    for hidden in entries:
        mine = [(i, w) for i, w in enumerate(walks) if w.shape.sizes[1:-1] == hidden]
        nets = {}
        for i, w in mine:
            held = final.get(i, np.array([np.nan, 1.0]))
            n = max(1, total - sizes.get(w.fold, 0))
            nets[w.fold] = Network(w.shape, w.w, float(held[0] / held[1] + 0.5 * l2 / n * (w.w @ w.w)))
        curve = [(w.fold, 0, e, float(v)) for _, w in mine for e, v in enumerate(w.history)]
        out[hidden] = Trained(nets, spark.createDataFrame(curve, "fold int, restart int, epoch int, loss double"))
    return out


def predict_by_fold(df: DataFrame, trained: Trained, vec_col: str = "features", fold: str = "fold") -> DataFrame:
    """Each row scored by the network that did not see its fold."""
    nets = trained.networks

    @F.pandas_udf("double")
    def run(v: pd.Series, k: pd.Series) -> pd.Series:
        out = np.zeros(len(v))
        if len(v):
            x, ks = np.stack(v.to_numpy()).astype(float), k.to_numpy()
            for f, net in nets.items():
                rows = ks == f
                if rows.any():
                    o = net.shape.forward(net.weights, x[rows])[-1]
                    out[rows] = o.argmax(1) if net.shape.softmax else o[:, 0]
        return pd.Series(out)

    return df.withColumn("prediction", run(F.col(vec_col).cast("array<double>"), F.col(fold).cast("int")))
