"""Histogram trees for many fits at once.

A fit is a unit (a fold, a cluster, a stock) with a learner: one tree, a forest
or boosted trees.  Targets are fixed point numbers, so that all sums are exact in
any order and a fit does not depend on how its rows are dealt to tasks.  A tree and
a forest may split at every value of a feature, so features become ranks; boosted
trees, as their libraries do, at the ends of at most 256 bins per unit.

A unit of at most ``BOUND`` rows and ``CELLS`` values is binned as one group, then
fitted by one group for each learner and, as trees of a forest do not depend on each
other, for some trees of a forest: level by level from arrays, all open nodes (and
several trees of a forest) together.
A larger unit is never gathered.  Its rows stay where they are; per level every
task adds up the histograms of all open nodes of all such units, Spark adds the
tasks' and picks each node's split, and only the splits reach the driver.  For
splits at every value, the histogram tells which bins may hold the best one; the
values in those bins are then tried one by one.
Forest nodes that have come down to ``BOUND`` rows are finished as groups, to
any depth.  Both ways grow the same trees.

Rows are drawn by a hash of their number and the tree's: a share of them for a
boosted tree, Poisson weights of mean one for a forest's.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

WIDTH = 256
BOUND = 1_000_000
#: Most values (rows x features) that one group holds: a task has them as ranks (4 bytes
#: each) in several forms, and fits feature by feature.
CELLS = 16_000_000
#: Rows that the trees of a forest which one group grows have together, and the most groups of a forest.
ROW_TREES, SHARES = 200_000, 25
#: Most partitions that the fits of small units are dealt to, and partitions for each fit: few meet in one.
FITS, APART = 2000, 4
#: Rounds after which the sums of a boosted fit are written down anew.
REWRITE = 20
#: Trees of a forest that are grown in one pass over a large unit.
TOGETHER = 10


@dataclass(frozen=True)
class Learner:
    """``depth`` and ``leaves`` None: without limit."""

    kind: str  # tree, forest or boosted
    trees: int = 1
    depth: int | None = None
    rate: float = 1.0
    rows: float = 1.0
    columns: float = 1.0
    min_leaf: int = 1
    l2: float = 0.0
    leaves: int | None = None
    seed: int = 42

    def weights(self, row: np.ndarray, tree: int) -> np.ndarray:
        """How often each row counts in a tree."""
        if self.kind == "tree" or (self.kind == "boosted" and self.rows >= 1):
            return np.ones(len(row))
        with np.errstate(over="ignore"):
            x = row.astype(np.int64).view(np.uint64) + np.uint64((self.seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        u = (x ^ (x >> np.uint64(31))).astype(float) / 2.0**64
        if self.kind == "boosted":
            return (u < self.rows).astype(float)
        k = np.arange(20)
        return np.searchsorted(np.cumsum(np.exp(-1) / np.cumprod(np.r_[1, k[1:]])), u, side="right").astype(float)

    def allowed(self, tree: int, features: int) -> np.ndarray:
        """The columns that a tree may split on."""
        mask = np.zeros(features, bool)
        mask[np.random.default_rng([self.seed, tree]).permutation(features)[: max(1, int(self.columns * features))]] = True
        return mask


def edges_of(values: np.ndarray, width: int | None = None) -> np.ndarray:
    """Upper ends of all bins but the last of one feature: every value, or, with
    ``width``, the ones at equal steps of rank if there are more than that."""
    distinct = np.unique(values)
    if width and len(distinct) > width:
        distinct = np.unique(np.sort(values)[(np.arange(1, width + 1) * len(values) // width) - 1])
    return distinct[:-1]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(x), len(edges)), np.min_scalar_type(max(map(len, edges), default=0)))
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(e, x[:, j])
    return out


def matrix_of(column: pa.Array | pa.ChunkedArray, kind, width: int) -> np.ndarray:
    """The rows of a binary column, ``width`` numbers each."""
    parts = [np.zeros(0, np.uint8)]
    for c in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        _, ends, data = c.buffers()
        if len(c) and data is not None:
            ends = np.frombuffer(ends, np.int64 if pa.types.is_large_binary(c.type) else np.int32)[c.offset : c.offset + len(c) + 1]
            parts.append(np.frombuffer(data, np.uint8)[ends[0] : ends[-1]])
    return np.concatenate(parts).view(kind).reshape(len(column), width)


@dataclass(frozen=True)
class Target:
    """A unit's labels as fixed point numbers about their (rounded) mean."""

    mean: float
    factor: float

    @staticmethod
    def of(n: int, mean: float, low: float, high: float) -> "Target":
        mean = float(np.float32(mean))
        far = max(high - mean, mean - low) or 1.0
        return Target(mean, 2.0 ** (50 - int(np.ceil(np.log2(n + 1))) - int(np.ceil(np.log2(far)))))

    def fixed(self, y: np.ndarray, at) -> np.ndarray:
        return np.rint((y - at) * self.factor)


def histogram(node: np.ndarray, bins: np.ndarray, nodes: int, *values: np.ndarray) -> np.ndarray:
    """(values, nodes, features, WIDTH): sums of each of ``values``."""
    out = np.zeros((len(values), nodes, bins.shape[1], WIDTH))
    start = node.astype(np.int64) * WIDTH
    for j, b in enumerate(np.ascontiguousarray(bins.T)):
        cell = start + b
        for k, v in enumerate(values):
            out[k, :, j] = np.bincount(cell, v, nodes * WIDTH).reshape(nodes, WIDTH)
    return out


def _score(g, n, l2):
    return g * g / np.maximum(n + l2, 1e-300)


def _gain(lg, ln, g, n, learner: Learner):
    if learner.l2 == 0:  # a shift changes nothing but the rounding: sums about the node's mean
        middle = np.rint(g / np.maximum(n, 1))
        lg, g = lg - ln * middle, g - n * middle
    whole = _score(g, n, learner.l2)
    gain = _score(lg, ln, learner.l2) + _score(g - lg, n - ln, learner.l2) - whole
    ok = (ln >= learner.min_leaf) & (n - ln >= learner.min_leaf) & (gain > (1e-12 * whole if learner.l2 else 0))
    return np.where(ok, gain, -np.inf)


@dataclass
class Splits:
    """Per node: sums, and the best split (gain -inf: none)."""

    g: np.ndarray
    n: np.ndarray
    gain: np.ndarray
    feature: np.ndarray
    bin: np.ndarray

    def keep(self, feature: int, node: np.ndarray, bin_: np.ndarray, gain: np.ndarray) -> None:
        """Take the splits of a feature, sorted by node and bin, that are better than
        the ones so far; of equal ones the first stays."""
        if not len(node):
            return
        start = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        most, here = np.maximum.reduceat(gain, start), node[start]
        better = most > self.gain[here]
        hit = np.flatnonzero(gain == np.repeat(np.where(better, most, np.nan), np.diff(np.r_[start, len(node)])))
        first = hit[np.unique(node[hit], return_index=True)[1]]
        self.gain[here[better]], self.feature[here[better]], self.bin[here[better]] = most[better], feature, bin_[first]


def nodes_at_once(hist: np.ndarray) -> int:
    """So that the arrays made from a histogram stay small."""
    return max(1, 2**20 // max(hist[0, :1].size, 1))


def best_of_histogram(hist: np.ndarray, allowed: np.ndarray, learner: Learner) -> Splits:
    nodes, features = hist.shape[1:3]
    some = nodes_at_once(hist)
    if nodes > some:
        parts = [vars(best_of_histogram(hist[:, i : i + some], allowed[i : i + some], learner)) for i in range(0, nodes, some)]
        return Splits(**{k: np.concatenate([p[k] for p in parts]) for k in parts[0]})
    g, n = hist[:, :, 0, :].sum(axis=-1)
    lg, ln = np.cumsum(hist, axis=-1)[..., :-1]
    gain = np.where(allowed[:, :, None], _gain(lg, ln, g[:, None, None], n[:, None, None], learner), -np.inf).reshape(nodes, -1)
    at = gain.argmax(axis=1)
    return Splits(g, n, gain[np.arange(nodes), at], at // (WIDTH - 1), at % (WIDTH - 1))


def promising(hist: np.ndarray, allowed: np.ndarray, learner: Learner) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bins (nodes, features, WIDTH) in which the best split at a value may lie, and
    the sums of ``g`` and ``w`` before each bin, from a histogram of ``g``, ``w`` and ``|g|``.

    The sums left of a value in a bin are those before the bin and a part of the bin's:
    they lie in a rectangle.  The gain is convex in them, so no value's is above
    the largest of the four corners; a bin stays if that is not below the best of
    the gains at the ends of bins."""
    some = nodes_at_once(hist)
    if hist.shape[1] > some:
        parts = [promising(hist[:, i : i + some], allowed[i : i + some], learner) for i in range(0, hist.shape[1], some)]
        return tuple(np.concatenate(p) for p in zip(*parts))
    g, n = hist[:2, :, 0].sum(axis=-1)[:, :, None, None]
    (lg, ln), least = np.cumsum(hist[:2], axis=-1), max(learner.min_leaf, 1)
    at_ends = np.where(allowed[:, :, None], _gain(lg, ln, g, n, learner), -np.inf).max(axis=(1, 2), initial=0)[:, None, None]
    low, high = np.maximum(ln - hist[1] + 1, least), np.minimum(ln, n - least)
    lg, ln = lg - hist[0], ln - hist[1]
    most = np.full(lg.shape, -np.inf)
    with np.errstate(over="ignore", invalid="ignore"):  # bins without a split, left out below
        for to in ((hist[0] - hist[2]) / 2, (hist[0] + hist[2]) / 2):
            for rows in (low, high):
                np.maximum(most, _gain(lg + to, rows, g, n, learner), out=most)
    return allowed[:, :, None] & (hist[1] > 0) & (low <= high) & (most > 0) & (most >= at_ends * (1 - 1e-9)), lg, ln


def best_of_values(node: np.ndarray, bins: np.ndarray, ranks: np.ndarray, g: np.ndarray, w: np.ndarray, nodes: int, allowed: np.ndarray, learner: Learner) -> Splits:
    """Every rank is tried, but for those in bins that cannot hold the best."""
    hist = histogram(node, bins, nodes, g, w, np.abs(g))
    tg, tn = hist[:2, :, 0].sum(axis=-1)
    kept, lg, ln = promising(hist, allowed, learner)
    out = Splits(tg, tn, np.full(nodes, -np.inf), np.zeros(nodes, int), np.zeros(nodes, int))
    for j in np.flatnonzero(kept.any(axis=(0, 2))):
        at = np.flatnonzero(kept[node, j, bins[:, j]])
        at = at[np.argsort(node[at].astype(np.int64) << 32 | ranks[at, j])]
        cell, b = node[at] * WIDTH + bins[at, j], ranks[at, j]
        ends = np.flatnonzero(np.r_[(b[1:] != b[:-1]) | (cell[1:] != cell[:-1]), True])
        start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        of = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(at)]))[ends]
        before = lambda v, base: (c := np.cumsum(v[at]))[ends] - (c[start] - v[at[start]] - base[node[at[start]], j, bins[at[start], j]])[of]
        n = node[at[ends]]
        out.keep(j, n, b[ends], _gain(before(g, lg), before(w, ln), tg[n], tn[n], learner))
    return out


def best_of_order(node: np.ndarray, bins: np.ndarray, g: np.ndarray, w: np.ndarray, nodes: int, allowed: np.ndarray, learner: Learner, order: np.ndarray) -> Splits:
    """The same from rows sorted by node and bin; ``order`` (features, rows) sorts
    them by bin.  For many nodes of few rows each."""
    tg, tn, per_node = np.bincount(node, g, nodes), np.bincount(node, w, nodes), np.bincount(node, minlength=nodes)
    out = Splits(tg, tn, np.full(nodes, -np.inf), np.zeros(nodes, int), np.zeros(nodes, int))
    key, of = node.astype(np.int16 if nodes < 2**15 else np.int64), np.repeat(np.arange(nodes), per_node)
    g0, n0, inside, columns = np.cumsum(tg) - tg, np.cumsum(tn) - tn, of[1:] == of[:-1], np.ascontiguousarray(bins.T)
    for j in np.flatnonzero(allowed.any(axis=0)):  # one feature at a time: a task holds little
        at = order[j][np.argsort(key[order[j]], kind="stable")]
        b = columns[j][at]
        ends = np.flatnonzero((b[1:] != b[:-1]) & inside)
        n = of[ends]
        gain = _gain(np.cumsum(g[at])[ends] - g0[n], np.cumsum(w[at])[ends] - n0[n], tg[n], tn[n], learner)
        out.keep(j, n, b[ends], np.where(allowed[n, j], gain, -np.inf))
    return out


@dataclass
class Trees:
    """Flat arrays over the nodes of some trees, the roots first; ``feature``
    -1: a leaf.  ``g`` and ``n`` are the sums of a node.  ``bin``, the largest that
    goes left, is a value for trees that are grown on values."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    g: np.ndarray
    n: np.ndarray

    @staticmethod
    def roots(trees: int, kind=int) -> "Trees":
        return Trees(np.full(trees, -1), np.zeros(trees, kind), np.zeros(trees, int), np.zeros(trees), np.zeros(trees), np.zeros(trees))

    def settle(self, at: np.ndarray, s: Splits, deeper: bool) -> np.ndarray:
        """Record the sums and, if ``deeper``, the splits of the nodes ``at``;
        the new children's numbers, left ones first, as pairs."""
        self.g[at], self.n[at] = s.g, s.n
        ok = np.flatnonzero(np.isfinite(s.gain) & deeper)
        left = len(self.feature) + 2 * np.arange(len(ok))
        self.feature[at[ok]], self.bin[at[ok]], self.left[at[ok]], self.gain[at[ok]] = s.feature[ok], s.bin[ok], left, s.gain[ok]
        new = Trees.roots(2 * len(ok))
        for name in vars(self):
            setattr(self, name, np.concatenate([getattr(self, name), getattr(new, name)]))
        return np.stack([left, left + 1], axis=1).ravel()

    def step(self, bins: np.ndarray, node: np.ndarray) -> np.ndarray:
        """One level down."""
        f = self.feature[node]
        down = self.left[node] + (bins[np.arange(len(node)), np.maximum(f, 0)] > self.bin[node])
        return np.where(f < 0, node, down)

    def leaf(self, bins: np.ndarray, root=0) -> np.ndarray:
        node = np.zeros(len(bins), int) + root
        while (self.feature[node] >= 0).any():
            node = self.step(bins, node)
        return node

    def keep_leaves(self, leaves: int | None) -> None:
        """Undo all but the ``leaves - 1`` splits that best-first growth makes first."""
        if leaves is None:
            return
        kept, open_ = set(), [(-self.gain[0], 0)] if self.feature[0] >= 0 else []
        while open_ and len(kept) < leaves - 1:
            _, i = heapq.heappop(open_)
            kept.add(i)
            for c in (int(self.left[i]), int(self.left[i]) + 1):
                if self.feature[c] >= 0:
                    heapq.heappush(open_, (-self.gain[c], c))
        for i in np.flatnonzero(self.feature >= 0):
            if int(i) not in kept:
                self.feature[i] = -1

    def values(self, learner: Learner, target: Target) -> np.ndarray:
        return learner.rate * self.g / np.maximum(self.n + learner.l2, 1e-300) / target.factor

    def importance(self, features: int) -> np.ndarray:
        inner = self.feature >= 0
        return np.bincount(self.feature[inner], self.gain[inner], features)


def grow(bins: np.ndarray, g: np.ndarray, w: np.ndarray, tree: np.ndarray, allowed: np.ndarray, learner: Learner, order: np.ndarray | Callable[[], np.ndarray], coarse: np.ndarray | None = None) -> Trees:
    """Trees from rows in memory; row ``i`` belongs to tree ``tree[i]``.  ``order``
    (features, rows), or what makes it when it is needed, sorts each tree's rows by
    bin.  ``coarse`` holds the ``WIDTH`` bins of ``bins`` that are ranks."""
    made, node, rows = Trees.roots(len(allowed)), tree.copy(), np.arange(len(bins))
    at, mask, depth = np.arange(len(allowed)), allowed, 0
    while len(at):
        local, b = node[rows] - at[0], bins[rows]
        deeper = learner.depth is None or depth < learner.depth
        if not deeper:
            s = Splits(np.bincount(local, g[rows], len(at)), np.bincount(local, w[rows], len(at)), np.full(len(at), -np.inf), local[:0], local[:0])
        elif 4 * len(at) * WIDTH > len(rows):
            order = order() if callable(order) else order
            place = np.full(len(bins), -1, np.int32)
            place[rows] = np.arange(len(rows), dtype=np.int32)
            if order.shape[1] > len(rows):
                order = np.stack([o[place[o] >= 0] for o in order])
            s = best_of_order(local, b, g[rows], w[rows], len(at), mask, learner, place[order])
        elif coarse is not None:
            s = best_of_values(local, coarse[rows], b, g[rows], w[rows], len(at), mask, learner)
        else:
            s = best_of_histogram(histogram(local, b, len(at), g[rows], w[rows]), mask, learner)
        ok = np.isfinite(s.gain) & deeper
        new = made.settle(at, s, deeper)
        rows = rows[ok[local]]
        node[rows] = made.step(bins[rows], node[rows])
        mask, at, depth = np.repeat(mask[ok], 2, axis=0), new, depth + 1
    return made


def order_of(bins: np.ndarray) -> np.ndarray:
    """(features, rows): the rows by bin."""
    return np.stack([np.argsort(b, kind="stable").astype(np.int32) for b in bins.T]) if bins.shape[1] else np.zeros((0, len(bins)), np.int32)


def order_drawn(order: np.ndarray, drawn: list[np.ndarray]) -> np.ndarray:
    """The same for the rows that each tree has drawn (true in its array), the
    trees' rows one after the other."""
    starts = np.cumsum([0, *[m.sum() for m in drawn]])
    places = [(np.cumsum(m) - 1 + start).astype(np.int32) for m, start in zip(drawn, starts)]
    return np.stack([np.concatenate([place[o[m[o]]] for m, place in zip(drawn, places)]) for o in order]) if len(order) else np.zeros((0, starts[-1]), np.int32)


def fit_in_memory(x: np.ndarray, y: np.ndarray, draw: np.ndarray, train: np.ndarray, learner: Learner, edges: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Predictions of all rows and gains by feature; learns from ``train``."""
    edges = edges or [edges_of(x[train, j]) for j in range(x.shape[1])]
    base, total, gains = fit_bins(binned(x, edges), y, draw, train, learner, range(learner.trees))
    return (base + total / learner.trees if learner.kind != "boosted" else total), gains


def fit_bins(bins: np.ndarray, y: np.ndarray, draw: np.ndarray, train: np.ndarray, learner: Learner, trees: range) -> tuple[float, np.ndarray, np.ndarray]:
    """The mean that trees start from, sums over ``trees`` of their values for all
    rows, and gains by feature.  ``bins`` are ranks of values or bins of any kind;
    boosted trees put them into ``WIDTH`` bins.  Boosted trees, each learning from the
    ones before, are all of a fit's; their sums hold the mean."""
    features, ty = bins.shape[1], y[train]
    coarse = binned(bins, [edges_of(bins[train, j], WIDTH) for j in range(features)])
    if learner.kind == "boosted" or bins.max(initial=0) < WIDTH:
        bins, coarse = coarse, None
    target = Target.of(len(ty), ty.mean(), ty.min(), ty.max())
    gains, own = np.zeros(features), bins[train]
    order = cache(lambda: order_of(own))
    if learner.kind == "boosted":
        out = np.full(len(y), target.mean)
        for t in trees:
            w = learner.weights(draw[train], t)
            used = np.flatnonzero(w)
            g = target.fixed(ty, out[train])
            made = grow(own[used], g[used], w[used], np.zeros(len(used), int), learner.allowed(t, features)[None], learner, lambda m=w > 0: order_drawn(order(), [m]))
            made.keep_leaves(learner.leaves)
            gains += made.importance(features)
            out += made.values(learner, target)[made.leaf(bins)]
        return 0.0, out, gains
    g, total = target.fixed(ty, target.mean), np.zeros(len(y))
    some = max(1, 200_000 // max(len(own), 1))
    for t in range(trees.start, trees.stop, some):
        group = range(t, min(t + some, trees.stop))
        weights = [learner.weights(draw[train], i) for i in group]
        at = [np.flatnonzero(w) for w in weights]
        tree = np.repeat(np.arange(len(at)), [len(a) for a in at])
        rows, w = np.concatenate(at), np.concatenate([w[a] for w, a in zip(weights, at)])
        made = grow(own[rows], g[rows] * w, w, tree, np.stack([learner.allowed(i, features) for i in group]), learner, lambda drawn=[v > 0 for v in weights]: order_drawn(order(), drawn), None if coarse is None else coarse[train][rows])
        value = made.values(learner, target)
        for i in range(len(at)):
            total += value[made.leaf(bins, i)]
        gains += made.importance(features)
    return target.mean, total, gains


OUT = "unit string, model string, row long, raw double, feature int, weight double"


def result(unit: str, model: str, row: Iterable, raw: Iterable, gains: np.ndarray) -> pa.Table:
    """Schema OUT: predictions (feature null) and shares of the gain by feature."""
    row, share = np.asarray(row, np.int64), gains / max(gains.sum(), 1e-300)
    n, k = len(row), len(gains)
    return pa.table({
        "unit": pa.array([unit] * (n + k), pa.string()), "model": pa.array([model] * (n + k), pa.string()),
        "row": pa.array([*row.tolist(), *[None] * k], pa.int64()), "raw": pa.array([*np.asarray(raw, float).tolist(), *[None] * k], pa.float64()),
        "feature": pa.array([*[None] * n, *range(k)], pa.int32()), "weight": pa.array([*[None] * n, *share.tolist()], pa.float64()),
    })


def empty_result() -> pa.Table:
    return result("", "", [], [], np.zeros(0))


def rows_in_a_group(features: int, cells: int | None = None) -> int:
    """The bound on a unit's rows: wide rows count for more."""
    return max(1, min(BOUND, (cells or CELLS) // max(features, 1)))


def split_by_size(rows: DataFrame, bound: int) -> tuple[DataFrame, DataFrame, list]:
    """(rows of units of at most ``bound`` rows, rows of the others, statistics
    of the others' training labels)."""
    sizes = rows.groupBy("unit").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("train").alias("n_train"), F.avg(F.when(F.col("train"), F.col("y"))).alias("mean"),
        F.min(F.when(F.col("train"), F.col("y"))).alias("low"), F.max(F.when(F.col("train"), F.col("y"))).alias("high"),
    )
    large = sizes.where(F.col("n") > bound).collect()  # at most rows / bound units
    names = [r["unit"] for r in large]
    return rows.where(~F.col("unit").isin(names)) if names else rows, rows.where(F.col("unit").isin(names)), large


def fit_units(rows: DataFrame, learners: dict[str, Learner], features: int, bound: int | None = None) -> DataFrame:
    """Schema OUT: for every unit of ``rows`` (``unit, row, draw, train, x, y``) and
    learner the predictions of the rows that are not ``train``, and gains.
    ``row`` is unique in its unit, ``draw`` the number that rows are sampled by.
    Units without training rows have no result."""
    bound = bound or rows_in_a_group(features)
    small, large, stats = split_by_size(rows, bound)
    done = fit_small(small, learners, features)
    stats = [s for s in stats if s["n_train"]]
    return done.unionByName(fit_large(large, learners, features, stats, bound)) if stats else done


# ---------------------------------------------------------------- small units
RANK = np.uint32
RANKED = "unit string, row long, draw long, train boolean, y double, n int, ranks binary"
PART = "unit string, model string, row long, base double, value double, feature int, weight double"


def shares_of(learners: dict[str, Learner], n: Column) -> Column:
    """For a unit of ``n`` rows the groups that fit it: ``model`` and the trees
    from ``first`` to before ``stop``."""

    def shares(name: str, learner: Learner) -> Column:
        step = F.lit(learner.trees)
        if learner.kind == "forest":
            step = F.least(step, F.greatest(F.floor(F.lit(ROW_TREES) / n).cast("int"), F.lit(-(-learner.trees // SHARES))))
        starts = F.sequence(F.lit(0), F.lit(learner.trees - 1), step)
        return F.transform(starts, lambda t: F.struct(F.lit(name).alias("model"), t.alias("first"), F.least(t + step, F.lit(learner.trees)).alias("stop")))

    return F.concat(*[shares(name, learner) for name, learner in learners.items()])


def fit_small(rows: DataFrame, learners: dict[str, Learner], features: int) -> DataFrame:
    """``fit_units`` for units that fit into a group: each is ranked in one group,
    its learners and shares of a forest are fitted by groups of their own."""

    def to_ranks(t: pa.Table) -> pa.Table:
        train = t["train"].to_numpy()
        if not train.any():
            t = t.slice(0, 0)
        x = pa.concat_arrays([c.flatten() for c in t["x"].chunks]).to_numpy().reshape(len(t), features)
        ranks = binned(x, [edges_of(x[train, j]) for j in range(features)]).astype(RANK) if len(t) else x
        kept = t.select(["unit", "row", "draw", "train", "y"])
        return kept.append_column("n", pa.array([len(t)] * len(t), pa.int32())).append_column("ranks", pa.array([r.tobytes() for r in ranks], pa.binary()))

    def fit(t: pa.Table) -> pa.Table:
        unit, name = t["unit"][0].as_py(), t["model"][0].as_py()
        ranks = matrix_of(t["ranks"], RANK, features)
        train, y, row, draw = (t[c].to_numpy() for c in ("train", "y", "row", "draw"))
        base, total, gains = fit_bins(ranks, y, draw, train, learners[name], range(t["first"][0].as_py(), t["stop"][0].as_py()))
        asked, k = np.flatnonzero(~train), len(gains)
        m = len(asked)
        return pa.table({
            "unit": pa.array([unit] * (m + k), pa.string()), "model": pa.array([name] * (m + k), pa.string()),
            "row": pa.array([*row[asked].tolist(), *[None] * k], pa.int64()), "base": pa.array([base] * (m + k), pa.float64()),
            "value": pa.array([*total[asked].tolist(), *[None] * k], pa.float64()),
            "feature": pa.array([*[None] * m, *range(k)], pa.int32()), "weight": pa.array([*[None] * m, *gains.tolist()], pa.float64()),
        })

    rows = cut_lineage(rows.groupBy("unit").applyInArrow(to_ranks, RANKED))
    shares = shares_of(learners, F.col("n"))
    groups = rows.select("unit", F.size(shares).alias("k")).distinct().agg(F.sum("k")).first()[0]
    work = rows.select("*", F.explode(shares).alias("share")).select(*rows.columns, "share.*")
    # partitions by number: fits take long for their bytes, so they are not to be put together by size
    dealt = work.repartition(min(max(groups or 0, 1) * APART, FITS), "unit", "model", "first")
    parts = cut_lineage(dealt.groupBy("unit", "model", "first").applyInArrow(fit, PART))
    over = F.element_at(F.create_map(*[F.lit(v) for n, learner in learners.items() for v in (n, 1.0 if learner.kind == "boosted" else float(learner.trees))]), F.col("model"))
    raw = parts.where("feature IS NULL").groupBy("unit", "model", "row").agg((F.max("base") + F.sum("value") / F.max(over)).alias("raw"))
    gains = parts.where("feature IS NOT NULL").groupBy("unit", "model", "feature").agg(F.sum("weight").alias("gain"))
    share = F.col("gain") / F.greatest(F.sum("gain").over(Window.partitionBy("unit", "model")), F.lit(1e-300))  # a row per feature
    none = lambda kind: F.lit(None).cast(kind)
    predicted = raw.select("unit", "model", "row", "raw", none("int").alias("feature"), none("double").alias("weight"))
    return predicted.unionByName(gains.select("unit", "model", none("long").alias("row"), none("double").alias("raw"), "feature", share.alias("weight")))


# ---------------------------------------------------------------- large units
def unit_edges(rows: DataFrame, features: int, units: list[str]) -> dict[str, list[np.ndarray]]:
    """Bin ends of each unit's training rows from mergeable quantile sketches."""
    at = F.posexplode("x").alias("feature", "v")
    steps = F.array(*[F.lit(i / WIDTH) for i in range(1, WIDTH + 1)])
    got = rows.where("train").select("unit", at).groupBy("unit", "feature").agg(F.percentile_approx("v", steps, F.lit(20_000)).alias("e")).collect()
    out = {u: [np.zeros(0)] * features for u in units}
    for r in got:
        out[r["unit"]][r["feature"]] = np.unique(r["e"])[:-1]
    return out


HIST = "unit string, tree int, node int, task int, hist binary"
SPLIT = "unit string, tree int, node int, g double, n double, gain double, feature int, bin double, lg double, ln double"
#: A node's sums, the bins (a bit each) that are searched value by value, and for each of these ``feature, bin, lg, ln``.
SEARCH = "unit string, tree int, node int, g double, n double, bits binary, cells binary"
CELL = "unit string, tree int, node int, g double, n double, feature int, cell int, lg double, ln double"
FOUND = "unit string, tree int, node int, feature int, cell int, v double, g double, w double"
#: Rows of FOUND in a batch.
ROWS_OUT = 1 << 17


def _add(t: pa.Table) -> np.ndarray:
    return np.sum([np.frombuffer(h) for h in t["hist"].to_pylist()], axis=0)


class Grown:
    """The trees of the large units while they grow; travels to the tasks."""

    def __init__(self, learner: Learner, targets: dict[str, Target], trees: list[int], features: int):
        self.learner, self.targets, self.features = learner, targets, features
        self.by_value = learner.kind != "boosted"  # splits are values, not ends of bins
        self.trees = {(u, t): Trees.roots(1, float if self.by_value else int) for u in targets for t in trees}
        self.open = {k: np.zeros(1, int) for k in self.trees}
        self.before: dict[str, list[Trees]] = {u: [] for u in targets}

    def margin(self, unit: str, bins: np.ndarray, stored: np.ndarray) -> np.ndarray:
        out = stored.copy()
        for made in self.before[unit]:
            out += made.values(self.learner, self.targets[unit])[made.leaf(bins)]
        return out

    def batches(self, batches):
        """(unit, columns, bins) of the rows of each unit of a batch."""
        for b in batches:
            unit = np.array(b.column("unit").to_pylist(), object)
            bins = matrix_of(b.column("bins"), np.uint8, self.features)
            cols = {c: b.column(c).to_numpy(zero_copy_only=False) for c in b.schema.names if c not in ("unit", "bins", "x")}
            if self.by_value:
                cols["x"] = matrix_of(b.column("x"), float, self.features)
            for u in dict.fromkeys(unit):
                own = np.flatnonzero(unit == u)
                yield u, {c: v[own] for c, v in cols.items()}, bins[own]

    def residual(self, unit: str, c: dict, bins: np.ndarray) -> np.ndarray:
        target = self.targets[unit]
        return target.fixed(c["y"], self.margin(unit, bins, c["margin"]) if self.learner.kind == "boosted" else target.mean)


    def open_rows(self, batches):
        """For each unit of a batch and each of its trees with open nodes: the keys, the
        open nodes, and of the rows in them the place of the node, the bins, the
        values, the residuals and the weights."""
        for u, c, bins in self.batches(batches):
            g = self.residual(u, c, bins)
            for (unit, t), made in self.trees.items():
                at = self.open[unit, t]
                if unit != u or not len(at):
                    continue
                w = self.learner.weights(c["draw"], t)
                node = made.leaf(c["x"] if self.by_value else bins)
                use = np.flatnonzero((w > 0) & (node >= at[0]))
                yield u, t, at, np.searchsorted(at, node[use]), bins[use], c["x"][use] if self.by_value else None, g[use], w[use]


def sums_of_bins(state: DataFrame, grown: Grown) -> DataFrame:
    """Schema HIST: the histograms of all open nodes, the tasks' added up in part."""

    def run(batches):
        sums: dict[tuple, np.ndarray] = {}
        task = TaskContext.get().partitionId()

        def flush():
            for (u, t), hist in sums.items():
                at = grown.open[u, t]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([u] * len(at)), pa.array([t] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array([task] * len(at), pa.int32()), pa.array([np.ascontiguousarray(hist[:, i]).tobytes() for i in range(len(at))], pa.binary())],
                    names=[c.split()[0] for c in HIST.split(", ")],
                )
            sums.clear()

        for u, t, at, place, bins, _, g, w in grown.open_rows(batches):
            more = [np.abs(g) * w] if grown.by_value else []
            hist = histogram(place, bins, len(at), g * w, w, *more)
            sums[u, t] = sums[u, t] + hist if (u, t) in sums else hist
            if sum(h.nbytes for h in sums.values()) > 64 << 20:
                yield from flush()
        yield from flush()

    def part(t: pa.Table) -> pa.Table:
        return t.slice(0, 1).set_column(4, "hist", pa.array([_add(t).tobytes()], pa.binary()))

    found = state.where("train").mapInArrow(run, HIST).withColumn("task", F.pmod("task", F.lit(64)).cast("int"))
    return found.groupBy("unit", "tree", "node", "task").applyInArrow(part, HIST).groupBy("unit", "tree", "node")


def _columns(first: pa.Table, **columns) -> pa.Table:
    for name, v in columns.items():
        first = first.append_column(name, v)
    return first


def next_level(state: DataFrame, grown: Grown) -> list:
    """The sums and best splits of all open nodes (schema SPLIT); ``lg`` and ``ln``
    are the sums of the rows that go left."""
    if grown.by_value:
        return next_level_by_value(state, grown)

    def choose(t: pa.Table) -> pa.Table:
        tree, hist = t["tree"][0].as_py(), _add(t).reshape(2, 1, grown.features, WIDTH)
        s = best_of_histogram(hist, grown.learner.allowed(tree, grown.features)[None], grown.learner)
        lg, ln = hist[:, 0, s.feature[0], : s.bin[0] + 1].sum(axis=-1)
        values = {"g": s.g, "n": s.n, "gain": s.gain, "feature": pa.array(s.feature, pa.int32()), "bin": s.bin.astype(float), "lg": [lg], "ln": [ln]}
        return _columns(t.slice(0, 1).select(["unit", "tree", "node"]), **{k: v if isinstance(v, pa.Array) else pa.array(v, pa.float64()) for k, v in values.items()})

    return [r.asDict() for r in sums_of_bins(state, grown).applyInArrow(choose, SPLIT).collect()]


def next_level_by_value(state: DataFrame, grown: Grown) -> list:
    """The same with a split at any value: histograms leave some bins, whose
    values are then added up one by one."""

    def search(t: pa.Table) -> pa.Table:
        tree, hist = t["tree"][0].as_py(), _add(t).reshape(3, 1, grown.features, WIDTH)
        kept, lg, ln = promising(hist, grown.learner.allowed(tree, grown.features)[None], grown.learner)
        _, feature, cell = np.nonzero(kept)
        cells = np.stack([feature, cell, lg[kept], ln[kept]], axis=1)
        g, n = hist[:2, 0, 0].sum(axis=-1)
        return _columns(
            t.slice(0, 1).select(["unit", "tree", "node"]), g=pa.array([g], pa.float64()), n=pa.array([n], pa.float64()),
            bits=pa.array([np.packbits(kept).tobytes()], pa.binary()), cells=pa.array([cells.astype(float).tobytes()], pa.binary()),
        )

    def listed(batches):
        for b in batches:
            for i, c in enumerate(b.column("cells").to_pylist()):
                feature, cell, lg, ln = np.frombuffer(c).reshape(-1, 4).T
                same = [b.column(k).slice(i, 1).take(pa.array(np.zeros(len(lg), int))) for k in ("unit", "tree", "node", "g", "n")]
                yield pa.RecordBatch.from_arrays([*same, pa.array(feature.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(lg), pa.array(ln)], names=[k.split()[0] for k in CELL.split(", ")])

    searched = cut_lineage(sums_of_bins(state, grown).applyInArrow(search, SEARCH))
    nodes = {(r["unit"], r["tree"], r["node"]): r for r in searched.drop("cells").collect()}  # the open nodes
    if not any(any(r["bits"]) for r in nodes.values()):
        best = []
    else:
        none = bytes(grown.features * WIDTH // 8)
        bits = {k: b"".join(bytes(nodes[*k, i]["bits"]) if (*k, i) in nodes else none for i in at.tolist()) for k, at in grown.open.items() if len(at)}

        def run(batches):
            kept = {k: np.unpackbits(np.frombuffer(b, np.uint8)).reshape(-1, grown.features, WIDTH).astype(bool) for k, b in bits.items()}
            for u, t, at, place, bins, x, g, w in grown.open_rows(batches):
                row, feature = np.nonzero(kept[u, t][place[:, None], np.arange(grown.features), bins])
                for i in range(0, len(row), ROWS_OUT):
                    r, f = row[i : i + ROWS_OUT], feature[i : i + ROWS_OUT]
                    columns = [pa.array(at[place[r]].astype(np.int32)), pa.array(f.astype(np.int32)), pa.array(bins[r, f].astype(np.int32)), pa.array(x[r, f]), pa.array(g[r] * w[r]), pa.array(w[r])]
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(u), len(r)), pa.repeat(pa.scalar(t, pa.int32()), len(r)), *columns], names=[k.split()[0] for k in FOUND.split(", ")])

        def gains(batches):
            for b in batches:
                lg, ln, g, n = (b.column(k).to_numpy() for k in ("lg", "ln", "g", "n"))
                yield b.append_column("gain", pa.array(_gain(lg, ln, g, n, grown.learner)))

        keys = ["unit", "tree", "node", "feature", "cell"]
        sums = state.where("train").mapInArrow(run, FOUND).groupBy(*keys, "v").agg(F.sum("g").alias("vg"), F.sum("w").alias("vw"))
        upto = Window.partitionBy(*keys).orderBy("v")  # the values of one bin in one node
        within = sums.select(*keys, "v", F.sum("vg").over(upto).alias("vg"), F.sum("vw").over(upto).alias("vw"))
        tried = within.join(searched.mapInArrow(listed, CELL), keys).select("unit", "tree", "node", "feature", "v", (F.col("lg") + F.col("vg")).alias("lg"), (F.col("ln") + F.col("vw")).alias("ln"), "g", "n")
        schema = "unit string, tree int, node int, feature int, v double, lg double, ln double, g double, n double, gain double"
        ok = tried.mapInArrow(gains, schema).where("gain > double('-inf')")
        first = F.max(F.struct("gain", (-F.col("feature")).alias("feature"), (-F.col("v")).alias("v"), "lg", "ln"))
        best = ok.groupBy("unit", "tree", "node").agg(first.alias("s")).select("unit", "tree", "node", "s.*").collect()  # one row a node
    none = {"gain": -np.inf, "feature": 0, "bin": 0.0, "lg": 0.0, "ln": 0.0}
    out = {k: {**{c: r[c] for c in ("unit", "tree", "node", "g", "n")}, **none} for k, r in nodes.items()}
    for r in best:
        out[r["unit"], r["tree"], r["node"]] |= {"gain": r["gain"], "feature": -r["feature"], "bin": -r["v"], "lg": r["lg"], "ln": r["ln"]}
    return list(out.values())


def grow_large(state: DataFrame, grown: Grown, until: int = 0) -> None:
    """Levels over all rows until no node is open, or until every open node has
    at most ``until`` rows (then it stays open).  The sums of a node are known from
    its parent's split, so the last level takes no pass."""
    depth = 0
    small: dict[tuple, list] = {k: [] for k in grown.trees}
    while any(len(v) for v in grown.open.values()) and (depth == 0 or grown.learner.depth is None or depth < grown.learner.depth):
        deeper = grown.learner.depth is None or depth < grown.learner.depth
        got: dict[tuple, list] = {}
        for r in next_level(state, grown):
            got.setdefault((r["unit"], r["tree"]), []).append(r)
        for k, made in grown.trees.items():
            rows = sorted(got.get(k, []), key=lambda r: r["node"])
            if not rows:
                grown.open[k] = np.zeros(0, int)
                continue
            at, g, n, gain, feature, bin_, lg, ln = (np.array([r[c] for r in rows]) for c in ("node", "g", "n", "gain", "feature", "bin", "lg", "ln"))
            leave = n <= until
            made.g[at], made.n[at] = g, n
            if deeper:
                small[k] += at[leave & np.isfinite(gain)].tolist()
            go = ~leave
            new = made.settle(at[go], Splits(g[go], n[go], gain[go], feature[go], bin_[go]), deeper)
            split = np.isfinite(gain[go])
            if len(new):
                made.g[new] = np.stack([lg[go][split], (g - lg)[go][split]], axis=1).ravel()
                made.n[new] = np.stack([ln[go][split], (n - ln)[go][split]], axis=1).ravel()
            grown.open[k] = new
        depth += 1
    grown.open = {k: np.array(v, int) for k, v in small.items()}


def fit_large(rows: DataFrame, learners: dict[str, Learner], features: int, stats: list, bound: int) -> DataFrame:
    """``fit_units`` for units that are too large for one group."""
    units = [s["unit"] for s in stats]
    edges = unit_edges(rows, features, units)
    targets = {s["unit"]: Target.of(s["n_train"], s["mean"], s["low"], s["high"]) for s in stats}

    def to_bins(batches):
        for b in batches:
            x = np.ascontiguousarray(b.column("x").flatten().to_numpy().reshape(-1, features))
            unit, out = np.array(b.column("unit").to_pylist(), object), np.zeros((b.num_rows, features), np.uint8)
            for u in dict.fromkeys(unit):
                out[unit == u] = binned(x[unit == u], edges[u])
            start = pa.array([targets[u].mean for u in unit], pa.float64())
            values = [pa.array([r.tobytes() for r in x], pa.binary())] if by_value else []
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("unit", "row", "draw", "train", "y")], start, pa.array([r.tobytes() for r in out], pa.binary()), *values], names=["unit", "row", "draw", "train", "y", "margin", "bins", *["x"] * by_value])

    by_value = any(learner.kind != "boosted" for learner in learners.values())
    schema = "unit string, row long, draw long, train boolean, y double, margin double, bins binary"
    base = cut_lineage(rows.where(F.col("unit").isin(units)).select("unit", "row", "draw", "train", "y", "x").mapInArrow(to_bins, schema + ", x binary" * by_value))
    done = None
    for name, learner in learners.items():
        out = boosted_large(base.drop("x"), learner, targets, features, name, schema) if learner.kind == "boosted" else forest_large(base, learner, targets, features, name, bound)
        done = out if done is None else done.unionByName(out)
    return done


def _gains(spark, name: str, gains: dict[str, np.ndarray]) -> DataFrame:
    rows = [(u, name, None, None, i, float(v / max(g.sum(), 1e-300))) for u, g in gains.items() for i, v in enumerate(g)]
    return spark.createDataFrame(rows, OUT)


def boosted_large(base: DataFrame, learner: Learner, targets: dict[str, Target], features: int, name: str, schema: str) -> DataFrame:
    state, gains = base, {u: np.zeros(features) for u in targets}
    before: dict[str, list[Trees]] = {u: [] for u in targets}

    def rewritten(grown: Grown) -> DataFrame:
        def run(batches):
            for u, c, bins in grown.batches(batches):
                margin = grown.margin(u, bins, c["margin"])
                yield pa.RecordBatch.from_arrays([pa.array([u] * len(bins)), *[pa.array(c[k]) for k in ("row", "draw", "train", "y")], pa.array(margin), pa.array([r.tobytes() for r in bins], pa.binary())], names=["unit", "row", "draw", "train", "y", "margin", "bins"])

        return cut_lineage(state.mapInArrow(run, schema))

    for t in range(learner.trees):
        grown = Grown(learner, targets, [t], features)
        grown.before = before
        grow_large(state, grown)
        for u in targets:
            made = grown.trees[u, t]
            made.keep_leaves(learner.leaves)
            gains[u] += made.importance(features)
            before[u].append(made)
        if (t + 1) % REWRITE == 0 or t + 1 == learner.trees:
            state = rewritten(grown)
            before = {u: [] for u in targets}
    none = lambda kind: F.lit(None).cast(kind)
    out = state.where("NOT train").select("unit", F.lit(name).alias("model"), "row", F.col("margin").alias("raw"), none("int").alias("feature"), none("double").alias("weight"))
    return out.unionByName(_gains(base.sparkSession, name, gains))


def forest_large(base: DataFrame, learner: Learner, targets: dict[str, Target], features: int, name: str, bound: int) -> DataFrame:
    """The upper levels over all rows; nodes of at most ``bound`` training rows
    are finished as groups."""
    gains = {u: np.zeros(features) for u in targets}
    parts = []
    for t in range(0, learner.trees, TOGETHER):
        trees = list(range(t, min(t + TOGETHER, learner.trees)))
        grown = Grown(learner, targets, trees, features)
        grow_large(base, grown, bound if learner.depth is None else 0)
        for (u, _), made in grown.trees.items():
            gains[u] += made.importance(features)

        def routed(batches, grown=grown):
            for u, c, bins in grown.batches(batches):
                g = grown.residual(u, c, bins)
                for (unit, tree), made in grown.trees.items():
                    if unit != u:
                        continue
                    node = made.leaf(c["x"])
                    w = np.where(c["train"], learner.weights(c["draw"], tree), 0.0)
                    ends = ~np.isin(node, grown.open[unit, tree])
                    use = np.flatnonzero(~c["train"] | ((w > 0) & ~ends))
                    value = np.where(ends, made.values(learner, targets[u])[node], np.nan)
                    x = [b"" if end else r.tobytes() for r, end in zip(c["x"][use], ends[use])]
                    yield pa.RecordBatch.from_arrays(  # maybe no rows: every type is named
                        [pa.array([u] * len(use), pa.string()), pa.array([tree] * len(use), pa.int32()), pa.array(node[use], pa.int32()), pa.array(c["row"][use]), pa.array(w[use]), pa.array(g[use]), pa.array(value[use]), pa.array(x, pa.binary())],
                        names=["unit", "tree", "node", "row", "w", "g", "value", "x"],
                    )

        rows = cut_lineage(base.mapInArrow(routed, "unit string, tree int, node int, row long, w double, g double, value double, x binary"))

        def finish(t: pa.Table) -> pa.Table:
            u, tree = t["unit"][0].as_py(), t["tree"][0].as_py()
            x = matrix_of(t["x"], float, features)
            w, g, row = (t[c].to_numpy() for c in ("w", "g", "row"))
            use = np.flatnonzero(w)
            bins = binned(x, [edges_of(x[use, j]) for j in range(features)])
            own = bins[use]
            coarse = binned(own, [edges_of(own[:, j], WIDTH) for j in range(features)])
            made = grow(own, g[use] * w[use], w[use], np.zeros(len(use), int), learner.allowed(tree, features)[None], learner, lambda: order_of(own), coarse)
            ask = np.flatnonzero(w == 0)
            value = made.values(learner, targets[u])[made.leaf(bins[ask])]
            return pa.table({"unit": pa.array([u] * len(ask), pa.string()), "row": pa.array(row[ask]), "value": pa.array(value, pa.float64())})

        ended = rows.where("w = 0 AND NOT isnan(value)").select("unit", "row", "value")
        parts.append(cut_lineage(ended.unionByName(rows.where("isnan(value)").groupBy("unit", "tree", "node").applyInArrow(finish, "unit string, row long, value double"))))
    each = parts[0]
    for p in parts[1:]:
        each = each.unionByName(p)
    mean = F.element_at(F.create_map(*[F.lit(v) for u, t in targets.items() for v in (u, t.mean)]), F.col("unit"))
    total = each.groupBy("unit", "row").agg(F.sum("value").alias("total"))
    none = lambda kind: F.lit(None).cast(kind)
    out = total.select("unit", F.lit(name).alias("model"), "row", (mean + F.col("total") / learner.trees).alias("raw"), none("int").alias("feature"), none("double").alias("weight"))
    return out.unionByName(_gains(base.sparkSession, name, gains))
