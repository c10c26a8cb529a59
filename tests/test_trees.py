from fractions import Fraction

import numpy as np
import pytest

from volspark.operators import trees as TR
from volspark.operators.trees import Learner


def plain_tree(bins, g, w, learner, allowed, depth=0):
    """Nested (feature, bin, gain, left, right) or the sums of a leaf, by trying every split."""
    score = lambda a, b: Fraction(int(a)) ** 2 / (Fraction(b) + Fraction(learner.l2))
    best = None
    if learner.depth is None or depth < learner.depth:
        for f in np.flatnonzero(allowed):
            for b in np.unique(bins[:, f])[:-1]:
                m = bins[:, f] <= b
                if min(w[m].sum(), w[~m].sum()) < learner.min_leaf:
                    continue
                gain = score(g[m].sum(), w[m].sum()) + score(g[~m].sum(), w[~m].sum()) - score(g.sum(), w.sum())
                if gain > 0 and (best is None or gain > best[2]):
                    best = (f, b, gain, m)
    if best is None:
        return g.sum(), w.sum()
    f, b, gain, m = best
    return f, b, gain, plain_tree(bins[m], g[m], w[m], learner, allowed, depth + 1), plain_tree(bins[~m], g[~m], w[~m], learner, allowed, depth + 1)


def plain_value(tree, x, learner):
    while len(tree) == 5:
        tree = tree[3] if x[tree[0]] <= tree[1] else tree[4]
    return learner.rate * tree[0] / (tree[1] + learner.l2)


def depth_of(tree):
    return 0 if len(tree) == 2 else 1 + max(depth_of(tree[3]), depth_of(tree[4]))


def data(n=120, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 9, (n, 4)).astype(float)
    return x, np.sin(x[:, 0]) + x[:, 1] * (x[:, 2] > 4) + rng.normal(size=n) * 0.1, rng.integers(-(2**62), 2**62, n), rng.random(n) < 0.7


@pytest.mark.parametrize("learner", [Learner("tree", depth=4, min_leaf=3), Learner("forest", 7), Learner("boosted", 12, 3, 0.3, 0.8, 0.8, l2=1.0)])
def test_trees_are_those_of_the_definition(learner):
    x, y, draw, train = data()
    got, _ = TR.fit_in_memory(x, y, draw, train, learner)
    bins = TR.binned(x, [TR.edges_of(x[train, j]) for j in range(4)])
    target = TR.Target.of(train.sum(), y[train].mean(), y[train].min(), y[train].max())
    out, total = np.full(len(y), target.mean), np.zeros(len(y))
    for t in range(learner.trees):
        w = learner.weights(draw[train], t)
        at = out[train] if learner.kind == "boosted" else target.mean
        g = np.rint((y[train] - at) * target.factor) * w
        tree = plain_tree(bins[train][w > 0], g[w > 0], w[w > 0], learner, learner.allowed(t, 4))
        step = np.array([plain_value(tree, b, learner) for b in bins]) / target.factor
        out, total = out + step, total + step
    want = out if learner.kind == "boosted" else target.mean + total / learner.trees
    assert np.allclose(got, want, rtol=0, atol=1e-12)
    assert np.mean((got - y)[~train] ** 2) < 0.7 * y[~train].var()


def test_best_first_leaves():
    x, y, draw, train = data(400)
    whole, few = Learner("tree", depth=6), Learner("tree", depth=6, leaves=7)
    made = {}
    for learner in (whole, few):
        bins = TR.binned(x, [TR.edges_of(x[:, j]) for j in range(4)])
        g = np.rint((y - y.mean()) * 2**30)
        t = TR.grow(bins, g, np.ones(400), np.zeros(400, int), np.ones((1, 4), bool), learner, np.argsort(bins.T, axis=1, kind="stable"))
        t.keep_leaves(learner.leaves)
        made[learner.leaves] = (t, len(np.unique(t.leaf(bins))))
    assert made[7][1] == 7 and made[None][1] > 30
    # the kept splits are those with the largest gains that can be reached
    t, full = made[7][0], made[None][0]
    kept = set(np.flatnonzero(t.feature >= 0))
    edge = {c for i in kept for c in (full.left[i], full.left[i] + 1) if c not in kept and full.feature[c] >= 0}
    assert min(full.gain[list(kept)]) >= max(full.gain[list(edge)])


def test_forest_without_depth_limit():
    """Every split peels one row off: a chain."""
    n = 36
    x, y = np.arange(n, dtype=float)[:, None], 2.5 ** np.arange(n)
    got, _ = TR.fit_in_memory(x, y, np.arange(n), np.ones(n, bool), Learner("tree"))
    bins = TR.binned(x, [TR.edges_of(x[:, 0])])
    target = TR.Target.of(n, y.mean(), y.min(), y.max())
    tree = plain_tree(bins, np.rint((y - target.mean) * target.factor), np.ones(n), Learner("tree"), np.ones(1, bool))
    assert depth_of(tree) > 30
    assert np.allclose(got, y, rtol=0, atol=2 / target.factor)


LEARNERS = {
    "DT": Learner("tree", depth=5, min_leaf=4),
    "RF": Learner("forest", 5),
    "XGB": Learner("boosted", 6, 4, 0.3, 0.8, 0.8, l2=1.0),
    "LGBM": Learner("boosted", 5, 6, 0.3, 1.0, 0.8, min_leaf=5, leaves=9),
}


def test_large_units_grow_the_same_trees(spark, monkeypatch):
    monkeypatch.setattr(TR, "REWRITE", 4)
    monkeypatch.setattr(TR, "TOGETHER", 3)
    rows = []
    for unit, n in (("a", 300), ("b", 260), ("c", 40)):
        x, y, draw, train = data(n, n)
        rows += [(unit, i, int(draw[i]), bool(train[i]), x[i].tolist(), float(y[i])) for i in range(n)]
    rows += [("none", 1, 1, False, [1.0] * 4, 1.0)]
    df = spark.createDataFrame(rows, "unit string, row long, draw long, train boolean, x array<double>, y double").repartition(5)
    key = lambda r: (r.unit, r.model, r.row is None, r.row or 0, r.feature or 0)
    whole = sorted(TR.fit_units(df, LEARNERS, 4).collect(), key=key)
    parts = sorted(TR.fit_units(df, LEARNERS, 4, bound=50).collect(), key=key)
    assert [key(r) for r in whole] == [key(r) for r in parts] and {r.unit for r in whole} == {"a", "b", "c"}
    assert np.allclose([r.raw for r in whole if r.raw is not None], [r.raw for r in parts if r.raw is not None], rtol=0, atol=1e-12)
    upper = lambda rs: [r.weight for r in rs if r.weight is not None and r.model != "RF"]
    assert np.allclose(upper(whole), upper(parts))


def test_one_value_and_constant_columns(spark):
    df = spark.createDataFrame([("u", i, i, i < 8, [1.0, float(i)], 3.5) for i in range(10)], "unit string, row long, draw long, train boolean, x array<double>, y double")
    assert {r.raw for r in TR.fit_units(df, LEARNERS, 2).collect() if r.row is not None} == {3.5}
    assert TR.fit_units(df.limit(0), LEARNERS, 2).count() == 0


def test_large_units_with_parts_that_hold_only_training_rows(spark):
    x, y, draw, train = data(300)
    rows = [("a", i, int(draw[i]), bool(train[i]), x[i].tolist(), float(y[i])) for i in range(300)]
    df = spark.createDataFrame(rows, "unit string, row long, draw long, train boolean, x array<double>, y double")
    df = df.repartitionByRange(4, "train", "row")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    learners = {"DT": Learner("tree", depth=1, min_leaf=20), "RF": Learner("forest", 5)}
    try:
        got = {(r.model, r.row): r.raw for r in TR.fit_units(df, learners, 4, bound=20).collect() if r.row is not None}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for name, learner in learners.items():
        want, _ = TR.fit_in_memory(x, y, draw, train, learner)
        assert np.allclose([got[name, i] for i in np.flatnonzero(~train)], want[~train], rtol=0, atol=1e-12)
    assert len(got) == 2 * (~train).sum()


def test_a_split_may_be_at_any_value(spark):
    """More values than bins, and the steps of the label lie between the ends of bins."""
    rng = np.random.default_rng(5)
    n = 1500
    x = np.stack([rng.permutation(n) + 0.0, np.round(rng.normal(size=n), 2), rng.normal(size=n)], axis=1)
    y = 3.0 * (x[:, 0] > 701) + (x[:, 2] > 0.1234) * (x[:, 1] > 0.37) + rng.normal(size=n) * 0.2
    draw, train = rng.integers(-(2**62), 2**62, n), rng.random(n) < 0.8
    learners = {"stump": Learner("tree", depth=1, min_leaf=20), "tree": Learner("tree", depth=4, min_leaf=5), "forest": Learner("forest", 3, 3)}
    df = spark.createDataFrame([("u", i, int(draw[i]), bool(train[i]), x[i].tolist(), float(y[i])) for i in range(n)], "unit string, row long, draw long, train boolean, x array<double>, y double")
    whole, parts = ({(r.model, r.row): r.raw for r in TR.fit_units(df, learners, 3, bound=b).collect() if r.row is not None} for b in (None, 100))
    ranks, asked = np.stack([np.searchsorted(np.unique(x[train, j])[:-1], x[:, j]) for j in range(3)], axis=1), np.flatnonzero(~train)
    target = TR.Target.of(train.sum(), y[train].mean(), y[train].min(), y[train].max())
    for name, learner in learners.items():
        total = np.zeros(len(asked))
        for t in range(learner.trees):
            w = learner.weights(draw[train], t)
            tree = plain_tree(ranks[train][w > 0], (np.rint((y[train] - target.mean) * target.factor) * w)[w > 0], w[w > 0], learner, np.ones(3, bool))
            total += [plain_value(tree, b, learner) / target.factor for b in ranks[asked]]
        for got in (whole, parts):
            assert np.allclose([got[name, i] for i in asked], target.mean + total / learner.trees, rtol=0, atol=1e-12)
    assert {round(parts["stump", i], 9) for i in asked} == {round(y[train][side].mean(), 9) for side in (x[train, 0] <= 701, x[train, 0] > 701)}


def test_the_ways_to_search_a_level_agree(monkeypatch):
    """Histograms of a few nodes at a time, sorted rows, and values in promising bins."""
    rng = np.random.default_rng(2)
    n, nodes = 3000, 6
    ranks = rng.integers(0, 200, (n, 4)).astype(np.uint32)
    node, g, w = rng.integers(0, nodes, n), np.rint(rng.normal(size=n) * 1e6 + 1e5 * (ranks[:, 2] > 77)), rng.integers(1, 4, n).astype(float)
    allowed = rng.random((nodes, 4)) < 0.8
    learner = Learner("tree", depth=3, min_leaf=4)
    some = [TR.best_of_histogram(TR.histogram(node, ranks, nodes, g, w), allowed, learner), TR.best_of_order(node, ranks, g, w, nodes, allowed, learner, TR.order_of(ranks))]
    coarse = (ranks // 25).astype(np.uint8)
    for at_once in (100, 2):
        monkeypatch.setattr(TR, "nodes_at_once", lambda hist, k=at_once: k)
        some += [TR.best_of_histogram(TR.histogram(node, ranks, nodes, g, w), allowed, learner), TR.best_of_values(node, coarse, ranks, g, w, nodes, allowed, learner)]
    for s in some:
        for name in vars(s):
            assert np.array_equal(getattr(s, name), getattr(some[0], name)), name


def test_groups_of_the_legacy_models_at_six_gb():
    """A cluster of 360,000 windows of 39 features is fitted by groups."""
    assert TR.rows_in_a_group(39) >= 360_000
