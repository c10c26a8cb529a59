"""Exact deduplication and the Jaccard join against direct computations."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from volspark.llm import exact_dedup, jaccard_join
from volspark.session import scratch_path

UP = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UP, UP.lower())


def sha(text):
    return hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()


EDGE = [
    (1, "Same Text", "x"), (2, "same text", "y"), (3, "SAME TEXT", None), (4, None, "x"), (5, "", "x"), (6, "É", "x"), (7, "é", "x"),
    (8, "one", "x"), (8, "one", "x"), (None, "alone", "x"), (None, "one", "x"), (9, "long " * 40000, "x"), (10, " same text", "x"),
]
SCHEMA = "doc_id long, text string, text_sha256 string"  # the last name clashes with a result column


def test_deduplicate_edges(spark):
    docs = spark.createDataFrame(EDGE, SCHEMA)
    got = exact_dedup.deduplicate(docs, exact_dedup.new_index(spark)).collect()
    groups = {}
    for i, t, _ in EDGE:
        groups.setdefault(sha(t), []).append(i)
    want = []
    for i, t, _ in EDGE:
        ids = groups[sha(t)]
        best = max((x for x in ids if x is not None), default=None)
        want.append((i, best, len(ids), i == best, sha(t)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_keep_unique_returns_one_row_per_text(spark):
    docs = spark.createDataFrame(EDGE, SCHEMA)
    kept = exact_dedup.keep_unique(docs, exact_dedup.new_index(spark))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted([(False, i) for i in (3, 5, 6, 7, 8, 9, 10)] + [(True, 0)])


def test_index_persists_and_grows(spark):
    path = scratch_path(spark, "index-test")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id long, text string")
    second = spark.createDataFrame([(4, "b"), (5, "c"), (6, "c")], "doc_id long, text string")
    exact_dedup.deduplicate(first, exact_dedup.DigestIndex(spark, path, 4)).collect()
    index = exact_dedup.DigestIndex(spark, path, 4)
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.deduplicate(second, index).collect()}
    assert got == {4: (2, False), 5: (6, False), 6: (6, True)}
    assert index.table().count() == 3
    plan = index.table().groupBy("text_sha256").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # read by bucket


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.deduplicate(empty, exact_dedup.new_index(spark)).count() == 0
    assert exact_dedup.keep_unique(empty, exact_dedup.new_index(spark)).count() == 0
    assert jaccard_join.group(empty).count() == 0


def brute_groups(rows):
    sets, parent = {}, {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    per_row = []
    for i, t in rows:
        w = (t or "").translate(LOWER).encode().split()
        s = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
        per_row.append((i, len(s)))
        if i is not None:
            parent[i] = i
            sets.setdefault(i, []).append(s)
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return sorted(((i, n, None if i is None else find(i)) for i, n in per_row), key=str)


def near_rows(seed=3, n=260):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(60)]
    base = [word() for _ in range(80)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.35:  # a large group of near copies of several strengths
            w = list(base)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = word()
        elif kind < 0.6:  # a passage that many texts share
            w = [word() for _ in range(rng.randint(0, 60))] + passage + [word() for _ in range(rng.randint(0, 40))]
        elif kind < 0.8 and rows:  # a changed or equal copy of an earlier text
            w = (rng.choice(rows)[1] or "x").split()
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = word().upper()
        else:
            w = [word() for _ in range(rng.randint(0, 200))]
        rows.append((i, " ".join(w)))
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "a b"), (1004, "A  b"), (1005, "b a"), (None, "a b"), (None, None), (1006, "a b c d e"), (1006, "z y x w v"), (1007, "Z y x w v")]
    rows += [(1011, "l m n o p"), (1012, "q r s t u"), (1015, "L m n o p"), (1015, "Q r s t u"), (1015, "Q r s t u")]  # linked by an id that represents neither
    return rows


def test_groups_equal_brute_force(spark, monkeypatch):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("clash"))
    got = sorted(map(tuple, jaccard_join.group(docs).collect()), key=str)
    assert got == brute_groups(rows)


def test_split_cells_lose_nothing(spark, monkeypatch):
    """Frequent shingles are dealt over several salts; the groups stay exact."""
    monkeypatch.setattr(jaccard_join, "CELL", 3)
    rows = near_rows(seed=4, n=200)
    order = jaccard_join.Order(__import__("numpy").bincount([5] * 90, minlength=1 << jaccard_join.SKETCH_BITS).astype(float))
    assert order.salts.max() > 1
    got = sorted(map(tuple, jaccard_join.group(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute_groups(rows)


def test_tree_bounds_never_lose_a_pair():
    import numpy as np

    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    sets = []
    for _ in range(150):
        keep = rng.random(300) < rng.uniform(0.6, 1)
        sets.append(np.unique(np.r_[base[keep], rng.integers(0, 2**63, rng.integers(0, 60)).astype(np.uint64)]))
    n = np.array([len(s) for s in sets])
    x = np.stack([jaccard_join.point(s) for s in sets])
    i, j = jaccard_join.Tree(n, x).pairs()
    found = {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())}
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            shared = len(np.intersect1d(sets[a], sets[b]))
            if 100 * shared >= 75 * (n[a] + n[b] - shared):
                assert (a, b) in found


@pytest.mark.parametrize("together", [1_000_000, 20])
def test_components_of_a_path_and_a_star(spark, together):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 200), (250, 300)]
    links = spark.createDataFrame(edges, "a long, b long").repartition(5)
    got = {r.node: r.comp for r in jaccard_join.components(links, together).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(30)}, 200: 200, 250: 200, 300: 200}
