import math

import numpy as np
import pytest

from volspark.llm import angular_negatives as A
from volspark.llm.queries import ORACLE_SQL, QUERIES


def plain(rows, anchor=lambda i: i % 50 == 0, k=5, n=3):
    good = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    firsts = {}
    for i, lab, v in good:
        if anchor(i):
            firsts[i, len(v)] = min(firsts.get((i, len(v)), (lab, v)), (lab, v))
    for (i, dim), (lab, v) in firsts.items():
        others = [(-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in good if j != i and len(w) == dim]
        others.sort()
        for s, p, _ in [o for o in others if o[2] == lab][:k]:
            hard = [(t, j) for t, j, m in others if m != lab and 50 * -s <= 100 * -t <= 95 * -s][:n]
            out += [(i, p, r, j, -s, -t) for r, (t, j) in enumerate(hard, 1)]
    return sorted(out)


def rows_of(df):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(300, 12)) * rng.choice([0, 1, 50, 4000], (300, 1)))
    x[:40] = x[40:80] * rng.choice([-1, 1, 2], (40, 1))
    unit = rng.normal(size=(5, 12))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    unit[0] = x[100] / np.linalg.norm(x[100]) if np.linalg.norm(x[100]) else unit[0]
    norm = np.linalg.norm(x, axis=1)
    angle = np.arccos(np.clip(x @ unit.T / np.where(norm > 0, norm, 1)[:, None], -1, 1))
    low, high = A.score_bounds(norm, angle, norm, norm, angle, angle)
    score = x @ x.T
    assert ((low <= score) & (score <= high)).all()
    cut = np.arange(0, 300, 7)
    ranges = [np.minimum.reduceat(norm, cut), np.maximum.reduceat(norm, cut), np.minimum.reduceat(angle, cut, axis=0), np.maximum.reduceat(angle, cut, axis=0)]
    low, high = A.score_bounds(norm, angle, *ranges)
    assert (low <= np.minimum.reduceat(score, cut, axis=1)).all() and (high >= np.maximum.reduceat(score, cut, axis=1)).all()
    assert (high < np.sqrt((norm**2).max() * norm**2)[:, None]).any()


@pytest.fixture()
def vectors():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(700):
        lab = int(rng.integers(0, 6))
        v = centres[lab if rng.random() < 0.6 else int(rng.integers(0, 6))] + rng.normal(size=8) * 0.3
        rows.append((i, lab, [float(np.float32(x)) for x in v]))
    rows += [(1000, 1, rows[3][2]), (1001, 1, rows[3][2]), (1002, 2, rows[3][2]), (1002, 2, rows[3][2]), (50, 3, rows[9][2])]
    rows += [(2000, 0, [0.0] * 8), (2050, None, rows[0][2]), (2100, 1, None), (2150, 1, [1.0, float("nan")] * 4), (2151, 1, [1.0, None] * 4), (None, 1, rows[0][2])]
    rows += [(2200, 1, []), (2250, 2, []), (2300, 0, [1.0, 2.0]), (2301, 0, [1.0, 2.0]), (2302, 4, [1.0, 1.0]), (2303, 4, [0.5, 1.0])]
    rows += [(3000 + i, 0, [0.5] * 8) for i in range(20)] + [(3050, 5, [0.45] * 8)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_negatives_are_those_of_brute_force(spark, vectors, monkeypatch, small):
    if small:  # many shards, blocks and merge rounds
        monkeypatch.setattr(A, "BLOCK", 8)
        monkeypatch.setattr(A, "ANCHORS", 8)
        monkeypatch.setattr(A, "FAN_IN", 3)
    docs = spark.createDataFrame([(*r, "x", 1) for r in vectors], "vec_id long, label int, embedding array<double>, dim string, shard int")
    got = rows_of(A.mine(docs, A.F.col("id") % 50 == 0))
    assert len(got) > 50 and got == plain(vectors)
    assert A.mine(docs.limit(0), A.F.col("id") % 50 == 0).count() == 0


def test_blocks_are_skipped(vectors, monkeypatch):
    """On clustered vectors many scores are never computed."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16)) * 4
    v = np.floor((centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 16)) * 0.05) * 256)
    norm = np.linalg.norm(v, axis=1)
    refs = centres / np.linalg.norm(centres, axis=1, keepdims=True)
    table = A.pa.table({"id": np.arange(4000), "label": np.arange(4000) % 2, "v": list(v), "norm": norm, "angles": list(np.arccos(np.clip(v @ refs.T / norm[:, None], -1, 1)))})
    scored = []
    plain_scores = A.Shard.scores
    monkeypatch.setattr(A.Shard, "scores", lambda self, q, at: (lambda s: scored.append(s.size) or s)(plain_scores(self, q, at)))
    q, c = A.Shard(table.slice(0, 50)), A.Shard(table)
    best = A.best_positives(q, c, 5)
    assert sum(scored) < 50 * 4000 / 3
    want = (q.v @ v.T).astype(np.int64)
    want[np.arange(50)[:, None] * 0 + q.ids[:, None] == np.arange(4000)[None, :]] = A.LOW
    assert (np.sort(best.score)[:, ::-1] == -np.sort(-want, axis=1)[:, :5]).all()


def test_query_against_duckdb(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = duckdb.sql(ORACLE_SQL["op12_angular_negatives"]).fetchall()
    assert rows_of(QUERIES["op12_angular_negatives"](spark, sf)) == sorted(tuple(r) for r in want)
