"""Blocked similarity and silhouette against numpy, with blocks of few stocks."""

import numpy as np

from volspark.operators import cluster as CL
from volspark.operators import curves as CV
from volspark.operators import universe as UV


def test_similarity_in_blocks(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(40, 7)) + rng.normal(size=(40, 1))
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 5] = np.where(np.isnan(x[:, 5]), np.nan, 2.5)  # constant: correlation 0
    x[:20, 6], x[20:, 0] = np.nan, np.nan  # stocks without a common window
    rows = [(f"stock_{s}", t, float(x[t, s])) for t in range(40) for s in range(7) if not np.isnan(x[t, s])]
    rows += [("stock_1", 3, 7.0), ("alone", 99, 1.0), (None, 3, 1.0), ("stock_2", 3, None)]
    df = spark.createDataFrame(rows, "stock_id string, time_id bigint, target_var double").repartition(5)
    x[3, 1] = np.nanmean([x[3, 1], 7.0])
    for block, windows in ((3, 8), (128, 16_384)):
        got = {(r["stock_a"], r["stock_b"]): r["corr"] for r in UV.stock_similarity(df, block, windows).collect()}
        want = {("alone", "alone"): 1.0}
        for a in range(7):
            for b in range(7):
                on = ~np.isnan(x[:, a]) & ~np.isnan(x[:, b])
                if a == b:
                    want[f"stock_{a}", f"stock_{b}"] = 1.0
                elif on.any():
                    flat = on.sum() < 2 or np.ptp(x[on, a]) == 0 or np.ptp(x[on, b]) == 0
                    want[f"stock_{a}", f"stock_{b}"] = 0.0 if flat else np.corrcoef(x[on, a], x[on, b])[0, 1]
        assert set(got) == set(want) and all(np.isclose(got[k], want[k], atol=1e-9) for k in want)
    assert UV.stock_similarity(df.limit(0)).count() == 0


def test_silhouette_in_blocks(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(30, 9)) + np.repeat([[0], [3], [1]], 10, axis=0)
    ids = [f"s{i}" for i in range(30)]
    feats = spark.createDataFrame([(i, *map(float, r)) for i, r in zip(ids, x)], "stock_id string, " + ", ".join(f"{c} double" for c in CL.BEHAVIOUR)).repartition(3)
    labels = spark.createDataFrame([(s, i // 10 + 1) for i, s in enumerate(ids)] , "stock_id string, cluster int")
    z = (x - x.mean(0)) / x.std(0)
    far, of = np.linalg.norm(z[:, None] - z[None], axis=2), np.arange(30) // 10
    s = []
    for i in range(30):
        a = far[i, (of == of[i]) & (np.arange(30) != i)].mean()
        b = min(far[i, of == c].mean() for c in range(3) if c != of[i])
        s.append((b - a) / max(a, b))
    for block in (4, 1024):
        assert np.isclose(CL.silhouette_given(feats, labels, block).first()[0], np.mean(s))
    ratio = CL.variance_ratio(feats, labels).first()
    between = sum(10 * ((z[of == c].mean(0) - z.mean(0)) ** 2).sum() for c in range(3))
    within = sum(((z[of == c] - z[of == c].mean(0)) ** 2).sum() for c in range(3))
    assert np.isclose(ratio["between_var"], between) and np.isclose(ratio["within_var"], within)


def test_bridge_joins_the_segments(spark):
    rows = [("s", 1, 0, 1.0, "observed"), ("s", 1, 1, 1.2, "observed"), ("s", 1, 2, 1.3, "heldout_actual"), ("s", 2, 5, 2.0, "heldout_actual"), ("s", 3, 5, 2.0, "observed")]
    series = spark.createDataFrame(rows, "stock_id string, time_id int, seconds_in_bucket int, realized_vol double, segment string")
    got = sorted(tuple(r) for r in CV.with_bridge(series).collect())
    assert got == sorted([(*r, False) for r in rows] + [("s", 1, 1, 1.2, "heldout_actual", True)])
