"""The Spark kernel against a direct numpy evaluation of the definitions on
a small random book (brute force on a small fixture)."""

import numpy as np
import pandas as pd

from conftest import BOOK_SCHEMA

from volspark.config import FeatureConfig, ewma_name
from volspark.operators.features import build_features

CFG = FeatureConfig(return_windows=(5, 30, 120), acf_windows=(30, 120), book_windows=(30, 60), ewma_lambdas=(0.9, 0.97))


def random_book(seed=7, windows=3):
    rng = np.random.default_rng(seed)
    rows = []
    for t in range(windows):
        secs = np.sort(rng.choice(600, size=260, replace=False))
        mid = 1 + np.cumsum(rng.normal(0, 2e-4, size=len(secs)))
        for s, m in zip(secs, mid):
            sp = abs(rng.normal(2e-4, 5e-5))
            rows.append((t, int(s), float(m - sp / 2), float(m + sp / 2), float(m - sp), float(m + sp), float(rng.integers(1, 100)),
                         float(rng.integers(1, 100)), float(rng.integers(1, 100)), float(rng.integers(1, 100)), "stock_0"))
    return rows


def reference(rows, cfg):
    cols = ["time_id", "sec", "b1", "a1", "b2", "a2", "bs1", "as1", "bs2", "as2", "stock_id"]
    df = pd.DataFrame(rows, columns=cols)
    out = {}
    for t, ch in df.groupby("time_id"):
        g = ch.set_index("sec").reindex(range(600)).ffill()
        wap = (g.b1 * g.as1 + g.a1 * g.bs1 + g.b2 * g.as2 + g.a2 * g.bs2) / (g.bs1 + g.as1 + g.bs2 + g.as2)
        r = (np.log(wap).diff() * 1e4).to_numpy()
        ok = np.isfinite(r)
        r, ob = r[ok], g[ok].reset_index(drop=True)
        cut = len(r) - cfg.forecast_horizon
        x = r[:cut]
        f = {"target_var": float(np.mean(r[cut:] ** 2)), "n_obs": float(len(r))}
        for w in cfg.return_windows:
            v = x[-w:]
            f[f"RV_{w}"] = np.mean(v ** 2)
            f[f"ret_q10_{w}"] = np.quantile(v, 0.1)
            f[f"jump_count_{w}"] = float(np.sum(np.abs(v) > 3 * np.std(v) + 1e-9))
            f[f"prop_zero_ret_{w}"] = np.mean(v == 0)
        for w in cfg.acf_windows:
            v = x[-w:]
            for k, name in ((1, "ret_autocorr"), (5, "ret_autocorr5")):
                a, b = v[:-k], v[k:]
                den = np.std(a) * np.std(b)
                f[f"{name}_{w}"] = 0.0 if den <= 0 else np.mean((a - a.mean()) * (b - b.mean())) / den
        for lam in cfg.ewma_lambdas:
            f[ewma_name(lam)] = pd.Series(x ** 2).ewm(alpha=1 - lam, adjust=False).mean().iloc[-1]
        o = ob.iloc[:cut]
        mid = (o.b1 + o.a1) / 2
        spread = (o.a1 - o.b1) / mid
        depth = o.bs1 + o.as1 + o.bs2 + o.as2
        for w in cfg.book_windows:
            f[f"mean_spread_{w}"] = spread.iloc[-w:].mean()
            f[f"std_depth_{w}"] = depth.iloc[-w:].std()
        out[t] = f
    return out


def test_kernel_matches_numpy(spark):
    rows = random_book()
    got = {r["time_id"]: r.asDict() for r in build_features(spark.createDataFrame(rows, BOOK_SCHEMA), CFG).collect()}
    want = reference(rows, CFG)
    assert set(got) == set(want)
    for t, f in want.items():
        for k, v in f.items():
            assert np.isclose(got[t][k], v, rtol=1e-9, atol=1e-9), (t, k, got[t][k], v)
