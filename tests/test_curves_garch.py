import json
import math

import numpy as np
from conftest import BOOK_SCHEMA, book_rows

from volspark.operators import curves as CV
from volspark.operators import garch as GA


def test_rolling_realised_vol(spark):
    # returns of 1..8 bp at seconds 1..8, then flat
    p, prices = 1.0, [1.0]
    for k in range(1, 9):
        p *= math.exp(k * 1e-4)
        prices.append(p)
    prices += [p] * (600 - len(prices))
    s = CV.realised_series(spark.createDataFrame(book_rows("stock_0", 1, prices), BOOK_SCHEMA), horizon=2)
    by_sec = {r["seconds_in_bucket"]: r for r in s.collect()}
    assert 4 not in by_sec  # only four returns by second 4 (min 5)
    assert math.isclose(by_sec[5]["realized_vol"], math.sqrt(np.mean(np.arange(1, 6) ** 2)), rel_tol=1e-9)
    assert math.isclose(by_sec[7]["realized_vol"], math.sqrt(np.mean(np.arange(1, 8) ** 2)), rel_tol=1e-9)
    assert by_sec[599]["segment"] == "heldout_actual" and by_sec[597]["segment"] == "observed"


def test_prediction_curve_anchor(spark):
    series = spark.createDataFrame(
        [("s", 1, 0, 1.0, "observed"), ("s", 1, 1, 1.2, "observed"), ("s", 1, 2, 1.3, "heldout_actual"), ("s", 1, 3, 1.4, "heldout_actual")],
        "stock_id string, time_id bigint, seconds_in_bucket int, realized_vol double, segment string",
    )
    pred = spark.createDataFrame(
        [("s", 1, "G", "GARCH(1,1)", None, "garch_path", "[2, 3]", "[1.6, 1.55]"),
         ("s", 1, "L", "Linear Regression", 1.5, "horizon_line", "", "")],
        "stock_id string, time_id bigint, model string, model_type string, pred_vol double, prediction_kind string, "
        "forecast_seconds string, forecast_vol_path string",
    )
    c = CV.prediction_curves(series, pred).collect()
    g = sorted((r["seconds_in_bucket"], r["pred_vol"]) for r in c if r["model"] == "G")
    assert g == [(1, 1.2), (2, 1.6), (3, 1.55)]
    assert sorted(r["seconds_in_bucket"] for r in c if r["model"] == "L") == [2, 3]


def test_garch_window_forecast(spark):
    rng = np.random.default_rng(3)
    sig, eps, e_prev = 1.0, [], 0.0
    for _ in range(600):
        sig = 0.1 + 0.1 * e_prev ** 2 + 0.8 * sig
        e_prev = rng.normal() * math.sqrt(sig)
        eps.append(e_prev)
    p, prices = 1.0, [1.0]
    for e in eps[:599]:
        p *= math.exp(e * 1e-4)
        prices.append(p)
    book = spark.createDataFrame(book_rows("stock_7", 101, prices), BOOK_SCHEMA)
    folds = spark.createDataFrame([(101, 1)], "time_id bigint, fold int")
    row = GA.garch_forecasts(book, folds, "GARCH(1,1)", 30).first()
    secs = json.loads(row["forecast_seconds"])
    path = json.loads(row["forecast_vol_path"])
    assert secs == list(range(570, 600)) and len(path) == 30
    assert np.isfinite(row["pred_var"]) and row["prediction_kind"] == "garch_path"
    theta, _ = GA.fit_rows(np.array([eps[:569]]), np.array([569]), False)
    assert 0.6 < theta[0, 1] + theta[0, 2] < 0.99


def simulate(omega, alpha, beta, gamma, n, seed):
    rng, s, e, out = np.random.default_rng(seed), omega / (1 - alpha - beta - gamma / 2), 0.0, []
    for _ in range(n):
        s = omega + (alpha + gamma * (e < 0)) * e * e + beta * s
        e = rng.normal() * math.sqrt(s)
        out.append(e)
    return out


def test_garch_recovers_strong_effects():
    eps, n = GA.padded([simulate(0.1, 0.8, 0.1, 0.0, 2500, s) for s in range(6)])
    assert abs(GA.fit_rows(eps, n, False)[0][:, 1].mean() - 0.8) < 0.08
    eps, n = GA.padded([simulate(0.1, 0.05, 0.3, 0.9, 2500, s) for s in range(6)])
    assert abs(GA.fit_rows(eps, n, True)[0][:, 3].mean() - 0.9) < 0.15


def test_garch_likelihood_not_below_a_fine_grid():
    eps, n = GA.padded([simulate(0.1, 0.2, 0.6, 0.0, m, m) for m in (400, 500, 570)])
    theta, _ = GA.fit_rows(eps, n, False)
    on = np.arange(eps.shape[1]) < n[:, None]
    eps = np.where(on, eps, 0)
    s0, var = GA.backcast(eps, n), (eps**2).sum(1) / n
    best = GA.recursion(eps, n, s0, theta)[0]
    for a in np.linspace(0, 1, 21):
        for b in np.linspace(0, 1 - a, 12):
            for w in (0.02, 0.1, 0.2, 0.3, 0.6, 1.0):
                t = np.stack([w * var, np.full(3, a), np.full(3, b), np.zeros(3)], axis=1)
                assert np.all(GA.recursion(eps, n, s0, t)[0] <= best + 1e-4)


def test_garch_recovers_low_persistence():
    eps, n = GA.padded([simulate(0.1, 0.3, 0.2, 0.0, 500, s) for s in range(40)])
    theta, _ = GA.fit_rows(eps, n, False)
    assert abs(theta[:, 1].mean() - 0.3) < 0.06 and abs(theta[:, 2].mean() - 0.2) < 0.1
    s0, var = GA.backcast(eps, n), (eps**2).sum(1) / n
    best = GA.recursion(eps, n, s0, theta)[0]
    for a in (0.1, 0.2, 0.3, 0.4, 0.5):
        for b in (0.05, 0.1, 0.2, 0.3, 0.4):
            for w in (0.2, 0.35, 0.5, 0.65):
                assert np.all(GA.recursion(eps, n, s0, np.stack([w * var, 0 * var + a, 0 * var + b, 0 * var], axis=1))[0] <= best + 1e-4)


def test_garch_constant_and_two_value_windows():
    eps, n = GA.padded([[0.0] * 50, [1.0] * 50, [1.0, -1.0] * 25, [0.0] * 49 + [3.0], [2.0]])
    for asymmetric in (False, True):
        theta, last = GA.fit_rows(eps, n, asymmetric)
        assert np.isfinite(theta).all() and np.isfinite(last).all() and GA.feasible(theta).all()


def sequential(ret, theta):
    eps = np.array(ret) - np.mean(ret)
    sig = [max(float(GA.backcast(eps[None], np.array([len(eps)]))[0]), 1e-12)]
    for e in eps[:-1]:
        sig.append(theta[0] + theta[1] * e * e + theta[2] * sig[-1])
    return eps, np.array(sig)


def test_garch_across_windows_by_blocks(spark, monkeypatch):
    """Blocks of 80 returns give the sequential recursion and the same fit."""
    rng, rows, ret = np.random.default_rng(3), [], {}
    for s, n in (("a", 300), ("b", 129), ("c", 40), ("d", 2), ("e", 1)):
        ret[s] = np.array(simulate(0.2, 0.2, 0.7, 0.0, n - 1, n) if n > 2 else [1.0] * (n - 1))
        wap = 100 * np.exp(np.r_[0, np.cumsum(ret[s])] / 100)
        rows += [(s, i * 3, float(w), float(rng.normal())) for i, w in enumerate(wap)]
    df = spark.createDataFrame(rows, "stock_id string, time_id bigint, last_wap double, log_rv_second double").repartition(5)
    theta = (0.15, 0.25, 0.6)
    blocks = GA.series_blocks(df, 80)
    assert {r["stock_id"]: r["blocks"] for r in blocks.collect()} == {"a": 4, "b": 2, "c": 1, "d": 1}
    given = blocks.select("stock_id").distinct().selectExpr("stock_id", "0.15D AS omega", "0.25D AS alpha", "0.6D AS beta")
    got = {(r["stock_id"], r["time_id"]): (r["sig"], r["r"], r["n"]) for r in GA.filtered(blocks, given).collect()}
    for s in "abcd":
        _, want = sequential(ret[s], theta)
        mine = [got[s, 3 * (i + 1)] for i in range(len(want))]
        assert np.allclose([m[0] for m in mine], want, rtol=1e-9) and [m[1] for m in mine] == list(range(1, len(want) + 1))
    long = GA.LongSeries(blocks.where("blocks > 1"))
    x = np.array([[np.log(0.3), 0.2, 0.5], [np.log(0.1), 0.1, 0.8], [np.log(0.3), 0.0, 0.0]])
    at = np.array([0, 1, 1])
    whole = GA.Windows(*GA.padded([ret[s] - ret[s].mean() for s in long.names]), 3)
    for mine, want in zip(long.score(x, at), whole.score(x, at)):
        assert np.allclose(mine, want, rtol=1e-8, atol=1e-8)
    fits = {r["stock_id"]: (r["omega"], r["alpha"], r["beta"]) for r in GA.fit_series(blocks).collect()}
    for s in ("a", "b", "c"):
        eps, n = GA.padded([ret[s] - ret[s].mean()])
        s0 = GA.backcast(eps, n)
        best = GA.recursion(eps, n, s0, GA.fit_rows(eps, n, False)[0])[0]
        assert GA.recursion(eps, n, s0, np.array([[*fits[s], 0.0]]))[0] > best - 1e-3
    monkeypatch.setattr(GA, "BLOCK", 80)
    out = GA.legacy_garch(df).collect()
    assert len(out) == 299 + 128 + 39 + 1 and all(np.isfinite(r["y_pred"]) for r in out)
    for s in ("a", "c"):
        own = sorted((r for r in out if r["stock_id"] == s), key=lambda r: r["time_id"])
        _, sig = sequential(ret[s], fits[s])
        k, y = int(0.8 * len(own)), np.array([r["y_true"] for r in own])
        line = np.polyfit(0.5 * np.log(sig[:k]), y[:k], 1)
        assert np.allclose([r["y_pred"] for r in own], np.polyval(line, 0.5 * np.log(sig)), atol=1e-6)
        assert [r["split"] for r in own] == ["train"] * k + ["test"] * (len(own) - k)


def test_garch_gates_and_path(spark):
    cases = [
        (1, 0.1, 0.1, 0.8, 0.0, 2.0, -1.0, True),
        (2, 0.1, 0.5, 0.6, 0.0, 2.0, 1.0, False),  # not stationary
        (3, -0.1, 0.1, 0.5, 0.0, 2.0, 1.0, False),
        (4, 0.1, 0.1, 0.1, 0.995, 2.0, 1.0, False),
        (5, 0.1, 0.1, 0.5, -0.2, 2.0, 1.0, False),  # alpha + gamma < 0
        (6, 0.1, float("nan"), 0.5, 0.0, 2.0, 1.0, False),
        (7, 0.1, 0.05, 0.5, 0.2, 2.0, -3.0, True),
        (8, 5e6, 0.1, 0.5, 0.0, 2.0, 1.0, False),  # beyond the credible range
    ]
    df = spark.createDataFrame([c[:7] for c in cases], "id int, omega double, alpha double, beta double, gamma double, last_var double, last_ret double")
    got = {r["id"]: r for r in GA.forecasts_from_fits(df, 30).collect()}
    for i, w, a, b, g, v, e, ok in cases:
        if not ok:
            assert got[i]["path"] is None and got[i]["pred_var"] is None
            continue
        path = [w + (a + g * (e < 0)) * e * e + b * v]
        for _ in range(29):
            path.append(w + (a + b + g / 2) * path[-1])
        assert np.allclose(got[i]["path"], path) and math.isclose(got[i]["pred_var"], np.mean(path), rel_tol=1e-9)
