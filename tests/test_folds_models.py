from dataclasses import replace

import numpy as np

import pytest

from volspark.config import ModelSpec, SplitConfig, columns_for_labels
from volspark.functions.indexing import ordered_index
from volspark.functions.quantiles import complement_quantile, group_quantiles
from volspark.operators import folds as FO
from volspark.operators import linear as LN
from volspark.operators import models as MO


def test_folds_have_array_split_sizes(spark):
    df = spark.createDataFrame([(i * 3,) for i in range(23)], "time_id bigint")
    folds = FO.fold_table(df, SplitConfig(n_folds=5)).orderBy("time_id").collect()
    sizes = np.bincount([r["fold"] for r in folds])[1:]
    assert sizes.tolist() == [len(x) for x in np.array_split(np.arange(23), 5)]
    assert [r["fold"] for r in folds] == sorted(r["fold"] for r in folds)  # contiguous tiles


def test_ordered_index_is_global(spark):
    df = spark.createDataFrame([(int(v),) for v in np.random.default_rng(0).permutation(1000)], "k bigint")
    rows = ordered_index(df, ["k"], partitions=7).collect()
    assert all(r["idx"] == r["k"] for r in rows) and rows[0]["n_rows"] == 1000


def model_rows(spark, n=90, d=4, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.array([1.0, 10.0, 0.1, 1.0])[:d] + 3
    x[:, 3] = 2 * x[:, 0] - 1  # dependent columns: a singular covariance
    y = 4 + x @ np.array([1.0, -0.2, 5.0, 0.0])[:d] + rng.normal(scale=0.3, size=n)
    fold = np.arange(n) % 3 + 1
    rows = [("s", i, int(fold[i]), float(y[i] ** 2), float(y[i]), *map(float, x[i])) for i in range(n)]
    cols = [f"f{j}" for j in range(d)]
    schema = "stock_id string, time_id bigint, fold int, target_var double, target_vol double, " + ", ".join(f"{c} double" for c in cols)
    return spark.createDataFrame(rows, schema).repartition(4), cols, x, y, fold


def standardised(x, train):
    mean, sd = x[train].mean(0), x[train].std(0)
    return (x - mean) / sd


@pytest.mark.parametrize("mode,k", [("Manual", None), ("PCA", 2)])
def test_linear_models_match_numpy(spark, mode, k):
    df, cols, x, y, fold = model_rows(spark)
    kinds = ["Linear Regression", "Ridge Regression", "LASSO"]
    pred, imp = MO.run_models(df, [ModelSpec(name=t, model_type=t, parameters={"alpha": 0.05} if t == "LASSO" else {}) for t in kinds], cols, mode, k or 12)
    got = {(r["model"], r["time_id"]): r["pred_vol"] for r in pred.collect()}
    assert len(got) == 3 * len(y)
    for f in (1, 2, 3):
        train = fold != f
        z = standardised(x, train)
        if k:
            z = z @ np.linalg.svd(z[train], full_matrices=False)[2][:k].T
        zt, yt, n = z[train], y[train], train.sum()
        ybar = yt.mean()
        w = {"Linear Regression": np.linalg.lstsq(zt, yt - ybar, rcond=1e-10)[0]}
        errors = []
        for a in LN.RIDGE_ALPHAS:
            inv = np.linalg.inv(zt.T @ zt + a * np.eye(zt.shape[1]))
            h = 1 / n + np.einsum("ij,jk,ik->i", zt, inv, zt)
            errors.append((np.sum(((yt - ybar - zt @ (inv @ zt.T @ (yt - ybar))) / (1 - h)) ** 2), a, inv @ zt.T @ (yt - ybar)))
        w["Ridge Regression"] = min(errors, key=lambda e: e[0])[2]
        for name, coef in w.items():
            floor = max(np.quantile(y[train], 0.01), 0.001)
            want = np.maximum(ybar + z[~train] @ coef, floor)
            assert np.allclose([got[name, i] for i in np.flatnonzero(~train)], want, rtol=1e-6, atol=1e-8), (name, f)
    assert imp.count() == 3 * 3 * (k or len(cols))


def test_lasso_meets_its_optimality_conditions():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 6))
    y = x @ np.array([2.0, 0, 0, -1, 0, 0]) + rng.normal(size=80)
    full = np.column_stack([x, y])
    m = LN.Moments(80.0, full.sum(0), full.T @ full, np.zeros(7))
    d = LN.Design(m, None)
    w = d.lasso(0.1)
    grad = (d.xy - d.gram @ w) / d.n
    assert np.allclose(grad[w != 0], 0.1 * np.sign(w[w != 0]), atol=1e-7) and np.all(np.abs(grad[w == 0]) <= 0.1 + 1e-9)
    assert (w == 0).any()


def test_pca_ratios_and_stock_map(spark):
    df, cols, x, _, _ = model_rows(spark)
    z = (x - x.mean(0)) / x.std(0)
    values = np.sort(np.linalg.eigvalsh(z.T @ z / len(z)))[::-1]
    got = [r["explained_variance_ratio"] for r in MO.pca_variance(df, cols, 3).orderBy("component").collect()]
    assert np.allclose(got, values[:3] / values.sum())
    named = df.withColumn("stock_id", (df["time_id"] % 3).cast("string"))
    out = {r["stock_id"]: r for r in MO.stock_pca_map(named, cols).collect()}
    per = np.stack([x[np.arange(len(x)) % 3 == s].mean(0) for s in range(3)])
    zs = (per - per.mean(0)) / per.std(0)
    gram = np.array([[out[str(a)]["PC1"] * out[str(b)]["PC1"] + out[str(a)]["PC2"] * out[str(b)]["PC2"] + out[str(a)]["PC3"] * out[str(b)]["PC3"] for b in range(3)] for a in range(3)])
    assert np.allclose(gram, zs @ zs.T)  # distances are kept, whatever the signs


def test_trees_and_unknown_learners(spark):
    df, cols, _, y, _ = model_rows(spark)
    pred, imp = MO.run_models(df, [ModelSpec(name="it's a tree", model_type="Decision Tree", parameters={"min_samples_leaf": 2})], cols, "Manual")
    rows = pred.collect()
    assert len(rows) == len(y) and {r["model"] for r in rows} == {"it's a tree"} and all(r["inference_ms"] is None for r in rows)
    with pytest.raises(ValueError, match="no learner"):
        MO.run_models(df, [ModelSpec(name="x", model_type="Perceptron")], cols)


def test_exact_quantiles(spark):
    rng = np.random.default_rng(2)
    rows = [("hot", float(v)) for v in rng.integers(0, 40, 3000)] + [("one", 7.0), ("none", None)] + [("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    got = {r["k"]: (r["q25"], r["top"]) for r in group_quantiles(df, ["k"], "v", {"q25": 0.25, "top": 0.999}).collect()}
    hot = np.array([v for k, v in rows if k == "hot"])
    assert set(got) == {"hot", "one", "two"}
    assert np.allclose(got["hot"], np.quantile(hot, [0.25, 0.999])) and got["one"] == (7.0, 7.0) and np.allclose(got["two"], (1.25, 1.999))


def test_complement_quantile(spark):
    rng = np.random.default_rng(3)
    v, f = rng.normal(size=2000), rng.integers(1, 6, 2000)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(f, v)], "fold int, v double").repartition(5)
    got = complement_quantile(df, "fold", "v", 0.01)
    assert all(np.isclose(got[k], np.quantile(v[f != k], 0.01)) for k in range(1, 6)) and len(got) == 5


def test_manual_labels():
    assert columns_for_labels(["RV_30", "WAP Returns", "RV_30", "nothing"], ["abs_last_return", "RV_30", "last_return"]) == ["RV_30", "last_return", "abs_last_return"]


def test_legacy_zoo_fits_clusters_and_stocks(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = []
    for s, n in (("stock_1", 130), ("stock_2", 120), ("stock_3", 40)):
        x = rng.normal(size=(n, 3))
        y = 1 + x[:, 0] - 0.5 * x[:, 1] + 0.05 * rng.normal(size=n)
        rows += [(s, 1 + (s == "stock_3"), i, float(y[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "stock_id string, cluster int, time_id bigint, log_rv_second double, a double, b double, c double").repartition(4)
    few = {n: replace(t, trees=min(t.trees, 8)) for n, t in MO.LEGACY_TREES.items()}
    fit = lambda: {(r["unit"], r["model"], r["stock_id"], r["time_id"]): (r["y_true"], r["y_pred"]) for r in MO.legacy_zoo(df, ["a", "b", "c"], trees=few).collect()}
    got = fit()
    # last fifth of the windows of each unit; stock_3 has too few rows for its own models
    tests = {"cluster:1": 26 + 16, "cluster:2": 8, "stock:stock_1": 26, "stock:stock_2": 24}
    assert {u: sum(k[0] == u and k[1] == "DT" for k in got) for u in tests} == tests and {k[0] for k in got} == set(tests)
    assert {k[1] for k in got} == {"MLR", "Lasso", "Ridge", "DT", "RF", "XGB", "LGBM"}
    own = [r for r in rows if r[0] == "stock_1"]
    x = np.array([[1.0, *r[4:]] for r in own])
    y = np.array([r[3] for r in own])
    w = np.linalg.lstsq(x[:104], y[:104], rcond=None)[0]
    assert all(np.isclose(got["stock:stock_1", "MLR", "stock_1", i][1], x[i] @ w) for i in range(104, 130))
    for m in ("MLR", "Lasso", "Ridge"):
        assert np.mean([(t - p) ** 2 for k, (t, p) in got.items() if k[1] == m and k[0] != "cluster:2"]) < 0.01
    monkeypatch.setattr(MO.TR, "BOUND", 100)  # the larger units by distributed sums
    again = fit()
    assert set(again) == set(got) and all(np.allclose(again[k], got[k], atol=1e-6) for k in got)


def test_legacy_boosted_settings():
    for name in ("XGB", "LGBM"):
        t = MO.LEGACY_TREES[name]
        assert (t.trees, t.rate, t.depth, t.columns) == (300, 0.05, 6, 0.8)
    assert MO.LEGACY_TREES["XGB"].rows == 0.8 and MO.TREE_LEARNERS["Random Forest"]({}).depth is None
