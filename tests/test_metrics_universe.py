import numpy as np

from volspark.operators import metrics as ME
from volspark.operators import universe as UV

PRED_SCHEMA = (
    "model string, model_type string, fold int, stock_id string, time_id bigint, pred_var double, pred_vol double, "
    "actual_var double, actual_vol double, inference_ms double, feature_cols string, prediction_kind string, "
    "forecast_seconds string, forecast_vol_path string"
)


def pred_rows(model, values, actual=1.0, ms=0.1, feats="PC1,PC2"):
    rows = []
    for i, (stock, v) in enumerate(values):
        rows.append((model, "T", 1 + i % 2, stock, i, v, v ** 0.5, actual, actual ** 0.5, ms, feats, "horizon_line", "", ""))
    return rows


def test_perfect_model_has_zero_losses(spark):
    rows = [("M", "T", 1, "stock_0", i, 2.0 + i, 0.0, 2.0 + i, 0.0, 0.1, "", "horizon_line", "", "") for i in range(5)]
    m = ME.loss_metrics(spark.createDataFrame(rows, PRED_SCHEMA), ["model"]).first()
    for k in ("mse", "rmse", "mae", "mape", "rmspe", "qlike"):
        assert abs(m[k]) < 1e-12
    assert abs(m["pearson_r"] - 1.0) < 1e-12


def test_qlike_matches_definition(spark):
    rng = np.random.default_rng(1)
    p, a = rng.uniform(0.5, 2, 50), rng.uniform(0.5, 2, 50)
    rows = [("M", "T", 1, "s", i, float(p[i]), 0.0, float(a[i]), 0.0, 0.1, "", "", "", "") for i in range(50)]
    got = ME.named_metrics(spark.createDataFrame(rows, PRED_SCHEMA), ["qlike", "rmse"]).first()
    ratio = a / p
    assert np.isclose(got["QLIKE"], np.mean(ratio - np.log(ratio) - 1))
    assert np.isclose(got["RMSE"], np.sqrt(np.mean((a - p) ** 2)))


def test_fold_zero_is_overall(spark):
    rows = pred_rows("A", [("stock_0", 1.0), ("stock_1", 1.2), ("stock_0", 0.8), ("stock_1", 1.1)])
    fm = {(r["model"], r["fold"]): r for r in ME.fold_metrics(spark.createDataFrame(rows, PRED_SCHEMA)).collect()}
    assert set(fm) == {("A", 0), ("A", 1), ("A", 2)}
    assert fm[("A", 0)]["n"] == 4


def test_win_counts_labels_latency(spark):
    rows = pred_rows("A", [("stock_0", 1.0), ("stock_1", 1.1)], ms=0.15) + pred_rows("B", [("stock_0", 2.0), ("stock_1", 2.0)], ms=0.3, feats="RV_30,RV_60,RV_120")
    pred = spark.createDataFrame(rows, PRED_SCHEMA)
    comp = {r["model"]: r for r in UV.model_comparison(pred, ME.fold_metrics(pred)).collect()}
    assert comp["A"]["best_stocks_rmse"] == 2 and comp["B"]["best_stocks_rmse"] == 0
    assert comp["A"]["feature_set"] == "2 PCs" and comp["B"]["feature_set"] == "3 features"
    assert abs(comp["A"]["mean_inference_ms"] - 0.15) < 1e-12


def test_backfill_fills_missing_losses(spark):
    rows = pred_rows("A", [("stock_0", 1.0), ("stock_1", 1.1)]) + pred_rows("B", [("stock_0", 2.0), ("stock_1", 2.0)])
    pred = spark.createDataFrame(rows, PRED_SCHEMA)
    summary = spark.createDataFrame([("stock_0", "A", None, None, None, None, None, None)],
                                    "stock_id string, best_model string, mse double, rmse double, mae double, mape double, rmspe double, qlike double")
    out = UV.backfill_summary(summary, pred).first()
    assert all(out[m] is not None for m in ("mse", "rmse", "mae", "mape", "rmspe", "qlike"))
    assert out["rmse"] == 0.0


def test_manual_selection_and_numeric_order(spark):
    assert [r["stock_id"] for r in UV.listed_stocks(spark, " 0, stock_2\nstock_2 99,").orderBy("manual_pos").collect()] == ["stock_0", "stock_2", "stock_99"]
    summary = spark.createDataFrame([(f"stock_{i}", float(10 - i)) for i in (0, 1, 2, 3, 10)], "stock_id string, mean_volatility double")
    out, missing = UV.select_display_stocks(summary, "mean_volatility", False, 2, "1, stock_3 99")
    assert sorted(r["stock_id"] for r in out.collect()) == ["stock_0", "stock_1", "stock_3"]
    assert [r["stock_id"] for r in missing.collect()] == ["stock_99"]
