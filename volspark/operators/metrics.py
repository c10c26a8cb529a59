"""Loss metrics and forecast tables.

Predictions (D5) carry ``model, model_type, fold, stock_id, time_id,
pred_var, pred_vol, actual_var, actual_vol, inference_ms, feature_cols,
prediction_kind, forecast_seconds, forecast_vol_path``.  All metrics are
grouped aggregates over it; the per-model fold table (A18) is one grouping-sets
aggregate, not two passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EPS, MIN_PRED_VOL, PRED_VOL_FLOOR_QUANTILE
from ..functions.quantiles import complement_quantile

FINITE = "({c} IS NOT NULL AND NOT isnan({c}) AND abs({c}) < CAST('Infinity' AS DOUBLE))"


def finite_pair(pred: str = "pred_var", actual: str = "actual_var") -> str:
    return f"({FINITE.format(c=pred)} AND {FINITE.format(c=actual)})"


def loss_exprs(pred: str = "pred_var", actual: str = "actual_var", eps: float = EPS) -> list[str]:
    """A17 as aggregate SQL: finite pairs only; mape/rmspe/qlike on clamped
    values; pearson only when n > 1 and both spreads are positive."""
    ok = finite_pair(pred, actual)
    p = f"CASE WHEN {ok} THEN {pred} END"
    a = f"CASE WHEN {ok} THEN {actual} END"
    ps = f"greatest({p}, {eps})"
    as_ = f"greatest({a}, {eps})"
    ratio = f"({as_} / {ps})"
    n = f"count({p})"
    sp, sa = f"stddev_pop({p})", f"stddev_pop({a})"
    return [
        f"CAST({n} AS BIGINT) AS n",
        f"avg(power({p} - {a}, 2)) AS mse",
        f"sqrt(avg(power({p} - {a}, 2))) AS rmse",
        f"avg(abs({p} - {a})) AS mae",
        f"avg(abs(({ps} - {as_}) / {as_})) * 100 AS mape",
        f"sqrt(avg(power(({ps} - {as_}) / {as_}, 2))) AS rmspe",
        f"avg({ratio} - ln({ratio}) - 1) AS qlike",
        f"CASE WHEN {n} > 1 AND {sp} > 0 AND {sa} > 0 THEN covar_pop({p}, {a}) / ({sp} * {sa}) END AS pearson_r",
    ]


def loss_metrics(pred: DataFrame, keys: list[str], **kw) -> DataFrame:
    """Metrics per group of ``keys``."""
    return pred.groupBy(*keys).agg(*[F.expr(e) for e in loss_exprs(**kw)])


def fold_metrics(pred: DataFrame) -> DataFrame:
    """Per ``(model, fold)`` plus per ``model`` as fold 0, in one
    grouping-sets aggregate (fold-0 rows first when ordered)."""
    sets = pred.groupingSets([["model"], ["model", "fold"]], "model", "fold")
    rows = sets.agg(F.grouping("fold").alias("_all"), *[F.expr(e) for e in loss_exprs()])
    return rows.withColumn("fold", F.expr("CAST(CASE WHEN _all = 1 THEN 0 ELSE fold END AS INT)")).drop("_all")


# Metric names accepted by the named-metric API.
NAMED_METRICS = ("QLIKE", "RMSE", "MAE")


def named_metrics(pred: DataFrame, names=NAMED_METRICS, keys: list[str] | None = None,
                  pred_col: str = "pred_var", actual_col: str = "actual_var") -> DataFrame:
    """A chosen subset of QLIKE/RMSE/MAE by case-insensitive name."""
    ok = finite_pair(pred_col, actual_col)
    p, a = f"CASE WHEN {ok} THEN {pred_col} END", f"CASE WHEN {ok} THEN {actual_col} END"
    ratio = f"(greatest({a}, {EPS}) / greatest({p}, {EPS}))"
    table = {
        "QLIKE": f"avg({ratio} - ln({ratio}) - 1)",
        "RMSE": f"sqrt(avg(power({a} - {p}, 2)))",
        "MAE": f"avg(abs({a} - {p}))",
    }
    exprs = []
    for name in names:
        key = name.upper()
        formula = table.get(key)
        if formula is None:
            raise ValueError(f"unknown metric {name!r}; choose from {', '.join(NAMED_METRICS)}")
        exprs.append(F.expr(f"{formula} AS {key}"))
    return pred.groupBy(*(keys or [])).agg(*exprs)


def baseline_predictions(features: DataFrame, folds: DataFrame, lookbacks=(30, 120, 300, 500), latency_ms: dict[int, float] | None = None) -> DataFrame:
    """A20 + U1 + P12: realised-variance baseline per lookback as a "model".

    ``pred_var`` is the mean squared return of the ``lookback`` returns just
    before the cutoff (``RV_<lookback>``); windows too short for it are
    skipped; ``inference_ms`` is that given for the lookback, else null.  One
    pass over the feature table: the lookbacks are unpivoted with ``stack``.
    """
    pairs = ", ".join(f"{lb}, RV_{lb}" for lb in lookbacks)
    known = " ".join(f"WHEN {int(lb)} THEN {float(ms)!r}D" for lb, ms in (latency_ms or {}).items())
    latency = f"CAST(CASE lookback {known} END AS DOUBLE)" if known else "CAST(NULL AS DOUBLE)"
    long = features.join(folds, "time_id").selectExpr(
        "stock_id", "time_id", "fold", "target_var", "target_vol",
        f"stack({len(lookbacks)}, {pairs}) AS (lookback, pred_var)",
    )
    return long.where("pred_var IS NOT NULL").selectExpr(
        "concat('RV baseline ', lookback) AS model",
        "'RV baseline' AS model_type",
        "CAST(fold AS INT) AS fold",
        "stock_id",
        "time_id",
        "pred_var",
        "sqrt(greatest(pred_var, 0D)) AS pred_vol",
        "target_var AS actual_var",
        "target_vol AS actual_vol",
        f"{latency} AS inference_ms",
        "concat('RV_', lookback) AS feature_cols",
        "'horizon_line' AS prediction_kind",
        "'' AS forecast_seconds",
        "'' AS forecast_vol_path",
    )


def rv_baseline(positions: DataFrame, lookbacks=(570,), horizon: int = 30) -> DataFrame:
    """Per window and lookback of any length the mean squared return of the
    ``lookback`` returns before the cutoff as forecast of the mean squared
    return after it; windows with too few returns are left out.  ``positions``
    has ``stock_id, time_id, pos, n_total, ret`` (pos from 1)."""
    cutoff = f"n_total - {int(horizon)}"
    tail = [f"avg(CASE WHEN pos <= {cutoff} AND pos > {cutoff} - {int(lb)} THEN ret * ret END) AS _v{int(lb)}" for lb in lookbacks]
    per = positions.groupBy("stock_id", "time_id").agg(F.max("n_total").alias("_n"), F.expr(f"avg(CASE WHEN pos > {cutoff} THEN ret * ret END) AS actual_var"), *[F.expr(t) for t in tail])
    pairs = ", ".join(f"{int(lb)}, CASE WHEN _n - {int(horizon)} >= {int(lb)} THEN _v{int(lb)} END" for lb in lookbacks)
    long = per.selectExpr("stock_id", "time_id", "actual_var", f"stack({len(lookbacks)}, {pairs}) AS (lookback, pred_var)")
    return long.where("pred_var IS NOT NULL AND actual_var IS NOT NULL").selectExpr("*", "sqrt(pred_var) AS pred_vol", "sqrt(actual_var) AS actual_vol")


def vol_floors(data: DataFrame, fold_col: str = "fold", vol_col: str = "target_vol", data_driven: bool = True) -> DataFrame:
    """Per fold ``max(q01(vol of the other folds), 0.001)`` (the floor of
    the linear models) or the flat ``0.001``; one row per fold."""
    schema = f"{fold_col} int, vol_floor double"
    if data_driven:
        floors = complement_quantile(data.withColumn(fold_col, F.col(fold_col).cast("int")), fold_col, vol_col, PRED_VOL_FLOOR_QUANTILE)
        return data.sparkSession.createDataFrame([(f, max(q, MIN_PRED_VOL)) for f, q in sorted(floors.items())], schema)
    return data.select(F.col(fold_col).cast("int").alias(fold_col)).distinct().withColumn("vol_floor", F.lit(MIN_PRED_VOL))


def mean_latency(pred: DataFrame, keys=("model",)) -> DataFrame:
    """Mean finite latency in microseconds."""
    return pred.groupBy(*keys).agg(
        F.expr(f"avg(CASE WHEN {FINITE.format(c='inference_ms')} THEN inference_ms END) * 1000 AS inference_us")
    )


def figure_metrics(metrics: DataFrame) -> DataFrame:
    """Mean of every metric row per model -- including the fold-0
    overall rows, as the figure code does."""
    return metrics.groupBy("model").agg(
        *[F.expr(f"avg({m}) AS {m}") for m in ("mse", "rmse", "mae", "mape", "rmspe", "qlike")]
    )


def legacy_losses(df: DataFrame, keys: list[str], y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    """QLIKE and RMSE on log-volatility targets (``var = exp(y)^2``)."""
    vt = f"power(exp({y}), 2)"
    vp = f"greatest(power(exp({yhat}), 2), 1e-20D)"
    ratio = f"({vt} / {vp})"
    return df.groupBy(*keys).agg(
        F.expr(f"avg({ratio} - ln({ratio}) - 1) AS qlike"),
        F.expr(f"sqrt(avg(power({y} - {yhat}, 2))) AS rmse"),
        F.expr("count(1) AS n"),
    )
