"""Query families whose results are not SQL-expressible (model fits and
likelihood optimisation): registered without an oracle, so the driver checks
rows only; pytest checks them against numpy on small fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import ModelSpec, SplitConfig
from ..operators import features as FT
from ..operators import folds as FO
from ..operators import garch as GA
from ..operators import models as MO
from ..operators import report as RP
from .queries import CFG, book, register, stored

PCA_K = 12


def _data(spark, sf):
    f = stored(spark, sf)
    cols = MO.usable_feature_list(FT.usable_columns(f, CFG))
    return FO.with_folds(f, SplitConfig()), cols


def _ml(model_type: str, mode: str = "PCA"):
    def build(spark, sf):
        data, cols = _data(spark, sf)
        pred, _imp = MO.run_models(data, [ModelSpec(name=model_type, model_type=model_type)], cols, mode, PCA_K)
        return pred

    return build


for _name, _type in (
    ("ml_linear", "Linear Regression"),
    ("ml_ridge", "Ridge Regression"),
    ("ml_lasso", "LASSO"),
    ("ml_har", "HAR-RV"),
    ("ml_tree", "Decision Tree"),
    ("ml_forest", "Random Forest"),
    ("ml_boosted", "XGBoost"),
):
    register(_name, None)(_ml(_type))


def _importance(spark, sf):
    data, cols = _data(spark, sf)
    specs = [ModelSpec(name="Linear Regression", model_type="Linear Regression"),
             ModelSpec(name="Decision Tree", model_type="Decision Tree")]
    _pred, imp = MO.run_models(data, specs, cols, "Manual", PCA_K)
    return imp


@register("importance_top10", None)
def q_importance_top10(spark, sf):
    return RP.importance_top(_importance(spark, sf), 10)


@register("importance_pivot", None)
def q_importance_pivot(spark, sf):
    return RP.importance_pivot(_importance(spark, sf), 10)


@register("pca_variance", None)
def q_pca_variance(spark, sf):
    f = stored(spark, sf)
    cols = MO.usable_feature_list(FT.usable_columns(f, CFG))
    ratios = MO.pca_variance(f, cols, PCA_K).selectExpr("*", "CAST(substr(component, 3) AS INT) AS k")
    return RP.cumulative_share(ratios, "k", "explained_variance_ratio").drop("k")  # W16


@register("stock_pca_map", None)
def q_stock_pca_map(spark, sf):
    f = stored(spark, sf)
    cols = MO.usable_feature_list(FT.usable_columns(f, CFG))
    return MO.stock_pca_map(f, cols)


def _garch(model_type):
    def build(spark, sf):
        folds = FO.fold_table(stored(spark, sf), SplitConfig())
        return GA.garch_forecasts(book(spark, sf), folds, model_type, CFG.forecast_horizon)

    return build


register("garch_window", None)(_garch("GARCH(1,1)"))
register("gjr_garch_window", None)(_garch("GJR-GARCH(1,1)"))


# ---------------------------------------------------------------- legacy path
from ..operators import cluster as CL  # noqa: E402
from ..operators import legacy as LG  # noqa: E402
from ..operators import metrics as ME  # noqa: E402
from ..operators import universe as UV  # noqa: E402
from ..config import BOOK_VALUE_COLUMNS  # noqa: E402
from .queries import R, book_ctes, predictions, sql_losses, sql_pred, sql_stock_model  # noqa: E402

BOOK_ONLY = "WITH " + book_ctes().lstrip().split(",\ndedup")[0]
LORDER = "seconds_in_bucket, " + ", ".join(BOOK_VALUE_COLUMNS)
#: What one window gives: the published features but for lags and products, and the label.
LEG_OUT = [c for c in LG.FEATURE_COLS if "lag" not in c and "rolling" not in c and "_x_" not in c and "_per_" not in c] + ["log_rv_second"]


def _legacy_sql_ctes() -> str:
    h1 = lambda e: f"CASE WHEN half = 1 THEN {e} END"
    acfs = ", ".join(f"sum({h1(f'(lr - lr_mean) * (l{k} - lr_mean)')}) / NULLIF(sum({h1('power(lr - lr_mean, 2)')}), 0) AS acf_{k}" for k in range(1, 6))
    leads = ", ".join(f"lead(lr, {k}) OVER w AS l{k}" for k in range(1, 6))
    dl = ["p1_1 AS (SELECT *, acf_1 AS p1_1 FROM lacf)"]
    prev = "p1_1"
    steps = []
    cur = "(SELECT *, acf_1 AS p1_1 FROM lacf)"
    for k in range(2, 6):
        num = f"acf_{k} - (" + " + ".join(f"p{k - 1}_{j} * acf_{k - j}" for j in range(1, k)) + ")"
        den = "1 - (" + " + ".join(f"p{k - 1}_{j} * acf_{j}" for j in range(1, k)) + ")"
        cur = f"(SELECT *, ({num}) / NULLIF({den}, 0) AS p{k}_{k} FROM {cur})"
        upd = ", ".join(f"p{k - 1}_{j} - p{k}_{k} * p{k - 1}_{k - j} AS p{k}_{j}" for j in range(1, k))
        cur = f"(SELECT *, {upd} FROM {cur})"
    skew = "CASE WHEN n1 >= 3 THEN CASE WHEN m2 = 0 THEN 0 ELSE (m3 / power(m2, 1.5)) * sqrt(n1 * (n1 - 1)) / (n1 - 2) END END"
    kurt = "CASE WHEN n1 >= 4 THEN CASE WHEN m2 = 0 THEN 0 ELSE ((n1 + 1) * (m4 / (m2 * m2) - 3) + 6) * (n1 - 1) / ((n1 - 2) * (n1 - 3)) END END"
    return f""",
lr1 AS (SELECT *, CASE WHEN seconds_in_bucket < 300 THEN 1 ELSE 2 END AS half,
               (bid_price1 * ask_size1 + ask_price1 * bid_size1) / NULLIF(bid_size1 + ask_size1, 0) AS wap FROM book),
lr2 AS (SELECT *, CASE WHEN wap > 0 THEN ln(wap) END AS lw, ask_price1 - bid_price1 AS spread,
               (ask_price1 - bid_price1) / NULLIF((bid_price1 + ask_price1) / 2, 0) AS rel_spread,
               bid_size1 + ask_size1 AS depth, (bid_size1 - ask_size1) / NULLIF(bid_size1 + ask_size1, 0) AS imbalance FROM lr1),
lr3 AS (SELECT *, lw - lag(lw) OVER w AS lr, wap - lag(wap) OVER w AS dwap, row_number() OVER w AS rn FROM lr2
        WINDOW w AS (PARTITION BY stock_id, time_id, half ORDER BY {LORDER})),
lr4 AS (SELECT *, avg(lr) OVER (PARTITION BY stock_id, time_id, half) AS lr_mean, {leads} FROM lr3
        WINDOW w AS (PARTITION BY stock_id, time_id, half ORDER BY {LORDER})),
lacf AS (
  SELECT stock_id, time_id,
    sqrt(coalesce(sum({h1('lr * lr')}), 0)) AS rv_first, stddev_samp({h1('lr')}) AS std_log_return,
    count({h1('lr')}) AS n1, avg({h1('power(lr - lr_mean, 2)')}) AS m2, avg({h1('power(lr - lr_mean, 3)')}) AS m3,
    avg({h1('power(lr - lr_mean, 4)')}) AS m4,
    max({h1('lr')}) AS max_log_return, min({h1('lr')}) AS min_log_return, sum({h1('power(lr, 4)')}) AS s4,
    avg({h1('abs(lr)')}) AS abs_return_mean, max({h1('abs(lr)')}) AS max_abs_return,
    max({h1('wap')}) - min({h1('wap')}) AS wap_range, stddev_samp({h1('wap')}) AS wap_std,
    count_if(half = 1 AND dwap IS NOT NULL AND dwap <> 0) AS n_price_changes,
    avg({h1('spread')}) AS mean_spread, stddev_samp({h1('spread')}) AS std_spread, max({h1('spread')}) - min({h1('spread')}) AS spread_range,
    avg({h1('rel_spread')}) AS mean_rel_spread, stddev_samp({h1('rel_spread')}) AS std_rel_spread,
    avg({h1('depth')}) AS mean_depth, stddev_samp({h1('depth')}) AS std_depth,
    avg({h1('imbalance')}) AS mean_imbalance, stddev_samp({h1('imbalance')}) AS std_imbalance,
    avg({h1('bid_size1')}) AS mean_bid_size1, avg({h1('ask_size1')}) AS mean_ask_size1, count({h1('wap')}) AS n_rows,
    arg_min({h1('wap')}, {h1('CASE WHEN wap IS NOT NULL THEN rn END')}) AS wf, arg_max({h1('wap')}, {h1('CASE WHEN wap IS NOT NULL THEN rn END')}) AS wl,
    {acfs},
    count_if(half = 1) AS r1, count_if(half = 2) AS r2,
    sqrt(coalesce(sum(CASE WHEN half = 2 THEN lr * lr END), 0)) AS rv_second
  FROM lr4 GROUP BY stock_id, time_id HAVING count_if(half = 1) > 0 AND count_if(half = 2) > 0),
ldl AS {cur},
legacy AS (
  SELECT stock_id, time_id, rv_first, std_log_return, {skew} AS skew_log_return, {kurt} AS kurt_log_return,
         max_log_return, min_log_return, n1 / 3.0 * s4 AS realized_quarticity, abs_return_mean, max_abs_return,
         wap_range, wap_std, CAST(n_price_changes AS DOUBLE) AS n_price_changes, CAST(n_rows AS DOUBLE) AS n_rows,
         mean_spread, std_spread, spread_range, mean_rel_spread, std_rel_spread, mean_depth, std_depth,
         mean_imbalance, std_imbalance, mean_bid_size1, mean_ask_size1, n_rows / 300.0 AS arrival_rate, wl - wf AS wap_momentum,
         acf_1 AS acf1, acf_5 AS acf5, p1_1 AS pacf1, p5_5 AS pacf5, ln(rv_second + 1e-8) AS log_rv_second
  FROM ldl)"""


@register(
    "legacy_window_features",
    BOOK_ONLY + _legacy_sql_ctes() + "\nSELECT stock_id, time_id, " + ", ".join(R(c, c) for c in LEG_OUT) + " FROM legacy",
)
def q_legacy_window_features(spark, sf):
    return LG.window_features(book(spark, sf)).select("stock_id", "time_id", *LEG_OUT)


def _lags_sql() -> str:
    w = "PARTITION BY stock_id ORDER BY time_id"
    roll = "ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING"
    cond = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in LG.FEATURE_COLS + ["log_rv_second"])
    return BOOK_ONLY + _legacy_sql_ctes() + f""",
lagged AS (SELECT *, lag(rv_first, 1) OVER ({w}) AS rv_first_lag1, lag(rv_first, 2) OVER ({w}) AS rv_first_lag2,
  lag(log_rv_second, 1) OVER ({w}) AS log_rv_lag1, lag(log_rv_second, 2) OVER ({w}) AS log_rv_lag2,
  lag(log_rv_second, 3) OVER ({w}) AS log_rv_lag3,
  CASE WHEN count(log_rv_second) OVER ({w} {roll}) = 5 THEN avg(log_rv_second) OVER ({w} {roll}) END AS log_rv_rolling5,
  rv_first / (mean_depth + 1e-10) AS vol_per_depth, rv_first * mean_rel_spread AS vol_x_spread,
  abs(mean_imbalance) * rv_first AS pressure_x_vol FROM legacy)
SELECT stock_id, time_id, {', '.join(R(c, c) for c in ['rv_first_lag1', 'rv_first_lag2', 'log_rv_lag1', 'log_rv_lag2', 'log_rv_lag3', 'log_rv_rolling5', 'vol_per_depth', 'vol_x_spread', 'pressure_x_vol', 'log_rv_second'])}
FROM lagged WHERE {cond}"""


LAG_OUT = ["rv_first_lag1", "rv_first_lag2", "log_rv_lag1", "log_rv_lag2", "log_rv_lag3", "log_rv_rolling5",
           "vol_per_depth", "vol_x_spread", "pressure_x_vol", "log_rv_second"]


@register("legacy_lags", _lags_sql())
def q_legacy_lags(spark, sf):
    return LG.with_lags(LG.window_features(book(spark, sf))).select("stock_id", "time_id", *LAG_OUT)


def _har_sql() -> str:
    w = "PARTITION BY stock_id ORDER BY time_id"
    return BOOK_ONLY + f""",
hr AS (SELECT *, (bid_price1 * ask_size1 + ask_price1 * bid_size1) / NULLIF(bid_size1 + ask_size1, 0) AS wap FROM book),
hr2 AS (SELECT *, CASE WHEN wap > 0 THEN ln(wap) END - lag(CASE WHEN wap > 0 THEN ln(wap) END) OVER w AS lr, row_number() OVER w AS rn
        FROM hr WINDOW w AS (PARTITION BY stock_id, time_id ORDER BY {LORDER})),
hb AS (SELECT stock_id, time_id, sqrt(coalesce(sum(CASE WHEN seconds_in_bucket < 300 THEN lr * lr END), 0)) AS rv_first,
              sqrt(coalesce(sum(CASE WHEN seconds_in_bucket >= 300 THEN lr * lr END), 0)) AS rv_second,
              arg_max(wap, CASE WHEN wap IS NOT NULL THEN rn END) AS last_wap
       FROM hr2 GROUP BY stock_id, time_id
       HAVING count_if(seconds_in_bucket < 300) > 0 AND count_if(seconds_in_bucket >= 300) > 0),
hb2 AS (SELECT *, ln(rv_second + 1e-8) AS log_rv_second FROM hb WHERE last_wap IS NOT NULL),
hl AS (SELECT *, lag(log_rv_second, 1) OVER ({w}) AS lag_d,
  CASE WHEN count(log_rv_second) OVER ({w} ROWS BETWEEN 5 PRECEDING AND 2 PRECEDING) = 4
       THEN avg(log_rv_second) OVER ({w} ROWS BETWEEN 5 PRECEDING AND 2 PRECEDING) END AS lag_w,
  CASE WHEN count(log_rv_second) OVER ({w} ROWS BETWEEN 22 PRECEDING AND 6 PRECEDING) = 17
       THEN avg(log_rv_second) OVER ({w} ROWS BETWEEN 22 PRECEDING AND 6 PRECEDING) END AS lag_m FROM hb2)
SELECT stock_id, time_id, {R('log_rv_second', 'log_rv_second')}, {R('lag_d', 'lag_d')}, {R('lag_w', 'lag_w')}, {R('lag_m', 'lag_m')}
FROM hl WHERE lag_d IS NOT NULL AND lag_w IS NOT NULL AND lag_m IS NOT NULL"""


@register("har_lags", _har_sql())
def q_har_lags(spark, sf):
    return LG.har_lags(LG.har_base(book(spark, sf))).select("stock_id", "time_id", "log_rv_second", "lag_d", "lag_w", "lag_m")


@register("har_per_stock", None)
def q_har_per_stock(spark, sf):
    fitted = LG.har_per_stock(LG.har_lags(LG.har_base(book(spark, sf))))
    losses = ME.legacy_losses(fitted.where("split = 'test'"), ["stock_id"], "y_true", "y_pred")
    coef = fitted.groupBy("stock_id").agg(*[F.first(c).alias(c) for c in ("b0", "b_d", "b_w", "b_m")])
    return losses.join(coef, "stock_id")


@register("garch_calibrated", None)
def q_garch_calibrated(spark, sf):
    return GA.legacy_garch(LG.har_base(book(spark, sf)))


# ---------------------------------------------------------------- clusters
def labels(df):
    """Cluster labels for the fixture: ``stock_number % 2 + 1``."""
    return df.select("stock_id").distinct().selectExpr(
        "stock_id", "CAST(CAST(regexp_extract(stock_id, '(\\\\d+)$', 1) AS INT) % 2 + 1 AS INT) AS cluster"
    )


RV_SQL = f""",
cr AS (SELECT *, CASE WHEN (bid_price1 * ask_size1 + ask_price1 * bid_size1) / NULLIF(bid_size1 + ask_size1, 0) > 0
                      THEN ln((bid_price1 * ask_size1 + ask_price1 * bid_size1) / NULLIF(bid_size1 + ask_size1, 0)) END AS lw FROM book),
cr2 AS (SELECT *, lw - lag(lw) OVER (PARTITION BY stock_id, time_id ORDER BY {LORDER}) AS lr FROM cr),
rv AS (SELECT stock_id, time_id, sqrt(coalesce(sum(lr * lr), 0)) AS rv FROM cr2 GROUP BY stock_id, time_id),
lab AS (SELECT DISTINCT stock_id, CAST(CAST(regexp_extract(stock_id, '(\\d+)$', 1) AS INTEGER) % 2 + 1 AS INTEGER) AS cluster FROM rv)"""


@register(
    "cluster_rv_series",
    BOOK_ONLY + RV_SQL + """,
cw AS (SELECT time_id FROM rv GROUP BY time_id HAVING count(DISTINCT stock_id) = (SELECT count(DISTINCT stock_id) FROM rv))
SELECT cluster, time_id, """ + R("avg(rv)", "mean_rv") + """ FROM rv JOIN lab USING (stock_id)
WHERE time_id IN (SELECT time_id FROM cw) GROUP BY cluster, time_id""",
)
def q_cluster_rv_series(spark, sf):
    rv = LG.window_rv(book(spark, sf))
    return CL.cluster_rv_series(rv, labels(rv))


def _behaviour_sql() -> str:
    skew = "CASE WHEN n >= 3 THEN CASE WHEN m2 = 0 THEN 0 ELSE (m3 / power(m2, 1.5)) * sqrt(n * (n - 1)) / (n - 2) END END"
    kurt = "CASE WHEN n >= 4 THEN CASE WHEN m2 = 0 THEN 0 ELSE ((n + 1) * (m4 / (m2 * m2) - 3) + 6) * (n - 1) / ((n - 2) * (n - 3)) END END"
    return BOOK_ONLY + _legacy_sql_ctes() + RV_SQL + f""",
rvm AS (SELECT *, avg(rv) OVER (PARTITION BY stock_id) AS mu, lag(rv) OVER (PARTITION BY stock_id ORDER BY time_id) AS rv_prev FROM rv),
bm AS (SELECT stock_id, avg(rv) AS mean_rv, stddev_samp(rv) AS std_rv, count(rv) AS n, avg(power(rv - mu, 2)) AS m2,
              avg(power(rv - mu, 3)) AS m3, avg(power(rv - mu, 4)) AS m4, quantile_cont(rv, 0.9) AS p90_rv,
              CASE WHEN count(rv_prev) > 1 AND stddev_pop(rv_prev) > 0 AND stddev_pop(CASE WHEN rv_prev IS NOT NULL THEN rv END) > 0
                   THEN covar_pop(rv_prev, CASE WHEN rv_prev IS NOT NULL THEN rv END)
                        / (stddev_pop(rv_prev) * stddev_pop(CASE WHEN rv_prev IS NOT NULL THEN rv END)) END AS rv_autocorr
       FROM rvm GROUP BY stock_id),
bs AS (SELECT stock_id, avg(mean_rel_spread) AS mean_rel_spread, avg(std_rel_spread) AS std_rel_spread,
              avg(mean_imbalance) AS mean_imbalance FROM legacy GROUP BY stock_id),
beh AS (SELECT bm.stock_id, mean_rv, std_rv, {skew} AS skew_rv, {kurt} AS kurt_rv, rv_autocorr, p90_rv,
               mean_rel_spread, std_rel_spread, mean_imbalance FROM bm JOIN bs USING (stock_id))"""


def _behaviour(spark, sf):
    b = book(spark, sf)
    rv = LG.window_rv(b)
    return CL.behaviour(rv, LG.window_features(b)), labels(rv)


@register(
    "cluster_summary",
    _behaviour_sql() + "\nSELECT cluster, count(*) AS n_stocks, " + R("avg(mean_rv)", "mean_rv")
    + " FROM beh JOIN lab USING (stock_id) GROUP BY cluster",
)
def q_cluster_summary(spark, sf):
    feats, lab = _behaviour(spark, sf)
    return CL.cluster_summary(feats, lab)


@register(
    "cluster_behaviour",
    _behaviour_sql() + "\nSELECT stock_id, " + ", ".join(R(c, c) for c in CL.BEHAVIOUR) + " FROM beh",
)
def q_cluster_behaviour(spark, sf):
    feats, _lab = _behaviour(spark, sf)
    return feats


def _z_sql() -> str:
    pairs = " UNION ALL ".join(f"SELECT stock_id, '{c}' AS feature, {c} AS x FROM beh" for c in CL.BEHAVIOUR)
    return f""",
lng AS ({pairs}),
z AS (SELECT stock_id, feature, (x - avg(x) OVER (PARTITION BY feature)) / NULLIF(stddev_pop(x) OVER (PARTITION BY feature), 0) AS z FROM lng),
zl AS (SELECT z.*, lab.cluster FROM z JOIN lab USING (stock_id) WHERE z IS NOT NULL)"""


@register(
    "cluster_variance",
    _behaviour_sql() + _z_sql() + """,
g AS (SELECT feature, avg(z) AS g FROM zl GROUP BY feature),
pc AS (SELECT cluster, feature, avg(z) AS m, count(*) AS n FROM zl GROUP BY cluster, feature),
bw AS (SELECT sum(n * power(m - g, 2)) AS between_var FROM pc JOIN g USING (feature)),
wi AS (SELECT sum(power(z - m, 2)) AS within_var FROM zl JOIN pc USING (cluster, feature))
SELECT """ + R("between_var", "between_var") + ", " + R("within_var", "within_var") + ", "
    + R("between_var / NULLIF(within_var, 0)", "ratio") + " FROM bw, wi",
)
def q_cluster_variance(spark, sf):
    feats, lab = _behaviour(spark, sf)
    return CL.variance_ratio(feats, lab)


@register(
    "cluster_silhouette_given",
    _behaviour_sql() + _z_sql() + """,
d AS (SELECT a.stock_id AS sa, b.stock_id AS sb, a.cluster AS ca, b.cluster AS cb, sqrt(sum(power(a.z - b.z, 2))) AS dist
      FROM zl a JOIN zl b ON a.feature = b.feature AND a.stock_id <> b.stock_id GROUP BY a.stock_id, b.stock_id, a.cluster, b.cluster),
pm AS (SELECT sa, ca, cb, avg(dist) AS md FROM d GROUP BY sa, ca, cb),
s AS (SELECT sa, CASE WHEN max(CASE WHEN ca = cb THEN md END) IS NULL THEN 0
           ELSE (min(CASE WHEN ca <> cb THEN md END) - max(CASE WHEN ca = cb THEN md END))
                / greatest(max(CASE WHEN ca = cb THEN md END), min(CASE WHEN ca <> cb THEN md END)) END AS s FROM pm GROUP BY sa)
SELECT """ + R("avg(s)", "silhouette") + " FROM s",
)
def q_cluster_silhouette_given(spark, sf):
    feats, lab = _behaviour(spark, sf)
    return CL.silhouette_given(feats, lab)


@register("cluster_kmeans_silhouette", None)
def q_cluster_kmeans(spark, sf):
    feats, _lab = _behaviour(spark, sf)
    return CL.kmeans_silhouette(feats)


@register("cluster_pca", None)
def q_cluster_pca(spark, sf):
    feats, _lab = _behaviour(spark, sf)
    return CL.pca_2d(feats)


@register(
    "cluster_win_rate",
    "WITH " + sql_pred() + "," + sql_stock_model() + """,
lab AS (SELECT DISTINCT stock_id, CAST(CAST(regexp_extract(stock_id, '(\\d+)$', 1) AS INTEGER) % 2 + 1 AS INTEGER) AS cluster FROM pred),
bench AS (SELECT l.cluster, p.model, sqrt(avg(power(p.pred_var - p.actual_var, 2))) AS bench_rmse
          FROM pred p JOIN lab l USING (stock_id) GROUP BY l.cluster, p.model),
j AS (SELECT l.cluster, sm.model, sm.stock_id, sm.rmse < coalesce(b.bench_rmse, CAST('Infinity' AS DOUBLE)) AS beats
      FROM sm JOIN lab l USING (stock_id) LEFT JOIN bench b ON b.cluster = l.cluster AND b.model = sm.model WHERE sm.n >= 100)
SELECT cluster, model, """ + R("avg(CAST(beats AS DOUBLE))", "win_rate") + ", count(*) AS n_stocks FROM j GROUP BY cluster, model",
)
def q_cluster_win_rate(spark, sf):
    pred = predictions(spark, sf)
    lab = labels(pred)
    sm = UV.stock_model_metrics(pred)
    bench = pred.join(lab, "stock_id").groupBy("cluster", "model").agg(
        F.expr("sqrt(avg(power(pred_var - actual_var, 2))) AS bench_rmse")
    )
    return CL.win_rate(sm, bench, lab)


@register(
    "cluster_loss_quartiles",
    "WITH " + sql_pred() + "," + sql_stock_model() + """,
lab AS (SELECT DISTINCT stock_id, CAST(CAST(regexp_extract(stock_id, '(\\d+)$', 1) AS INTEGER) % 2 + 1 AS INTEGER) AS cluster FROM pred)
SELECT cluster, model, """ + ", ".join(R(f"quantile_cont(qlike, {q})", n) for q, n in ((0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1, "max")))
    + " FROM sm JOIN lab USING (stock_id) GROUP BY cluster, model",
)
def q_cluster_loss_quartiles(spark, sf):
    pred = predictions(spark, sf)
    return CL.loss_quartiles(UV.stock_model_metrics(pred), labels(pred), "qlike")


# ---------------------------------------------------------------- storage
from ..session import ensure_checkpoint_dir, scratch_path  # noqa: E402
from ..sources import store as ST  # noqa: E402
from ..config import feature_columns  # noqa: E402
from .queries import features, sql_features  # noqa: E402


def _table_path(spark, sf):
    stored(spark, sf)  # make sure it exists
    return ST.feature_table_path(spark, sf, CFG)


@register(
    "cache_counts",
    "WITH " + sql_features() + """
SELECT stock_id, count(*) AS n_rows, count(DISTINCT time_id) AS n_windows FROM feat GROUP BY stock_id
UNION ALL SELECT '__all__', count(*), count(DISTINCT time_id) FROM feat""",
)
def q_cache_counts(spark, sf):
    return ST.manifest(spark.read.parquet(_table_path(spark, sf)))


@register(
    "cache_limit_per_stock",
    "WITH " + sql_features() + """
SELECT stock_id, time_id, """ + R("target_var", "target_var") + ", " + R("target_vol", "target_vol") + """ FROM (
  SELECT *, row_number() OVER (PARTITION BY stock_id ORDER BY time_id) AS r FROM feat
  WHERE stock_id IN ('stock_0', 'stock_1', 'stock_2', 'stock_3')) WHERE r <= 20""",
)
def q_cache_limit_per_stock(spark, sf):
    return ST.load_feature_table(
        spark, _table_path(spark, sf), columns=["target_var", "target_vol"], stocks=["0", "1", "stock_2", "3"], max_windows=20
    )


@register(
    "run_artifacts",
    "WITH " + sql_pred() + """
SELECT 'predictions' AS frame, count(*) AS n_rows, 'completed' AS status FROM pred
UNION ALL SELECT 'metrics', count(DISTINCT (model, fold)) + count(DISTINCT model), 'completed' FROM pred
UNION ALL SELECT 'feature_importance', count(DISTINCT fold), 'completed' FROM pred
UNION ALL SELECT 'universe_summary', count(DISTINCT stock_id), 'completed' FROM feat
UNION ALL SELECT 'stock_similarity', count(*), 'completed' FROM (
    SELECT DISTINCT a.stock_id, b.stock_id AS other FROM feat a JOIN feat b USING (time_id))""",
)
def q_run_artifacts(spark, sf):
    """S12 + S13: write a run's five frames and its status, read them back."""
    import uuid
    from datetime import datetime, timezone

    store = ST.RunStore(spark, scratch_path(spark, "runs"))  # a folder of this call's own
    run_id = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ") + "_" + uuid.uuid4().hex[:8]
    pred, f = predictions(spark, sf), stored(spark, sf)
    one = [ModelSpec(name="Linear Regression", model_type="Linear Regression")]
    frames = {
        "predictions": pred,
        "metrics": ME.fold_metrics(pred),
        "feature_importance": MO.run_models(FO.with_folds(f, SplitConfig()), one, ["RV_300"], "Manual")[1],
        "universe_summary": UV.universe_summary(f, pred),
        "stock_similarity": UV.stock_similarity(f),
    }
    store.write(run_id, frames, {"features": CFG.__dict__}, {"status": "completed", "run_id": run_id})
    status = store.runs().where(F.col("run_id") == store.resolve()).select("status")
    counts = None
    for name in frames:
        n = store.frame(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("frame"), "n_rows")
        counts = n if counts is None else counts.unionByName(n)
    return counts.crossJoin(F.broadcast(status)).select("frame", "n_rows", "status")  # one row


@register(
    "resume_build",
    "WITH " + sql_features() + """
SELECT stock_id, count(*) AS n_rows, count(DISTINCT time_id) AS n_windows FROM feat GROUP BY stock_id
UNION ALL SELECT '__all__', count(*), count(DISTINCT time_id) FROM feat""",
)
def q_resume_build(spark, sf):
    """Build stocks in two passes; the second pass appends only the
    stocks that are not in the table yet."""
    import uuid

    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/resume/{uuid.uuid4().hex[:8]}"
    firsts = book(spark, sf).where("stock_id IN ('stock_0', 'stock_1')")
    ST.write_new_stocks(FT.build_features(firsts, CFG), path)
    ST.write_new_stocks(features(spark, sf), path)
    return ST.manifest(spark.read.parquet(path))


@register(
    "streaming_feature_build",
    "WITH " + sql_features() + "\nSELECT stock_id, time_id, " + R("target_var", "target_var") + ", "
    + R("target_vol", "target_vol") + ", " + ", ".join(R(c, c) for c in feature_columns(CFG)) + " FROM feat",
)
def q_streaming_feature_build(spark, sf):
    """Structured Streaming form of the feature build: the derived book is
    written to files that split every window, read back as a file stream and
    turned into the feature table batch by batch."""
    import uuid

    from ..streaming.incremental import read_features, start_incremental_build

    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/stream/{uuid.uuid4().hex[:8]}"
    book(spark, sf).repartition(8).write.mode("overwrite").parquet(f"{base}/book")
    query = start_incremental_build(spark, f"{base}/book", f"{base}/features", f"{base}/ckpt", CFG, files_per_batch=2)
    query.awaitTermination()
    return read_features(spark, f"{base}/features")


# ---------------------------------------------------------------- sources on files, report tables
from ..config import LOSS_METRICS  # noqa: E402
from ..operators import curves as CV  # noqa: E402
from ..sources.book import list_stocks, read_book  # noqa: E402
from .queries import BOOK_VALS, metrics as metrics_df  # noqa: E402


def _stock_files(spark, sf, fmt):
    """The derived book stored per stock (one folder per stock, written in
    one distributed job; the stock column comes back from the folder name)."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/book_files/{uuid.uuid4().hex[:8]}"
    writer = book(spark, sf).write.partitionBy("stock_id")
    (writer.option("header", True).csv(base) if fmt == "csv" else writer.parquet(base))
    return base


@register(
    "book_sources",
    "WITH " + book_ctes().lstrip().split(",\ndedup")[0]
    + "\nSELECT time_id, seconds_in_bucket, " + ", ".join(R(c, c) for c in BOOK_VALS) + ", stock_id FROM book",
)
def q_book_sources(spark, sf):
    """S1 + S3 + S4 + P15: discover ``stock_*.csv`` files, scan them with a
    fixed schema (missing columns raise), stock name from the file name."""
    base = _stock_files(spark, sf, "csv")
    stocks = list_stocks(spark, base, "csv")
    scanned = read_book(spark, base, "csv", partitioned=True)
    return scanned.join(stocks, "stock_id", "left_semi").select("time_id", "seconds_in_bucket", *BOOK_VALS, "stock_id")


@register(
    "result_csv",
    "WITH " + sql_pred() + "," + sql_stock_model() + """
SELECT stock_id, model, metric, """ + R("value", "value") + """ FROM (
  UNPIVOT (SELECT stock_id, model, rmse, qlike FROM sm) ON rmse, qlike INTO NAME metric VALUE value)""",
)
def q_result_csv(spark, sf):
    """Per-stock results written as CSV, read back and melted."""
    import uuid

    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/results/{uuid.uuid4().hex[:8]}"
    ST.write_csv(UV.stock_model_metrics(predictions(spark, sf)).select("stock_id", "model", "rmse", "qlike"), path)
    back = ST.read_csv(spark, path, "stock_id string, model string, rmse double, qlike double")
    return ST.melt_benchmarks(back, "stock_id, model", ["rmse", "qlike"])


@register(
    "prediction_series",
    "WITH " + sql_pred() + """
SELECT model, fold, stock_id, time_id, """ + R("pred_vol", "pred_vol") + ", " + R("actual_vol", "actual_vol")
    + " FROM pred WHERE stock_id = 'stock_0' AND time_id = 7",
)
def q_prediction_series(spark, sf):
    """F12 + O6: one stock's (and window's) predictions, ordered by model,
    fold, window -- the filter reaches the stored table's partitions."""
    p = predictions(spark, sf).where("stock_id = 'stock_0' AND time_id = 7")
    return p.select("model", "fold", "stock_id", "time_id", "pred_vol", "actual_vol").orderBy("model", "fold", "time_id")


@register(
    "model_summary",
    "WITH " + sql_pred() + """,
metrics AS (
  SELECT CAST(CASE WHEN grouping(fold) = 1 THEN 0 ELSE fold END AS INTEGER) AS fold, model, """ + sql_losses()
    + """ FROM pred GROUP BY GROUPING SETS ((model), (model, fold))),
fm AS (SELECT model, """ + ", ".join(f"avg({m}) AS {m}" for m in LOSS_METRICS) + """ FROM metrics GROUP BY model),
lat AS (SELECT model, avg(CASE WHEN NOT isnan(inference_ms) THEN inference_ms END) * 1000 AS inference_us FROM pred GROUP BY model)
SELECT coalesce(fm.model, lat.model) AS model, """ + R("lat.inference_us", "mean_inference_us") + ", "
    + ", ".join(R(f"fm.{m}", m) for m in LOSS_METRICS) + " FROM fm FULL OUTER JOIN lat ON fm.model = lat.model",
)
def q_model_summary(spark, sf):
    """J8 + J9 + U3 + A28 + A29: figure metrics (means over all metric rows)
    full-joined with mean latency; one row per model."""
    pred = predictions(spark, sf)
    fm = ME.figure_metrics(ME.fold_metrics(pred)).dropDuplicates(["model"])
    lat = ME.mean_latency(pred).withColumnRenamed("inference_us", "mean_inference_us")
    joined = fm.join(lat, "model", "full")
    return joined.select("model", "mean_inference_us", *LOSS_METRICS)


@register(
    "payload_selection",
    "WITH " + sql_pred() + """,
sk AS (SELECT stock_id FROM (SELECT stock_id, row_number() OVER (ORDER BY CASE WHEN stock_id = 'stock_0' THEN 0 ELSE 1 END,
          CAST(regexp_extract(stock_id, '(\\d+)$', 1) AS BIGINT), stock_id) AS r FROM (SELECT DISTINCT stock_id FROM pred)) WHERE r <= 3),
tk AS (SELECT time_id FROM (SELECT time_id, row_number() OVER (ORDER BY CASE WHEN time_id = 45 THEN 0 ELSE 1 END, time_id) AS r
          FROM (SELECT DISTINCT time_id FROM pred)) WHERE r <= 20)
SELECT model, stock_id, time_id, """ + R("pred_vol", "pred_vol") + """ FROM pred
WHERE stock_id IN (SELECT stock_id FROM sk) AND time_id IN (SELECT time_id FROM tk)""",
)
def q_payload_selection(spark, sf):
    """First 3 stocks (numeric order, stock_0 forced) and first 20
    windows (window 45 forced) of the forecast table."""
    p = predictions(spark, sf).select("model", "stock_id", "time_id", "pred_vol")
    p = CV.first_keys_with_forced(p, "stock_id", 3, "stock_0")
    return CV.first_keys_with_forced(p, "time_id", 20, 45)


def _zoo(spark, sf, only):
    data = LG.with_lags(LG.window_features(book(spark, sf)))
    return MO.legacy_zoo(data.join(labels(data), "stock_id"), LG.FEATURE_COLS, only=only)


@register("ml_legacy_zoo", None)
def q_ml_legacy_zoo(spark, sf):
    """M15 + M22 + W12: cluster models on the legacy features, temporal split,
    log-vol RMSE / QLIKE per (cluster, model)."""
    pred = _zoo(spark, sf, "cluster:").withColumn("cluster", F.expr("CAST(substr(unit, 9) AS INT)"))
    return ME.legacy_losses(pred, ["cluster", "model"], "y_true", "y_pred")


@register("ml_legacy_stocks", None)
def q_ml_legacy_stocks(spark, sf):
    """M15 + F11: the same models per stock with at least 100 rows."""
    pred = _zoo(spark, sf, "stock:")
    return ME.legacy_losses(pred, ["stock_id", "model"], "y_true", "y_pred")
