"""Queries of the model layer and the run store that SQL can check: one-feature
fits have closed forms, a depth-one tree is a search over thresholds, principal
components keep traces and norms, GARCH paths and variances follow from given
parameters by recursion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SplitConfig, ModelSpec
from ..operators import cluster as CL
from ..operators import features as FT
from ..operators import folds as FO
from ..operators import garch as GA
from ..operators import legacy as LG
from ..operators import metrics as ME
from ..operators import models as MO
from ..operators import report as RP
from ..operators import universe as UV
from ..operators.book import book_runs, return_positions
from ..session import scratch_path
from ..sources.store import RUN_FRAMES, RunStore
from .queries import CFG, R, book, predictions, register, sql_features, sql_losses, sql_metrics, sql_pred, sql_stock_model, sql_summary, stored
from .registry_extra import BOOK_ONLY, _har_sql, labels

X = "RV_300"


def _one_feature(model_type: str, **parameters):
    def build(spark, sf):
        data = FO.with_folds(stored(spark, sf), SplitConfig())
        pred, _ = MO.run_models(data, [ModelSpec(name=model_type, model_type=model_type, parameters=parameters)], [X], "Manual")
        return pred.select("fold", "stock_id", "time_id", "pred_vol", "pred_var")

    return build


#: Per fold and training row: standardised feature and centred label.
TRAIN = "WITH " + sql_features() + f""",
fd AS (SELECT time_id, CAST(ntile(5) OVER (ORDER BY time_id) AS INTEGER) AS fold FROM (SELECT DISTINCT time_id FROM feat) d),
rw AS (SELECT stock_id, time_id, fold, {X} AS x, target_vol AS y FROM feat JOIN fd USING (time_id)),
st AS (SELECT f.fold, avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, count(*) AS n, greatest(quantile_cont(y, 0.01), 0.001) AS floor
       FROM (SELECT DISTINCT fold FROM rw) f JOIN rw ON rw.fold <> f.fold GROUP BY f.fold),
tr AS (SELECT st.fold, (x - mx) / sx AS z, y - my AS e, n FROM st JOIN rw ON rw.fold <> st.fold),
co AS (SELECT fold, sum(z * e) / any_value(n) AS c, any_value(n) AS n FROM tr GROUP BY fold)"""
PREDICTED = """
SELECT r.fold, stock_id, time_id, """ + R("greatest(my + w * (x - mx) / sx, floor)", "pred_vol") + ", " + R("power(greatest(my + w * (x - mx) / sx, floor), 2)", "pred_var") + """
FROM rw r JOIN st USING (fold) JOIN wt USING (fold)"""

register("ml_linear_one", TRAIN + ", wt AS (SELECT fold, c AS w FROM co)" + PREDICTED)(_one_feature("Linear Regression"))
register("ml_lasso_one", TRAIN + ", wt AS (SELECT fold, sign(c) * greatest(abs(c) - 0.01, 0) AS w FROM co)" + PREDICTED)(_one_feature("LASSO"))
register(
    "ml_ridge_one",
    TRAIN + """,
al AS (SELECT power(10, -4 + i / 3.0) AS alpha FROM range(25) t(i)),
loo AS (SELECT co.fold, alpha, co.n * c / (co.n + alpha) AS w,
               sum(power((e - z * co.n * c / (co.n + alpha)) / (1 - 1.0 / co.n - z * z / (co.n + alpha)), 2)) AS err
        FROM co JOIN tr USING (fold), al GROUP BY co.fold, alpha, co.n, c),
wt AS (SELECT fold, arg_min(w, err) AS w FROM loo GROUP BY fold)""" + PREDICTED,
)(_one_feature("Ridge Regression"))


@register(
    "ml_stump",
    TRAIN + """,
raw AS (SELECT st.fold, x, y FROM st JOIN rw ON rw.fold <> st.fold),
cut AS (SELECT a.fold, a.x AS cut_at, count(CASE WHEN b.x <= a.x THEN 1 END) AS nl, count(CASE WHEN b.x > a.x THEN 1 END) AS nr,
               avg(CASE WHEN b.x <= a.x THEN b.y END) AS ml, avg(CASE WHEN b.x > a.x THEN b.y END) AS mr
        FROM (SELECT DISTINCT fold, x FROM raw) a JOIN raw b USING (fold) GROUP BY a.fold, a.x),
best AS (SELECT fold, arg_max(struct_pack(cut_at := cut_at, ml := ml, mr := mr), nl * nr * 1.0 / (nl + nr) * power(ml - mr, 2)) AS b FROM cut WHERE nl >= 20 AND nr >= 20 GROUP BY fold)
SELECT fold, stock_id, time_id, """ + R("greatest(CASE WHEN x <= b.cut_at THEN b.ml ELSE b.mr END, 0.001)", "pred_vol") + ", "
    + R("power(greatest(CASE WHEN x <= b.cut_at THEN b.ml ELSE b.mr END, 0.001), 2)", "pred_var") + " FROM rw JOIN best USING (fold)",
)
def q_ml_stump(spark, sf):
    """M9 with one split: the threshold with the largest gain, by trying all."""
    return _one_feature("Decision Tree", max_depth=1, min_samples_leaf=20)(spark, sf)


@register("importance_linear_one", TRAIN + "\nSELECT 'Linear Regression' AS model, fold, '" + X + "' AS feature, " + R("abs(c)", "importance") + " FROM co")
def q_importance_linear_one(spark, sf):
    """The absolute coefficient of the standardised feature, by fold."""
    data = FO.with_folds(stored(spark, sf), SplitConfig())
    return MO.run_models(data, [ModelSpec(name="Linear Regression", model_type="Linear Regression")], [X], "Manual")[1]


# ---------------------------------------------------------------- principal components
PCA_COLUMNS = ["RV_5", "RV_30", "RV_120", "RV_500", "mean_spread_60", "EWMA_094", "ret_autocorr_60"]


def _moments_sql() -> str:
    cols = PCA_COLUMNS
    pairs = " UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, corr({a}, {b}) AS c FROM feat" for i, a in enumerate(cols) for j, b in enumerate(cols))
    d = len(cols)
    return "WITH " + sql_features() + f""", cm AS ({pairs})
SELECT """ + ", ".join([
        R(f"(SELECT sum(c) FROM cm WHERE i = j) / {d}", "share_1"),
        R(f"(SELECT sum(c * c) FROM cm) / {d * d}", "share_2"),
        R(f"(SELECT sum(a.c * b.c * e.c) FROM cm a JOIN cm b ON a.j = b.i JOIN cm e ON b.j = e.i AND e.j = a.i) / {d ** 3}", "share_3"),
        R("1", "cumulative"),
    ])


@register("pca_spectrum", _moments_sql())
def q_pca_spectrum(spark, sf):
    """M3 + W16: the explained shares of all components of a few columns; their
    power sums are the traces of the powers of the correlation matrix."""
    cols = PCA_COLUMNS
    shares = RP.cumulative_share(MO.pca_variance(stored(spark, sf), cols, len(cols)).selectExpr("*", "CAST(substr(component, 3) AS INT) AS k"), "k", "explained_variance_ratio")
    p = lambda k: F.sum(F.pow("explained_variance_ratio", F.lit(float(k)))).alias(f"share_{k}")
    return shares.agg(p(1), p(2), p(3), F.max("cumulative").alias("cumulative"))


def _stock_norm_sql() -> str:
    return "WITH " + sql_features() + """,
lg AS (UNPIVOT (SELECT * EXCLUDE (time_id, target_var, target_vol) FROM feat) ON COLUMNS(* EXCLUDE (stock_id)) INTO NAME feature VALUE v),
us AS (SELECT feature FROM lg GROUP BY feature HAVING count(*) = (SELECT count(*) FROM feat) AND bool_and(isfinite(v)) AND min(v) < max(v)),
mn AS (SELECT stock_id, feature, avg(v) AS m FROM lg JOIN us USING (feature) GROUP BY stock_id, feature),
zs AS (SELECT stock_id, (m - avg(m) OVER (PARTITION BY feature)) / NULLIF(stddev_pop(m) OVER (PARTITION BY feature), 0) AS z FROM mn)"""


@register(
    "stock_pca_norms",
    _stock_norm_sql() + "\nSELECT stock_id, " + R("sum(z * z)", "norm", 4) + " FROM zs GROUP BY stock_id",
)
def q_stock_pca_norms(spark, sf):
    """M4: with as many components as stocks the map keeps every stock's distance
    from the mean of the standardised features."""
    f = stored(spark, sf)
    cols = MO.usable_feature_list(FT.usable_columns(f, CFG))
    m = MO.stock_pca_map(f, cols)
    return m.select("stock_id", F.round(sum(F.pow(F.col(c), F.lit(2.0)) for c in m.columns if c != "stock_id"), 4).alias("norm"))


@register(
    "stock_pca_scatter",
    "WITH " + sql_summary() + "\nSELECT stock_id, best_model, " + R("mean_volatility", "mean_volatility") + ", CAST(n_windows AS BIGINT) AS n_windows, (SELECT count(DISTINCT stock_id) FROM feat) AS n_components FROM summ",
)
def q_stock_pca_scatter(spark, sf):
    """The map joined to the universe summary."""
    f = stored(spark, sf)
    m = MO.stock_pca_map(f, MO.usable_feature_list(FT.usable_columns(f, CFG)))
    n = len(m.columns) - 1
    return UV.pca_scatter(m, UV.universe_summary(f, predictions(spark, sf))).select("stock_id", "best_model", "mean_volatility", F.col("n_windows").cast("bigint").alias("n_windows"), F.lit(n).cast("bigint").alias("n_components"))


# ---------------------------------------------------------------- importance tables
RV_COLUMNS = [f"RV_{w}" for w in CFG.return_windows]


def correlations(spark, sf) -> DataFrame:
    """An importance table: |correlation| of each realised variance with the
    target, the stock as model."""
    data = FO.with_folds(stored(spark, sf), SplitConfig())
    cor = [F.expr(f"abs(covar_pop({c}, target_vol) / nullif(stddev_pop({c}) * stddev_pop(target_vol), 0D)) AS {c}") for c in RV_COLUMNS]
    wide = data.groupBy(F.col("stock_id").alias("model"), "fold").agg(*cor)
    pairs = ", ".join(f"'{c}', {c}" for c in RV_COLUMNS)
    return wide.selectExpr("model", "CAST(fold AS INT) AS fold", f"stack({len(RV_COLUMNS)}, {pairs}) AS (feature, importance)")


CORRELATIONS = "WITH " + sql_features() + """,
fd AS (SELECT time_id, CAST(ntile(5) OVER (ORDER BY time_id) AS INTEGER) AS fold FROM (SELECT DISTINCT time_id FROM feat) d),
imp AS (""" + " UNION ALL ".join(f"SELECT stock_id AS model, fold, '{c}' AS feature, abs(corr({c}, target_vol)) AS importance FROM feat JOIN fd USING (time_id) GROUP BY stock_id, fold" for c in RV_COLUMNS) + ")"


@register("importance_top_correlation", CORRELATIONS + "\nSELECT feature, " + R("avg(importance)", "mean_importance") + " FROM imp GROUP BY feature ORDER BY avg(importance) DESC, feature LIMIT 10")
def q_importance_top_correlation(spark, sf):
    """A31 on a table that SQL can make."""
    return RP.importance_top(correlations(spark, sf), 10)


@register(
    "importance_pivot_correlation",
    CORRELATIONS + """,
bm AS (SELECT model, feature, avg(importance) AS importance FROM imp GROUP BY model, feature),
tp AS (SELECT feature FROM bm GROUP BY feature ORDER BY sum(importance) DESC, feature LIMIT 10)
SELECT model, feature, """ + R("importance", "importance") + " FROM bm WHERE feature IN (SELECT feature FROM tp)",
)
def q_importance_pivot_correlation(spark, sf):
    """A32 on the same table."""
    return RP.importance_pivot(correlations(spark, sf), 10)


# ---------------------------------------------------------------- GARCH from given parameters
PLANTED = "(1 + time_id % 4) * 0.08 AS alpha, (time_id % 3) * 0.35 AS beta, CASE WHEN time_id % 5 = 0 THEN -0.3 ELSE (time_id % 2) * 0.1 END AS gamma"


@register(
    "garch_paths",
    "WITH " + sql_features() + f""",
pl AS (SELECT stock_id, time_id, 0.05 * target_var AS omega, {PLANTED}, target_var AS last_var, sqrt(target_var) * (CASE WHEN time_id % 2 = 0 THEN -1 ELSE 1 END) AS last_ret FROM feat),
ok AS (SELECT *, alpha + beta + gamma / 2 AS p FROM pl),
fp AS (SELECT *, omega + (alpha + CASE WHEN last_ret < 0 THEN gamma ELSE 0 END) * last_ret * last_ret + beta * last_var AS v1,
              p < 0.99 AND alpha + gamma >= 0 AND greatest(alpha, beta, abs(gamma)) < 0.99 AND p >= 0 AND omega >= 0 AS fit FROM ok),
mn AS (SELECT *, omega / (1 - p) + (v1 - omega / (1 - p)) * (1 - power(p, 30)) / (1 - p) / 30 AS pv FROM fp)
SELECT stock_id, time_id, fit, """ + R("CASE WHEN fit THEN pv END", "pred_var") + ", " + R("CASE WHEN fit THEN v1 END", "first") + " FROM mn",
)
def q_garch_paths(spark, sf):
    """Gates and 30-step paths of given parameters, some of them not usable."""
    planted = stored(spark, sf).selectExpr(
        "stock_id", "time_id", "0.05D * target_var AS omega", *[f"CAST({p.split(' AS ')[0]} AS DOUBLE) AS {p.split(' AS ')[1]}" for p in PLANTED.split(", ")],
        "target_var AS last_var", "sqrt(target_var) * (CASE WHEN time_id % 2 = 0 THEN -1 ELSE 1 END) AS last_ret",
    )
    done = GA.forecasts_from_fits(planted, 30)
    return done.select("stock_id", "time_id", F.col("path").isNotNull().alias("fit"), "pred_var", F.get("path", F.lit(0)).alias("first"))


@register(
    "garch_filter_line",
    _har_sql().split(",\nhl AS")[0].replace("WITH ", "WITH RECURSIVE ", 1) + """,
rt AS (SELECT stock_id, time_id, log_rv_second AS y, 100 * (ln(last_wap) - lag(ln(last_wap)) OVER (PARTITION BY stock_id ORDER BY time_id)) AS r FROM hb2),
nr AS (SELECT *, r - avg(r) OVER (PARTITION BY stock_id) AS e, row_number() OVER (PARTITION BY stock_id ORDER BY time_id) AS i, count(*) OVER (PARTITION BY stock_id) AS n FROM rt WHERE r IS NOT NULL),
s0 AS (SELECT stock_id, sum(power(0.94, i - 1) * e * e) / sum(power(0.94, i - 1)) AS s FROM nr WHERE i <= 75 GROUP BY stock_id),
va AS (SELECT nr.stock_id, i, greatest(s, 1e-12) AS sig, e FROM nr JOIN s0 USING (stock_id) WHERE i = 1
       UNION ALL SELECT nr.stock_id, nr.i, 0.02 + 0.15 * va.e * va.e + 0.7 * va.sig, nr.e FROM va JOIN nr ON nr.stock_id = va.stock_id AND nr.i = va.i + 1),
xy AS (SELECT nr.stock_id, time_id, nr.i, n, y, 0.5 * ln(sig) AS x FROM nr JOIN va ON va.stock_id = nr.stock_id AND va.i = nr.i),
ln_ AS (SELECT stock_id, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM xy WHERE i <= floor(0.8 * n) GROUP BY stock_id)
SELECT stock_id, time_id, """ + R("y", "y_true") + ", " + R("a + b * x", "y_pred") + ", CASE WHEN i <= floor(0.8 * n) THEN 'train' ELSE 'test' END AS split FROM xy JOIN ln_ USING (stock_id)",
)
def q_garch_filter_line(spark, sf):
    """M13 with given parameters: variances along each stock's windows and the
    line to log realised volatility."""
    blocks = GA.series_blocks(LG.har_base(book(spark, sf)), 75)
    given = blocks.select("stock_id").distinct().selectExpr("stock_id", "0.02D AS omega", "0.15D AS alpha", "0.7D AS beta")
    return GA.calibrated(GA.filtered(blocks, given))


@register(
    "har_per_stock_fit",
    _har_sql().rsplit("\nSELECT", 1)[0] + """,
ok AS (SELECT *, row_number() OVER (PARTITION BY stock_id ORDER BY time_id) AS i, count(*) OVER (PARTITION BY stock_id) AS n FROM hl WHERE lag_d IS NOT NULL AND lag_w IS NOT NULL AND lag_m IS NOT NULL),
s AS (SELECT stock_id, avg(lag_d) AS md, avg(lag_w) AS mw, avg(lag_m) AS mm, avg(log_rv_second) AS my,
             var_pop(lag_d) AS dd, var_pop(lag_w) AS ww, var_pop(lag_m) AS mmv, covar_pop(lag_d, lag_w) AS dw, covar_pop(lag_d, lag_m) AS dm, covar_pop(lag_w, lag_m) AS wm,
             covar_pop(lag_d, log_rv_second) AS dy, covar_pop(lag_w, log_rv_second) AS wy, covar_pop(lag_m, log_rv_second) AS my_
      FROM ok WHERE i <= floor(0.8 * n) GROUP BY stock_id),
c AS (SELECT *, dd * (ww * mmv - wm * wm) - dw * (dw * mmv - wm * dm) + dm * (dw * wm - ww * dm) AS det FROM s),
b AS (SELECT *, (dy * (ww * mmv - wm * wm) - dw * (wy * mmv - wm * my_) + dm * (wy * wm - ww * my_)) / det AS b_d,
                (dd * (wy * mmv - my_ * wm) - dy * (dw * mmv - wm * dm) + dm * (dw * my_ - wy * dm)) / det AS b_w,
                (dd * (ww * my_ - wy * wm) - dw * (dw * my_ - wy * dm) + dy * (dw * wm - ww * dm)) / det AS b_m FROM c),
f AS (SELECT ok.stock_id, time_id, log_rv_second AS y, my + b_d * (lag_d - md) + b_w * (lag_w - mw) + b_m * (lag_m - mm) AS p, i > floor(0.8 * n) AS test FROM ok JOIN b USING (stock_id))
SELECT stock_id, time_id, CASE WHEN test THEN 'test' ELSE 'train' END AS split, """ + R("y", "y_true") + ", " + R("p", "y_pred", 5) + " FROM f",
)
def q_har_per_stock_fit(spark, sf):
    """Fitted values and forecasts; the oracle solves the normal equations."""
    fitted = LG.har_per_stock(LG.har_lags(LG.har_base(book(spark, sf))))
    return fitted.select("stock_id", "time_id", "split", "y_true", F.round("y_pred", 5).alias("y_pred"))


# ---------------------------------------------------------------- baselines, clusters
@register(
    "rv_baseline_scores",
    "WITH " + sql_features() + """,
bl AS (SELECT CAST(unnest([60, 300, 540, 570]) AS INTEGER) AS lookback),
fc AS (SELECT lookback, stock_id, time_id, avg(CASE WHEN pos > n - 30 THEN r * r END) AS actual_var,
              avg(CASE WHEN pos <= n - 30 AND pos > n - 30 - lookback THEN r * r END) AS pred_var
       FROM pv, bl WHERE n - 30 >= lookback GROUP BY lookback, stock_id, time_id)
SELECT lookback, """ + ", ".join(R(m, m) for m in ("mse", "rmse", "mae", "qlike")) + ", n FROM (SELECT lookback, " + sql_losses() + " FROM fc GROUP BY lookback)",
)
def q_rv_baseline_scores(spark, sf):
    """A20 + A17: the baseline of any lookback, 570 included, and its losses."""
    pos = return_positions(book_runs(book(spark, sf)))
    scored = ME.loss_metrics(ME.rv_baseline(pos, (60, 300, 540, 570)), ["lookback"])
    return scored.select(F.col("lookback").cast("int").alias("lookback"), "mse", "rmse", "mae", "qlike", F.col("n").cast("bigint").alias("n"))


LAB = """,
lab AS (SELECT DISTINCT stock_id, CAST(CAST(regexp_extract(stock_id, '(\\d+)$', 1) AS INTEGER) % 2 + 1 AS INTEGER) AS cluster FROM pred)"""


@register(
    "cluster_rmse",
    "WITH " + sql_pred() + "," + sql_stock_model() + LAB + "\nSELECT cluster, model, " + ", ".join(R(f"{f}(rmse)", f"{f}_rmse") for f in ("avg", "min", "max")) + ", count(*) AS n_stocks FROM sm JOIN lab USING (stock_id) GROUP BY cluster, model",
)
def q_cluster_rmse(spark, sf):
    """RMSE of a cluster's stocks by model."""
    pred = predictions(spark, sf)
    return CL.cluster_rmse(UV.stock_model_metrics(pred), labels(pred))


@register(
    "cluster_win_rate_small",
    "WITH " + sql_pred() + "," + sql_stock_model() + LAB + """,
bench AS (SELECT l.cluster, p.model, sqrt(avg(power(p.pred_var - p.actual_var, 2))) AS bench_rmse
          FROM pred p JOIN lab l USING (stock_id) WHERE p.model <> 'RV baseline 30' GROUP BY l.cluster, p.model),
j AS (SELECT l.cluster, sm.model, sm.rmse < coalesce(b.bench_rmse, CAST('Infinity' AS DOUBLE)) AS beats
      FROM sm JOIN lab l USING (stock_id) LEFT JOIN bench b ON b.cluster = l.cluster AND b.model = sm.model WHERE sm.n >= 20)
SELECT cluster, model, """ + R("avg(CAST(beats AS DOUBLE))", "win_rate") + ", count(*) AS n_stocks FROM j GROUP BY cluster, model",
)
def q_cluster_win_rate_small(spark, sf):
    """J15 + A40 + F11 with stocks of 20 rows or more; a model has no benchmark."""
    pred = predictions(spark, sf)
    lab = labels(pred)
    bench = pred.where("model <> 'RV baseline 30'").join(lab, "stock_id").groupBy("cluster", "model").agg(F.expr("sqrt(avg(power(pred_var - actual_var, 2))) AS bench_rmse"))
    return CL.win_rate(UV.stock_model_metrics(pred), bench, lab, min_rows=20)


# ---------------------------------------------------------------- run store
def _frames(spark, sf, folds: list[int]) -> dict[str, DataFrame]:
    pred = predictions(spark, sf).where(F.col("fold").isin(folds))
    f = stored(spark, sf)
    return {
        "predictions": pred, "metrics": ME.fold_metrics(pred), "feature_importance": correlations(spark, sf).where(F.col("fold").isin(folds)),
        "universe_summary": UV.universe_summary(f, pred), "stock_similarity": UV.stock_similarity(f),
    }


def _run_rows(case: str, run: str, folds: str, absent=()) -> str:
    counts = {
        "predictions": f"(SELECT count(*) FROM pred WHERE fold IN ({folds}))",
        "metrics": f"(SELECT count(DISTINCT (model, fold)) + count(DISTINCT model) FROM pred WHERE fold IN ({folds}))",
        "feature_importance": f"(SELECT {len(RV_COLUMNS)} * count(DISTINCT (stock_id, fold)) FROM pred WHERE fold IN ({folds}))",
        "universe_summary": "(SELECT count(DISTINCT stock_id) FROM feat)",
        "stock_similarity": "(SELECT count(*) FROM (SELECT DISTINCT a.stock_id, b.stock_id AS other FROM feat a JOIN feat b USING (time_id)))",
    }
    return " UNION ALL ".join(f"SELECT '{case}' AS chosen_by, '{run}' AS run_id, '{n}' AS frame, {0 if n in absent else q} AS n_rows" for n, q in counts.items())


OLD, NEWER, BROKEN = "20240101T000000Z_done", "20240102T000000Z_failed", "20240103T000000Z_broken"


@register(
    "run_store",
    "WITH " + sql_pred() + "\n" + " UNION ALL ".join([
        _run_rows("newest completed", OLD, "1, 2, 3, 4, 5"), _run_rows("newest with results", NEWER, "1, 2"),
        _run_rows("requested", BROKEN, "3", ("predictions", "universe_summary", "stock_similarity")),
        "SELECT 'requested, not there', NULL, 'predictions', 0",
    ]),
)
def q_run_store(spark, sf):
    """S12 + S13 + S14: three runs -- a completed one, a newer one that failed
    after its results, the newest broken off while its frames were written --
    and which of them, and which rows, each way of asking gives."""
    store = RunStore(spark, scratch_path(spark, "runs"))
    store.write(NEWER, _frames(spark, sf, [1, 2]), {"features": CFG.__dict__}, {"status": "failed"})
    broken = _frames(spark, sf, [3])
    for name in ("metrics", "feature_importance"):
        broken[name].write.parquet(f"{store.runs_dir}/{BROKEN}/{name}")
    spark.createDataFrame([("{not json",)], "doc string").coalesce(1).write.text(f"{store.runs_dir}/{BROKEN}/status")
    asked = [("newest with results", store.resolve()), ("requested", store.resolve(BROKEN)), ("requested, not there", store.resolve("no such run"))]
    store.write(OLD, _frames(spark, sf, [1, 2, 3, 4, 5]), {"features": CFG.__dict__}, {"status": "Completed"})
    asked.append(("newest completed", store.resolve()))
    out = None
    for case, run in asked:
        for name in RUN_FRAMES if run else ["predictions"]:
            frame = store.frame(name, run) if run else spark.createDataFrame([], RUN_FRAMES[name])
            one = frame.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(case).alias("chosen_by"), F.lit(run).cast("string").alias("run_id"), F.lit(name).alias("frame"), "n_rows")
            out = one if out is None else out.unionByName(one)
    return out
