"""Query registry: every operator family as a Spark plan plus, where the
semantics are SQL-expressible, an independent DuckDB statement over the same
parquet tables (the correctness oracle).

All inputs start from the driver's tables: the order book is the view over
``lineitem`` (see ``volspark.sources.book.derived_book``), everything else is
derived from it by Spark.  Double columns are rounded to ``DIGITS`` decimals on
both sides so that summation order does not change the comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LOSS_METRICS, METRIC_COLUMNS, MODEL_CATALOGUE, FeatureConfig, SplitConfig, feature_columns
from ..functions.columns import round_doubles
from ..operators import curves as CV
from ..operators import features as FT
from ..operators import folds as FO
from ..operators import metrics as ME
from ..operators import report as RP
from ..operators import universe as UV
from ..operators.book import book_runs, regular_grid, return_positions
from ..sources.book import derived_book, first_windows, select_stocks
from ..sources.store import materialized_features
from .sql_book import book_ctes, feature_sql_parts, target_cte

DIGITS = 6
CFG = FeatureConfig()
LOOKBACKS = (30, 120, 300, 500)
#: Latencies given with the baselines: an input of the tables that compare models.
LATENCY_MS = {lb: lb / 1e3 for lb in LOOKBACKS}


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    digits: int = DIGITS


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, digits: int = DIGITS):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, digits)
        return fn

    return deco


def run(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    q = REGISTRY[name]
    return round_doubles(q.build(spark, sf_dir), q.digits)


# ---------------------------------------------------------------- shared inputs
def book(spark, sf):
    return derived_book(spark, sf)


def features(spark, sf):
    return FT.build_features(book(spark, sf), CFG)


def stored(spark, sf):
    """The feature table, built once per source and read back (S8 -> S5)."""
    return materialized_features(spark, sf, lambda: features(spark, sf), CFG)


def fold_tab(df):
    return FO.fold_table(df, SplitConfig())


def predictions(spark, sf):
    f = stored(spark, sf)
    return ME.baseline_predictions(f, fold_tab(f), LOOKBACKS, LATENCY_MS)


def metrics(spark, sf):
    return ME.fold_metrics(predictions(spark, sf))


def summary(spark, sf):
    return UV.universe_summary(stored(spark, sf), predictions(spark, sf))


def comparison(spark, sf):
    p = predictions(spark, sf)
    return UV.model_comparison(p, ME.fold_metrics(p))


# ---------------------------------------------------------------- SQL pieces
def R(expr: str, name: str, digits: int = DIGITS) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) AS {name}"


def sql_features() -> str:
    ctes, exprs = feature_sql_parts(CFG)
    cols = ",\n       ".join(f"{exprs[c]} AS {c}" for c in feature_columns(CFG))
    return (
        book_ctes(CFG.forecast_horizon).lstrip() + "," + target_cte(CFG) + "," + ctes
        + f""",
feat AS (
  SELECT f.stock_id, f.time_id, k.target_var, sqrt(greatest(k.target_var, 0)) AS target_vol,
       {cols}
  FROM f JOIN kept k USING (stock_id, time_id))"""
    )


def sql_pred() -> str:
    parts = []
    for lb in LOOKBACKS:
        parts.append(
            f"""SELECT 'RV baseline {lb}' AS model, 'RV baseline' AS model_type, fo.fold, feat.stock_id, feat.time_id,
       RV_{lb} AS pred_var, sqrt(greatest(RV_{lb}, 0)) AS pred_vol, target_var AS actual_var, target_vol AS actual_vol,
       CAST({LATENCY_MS[lb]} AS DOUBLE) AS inference_ms, 'RV_{lb}' AS feature_cols, 'horizon_line' AS prediction_kind,
       '' AS forecast_seconds, '' AS forecast_vol_path
FROM feat JOIN folds fo USING (time_id) WHERE RV_{lb} IS NOT NULL"""
        )
    union = "\nUNION ALL\n".join(parts)
    return sql_features() + f""",
folds AS (SELECT time_id, CAST(ntile(5) OVER (ORDER BY time_id) AS INTEGER) AS fold FROM (SELECT DISTINCT time_id FROM feat) d),
pred AS ({union})"""


def sql_losses(p="pred_var", a="actual_var") -> str:
    """The losses as DuckDB aggregates with filters, written for themselves."""
    ok = f"FILTER (WHERE isfinite({p}) AND isfinite({a}))"
    low_p, low_a = f"greatest({p}, 1e-9)", f"greatest({a}, 1e-9)"
    return f"""count(*) {ok} AS n,
       avg(({a} - {p}) ^ 2) {ok} AS mse,
       sqrt(avg(({a} - {p}) ^ 2) {ok}) AS rmse,
       avg(abs({a} - {p})) {ok} AS mae,
       100 * avg(abs({low_a} - {low_p}) / {low_a}) {ok} AS mape,
       sqrt(avg((({low_a} - {low_p}) / {low_a}) ^ 2) {ok}) AS rmspe,
       avg({low_a} / {low_p} - 1 - ln({low_a}) + ln({low_p})) {ok} AS qlike,
       CASE WHEN var_pop({p}) {ok} > 0 AND var_pop({a}) {ok} > 0 THEN corr({p}, {a}) {ok} END AS pearson_r"""


def sql_metrics() -> str:
    return sql_pred() + f""",
metrics AS (
  SELECT CAST(CASE WHEN grouping(fold) = 1 THEN 0 ELSE fold END AS INTEGER) AS fold, model,
       {sql_losses()}
  FROM pred GROUP BY GROUPING SETS ((model), (model, fold)))"""


def sql_stock_model() -> str:
    return f"""
sm AS (SELECT stock_id, model, {sql_losses()} FROM pred GROUP BY stock_id, model),
best AS (SELECT stock_id, model AS best_model, {', '.join(LOSS_METRICS)} FROM (
   SELECT *, row_number() OVER (PARTITION BY stock_id ORDER BY rmse ASC NULLS LAST, model) AS r FROM sm) WHERE r = 1)"""


def sql_summary() -> str:
    return sql_pred() + "," + sql_stock_model() + """,
summ AS (
  SELECT s.*, b.best_model, b.mse, b.rmse, b.mae, b.mape, b.rmspe, b.qlike FROM (
    SELECT stock_id, avg(target_vol) AS mean_volatility, avg(target_var) AS mean_variance,
           count(DISTINCT time_id) AS n_windows FROM feat GROUP BY stock_id) s
  LEFT JOIN best b USING (stock_id))"""


def sql_comparison() -> str:
    w = LOSS_METRICS
    ranks = ",\n         ".join(
        f"CASE WHEN {m} IS NOT NULL AND NOT isnan({m}) THEN rank() OVER (PARTITION BY stock_id ORDER BY {m} ASC NULLS LAST) END AS rank_{m}"
        for m in w
    )
    label_first = "min(CASE WHEN feature_cols <> '' THEN feature_cols END)"
    items = f"list_filter(string_split({label_first}, ','), lambda x: x <> '')"
    label = (
        f"CASE WHEN {label_first} IS NULL THEN '' "
        f"WHEN len({items}) > 0 AND len(list_filter({items}, lambda x: NOT starts_with(x, 'PC'))) = 0 THEN concat(len({items}), ' PCs') "
        f"WHEN len({items}) > 0 THEN concat(len({items}), ' features') ELSE '' END"
    )
    return sql_metrics() + "," + sql_stock_model() + f""",
info AS (
  SELECT model, min(model_type) AS model_type, count(pred_var) AS n_predictions, avg(inference_ms) AS mean_inference_ms,
         quantile_cont(inference_ms, 0.5) AS median_inference_ms, quantile_cont(inference_ms, 0.95) AS p95_inference_ms,
         {label} AS feature_set
  FROM pred GROUP BY model),
fstd AS (SELECT model, {', '.join(f'stddev_samp({m}) AS fold_std_{m}' for m in w)} FROM metrics WHERE fold <> 0 GROUP BY model),
ranked AS (SELECT stock_id, model, {ranks} FROM sm),
mwins AS (SELECT model, {', '.join(f'count_if(rank_{m} = 1) AS best_stocks_{m}' for m in w)},
                {', '.join(f'avg(rank_{m}) AS avg_rank_{m}' for m in w)} FROM ranked GROUP BY model),
ns AS (SELECT count(DISTINCT stock_id) AS _ns FROM sm),
comp AS (
  SELECT coalesce(o.model, i.model) AS model, i.model_type, i.feature_set, i.n_predictions,
         i.mean_inference_ms, i.median_inference_ms, i.p95_inference_ms,
         {', '.join('o.' + m for m in METRIC_COLUMNS)},
         {', '.join('fstd.fold_std_' + m for m in w)},
         {', '.join(f'CAST(coalesce(mwins.best_stocks_{m}, 0) AS BIGINT) AS best_stocks_{m}' for m in w)},
         {', '.join(f'coalesce(mwins.best_stocks_{m}, 0) / greatest(ns._ns, 1) AS best_stock_share_{m}' for m in w)},
         {', '.join('mwins.avg_rank_' + m for m in w)}
  FROM (SELECT * FROM metrics WHERE fold = 0) o
  FULL OUTER JOIN info i ON o.model = i.model
  LEFT JOIN fstd ON fstd.model = coalesce(o.model, i.model)
  LEFT JOIN mwins ON mwins.model = coalesce(o.model, i.model)
  CROSS JOIN ns)"""


def _select_rounded(cols: list[tuple[str, str, bool]], src: str) -> str:
    out = [R(e, n) if dbl else f"{e} AS {n}" for n, e, dbl in cols]
    return "SELECT " + ", ".join(out) + f" FROM {src}"


def feature_family_sql(cols: list[str]) -> str:
    sel = ", ".join(R(c, c) for c in cols)
    return "WITH " + sql_features() + f"\nSELECT stock_id, time_id, {sel} FROM feat"


def feature_family(cols: list[str]):
    def build(spark, sf):
        return features(spark, sf).select("stock_id", "time_id", *cols)

    return build


# ---------------------------------------------------------------- book
BOOK_VALS = ["bid_price1", "ask_price1", "bid_price2", "ask_price2", "bid_size1", "ask_size1", "bid_size2", "ask_size2"]


@register(
    "book_scan",
    "WITH " + book_ctes().lstrip().split(",\ndedup")[0]
    + "\nSELECT time_id, seconds_in_bucket, " + ", ".join(R(c, c) for c in BOOK_VALS)
    + ", stock_id FROM book WHERE stock_id IN ('stock_0', 'stock_1', 'stock_2', 'stock_3')",
)
def q_book_scan(spark, sf):
    b = select_stocks(book(spark, sf), stocks=["0", "stock_1", "2", "stock_3"])
    return b.select("time_id", "seconds_in_bucket", *BOOK_VALS, "stock_id")


@register(
    "book_first_windows",
    "WITH " + book_ctes().lstrip().split(",\ndedup")[0]
    + """, firsts AS (SELECT stock_id, time_id FROM (SELECT stock_id, time_id, dense_rank() OVER (PARTITION BY stock_id ORDER BY time_id) AS r
         FROM (SELECT DISTINCT stock_id, time_id FROM book)) WHERE r <= 25)
SELECT stock_id, time_id, count(*) AS n_rows FROM book SEMI JOIN firsts USING (stock_id, time_id) GROUP BY stock_id, time_id""",
)
def q_book_first_windows(spark, sf):
    b = first_windows(book(spark, sf), 25)
    return b.groupBy("stock_id", "time_id").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "book_regular_grid",
    "WITH " + book_ctes().lstrip()
    + "\nSELECT time_id, seconds_in_bucket, " + ", ".join(R(c, c) for c in BOOK_VALS)
    + ", stock_id, " + R("weighted_price", "weighted_price", 9) + ", " + R("mid_price", "mid_price", 9)
    + ", " + R("log_price", "log_price", 9) + ", " + R("log_price_diff", "log_price_diff", 9) + " FROM grid",
    digits=9,
)
def q_book_regular_grid(spark, sf):
    return regular_grid(book_runs(book(spark, sf)))


@register(
    "book_returns",
    "WITH " + book_ctes().lstrip()
    + "\nSELECT stock_id, time_id, seconds_in_bucket, CAST(pos AS BIGINT) AS pos, CAST(n AS BIGINT) AS n_obs, "
    + R("r", "ret_bp") + " FROM pv",
)
def q_book_returns(spark, sf):
    pos = return_positions(book_runs(book(spark, sf)))
    return pos.selectExpr(
        "stock_id", "time_id", "second AS seconds_in_bucket", "CAST(pos AS BIGINT) AS pos",
        "CAST(n_total AS BIGINT) AS n_obs", "ret AS ret_bp",
    )


@register(
    "window_target",
    "WITH " + book_ctes().lstrip() + "," + target_cte(CFG)
    + """
SELECT stock_id, time_id, CAST(n_obs AS INTEGER) AS n_obs, CAST(n_obs - 30 AS INTEGER) AS cutoff,
       CAST(observed_moves AS INTEGER) AS observed_moves, CAST(target_moves AS INTEGER) AS target_moves, """
    + R("coalesce(target_var, 0)", "target_var") + ", " + R("sqrt(greatest(coalesce(target_var, 0), 0))", "target_vol")
    + " FROM kept",
)
def q_window_target(spark, sf):
    return FT.window_targets(book(spark, sf), CFG)


# ---------------------------------------------------------------- feature families
FAMILIES = {
    "feat_position": ["seconds_elapsed", "n_obs", "cutoff", "last_return", "abs_last_return"],
    "feat_return_moments": [
        f"{n}_{w}" for w in CFG.return_windows
        for n in ("RV", "vol", "mean_abs_ret", "mean_ret", "max_abs_ret", "prop_zero_ret", "downside_RV", "upside_RV")
    ],
    "feat_return_jumps": [f"jump_count_{w}" for w in CFG.return_windows],
    "feat_return_quantiles": [f"{n}_{w}" for w in CFG.return_windows for n in ("ret_q10", "ret_q90")],
    "feat_autocorr": [f"{n}_{w}" for w in CFG.acf_windows for n in ("ret_autocorr", "ret_autocorr5")],
    "feat_ewma": ["EWMA_08", "EWMA_09", "EWMA_094", "EWMA_097"],
    "feat_ratios": ["vol_trend", "RV_ratio_5_30", "RV_ratio_10_60", "RV_ratio_30_120", "RV_ratio_30_300",
                    "RV_ratio_60_300", "RV_ratio_120_420", "RV_ratio_300_420"],
    "feat_book_shape": [
        f"{n}_{w}" for w in CFG.book_windows
        for n in ("mean_spread", "std_spread", "mean_imbalance", "std_imbalance", "depth_ratio", "mean_depth",
                  "std_depth", "book_pressure")
    ],
}
for _name, _cols in FAMILIES.items():
    register(_name, feature_family_sql(_cols))(feature_family(_cols))


@register(
    "feature_table",
    "WITH " + sql_features() + "\nSELECT stock_id, time_id, " + R("target_var", "target_var") + ", "
    + R("target_vol", "target_vol") + ", " + ", ".join(R(c, c) for c in feature_columns(CFG)) + " FROM feat",
)
def q_feature_table(spark, sf):
    return features(spark, sf)


def _usable_sql() -> str:
    rows = []
    for i, c in enumerate(feature_columns(CFG)):
        rows.append(
            f"SELECT '{c}' AS \"column\", {i + 1} AS position, coalesce(count_if({c} IS NULL OR isnan({c}) OR isinf({c})) = 0 "
            f"AND min({c}) < max({c}), false) AS usable FROM feat"
        )
    return "WITH " + sql_features() + "\n" + "\nUNION ALL\n".join(rows)


@register("usable_columns", _usable_sql())
def q_usable_columns(spark, sf):
    return FT.usable_columns(features(spark, sf), CFG)


# ---------------------------------------------------------------- folds / splits
@register(
    "folds_ordered",
    "WITH " + sql_features() + """
SELECT time_id, CAST(ntile(5) OVER (ORDER BY time_id) AS INTEGER) AS fold FROM (SELECT DISTINCT time_id FROM feat) d""",
)
def q_folds_ordered(spark, sf):
    return fold_tab(stored(spark, sf))


@register(
    "folds_by_stock",
    "WITH " + sql_features() + """
SELECT stock_id, CAST(ntile(least(5, (SELECT count(DISTINCT stock_id) FROM feat))) OVER (ORDER BY stock_id) AS INTEGER) AS fold
FROM (SELECT DISTINCT stock_id FROM feat) d""",
)
def q_folds_by_stock(spark, sf):
    return FO.fold_table(stored(spark, sf), SplitConfig(by="stock_id"))


@register(
    "split_temporal",
    "WITH " + sql_features() + """,
ids AS (SELECT time_id, row_number() OVER (ORDER BY time_id) - 1 AS idx, count(*) OVER () AS n FROM (SELECT DISTINCT time_id FROM feat) d)
SELECT f.stock_id, f.time_id, CASE WHEN idx <= CAST(floor(n * 0.8) AS BIGINT) - 1 THEN 'train' ELSE 'test' END AS split
FROM feat f JOIN ids USING (time_id)""",
)
def q_split_temporal(spark, sf):
    return FO.temporal_split(stored(spark, sf).select("stock_id", "time_id"), 0.8)


@register(
    "split_positional",
    "WITH " + sql_features() + """
SELECT stock_id, time_id, CASE WHEN row_number() OVER (PARTITION BY stock_id ORDER BY time_id)
   <= CAST(floor(0.8 * count(*) OVER (PARTITION BY stock_id)) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM feat""",
)
def q_split_positional(spark, sf):
    return FO.positional_split(stored(spark, sf).select("stock_id", "time_id"), ["time_id"])


# ---------------------------------------------------------------- forecasts and metrics
PRED_COLS = [
    ("model", "model", False), ("model_type", "model_type", False), ("fold", "fold", False),
    ("stock_id", "stock_id", False), ("time_id", "time_id", False), ("pred_var", "pred_var", True),
    ("pred_vol", "pred_vol", True), ("actual_var", "actual_var", True), ("actual_vol", "actual_vol", True),
    ("inference_ms", "inference_ms", True), ("feature_cols", "feature_cols", False),
    ("prediction_kind", "prediction_kind", False), ("forecast_seconds", "forecast_seconds", False),
    ("forecast_vol_path", "forecast_vol_path", False),
]


@register("baseline_forecasts", "WITH " + sql_pred() + "\n" + _select_rounded(PRED_COLS, "pred"))
def q_baseline_forecasts(spark, sf):
    return predictions(spark, sf)


@register(
    "metrics_by_fold",
    "WITH " + sql_metrics() + "\nSELECT fold, model, n, " + ", ".join(R(m, m) for m in METRIC_COLUMNS) + " FROM metrics",
)
def q_metrics_by_fold(spark, sf):
    return metrics(spark, sf)


@register(
    "metrics_by_stock",
    "WITH " + sql_pred() + "," + sql_stock_model() + "\nSELECT stock_id, model, n, "
    + ", ".join(R(m, m) for m in METRIC_COLUMNS) + " FROM sm",
)
def q_metrics_by_stock(spark, sf):
    return UV.stock_model_metrics(predictions(spark, sf))


def _named_sql() -> str:
    ok = ME.finite_pair()
    p, a = f"CASE WHEN {ok} THEN pred_var END", f"CASE WHEN {ok} THEN actual_var END"
    ratio = f"(greatest({a}, 1e-09) / greatest({p}, 1e-09))"
    return "WITH " + sql_pred() + f"""
SELECT model, {R(f'avg({ratio} - ln({ratio}) - 1)', 'QLIKE')}, {R(f'sqrt(avg(power({a} - {p}, 2)))', 'RMSE')},
       {R(f'avg(abs({a} - {p}))', 'MAE')} FROM pred GROUP BY model"""


@register("named_metrics", _named_sql())
def q_named_metrics(spark, sf):
    return ME.named_metrics(predictions(spark, sf), ["qlike", "Rmse", "MAE"], keys=["model"])


@register(
    "vol_floor_by_fold",
    "WITH " + sql_features() + """,
folds AS (SELECT time_id, CAST(ntile(5) OVER (ORDER BY time_id) AS INTEGER) AS fold FROM (SELECT DISTINCT time_id FROM feat) d),
fl AS (SELECT DISTINCT fold FROM folds),
train AS (SELECT fl.fold, feat.target_vol FROM fl JOIN folds fo ON fo.fold <> fl.fold JOIN feat USING (time_id))
SELECT fold, """ + R("greatest(quantile_cont(target_vol, 0.01), 0.001)", "vol_floor") + " FROM train GROUP BY fold",
)
def q_vol_floor_by_fold(spark, sf):
    f = stored(spark, sf)
    folds = fold_tab(f)
    return ME.vol_floors(f.join(folds, "time_id").select("fold", "target_vol"))


@register(
    "figure_metrics",
    "WITH " + sql_metrics() + "\nSELECT model, " + ", ".join(R(f"avg({m})", m) for m in LOSS_METRICS)
    + " FROM metrics GROUP BY model",
)
def q_figure_metrics(spark, sf):
    return ME.figure_metrics(metrics(spark, sf))


# ---------------------------------------------------------------- universe
SUMMARY_COLS = ["stock_id", "mean_volatility", "mean_variance", "n_windows", "best_model", *LOSS_METRICS]


@register(
    "universe_summary",
    "WITH " + sql_summary() + "\nSELECT stock_id, " + R("mean_volatility", "mean_volatility") + ", "
    + R("mean_variance", "mean_variance") + ", n_windows, best_model, " + ", ".join(R(m, m) for m in LOSS_METRICS)
    + " FROM summ",
)
def q_universe_summary(spark, sf):
    return summary(spark, sf).select(*SUMMARY_COLS)


@register(
    "universe_backfill",
    "WITH " + sql_summary() + "\nSELECT stock_id, best_model, " + ", ".join(R(m, m) for m in LOSS_METRICS) + " FROM summ",
)
def q_universe_backfill(spark, sf):
    s = summary(spark, sf).selectExpr(
        "stock_id", "best_model", "CAST(NULL AS DOUBLE) AS mse", "rmse", "mae",
        "CASE WHEN stock_id = 'stock_1' THEN NULL ELSE mape END AS mape", "rmspe", "CAST(NULL AS DOUBLE) AS qlike",
    )
    return UV.backfill_summary(s, predictions(spark, sf))


SIM_SQL = """,
means AS (SELECT stock_id, time_id, avg(target_var) AS x FROM feat GROUP BY stock_id, time_id),
pairs AS (SELECT a.stock_id AS stock_a, b.stock_id AS stock_b, a.x AS xa, b.x AS xb
          FROM means a JOIN means b ON a.time_id = b.time_id AND a.stock_id < b.stock_id
          WHERE a.x IS NOT NULL AND b.x IS NOT NULL),
st AS (SELECT stock_a, stock_b, coalesce(CASE WHEN count(*) > 1 AND stddev_pop(xa) > 0 AND stddev_pop(xb) > 0
              THEN covar_pop(xa, xb) / (stddev_pop(xa) * stddev_pop(xb)) END, 0) AS corr FROM pairs GROUP BY stock_a, stock_b),
sim AS (SELECT * FROM st UNION ALL SELECT stock_b, stock_a, corr FROM st
        UNION ALL SELECT DISTINCT stock_id, stock_id, 1.0 FROM feat)"""


@register("stock_similarity", "WITH " + sql_features() + SIM_SQL + "\nSELECT stock_a, stock_b, " + R("corr", "corr") + " FROM sim")
def q_stock_similarity(spark, sf):
    return UV.stock_similarity(stored(spark, sf))


@register(
    "similarity_subset",
    "WITH " + sql_summary() + SIM_SQL + """,
top AS (SELECT stock_id FROM summ ORDER BY mean_volatility DESC NULLS LAST, CAST(regexp_extract(stock_id, '(\\d+)$', 1) AS BIGINT), stock_id LIMIT 3)
SELECT stock_a, stock_b, """ + R("corr", "corr") + """ FROM sim
WHERE stock_a IN (SELECT stock_id FROM top) AND stock_b IN (SELECT stock_id FROM top)""",
)
def q_similarity_subset(spark, sf):
    f = stored(spark, sf)
    top = UV.top_stocks(UV.universe_summary(f, None), "mean_volatility", 3)
    return UV.similarity_subset(UV.stock_similarity(f), top)


COMP_COLS = (
    ["model", "model_type", "feature_set", "n_predictions"]
    + ["mean_inference_ms", "median_inference_ms", "p95_inference_ms"]
    + list(METRIC_COLUMNS)
    + [f"fold_std_{m}" for m in LOSS_METRICS]
    + [f"best_stocks_{m}" for m in LOSS_METRICS]
    + [f"best_stock_share_{m}" for m in LOSS_METRICS]
    + [f"avg_rank_{m}" for m in LOSS_METRICS]
)
COMP_DOUBLE = {c for c in COMP_COLS if c not in ("model", "model_type", "feature_set", "n_predictions") and not c.startswith("best_stocks_")}


@register(
    "model_comparison",
    "WITH " + sql_comparison() + "\n" + _select_rounded([(c, c, c in COMP_DOUBLE) for c in COMP_COLS], "comp"),
)
def q_model_comparison(spark, sf):
    return comparison(spark, sf).select(*COMP_COLS)


@register(
    "model_table",
    "WITH " + sql_comparison() + "\nSELECT model, model_type, feature_set, " + R("mean_inference_ms * 1000", "inference_us")
    + ", " + ", ".join(R(m, m) for m in LOSS_METRICS)
    + ", best_stocks_qlike AS wins, " + R("best_stock_share_qlike", "win_share") + ", " + R("avg_rank_qlike", "avg_rank")
    + " FROM comp",
)
def q_model_table(spark, sf):
    return UV.model_table(comparison(spark, sf), "qlike")


@register(
    "universe_kpis",
    "WITH " + sql_summary() + "\nSELECT count(*) AS n_stocks, " + R("avg(mean_volatility)", "mean_volatility")
    + ", arg_max(stock_id, mean_volatility) AS most_volatile_stock, arg_max(stock_id, rmse) AS highest_rmse_stock FROM summ",
)
def q_universe_kpis(spark, sf):
    return UV.universe_kpis(summary(spark, sf))


@register(
    "universe_ranking",
    "WITH " + sql_summary() + """,
top AS (SELECT stock_id, 'top' AS source FROM summ ORDER BY mean_volatility DESC NULLS LAST,
        CAST(regexp_extract(stock_id, '(\\d+)$', 1) AS BIGINT) LIMIT 2),
manual AS (SELECT unnest(['stock_1', 'stock_3', 'stock_99']) AS stock_id),
extra AS (SELECT stock_id, 'manual' AS source FROM manual WHERE stock_id IN (SELECT stock_id FROM summ)
          AND stock_id NOT IN (SELECT stock_id FROM top)),
chosen AS (SELECT * FROM top UNION ALL SELECT * FROM extra)
SELECT c.stock_id, c.source, concat('Stock ', regexp_extract(c.stock_id, '^stock_(\\d+)$', 1)) AS label,
       CAST(regexp_extract(c.stock_id, '^stock_(\\d+)$', 1) AS BIGINT) AS stock_number, """
    + R("s.mean_volatility", "mean_volatility") + " FROM chosen c JOIN summ s USING (stock_id)",
)
def q_universe_ranking(spark, sf):
    out, _missing = UV.select_display_stocks(summary(spark, sf), "mean_volatility", False, 2, "1, stock_3 99 stock_3")
    return out


@register(
    "stock_model_metrics",
    "WITH " + sql_pred() + "," + sql_stock_model() + """,
lat AS (SELECT stock_id, model, avg(CASE WHEN NOT isnan(inference_ms) THEN inference_ms END) * 1000 AS inference_us FROM pred GROUP BY stock_id, model),
every AS (SELECT stock_id, model FROM sm UNION
          SELECT stock_id, unnest([""" + ", ".join(f"'{m}'" for m in MODEL_CATALOGUE) + """]) AS model FROM (SELECT DISTINCT stock_id FROM sm))
SELECT stock_id, model, """ + R("inference_us", "inference_us") + ", " + ", ".join(R(m, m) for m in LOSS_METRICS)
    + ", CAST(coalesce(nullif(list_position([" + ", ".join(f"'{m}'" for m in MODEL_CATALOGUE) + f"], model), 0) - 1, {len(MODEL_CATALOGUE)}) AS INTEGER) AS display_order"
    + " FROM every LEFT JOIN sm USING (stock_id, model) LEFT JOIN lat USING (stock_id, model)",
)
def q_stock_model_metrics(spark, sf):
    return UV.individual_model_metrics(predictions(spark, sf))


# ---------------------------------------------------------------- report data
def _model_points_sql() -> str:
    return sql_comparison() + """,
pts AS (SELECT model, mean_inference_ms * 1000 AS mean_inference_us, qlike, rmse FROM comp
        WHERE model IS NOT NULL AND mean_inference_ms IS NOT NULL AND qlike IS NOT NULL AND mean_inference_ms > 0)"""


def model_points(spark, sf):
    return RP.plottable(comparison(spark, sf).selectExpr("model", "mean_inference_ms * 1000 AS mean_inference_us", "qlike", "rmse"))


@register(
    "pareto_frontier",
    "WITH " + _model_points_sql() + """
SELECT model, """ + R("mean_inference_us", "mean_inference_us") + ", " + R("qlike", "qlike") + ", " + R("rmse", "rmse") + """ FROM pts a
WHERE NOT EXISTS (SELECT 1 FROM pts b WHERE b.mean_inference_us <= a.mean_inference_us AND b.qlike <= a.qlike
                  AND (b.mean_inference_us < a.mean_inference_us OR b.qlike < a.qlike))""",
)
def q_pareto_frontier(spark, sf):
    return RP.pareto_frontier(model_points(spark, sf), "mean_inference_us", "qlike")


@register(
    "pareto_best_balance",
    "WITH " + _model_points_sql() + """,
fr AS (SELECT * FROM pts a WHERE NOT EXISTS (SELECT 1 FROM pts b WHERE b.mean_inference_us <= a.mean_inference_us AND b.rmse <= a.rmse
                  AND (b.mean_inference_us < a.mean_inference_us OR b.rmse < a.rmse))),
lg AS (SELECT *, log10(greatest(mean_inference_us, 1e-12)) AS ll FROM fr),
sc AS (SELECT *, sqrt(power((ll - min(ll) OVER ()) / greatest(max(ll) OVER () - min(ll) OVER (), 1e-12), 2)
                    + power((rmse - min(rmse) OVER ()) / greatest(max(rmse) OVER () - min(rmse) OVER (), 1e-12), 2)) AS bs FROM lg)
SELECT (SELECT arg_min(model, (mean_inference_us, model)) FROM pts) AS fastest_model,
       (SELECT arg_min(model, (rmse, model)) FROM pts) AS best_metric_model,
       (SELECT count(*) FROM pts) AS n_models,
       (SELECT count(*) FROM fr) AS n_pareto,
       (SELECT model FROM sc ORDER BY bs, rmse, mean_inference_us, model LIMIT 1) AS best_balance_model""",
)
def q_pareto_best_balance(spark, sf):
    return RP.pareto_summary(model_points(spark, sf), "rmse").select(
        "fastest_model", "best_metric_model", "n_models", "n_pareto", "best_balance_model"
    )


@register(
    "best_model_counts",
    "WITH " + sql_summary() + """
SELECT trim(best_model) AS best_model, count(*) AS n_stocks FROM summ
WHERE best_model IS NOT NULL AND trim(best_model) <> '' GROUP BY trim(best_model)""",
)
def q_best_model_counts(spark, sf):
    return RP.best_model_counts(summary(spark, sf))


SQL_ROW_QLIKE = "greatest(actual_var, 1e-9) / greatest(pred_var, 1e-9) - 1 - ln(greatest(actual_var, 1e-9)) + ln(greatest(pred_var, 1e-9))"
ROW_QLIKE = "(greatest(actual_var, 1e-09) / greatest(pred_var, 1e-09)) - ln(greatest(actual_var, 1e-09) / greatest(pred_var, 1e-09)) - 1"


@register(
    "outlier_cap",
    "WITH " + sql_pred() + f""",
rows_ AS (SELECT model, stock_id, time_id, {SQL_ROW_QLIKE} AS qlike_row FROM pred),
caps AS (SELECT model, least(greatest(quantile_cont(qlike_row, 0.75) + 1.5 * (quantile_cont(qlike_row, 0.75) - quantile_cont(qlike_row, 0.25)),
                quantile_cont(qlike_row, 0.5)), max(qlike_row)) AS cap FROM rows_ GROUP BY model)
SELECT model, stock_id, time_id, {R('qlike_row', 'qlike_row')}, {R('cap', 'cap')}, {R('least(qlike_row, cap)', 'qlike_row_capped')}
FROM rows_ JOIN caps USING (model)""",
)
def q_outlier_cap(spark, sf):
    p = predictions(spark, sf).selectExpr("model", "stock_id", "time_id", f"{ROW_QLIKE} AS qlike_row")
    return RP.outlier_cap(p, ("model",), "qlike_row")


@register(
    "scatter_cap",
    "WITH " + sql_pred() + """,
b AS (SELECT stock_id, model, time_id, TRY_CAST(pred_vol AS DOUBLE) AS p, TRY_CAST(actual_vol AS DOUBLE) AS a FROM pred),
b2 AS (SELECT * FROM b WHERE p IS NOT NULL AND a IS NOT NULL AND NOT isnan(p) AND NOT isnan(a) AND NOT isinf(p)),
st AS (SELECT stock_id, greatest(least(quantile_cont(p, 0.995), quantile_cont(p, 0.5) + 50 * greatest(quantile_cont(p, 0.75) - quantile_cont(p, 0.25),
        0.01 * abs(quantile_cont(p, 0.5)), 0.001)), max(a)) AS cap FROM b2 GROUP BY stock_id),
fl AS (SELECT b2.*, st.cap, p <= st.cap AS shown FROM b2 JOIN st USING (stock_id))
SELECT stock_id, model, time_id, """ + R("p", "p") + ", " + R("a", "a") + ", " + R("cap", "cap")
    + """, shown OR max(CAST(shown AS INTEGER)) OVER (PARTITION BY stock_id) = 0 AS display FROM fl""",
)
def q_scatter_cap(spark, sf):
    return RP.scatter_cap(predictions(spark, sf), ("stock_id",))


@register(
    "representative_stock",
    "WITH " + sql_pred() + """
SELECT stock_id, count(DISTINCT time_id) AS n_times, count(DISTINCT model) AS n_models, count(*) AS n_rows FROM pred
GROUP BY stock_id ORDER BY n_times DESC, n_models DESC, n_rows DESC, stock_id LIMIT 1""",
)
def q_representative_stock(spark, sf):
    return RP.representative_stock(predictions(spark, sf))


@register(
    "series_models",
    "WITH " + sql_pred() + """,
pt AS (SELECT stock_id, model, time_id, avg(pred_vol) AS pv, avg(actual_vol) AS av FROM pred GROUP BY stock_id, model, time_id),
rm AS (SELECT stock_id, model, sqrt(avg(power(pv - av, 2))) AS rmse FROM pt GROUP BY stock_id, model)
SELECT stock_id, model, """ + R("rmse", "rmse") + """, CAST(row_number() OVER (PARTITION BY stock_id ORDER BY rmse ASC NULLS LAST, model) AS INTEGER) AS rank_pos FROM rm""",
)
def q_series_models(spark, sf):
    pred = predictions(spark, sf)
    return RP.series_models(pred).join(RP.single_stock_vol_rmse(pred), ["stock_id", "model"]).selectExpr("stock_id", "model", "rmse", "CAST(rank_pos AS INT) AS rank_pos")


@register(
    "series_models_capped",
    "WITH " + sql_pred() + """,
rm AS (SELECT stock_id, model, sqrt(avg((pv - av) ^ 2)) AS rmse
       FROM (SELECT stock_id, model, time_id, avg(pred_vol) AS pv, avg(actual_vol) AS av FROM pred GROUP BY ALL) GROUP BY stock_id, model),
best AS (SELECT *, row_number() OVER (PARTITION BY stock_id ORDER BY rmse, model) AS k FROM rm),
ms AS (SELECT model, avg(inference_ms) AS ms FROM pred GROUP BY model),
slow AS (SELECT stock_id, model, row_number() OVER (PARTITION BY stock_id ORDER BY ms, model) AS f FROM best JOIN ms USING (model) WHERE k > 2)
SELECT stock_id, model, CAST(k AS INTEGER) AS rank_pos FROM best WHERE k <= 2
UNION ALL SELECT stock_id, model, 3 FROM slow WHERE f = 1""",
)
def q_series_models_capped(spark, sf):
    """O4 + J12 with more models than places: the best two and the fastest other."""
    picked = RP.series_models(predictions(spark, sf), places=3)
    return picked.selectExpr("stock_id", "model", "CAST(rank_pos AS INT) AS rank_pos")


# ---------------------------------------------------------------- curves
def _series_sql(with_final: bool = True) -> str:
    body = book_ctes().lstrip() + """,
rs AS (
  SELECT stock_id, time_id, seconds_in_bucket, pos, n,
         avg(r * r) OVER w AS ms, count(r) OVER w AS cnt,
         min(CASE WHEN pos = n - 30 + 1 THEN seconds_in_bucket END) OVER (PARTITION BY stock_id, time_id) AS split_second
  FROM pv WINDOW w AS (PARTITION BY stock_id, time_id ORDER BY pos ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
series AS (
  SELECT stock_id, time_id, seconds_in_bucket, sqrt(ms) AS realized_vol,
         CASE WHEN pos <= n - 30 THEN 'observed' ELSE 'heldout_actual' END AS segment, split_second, 30 AS forecast_horizon
  FROM rs WHERE n > 30 AND cnt >= 5)"""
    return body


@register(
    "realised_series",
    "WITH " + _series_sql() + "\nSELECT stock_id, time_id, seconds_in_bucket, " + R("realized_vol", "realized_vol")
    + """, segment, false AS bridge, split_second, forecast_horizon FROM series
UNION ALL
SELECT stock_id, time_id, seconds_in_bucket, """ + R("realized_vol", "realized_vol") + """, 'heldout_actual', true, split_second, forecast_horizon
FROM series s WHERE segment = 'observed'
  AND seconds_in_bucket = (SELECT max(o.seconds_in_bucket) FROM series o WHERE o.stock_id = s.stock_id AND o.time_id = s.time_id AND o.segment = 'observed')
  AND EXISTS (SELECT 1 FROM series h WHERE h.stock_id = s.stock_id AND h.time_id = s.time_id AND h.segment = 'heldout_actual')""",
)
def q_realised_series(spark, sf):
    return CV.with_bridge(CV.realised_series(book(spark, sf), 30))


def _curves_ctes() -> str:
    # the feature CTEs already define book .. pv; the series sits on top of them
    return sql_pred() + """,
rs AS (
  SELECT stock_id, time_id, seconds_in_bucket, pos, n,
         avg(r * r) OVER w AS ms, count(r) OVER w AS cnt,
         min(CASE WHEN pos = n - 30 + 1 THEN seconds_in_bucket END) OVER (PARTITION BY stock_id, time_id) AS split_second
  FROM pv WINDOW w AS (PARTITION BY stock_id, time_id ORDER BY pos ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
series AS (
  SELECT stock_id, time_id, seconds_in_bucket, sqrt(ms) AS realized_vol,
         CASE WHEN pos <= n - 30 THEN 'observed' ELSE 'heldout_actual' END AS segment, split_second, 30 AS forecast_horizon
  FROM rs WHERE n > 30 AND cnt >= 5),
curves AS (
  SELECT p.stock_id, p.time_id, p.model, p.model_type, s.seconds_in_bucket, p.pred_vol, 'horizon_line' AS prediction_kind
  FROM pred p JOIN series s ON s.stock_id = p.stock_id AND s.time_id = p.time_id AND s.segment = 'heldout_actual'
  WHERE p.pred_vol IS NOT NULL AND NOT isnan(p.pred_vol))"""


def curves_df(spark, sf):
    return CV.prediction_curves(CV.realised_series(book(spark, sf), 30), predictions(spark, sf))


@register(
    "prediction_curves",
    "WITH " + _curves_ctes() + "\nSELECT stock_id, time_id, model, model_type, seconds_in_bucket, " + R("pred_vol", "pred_vol")
    + ", prediction_kind FROM curves",
)
def q_prediction_curves(spark, sf):
    return curves_df(spark, sf)


@register(
    "window_payload",
    "WITH " + _curves_ctes() + """,
allpts AS (SELECT stock_id, time_id, segment AS curve, seconds_in_bucket, realized_vol AS value FROM series
           UNION ALL SELECT stock_id, time_id, model, seconds_in_bucket, pred_vol FROM curves)
SELECT stock_id, time_id, curve,
       CAST(to_json(list(seconds_in_bucket ORDER BY seconds_in_bucket)) AS VARCHAR) AS seconds_json,
       count(*) AS n_points, """ + R("sum(round(value, 6))", "values_sum") + """
FROM allpts GROUP BY stock_id, time_id, curve""",
)
def q_window_payload(spark, sf):
    s = CV.realised_series(book(spark, sf), 30)
    c = CV.prediction_curves(s, predictions(spark, sf))
    return CV.window_payload(s, c).selectExpr(
        "stock_id", "time_id", "curve", "seconds_json", "CAST(n_points AS BIGINT) AS n_points",
        "aggregate(from_json(values_json, 'array<double>'), 0D, (a, v) -> a + v) AS values_sum",
    )


@register(
    "series_smoothed",
    "WITH " + _series_sql() + """,
ix AS (SELECT *, row_number() OVER (PARTITION BY stock_id, time_id ORDER BY seconds_in_bucket) - 1 AS i,
              count(*) OVER (PARTITION BY stock_id, time_id) AS nn FROM series),
wd AS (SELECT *, greatest(3, least(25, nn // 75)) AS width FROM ix),
sm AS (SELECT a.stock_id, a.time_id, a.seconds_in_bucket, a.realized_vol, a.i, a.nn, avg(b.realized_vol) AS vs
       FROM wd a JOIN wd b ON a.stock_id = b.stock_id AND a.time_id = b.time_id AND abs(a.i - b.i) <= (a.width + 1 - a.width % 2 - 1) / 2
       GROUP BY ALL)
SELECT stock_id, time_id, seconds_in_bucket, """ + R("realized_vol", "realized_vol") + ", " + R("vs", "realized_vol_smooth") + """
FROM sm WHERE nn <= 100 OR list_contains(list_transform(range(0, 100), lambda k: CAST(floor(k * (nn - 1) / 99.0) AS BIGINT)), i)""",
)
def q_series_smoothed(spark, sf):
    s = CV.realised_series(book(spark, sf), 30)
    sm = RP.smooth_centred(s, ["stock_id", "time_id"], "seconds_in_bucket", "realized_vol")
    return RP.downsample_even(sm, ["stock_id", "time_id"], "seconds_in_bucket", 100).select(
        "stock_id", "time_id", "seconds_in_bucket", "realized_vol", "realized_vol_smooth"
    )
