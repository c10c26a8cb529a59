"""Legacy cluster-path features (S4, P5, P10, P11, F6, F7, A14-A16, W4-W6,
W17, J2, J3, M14).

These work on the raw book rows (no densifying), split at second 300: the
first half gives features, the second half the target.  Both halves come out
of one ``groupBy(stock_id, time_id)`` with conditional aggregates (J2 as one
pass instead of two frames and a merge), all of which are combined map-side.
Within a window rows are ordered by second and then by every book column, so
ties are deterministic.  Differences and lags look a few rows back; a window of
more than ``LARGE`` raw rows is cut into blocks that carry those rows, so no task
holds it whole.

Definitions of mine (the original names them but never computes them):
``realized_quarticity = n/3 * sum(r^4)``, ``abs_return_mean``,
``max_abs_return``, sample autocorrelations ``acf1``/``acf5`` around the
window mean, and partial autocorrelations ``pacf1``/``pacf5`` by the
Durbin-Levinson recursion on the autocorrelations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BOOK_VALUE_COLUMNS
from ..functions.quantiles import in_blocks
from ..session import cut_lineage

ORDER = "seconds_in_bucket, " + ", ".join(BOOK_VALUE_COLUMNS)
WAP1 = "(bid_price1 * ask_size1 + ask_price1 * bid_size1) / nullif(bid_size1 + ask_size1, 0D)"
ACF_LAGS = (1, 2, 3, 4, 5)

# The legacy model's feature list (order as published).
FEATURE_COLS = [
    "rv_first", "std_log_return", "skew_log_return", "kurt_log_return", "max_log_return", "min_log_return",
    "realized_quarticity", "abs_return_mean", "max_abs_return", "wap_range", "wap_std", "n_price_changes",
    "n_rows", "mean_spread", "std_spread", "spread_range", "mean_rel_spread", "std_rel_spread", "mean_depth",
    "std_depth", "mean_imbalance", "std_imbalance", "mean_bid_size1", "mean_ask_size1", "arrival_rate",
    "wap_momentum", "acf1", "acf5", "pacf1", "pacf5", "rv_first_lag1", "rv_first_lag2", "log_rv_lag1",
    "log_rv_lag2", "log_rv_lag3", "log_rv_rolling5", "vol_per_depth", "vol_x_spread", "pressure_x_vol",
]


#: Raw rows of a window that one task sorts; larger windows go in blocks.
LARGE = 65_536


def look_back(rows: DataFrame, keys: list[str], steps, back: int) -> DataFrame:
    """``rows`` with window expressions over each group of ``keys`` in the book's
    order.  ``steps(window, number)`` gives lists of SQL expressions, each list
    over the columns of the one before, which together look at most ``back`` rows
    back; ``window`` is the specification and ``number`` the row's number."""

    def apply(df: DataFrame, window: str, number: str) -> DataFrame:
        for exprs in steps(window, number):
            df = df.selectExpr("*", *exprs)
        return df

    plain = f"PARTITION BY {', '.join(keys)} ORDER BY {ORDER}"
    number = f"row_number() OVER ({plain})"
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > LARGE).select(*keys)
    if large.isEmpty():
        return apply(rows, plain, number)
    large = cut_lineage(large)
    hot = rows.join(large, keys, "left_semi").withColumn("_k", F.struct(*keys)).withColumn("_o", F.struct(*[F.col(c.strip()) for c in ORDER.split(",")]))
    blocks = in_blocks(hot, "_k", "_o", back, rank="_rank")
    done = apply(blocks, "PARTITION BY _k, _block ORDER BY _rank", "_rank").where("_own")
    cold = apply(rows.join(large, keys, "left_anti"), plain, number)
    return cold.unionByName(done.select(*cold.columns))


def half_rows(book: DataFrame) -> DataFrame:
    """P5 + P10 + F7 + W2 + W17 per raw row; returns restart in each half."""
    rows = book.selectExpr(
        "*",
        "CASE WHEN seconds_in_bucket < 300 THEN 1 ELSE 2 END AS half",
        f"{WAP1} AS wap",
    ).selectExpr(
        "*",
        "CASE WHEN wap > 0 THEN ln(wap) END AS lw",
        "ask_price1 - bid_price1 AS spread",
        "(ask_price1 - bid_price1) / nullif((bid_price1 + ask_price1) / 2, 0D) AS rel_spread",
        "bid_size1 + ask_size1 AS depth",
        "(bid_size1 - ask_size1) / nullif(bid_size1 + ask_size1, 0D) AS imbalance",
    )
    steps = lambda w, number: [
        [f"lw - lag(lw) OVER ({w}) AS lr", f"wap - lag(wap) OVER ({w}) AS dwap", f"{number} AS rn"],
        [f"lag(lr, {k}) OVER ({w}) AS lr_lag{k}" for k in ACF_LAGS],
    ]
    return look_back(rows, ["stock_id", "time_id", "half"], steps, max(ACF_LAGS) + 1)


def _skew(n, g1, var):
    return f"CASE WHEN {n} >= 3 THEN CASE WHEN {var} = 0 THEN 0D ELSE {g1} * sqrt({n} * ({n} - 1)) / ({n} - 2) END END"


def _kurt(n, g2, var):
    return (
        f"CASE WHEN {n} >= 4 THEN CASE WHEN {var} = 0 THEN 0D ELSE "
        f"(({n} + 1) * {g2} + 6) * ({n} - 1) / (({n} - 2) * ({n} - 3)) END END"
    )


def window_features(book: DataFrame) -> DataFrame:
    """A14 + A15 + J2: first-half features and second-half target per window
    (windows with rows in both halves)."""
    rows = half_rows(book)
    h1 = lambda e: f"CASE WHEN half = 1 THEN {e} END"
    h2 = lambda e: f"CASE WHEN half = 2 THEN {e} END"
    aggs = [
        f"sqrt(coalesce(sum({h1('lr * lr')}), 0D)) AS rv_first",
        f"stddev_samp({h1('lr')}) AS std_log_return",
        f"count({h1('lr')}) AS _n",
        f"skewness({h1('lr')}) AS _g1",
        f"kurtosis({h1('lr')}) AS _g2",
        f"var_pop({h1('lr')}) AS _v",
        f"max({h1('lr')}) AS max_log_return",
        f"min({h1('lr')}) AS min_log_return",
        f"sum({h1('power(lr, 4)')}) AS _s4",
        f"avg({h1('abs(lr)')}) AS abs_return_mean",
        f"max({h1('abs(lr)')}) AS max_abs_return",
        f"max({h1('wap')}) - min({h1('wap')}) AS wap_range",
        f"stddev_samp({h1('wap')}) AS wap_std",
        f"count_if(half = 1 AND dwap IS NOT NULL AND dwap <> 0) AS n_price_changes",
        f"avg({h1('spread')}) AS mean_spread",
        f"stddev_samp({h1('spread')}) AS std_spread",
        f"max({h1('spread')}) - min({h1('spread')}) AS spread_range",
        f"avg({h1('rel_spread')}) AS mean_rel_spread",
        f"stddev_samp({h1('rel_spread')}) AS std_rel_spread",
        f"avg({h1('depth')}) AS mean_depth",
        f"stddev_samp({h1('depth')}) AS std_depth",
        f"avg({h1('imbalance')}) AS mean_imbalance",
        f"stddev_samp({h1('imbalance')}) AS std_imbalance",
        f"avg({h1('bid_size1')}) AS mean_bid_size1",
        f"avg({h1('ask_size1')}) AS mean_ask_size1",
        f"count({h1('wap')}) AS n_rows",
        f"min_by({h1('wap')}, {h1('CASE WHEN wap IS NOT NULL THEN rn END')}) AS _wap_first",
        f"max_by({h1('wap')}, {h1('CASE WHEN wap IS NOT NULL THEN rn END')}) AS _wap_last",
        f"avg({h1('lr')}) AS _mu",
        # sums over the pairs k rows apart: products, both members, number
        *[f"struct(sum({h1(f'lr * lr_lag{k}')}) AS p, sum({h1(f'lr + lr_lag{k}')}) AS s, count({h1(f'lr + lr_lag{k}')}) AS n) AS _pair{k}" for k in ACF_LAGS],
        "count_if(half = 1) AS _rows1",
        "count_if(half = 2) AS _rows2",
        f"sqrt(coalesce(sum({h2('lr * lr')}), 0D)) AS rv_second",
    ]
    g = rows.groupBy("stock_id", "time_id").agg(*[F.expr(a) for a in aggs]).where("_rows1 > 0 AND _rows2 > 0")
    acf = [f"(_pair{k}.p - _mu * _pair{k}.s + _mu * _mu * _pair{k}.n) / nullif(_v * _n, 0D) AS acf_{k}" for k in ACF_LAGS]
    step = g.selectExpr("*", *acf)
    # Durbin-Levinson: phi_{k,k} from the autocorrelations, one step per lag
    step = step.selectExpr("*", "acf_1 AS p1_1")
    for k in range(2, max(ACF_LAGS) + 1):
        num = f"acf_{k} - (" + " + ".join(f"p{k - 1}_{j} * acf_{k - j}" for j in range(1, k)) + ")"
        den = "1 - (" + " + ".join(f"p{k - 1}_{j} * acf_{j}" for j in range(1, k)) + ")"
        step = step.selectExpr("*", f"({num}) / nullif({den}, 0D) AS p{k}_{k}")
        step = step.selectExpr("*", *[f"p{k - 1}_{j} - p{k}_{k} * p{k - 1}_{k - j} AS p{k}_{j}" for j in range(1, k)])
    return step.selectExpr(
        "stock_id", "time_id",
        "rv_first", "std_log_return",
        f"{_skew('_n', '_g1', '_v')} AS skew_log_return",
        f"{_kurt('_n', '_g2', '_v')} AS kurt_log_return",
        "max_log_return", "min_log_return",
        "_n / 3D * _s4 AS realized_quarticity",
        "abs_return_mean", "max_abs_return", "wap_range", "wap_std",
        "CAST(n_price_changes AS DOUBLE) AS n_price_changes", "CAST(n_rows AS DOUBLE) AS n_rows",
        "mean_spread", "std_spread", "spread_range", "mean_rel_spread", "std_rel_spread",
        "mean_depth", "std_depth", "mean_imbalance", "std_imbalance", "mean_bid_size1", "mean_ask_size1",
        "n_rows / 300D AS arrival_rate",
        "_wap_last - _wap_first AS wap_momentum",
        "acf_1 AS acf1", "acf_5 AS acf5", "p1_1 AS pacf1", "p5_5 AS pacf5",
        "ln(rv_second + 1e-8D) AS log_rv_second",
    )


def with_lags(data: DataFrame) -> DataFrame:
    """W4 + W5 + P11 + F6: lags by stock over ``time_id``, the shifted
    5-window mean (all five required), interactions, then drop rows with any
    missing model input."""
    w = "PARTITION BY stock_id, _block ORDER BY time_id"
    roll = "ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING"
    lagged = in_blocks(data, "stock_id", "time_id", 5).selectExpr(
        "*",
        f"lag(rv_first, 1) OVER ({w}) AS rv_first_lag1",
        f"lag(rv_first, 2) OVER ({w}) AS rv_first_lag2",
        f"lag(log_rv_second, 1) OVER ({w}) AS log_rv_lag1",
        f"lag(log_rv_second, 2) OVER ({w}) AS log_rv_lag2",
        f"lag(log_rv_second, 3) OVER ({w}) AS log_rv_lag3",
        f"CASE WHEN count(log_rv_second) OVER ({w} {roll}) = 5 THEN avg(log_rv_second) OVER ({w} {roll}) END AS log_rv_rolling5",
        "rv_first / (mean_depth + 1e-10D) AS vol_per_depth",
        "rv_first * mean_rel_spread AS vol_x_spread",
        "abs(mean_imbalance) * rv_first AS pressure_x_vol",
    )
    cond = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in FEATURE_COLS + ["log_rv_second"])
    return lagged.where(f"_own AND {cond}").drop("_block", "_own")


def har_base(book: DataFrame) -> DataFrame:
    """Per window, RV of each half (returns over the whole window, so the
    first second-half return spans the split) and the last WAP; windows
    missing any of them are dropped; logs added."""
    steps = lambda w, number: [[f"lw - lag(lw) OVER ({w}) AS lr", f"{number} AS rn"]]
    priced = book.selectExpr("*", f"{WAP1} AS wap").selectExpr("*", "CASE WHEN wap > 0 THEN ln(wap) END AS lw")
    rows = look_back(priced, ["stock_id", "time_id"], steps, 1)
    g = rows.groupBy("stock_id", "time_id").agg(
        F.expr("count_if(seconds_in_bucket < 300) AS _n1"),
        F.expr("count_if(seconds_in_bucket >= 300) AS _n2"),
        F.expr("sqrt(coalesce(sum(CASE WHEN seconds_in_bucket < 300 THEN lr * lr END), 0D)) AS rv_first"),
        F.expr("sqrt(coalesce(sum(CASE WHEN seconds_in_bucket >= 300 THEN lr * lr END), 0D)) AS rv_second"),
        F.expr("max_by(wap, CASE WHEN wap IS NOT NULL THEN rn END) AS last_wap"),
    )
    return g.where("_n1 > 0 AND _n2 > 0 AND last_wap IS NOT NULL").selectExpr(
        "stock_id", "time_id", "rv_first", "rv_second", "last_wap",
        "ln(rv_first + 1e-8D) AS log_rv_first", "ln(rv_second + 1e-8D) AS log_rv_second",
    )


def har_lags(base: DataFrame) -> DataFrame:
    """daily = lag 1, weekly = mean of lags 2-5 (all 4), monthly = mean of
    lags 6-22 (all 17) of ``log_rv_second``, by stock over ``time_id``."""
    w = "PARTITION BY stock_id, _block ORDER BY time_id"
    wk, mo = "ROWS BETWEEN 5 PRECEDING AND 2 PRECEDING", "ROWS BETWEEN 22 PRECEDING AND 6 PRECEDING"
    out = in_blocks(base, "stock_id", "time_id", 22).selectExpr(
        "*",
        f"lag(log_rv_second, 1) OVER ({w}) AS lag_d",
        f"CASE WHEN count(log_rv_second) OVER ({w} {wk}) = 4 THEN avg(log_rv_second) OVER ({w} {wk}) END AS lag_w",
        f"CASE WHEN count(log_rv_second) OVER ({w} {mo}) = 17 THEN avg(log_rv_second) OVER ({w} {mo}) END AS lag_m",
    )
    return out.where("_own AND lag_d IS NOT NULL AND lag_w IS NOT NULL AND lag_m IS NOT NULL").drop("_block", "_own")


def har_per_stock(lags: DataFrame) -> DataFrame:
    """M14 + W13: per stock OLS of ``log_rv_second`` on (1, d, w, m) fitted on
    the first 80 % of rows.  The 4 x 4 normal equations are sums per stock
    (one aggregate), solved per stock on that one summary row; predictions
    for every row follow from the coefficients."""
    from .folds import positional_split

    split = positional_split(lags, ["time_id"])
    xs = ["1D", "lag_d", "lag_w", "lag_m"]
    sums = [F.expr(f"sum(CASE WHEN split = 'train' THEN ({a}) * ({b}) END) AS s{i}{j}")
            for i, a in enumerate(xs) for j, b in enumerate(xs) if j >= i]
    sums += [F.expr(f"sum(CASE WHEN split = 'train' THEN ({a}) * log_rv_second END) AS t{i}") for i, a in enumerate(xs)]
    normal = split.groupBy("stock_id").agg(*sums)

    def solve(pdf):
        import numpy as np
        import pandas as pd

        out = []
        for _, r in pdf.iterrows():
            a = np.zeros((4, 4))
            for i in range(4):
                for j in range(i, 4):
                    a[i, j] = a[j, i] = r[f"s{i}{j}"]
            b = np.array([r[f"t{i}"] for i in range(4)])
            c = np.linalg.lstsq(a, b, rcond=None)[0]
            out.append({"stock_id": r["stock_id"], "b0": c[0], "b_d": c[1], "b_w": c[2], "b_m": c[3]})
        return pd.DataFrame(out, columns=["stock_id", "b0", "b_d", "b_w", "b_m"])

    coef = normal.groupBy("stock_id").applyInPandas(solve, "stock_id string, b0 double, b_d double, b_w double, b_m double")
    return split.join(coef, "stock_id").selectExpr(
        "stock_id", "time_id", "split", "log_rv_second AS y_true",
        "b0 + b_d * lag_d + b_w * lag_w + b_m * lag_m AS y_pred", "b0", "b_d", "b_w", "b_m",
    )


def window_rv(book: DataFrame) -> DataFrame:
    """Per (stock, window) RV over all seconds (one-level WAP)."""
    priced = book.selectExpr("*", f"CASE WHEN {WAP1} > 0 THEN ln({WAP1}) END AS lw")
    rows = look_back(priced, ["stock_id", "time_id"], lambda w, number: [[f"lw - lag(lw) OVER ({w}) AS lr"]], 1)
    return rows.groupBy("stock_id", "time_id").agg(F.expr("sqrt(coalesce(sum(lr * lr), 0D)) AS rv"))
