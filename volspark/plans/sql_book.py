"""Reference SQL (DuckDB dialect) for the book and feature operators.

These strings are the brute-force definitions used by the correctness check:
they build the full 600-second grid per window, forward fill with
``last_value(... IGNORE NULLS)``, number the usable returns and evaluate
every feature straight from its definition.  The Spark plans in
``volspark.operators`` compute the same values a different way (runs and
positions, no grid join), so agreement is a real cross-check.
"""

from __future__ import annotations

from ..config import (
    BOOK_VALUE_COLUMNS,
    EPS,
    RATIO_PAIRS,
    FeatureConfig,
    ewma_name,
    feature_columns,
)
from ..sources.book import derived_book_sql

P = "PARTITION BY stock_id, time_id"
VALS = ", ".join(BOOK_VALUE_COLUMNS)


def book_ctes(horizon: int = 30) -> str:
    """CTEs: book, dedup, grid (D2 with returns), pv (usable returns)."""
    fills = ",\n       ".join(
        f"last_value({c} IGNORE NULLS) OVER wf AS {c}" for c in BOOK_VALUE_COLUMNS
    )
    wap = (
        "(bid_price1 * ask_size1 + ask_price1 * bid_size1 + bid_price2 * ask_size2 + ask_price2 * bid_size2)"
        " / NULLIF(bid_size1 + ask_size1 + bid_size2 + ask_size2, 0)"
    )
    return f"""
book AS ({derived_book_sql('varchar')}),
dedup AS (
  SELECT stock_id, time_id, seconds_in_bucket, {VALS} FROM (
    SELECT *, row_number() OVER (PARTITION BY stock_id, time_id, seconds_in_bucket ORDER BY {VALS}) AS rn
    FROM book WHERE seconds_in_bucket BETWEEN 0 AND 599 AND time_id IS NOT NULL) WHERE rn = 1),
wins AS (SELECT DISTINCT stock_id, time_id FROM dedup),
sec AS (SELECT stock_id, time_id, CAST(unnest(range(0, 600)) AS INTEGER) AS seconds_in_bucket FROM wins),
joined AS (SELECT s.stock_id, s.time_id, s.seconds_in_bucket, {', '.join('d.' + c for c in BOOK_VALUE_COLUMNS)}
           FROM sec s LEFT JOIN dedup d USING (stock_id, time_id, seconds_in_bucket)),
filled AS (
  SELECT stock_id, time_id, seconds_in_bucket,
       {fills}
  FROM joined
  WINDOW wf AS ({P} ORDER BY seconds_in_bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
priced AS (SELECT *, {wap} AS weighted_price, (bid_price1 + ask_price1) / 2 AS mid_price FROM filled),
logged AS (SELECT *, CASE WHEN weighted_price > 0 THEN ln(weighted_price) END AS log_price FROM priced),
grid AS (SELECT *, log_price - lag(log_price) OVER ({P} ORDER BY seconds_in_bucket) AS log_price_diff FROM logged),
valid AS (
  SELECT *, log_price_diff * 10000 AS r,
         row_number() OVER ({P} ORDER BY seconds_in_bucket) AS pos,
         count(*) OVER ({P}) AS n
  FROM grid WHERE log_price_diff IS NOT NULL AND isfinite(log_price_diff)),
pv AS (SELECT *, n - {horizon} AS cutoff, (n - {horizon}) - pos + 1 AS rev FROM valid)"""


def target_cte(cfg: FeatureConfig = FeatureConfig()) -> str:
    h = cfg.forecast_horizon
    return f"""
tgt AS (
  SELECT stock_id, time_id, max(n) AS n_obs,
         sum(CASE WHEN rev < 1 THEN r * r END) / {float(h)} AS target_var,
         sum(CASE WHEN rev < 1 AND r <> 0 THEN 1 ELSE 0 END) AS target_moves,
         sum(CASE WHEN rev >= 1 AND r <> 0 THEN 1 ELSE 0 END) AS observed_moves
  FROM pv GROUP BY stock_id, time_id),
kept AS (
  SELECT * FROM tgt
  WHERE n_obs >= {cfg.min_observations} AND observed_moves >= 20 AND target_moves >= 5)"""


def _w(col: str, w: int, extra: str = "") -> str:
    return f"CASE WHEN rev BETWEEN 1 AND {w}{extra} THEN {col} END"


def feature_sql_parts(cfg: FeatureConfig = FeatureConfig()) -> tuple[str, dict[str, str]]:
    """(extra CTEs, feature name -> SQL expression over ``f``)."""
    h = cfg.forecast_horizon
    rw = sorted(set(cfg.return_windows))
    sig = ",\n         ".join(f"stddev_pop({_w('r', w)}) AS sig_{w}" for w in rw)
    lead = ",\n         ".join(f"lead(r, {k}) OVER ({P} ORDER BY pos) AS r_lead{k}" for k in (1, 5))
    agg = [
        "max(n) AS n_obs",
        "max(CASE WHEN rev = 1 THEN r END) AS last_return",
    ]
    for w in rw:
        cond = f"rev BETWEEN 1 AND {w}"
        agg += [
            f"avg(CASE WHEN {cond} THEN r * r END) AS RV_{w}",
            f"avg(CASE WHEN {cond} THEN abs(r) END) AS mean_abs_ret_{w}",
            f"avg(CASE WHEN {cond} THEN r END) AS mean_ret_{w}",
            f"max(CASE WHEN {cond} THEN abs(r) END) AS max_abs_ret_{w}",
            f"avg(CASE WHEN {cond} THEN CASE WHEN r = 0 THEN 1.0 ELSE 0.0 END END) AS prop_zero_ret_{w}",
            f"coalesce(avg(CASE WHEN {cond} AND r < 0 THEN r * r END), 0.0) AS downside_RV_{w}",
            f"coalesce(avg(CASE WHEN {cond} AND r > 0 THEN r * r END), 0.0) AS upside_RV_{w}",
            f"sum(CASE WHEN {cond} AND abs(r) > 3 * sig_{w} + {EPS} THEN 1 ELSE 0 END) AS jump_count_{w}",
            f"quantile_cont(CASE WHEN {cond} THEN r END, 0.1) AS ret_q10_{w}",
            f"quantile_cont(CASE WHEN {cond} THEN r END, 0.9) AS ret_q90_{w}",
        ]
    for w in sorted(set(cfg.acf_windows)):
        for k, name in ((1, "ret_autocorr"), (5, "ret_autocorr5")):
            a = f"CASE WHEN rev BETWEEN {k + 1} AND {w} THEN r END"
            b = f"CASE WHEN rev BETWEEN {k + 1} AND {w} THEN r_lead{k} END"
            agg += [
                f"covar_pop({a}, {b}) AS cov_{name}_{w}",
                f"stddev_pop({a}) AS sa_{name}_{w}",
                f"stddev_pop({b}) AS sb_{name}_{w}",
            ]
    for lam in cfg.ewma_lambdas:
        weight = f"CASE WHEN rev = cutoff THEN pow({lam}, cutoff - 1) ELSE {1.0 - lam} * pow({lam}, rev - 1) END"
        agg.append(f"coalesce(sum(CASE WHEN rev >= 1 THEN r * r * {weight} END), 0.0) AS {ewma_name(lam)}")
    spread = "(ask_price1 - bid_price1) / NULLIF((bid_price1 + ask_price1) / 2, 0)"
    l2 = "NULLIF(bid_size2 + ask_size2, 0)"
    depth = f"(bid_size1 + ask_size1 + {l2})"
    imb = "(bid_size1 - ask_size1) / NULLIF(bid_size1 + ask_size1, 0)"
    press = f"(bid_size1 + bid_size2 - ask_size1 - ask_size2) / NULLIF({depth}, 0)"
    ratio = f"(bid_size1 + ask_size1) / {l2}"
    for w in sorted(set(cfg.book_windows)):
        agg += [
            f"avg({_w(spread, w)}) AS mean_spread_{w}",
            f"stddev_samp({_w(spread, w)}) AS std_spread_{w}",
            f"avg({_w(imb, w)}) AS mean_imbalance_{w}",
            f"stddev_samp({_w(imb, w)}) AS std_imbalance_{w}",
            f"avg({_w(ratio, w)}) AS depth_ratio_{w}",
            f"avg({_w(depth, w)}) AS mean_depth_{w}",
            f"stddev_samp({_w(depth, w)}) AS std_depth_{w}",
            f"avg({_w(press, w)}) AS book_pressure_{w}",
        ]
    aggs = ",\n         ".join(agg)
    ctes = f"""
pvx AS (
  SELECT pv.*,
         {lead},
         {sig}
  FROM pv SEMI JOIN kept USING (stock_id, time_id)
  WINDOW wsig AS ({P})),
f AS (
  SELECT stock_id, time_id,
         {aggs}
  FROM pvx GROUP BY stock_id, time_id)"""
    # stddev_pop as a window aggregate
    ctes = ctes.replace(
        ",\n         ".join(f"stddev_pop({_w('r', w)}) AS sig_{w}" for w in rw),
        ",\n         ".join(f"stddev_pop({_w('r', w)}) OVER wsig AS sig_{w}" for w in rw),
    )
    cutoff = f"(f.n_obs - {h})"
    exprs: dict[str, str] = {
        "seconds_elapsed": f"CAST({cutoff} AS DOUBLE) / greatest(f.n_obs, 1)",
        "n_obs": "CAST(f.n_obs AS DOUBLE)",
        "cutoff": f"CAST({cutoff} AS DOUBLE)",
        "last_return": "f.last_return",
        "abs_last_return": "abs(f.last_return)",
    }
    for w in cfg.return_windows:
        ok = f"{cutoff} >= {w}"
        for name in ("RV", "mean_abs_ret", "mean_ret", "max_abs_ret", "prop_zero_ret", "downside_RV", "upside_RV", "jump_count", "ret_q10", "ret_q90"):
            exprs[f"{name}_{w}"] = f"CASE WHEN {ok} THEN CAST(f.{name}_{w} AS DOUBLE) END"
        exprs[f"vol_{w}"] = f"CASE WHEN {ok} THEN sqrt(f.RV_{w}) END"
    for w in cfg.acf_windows:
        for name in ("ret_autocorr", "ret_autocorr5"):
            den = f"(f.sa_{name}_{w} * f.sb_{name}_{w})"
            exprs[f"{name}_{w}"] = (
                f"CASE WHEN {cutoff} >= {w} THEN CASE WHEN {den} > 0 THEN f.cov_{name}_{w} / {den} ELSE 0.0 END END"
            )
    for lam in cfg.ewma_lambdas:
        exprs[ewma_name(lam)] = f"f.{ewma_name(lam)}"

    def rv(w):
        return exprs.get(f"RV_{w}", "CAST(NULL AS DOUBLE)")

    exprs["vol_trend"] = f"({rv(30)}) / (({rv(300)}) + {EPS})"
    for s, l in RATIO_PAIRS:
        exprs[f"RV_ratio_{s}_{l}"] = f"({rv(s)}) / (({rv(l)}) + {EPS})"
    for w in cfg.book_windows:
        for name in ("mean_spread", "std_spread", "mean_imbalance", "std_imbalance", "depth_ratio", "mean_depth", "std_depth", "book_pressure"):
            exprs[f"{name}_{w}"] = f"CASE WHEN {cutoff} >= {w} THEN f.{name}_{w} END"
    assert set(exprs) == set(feature_columns(cfg))
    return ctes, exprs


def rnd(expr: str, digits: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits})"


def feature_select_sql(columns: list[str], cfg: FeatureConfig = FeatureConfig(), with_target: bool = False) -> str:
    """Full statement: keys (+ target) + the requested feature columns, rounded."""
    ctes, exprs = feature_sql_parts(cfg)
    sel = ["f.stock_id", "f.time_id"]
    if with_target:
        sel += [f"{rnd('k.target_var')} AS target_var", f"{rnd('sqrt(greatest(k.target_var, 0))')} AS target_vol"]
    sel += [f"{rnd(exprs[c])} AS {c}" for c in columns]
    return (
        "WITH " + book_ctes(cfg.forecast_horizon).lstrip() + "," + target_cte(cfg) + "," + ctes
        + "\nSELECT " + ",\n       ".join(sel)
        + "\nFROM f JOIN kept k USING (stock_id, time_id)"
    )
