"""Per-window feature kernel (W3, F4, F5, P6-P9, A1-A13, F8): D2 -> D3.

Position arithmetic (per window): ``cutoff = n_obs - horizon``; observed
returns are ``pos <= cutoff``; ``rev = cutoff - pos + 1`` is the distance from
the end of the observed part, so "the last ``w`` observed returns" is
``1 <= rev <= w``.

Every windowed statistic is a sum (or max, or sorted list) over a prefix
``rev <= w``.  Spark brings a window's runs of usable returns together (at most
600, in the ``(stock_id, time_id)`` partitioning of the book stage), drops windows
by F4/F5 and computes the target.  A task then lays some hundreds of windows side
by side, distance from the end as first axis: the statistics of each interval
between two window lengths that any feature needs are added up once, their running
sums are the values for every length, and the 255 features are read off.  A run is
never expanded into a row per second.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (
    EPS,
    MIN_OBSERVED_MOVES,
    MIN_TARGET_MOVES,
    RATIO_PAIRS,
    FeatureConfig,
    ewma_name,
    feature_columns,
)
from .book import KEYS, book_runs

LAGS = (1, 5)
#: Windows that the kernel lays side by side.
TOGETHER = 256

SPREAD = "((ask_price1 - bid_price1) / nullif((bid_price1 + ask_price1) / 2, 0D))"
L2 = "nullif(bid_size2 + ask_size2, 0D)"
DEPTH = f"(bid_size1 + ask_size1 + {L2})"
IMBALANCE = "((bid_size1 - ask_size1) / nullif(bid_size1 + ask_size1, 0D))"
PRESSURE = f"((bid_size1 + bid_size2 - ask_size1 - ask_size2) / nullif({DEPTH}, 0D))"
DEPTH_RATIO = f"((bid_size1 + ask_size1) / {L2})"
SHIFTED = {"sp": SPREAD, "im": IMBALANCE, "dp": DEPTH}  # std needs a shift for stability
PLAIN = {"dr": DEPTH_RATIO, "pr": PRESSURE}


def edges(cfg: FeatureConfig) -> list[int]:
    """Every prefix length a feature reads (window lengths and lag ranges)."""
    e = set(cfg.return_windows) | set(cfg.book_windows) | set(cfg.acf_windows) | {1}
    for w in cfg.acf_windows:
        for k in LAGS:
            e |= {k, w - k}
    return sorted(x for x in e if x >= 1)


def kept_windows(runs: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """One row per window that passes F4 and F5: ``n_total``, ``target_var`` and,
    as ``runs``, its runs of usable returns (at most 600) with the book ratios
    that hold during the run.  A run knows its position, so their order is free."""
    h = cfg.forecast_horizon
    rev = f"((n_total - {h}) - pos_before)"  # rev of the run's first usable return
    moved = "(n_valid > 0 AND ret_first IS NOT NULL AND ret_first <> 0)"
    ratios = ", ".join(f"{expr} AS {key}" for key, expr in {**SHIFTED, **PLAIN}.items())
    grouped = runs.groupBy(*KEYS).agg(
        F.expr("max(n_total) AS n_total"),
        F.expr(f"sum(CASE WHEN {moved} AND {rev} < 1 THEN ret_first * ret_first END) AS tgt_sum"),
        F.expr(f"count_if({moved} AND {rev} < 1) AS target_moves"),
        F.expr(f"count_if({moved} AND {rev} >= 1) AS observed_moves"),
        F.expr(f"collect_list(CASE WHEN n_valid > 0 THEN struct(pos_before, n_valid, ret_first, {ratios}) END) AS runs"),
    )
    kept = grouped.where(f"n_total >= {cfg.min_observations} AND observed_moves >= {MIN_OBSERVED_MOVES} AND target_moves >= {MIN_TARGET_MOVES}")
    return kept.selectExpr(*KEYS, "n_total", f"coalesce(tgt_sum, 0D) / {float(h)} AS target_var", "runs")


class Prefixes:
    """Sums (or maxima) over the last ``w`` observed returns of many windows, for
    every ``w`` in ``cuts``: distance from the end first, windows last."""

    def __init__(self, cuts: list[int]):
        self.starts, self.at = [0, *cuts[:-1]], {c: i for i, c in enumerate(cuts)}
        self.last = cuts[-1]

    def sums(self, x: np.ndarray) -> dict[int, np.ndarray]:
        total = np.cumsum(np.add.reduceat(x[: self.last], self.starts, axis=0, dtype=float), axis=0)
        return {c: total[i] for c, i in self.at.items()}

    def maxima(self, x: np.ndarray) -> dict[int, np.ndarray]:
        top = np.maximum.accumulate(np.maximum.reduceat(x[: self.last], self.starts, axis=0), axis=0)
        return {c: top[i] for c, i in self.at.items()}


def _over(a, b):
    """``a / b`` and where it has no value: a null divisor is a zero."""
    none = b == 0
    return a / np.where(none, 1.0, b), none


def features_of_runs(n_total: np.ndarray, sizes: np.ndarray, runs: dict[str, np.ndarray], cfg: FeatureConfig) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Every feature of a batch of windows as (values, where null).  ``runs`` are
    the runs of all windows one after the other, ``sizes`` their number per window;
    a null is a masked entry."""
    cutoff, k = n_total - cfg.forecast_horizon, len(n_total)
    cuts = edges(cfg)
    of, every, never = np.repeat(np.arange(k), sizes), np.arange(k), np.zeros(k, bool)
    rev = cutoff[of] - runs["pos_before"]  # of a run's first return
    prefix = Prefixes(cuts)
    # returns by distance from the end; but for the runs' first ones they are zero
    r = np.zeros((max(int(cutoff.max(initial=0)), cuts[-1]), k))
    own = ~runs["ret_first"].mask & (rev >= 1)
    r[rev[own] - 1, of[own]] = runs["ret_first"].data[own]
    square, size = r * r, np.abs(r)
    up, down = ~(r <= 0), r < 0
    s1, s2, sa, mx, nz = prefix.sums(r), prefix.sums(square), prefix.sums(size), prefix.maxima(size), prefix.sums(r != 0)
    ns, nn, ps, pn = prefix.sums(np.where(down, square, 0.0)), prefix.sums(down), prefix.sums(np.where(up, square, 0.0)), prefix.sums(up)
    ordered = np.ascontiguousarray(r.T)
    out = {
        "seconds_elapsed": (cutoff / np.maximum(n_total, 1), never),
        "n_obs": (n_total.astype(float), never),
        "cutoff": (cutoff.astype(float), never),
        "last_return": (s1[1], never),
        "abs_last_return": (np.abs(s1[1]), never),
    }
    for w in sorted(set(cfg.return_windows)):
        short = cutoff < w
        out[f"RV_{w}"] = (s2[w] / w, short)
        out[f"vol_{w}"] = (np.sqrt(s2[w] / w), short)
        out[f"mean_abs_ret_{w}"] = (sa[w] / w, short)
        out[f"mean_ret_{w}"] = (s1[w] / w, short)
        out[f"max_abs_ret_{w}"] = (mx[w], short)
        out[f"prop_zero_ret_{w}"] = (1 - nz[w] / w, short)
        out[f"downside_RV_{w}"] = (_over(ns[w], nn[w])[0], short)
        out[f"upside_RV_{w}"] = (_over(ps[w], pn[w])[0], short)
        sigma = np.sqrt(np.maximum(s2[w] / w - (s1[w] / w) ** 2, 0))
        out[f"jump_count_{w}"] = ((size[:w] > 3 * sigma + EPS).sum(axis=0).astype(float), short)
        ranked = np.sort(ordered[:, :w], axis=1)
        for q, name in ((0.1, "ret_q10"), (0.9, "ret_q90")):
            h = (w - 1) * q
            low = int(h // 1)
            a, b = ranked[:, low], ranked[:, min(low + 1, w - 1)]
            out[f"{name}_{w}"] = (a + (h - low) * (b - a), short)
    for lag, name in zip(LAGS, ("ret_autocorr", "ret_autocorr5")):
        pairs = np.zeros_like(r)
        pairs[lag:] = r[lag:] * r[:-lag]
        both = prefix.sums(pairs)
        for w in cfg.acf_windows:
            m = float(w - lag)
            ma, mb = (s1[w] - s1[lag]) / m, s1[w - lag] / m
            va = np.maximum((s2[w] - s2[lag]) / m - ma * ma, 0)
            vb = np.maximum(s2[w - lag] / m - mb * mb, 0)
            den = np.sqrt(va) * np.sqrt(vb)
            flat = den == 0
            out[f"{name}_{w}"] = (np.where(flat, 0.0, ((both[w] - both[lag]) / m - ma * mb) / np.where(flat, 1.0, den)), cutoff < w)
    oldest = np.where(cutoff > 0, square[np.maximum(cutoff, 1) - 1, every], 0.0)
    for lam in cfg.ewma_lambdas:
        weights = lam ** np.arange(len(r))
        out[ewma_name(lam)] = ((1 - lam) * (weights @ square) + lam * lam ** np.maximum(cutoff - 1.0, 0) * oldest, never)
    nothing = (np.zeros(k), np.ones(k, bool))
    ratios = [("vol_trend", 30, 300), *((f"RV_ratio_{s}_{l}", s, l) for s, l in RATIO_PAIRS)]
    for name, s, l in ratios:
        (a, no_a), (b, no_b) = out.get(f"RV_{s}", nothing), out.get(f"RV_{l}", nothing)
        out[name] = (a / (b + EPS), no_a | no_b)
    # the book of a run holds for each of its returns
    far = max(cfg.book_windows, default=1)
    run = np.repeat(np.arange(len(of)), runs["n_valid"])
    first = np.cumsum(runs["n_valid"]) - runs["n_valid"]
    back = rev[run] - (np.arange(len(run)) - first[run])
    near = (back >= 1) & (back <= far)
    run, back = run[near], back[near] - 1
    win, book_prefix = of[run], Prefixes(sorted(set(cfg.book_windows)) or [1])
    of_key = {"sp": ("mean_spread", "std_spread"), "im": ("mean_imbalance", "std_imbalance"), "dp": ("mean_depth", "std_depth"), "dr": ("depth_ratio",), "pr": ("book_pressure",)}
    for key, names in of_key.items() if cfg.book_windows else ():
        x, known = np.zeros((far, k)), np.zeros((far, k), bool)
        x[back, win], known[back, win] = np.where(runs[key].mask, 0.0, runs[key].data)[run], ~runs[key].mask[run]
        shift = x[0].copy() if key in SHIFTED else np.zeros(k)  # the value at rev 1: std needs a shift for stability
        x = np.where(known, x - shift, 0.0)
        s, n = book_prefix.sums(x), book_prefix.sums(known)
        q = book_prefix.sums(x * x)
        for w in cfg.book_windows:
            mean, none = _over(s[w], n[w])
            out[f"{names[0]}_{w}"] = (shift + mean, none | (cutoff < w))
            if len(names) > 1:
                some = np.maximum(n[w], 2)
                var = np.maximum((q[w] - s[w] * s[w] / some) / (some - 1), 0)
                out[f"{names[1]}_{w}"] = (np.sqrt(var), (n[w] < 2) | (cutoff < w))
    return out


def feature_table_from_runs(runs: DataFrame, cfg: FeatureConfig) -> DataFrame:
    columns = feature_columns(cfg)
    keys = "stock_id string, time_id bigint, target_var double, target_vol double"

    def kernel(batches):
        for b in batches:
            for i in range(0, b.num_rows, TOGETHER):
                part = b.slice(i, TOGETHER)
                rows = part.column("runs")
                fields = {}
                for f, a in zip(rows.type.value_type, rows.flatten().flatten()):
                    none = a.is_null().to_numpy(zero_copy_only=False)
                    fields[f.name] = np.ma.MaskedArray(a.fill_null(0).to_numpy(zero_copy_only=False), none) if pa.types.is_floating(f.type) else a.to_numpy().astype(np.int64)
                sizes = rows.value_lengths().to_numpy().astype(np.int64)
                got = features_of_runs(part.column("n_total").to_numpy().astype(np.int64), sizes, fields, cfg)
                target = part.column("target_var").to_numpy()
                arrays = [part.column("stock_id"), part.column("time_id"), pa.array(target), pa.array(np.sqrt(np.maximum(target, 0)))]
                yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(got[c][0], mask=got[c][1]) for c in columns)], names=["stock_id", "time_id", "target_var", "target_vol", *columns])

    return kept_windows(runs, cfg).mapInArrow(kernel, f"{keys}, " + ", ".join(f"`{c}` double" for c in columns))


def build_features(book: DataFrame, cfg: FeatureConfig = FeatureConfig(), partitions: int | None = None) -> DataFrame:
    """D1 -> D3: ``stock_id, time_id, target_var, target_vol`` + features."""
    return feature_table_from_runs(book_runs(book, partitions), cfg)


def window_targets(book: DataFrame, cfg: FeatureConfig = FeatureConfig(), partitions: int | None = None) -> DataFrame:
    """W3/F4/F5/A12 on the runs alone (no per-second expansion): the target
    is the last ``horizon`` usable returns, i.e. ``rev < 1``."""
    h = cfg.forecast_horizon
    runs = book_runs(book, partitions)
    rev = f"((n_total - {h}) - pos_before)"  # rev of the run's first usable return
    first = "(ret_first IS NOT NULL AND n_valid > 0)"
    grouped = runs.groupBy(*KEYS).agg(
        F.expr("max(n_total) AS n_obs"),
        F.expr(f"sum(CASE WHEN {first} AND {rev} < 1 THEN ret_first * ret_first END) AS tgt_sum"),
        F.expr(f"count_if({first} AND {rev} < 1 AND ret_first <> 0) AS target_moves"),
        F.expr(f"count_if({first} AND {rev} >= 1 AND ret_first <> 0) AS observed_moves"),
    )
    target = f"(coalesce(tgt_sum, 0D) / {float(h)})"
    return grouped.where(
        f"n_obs >= {cfg.min_observations} AND observed_moves >= {MIN_OBSERVED_MOVES} AND target_moves >= {MIN_TARGET_MOVES}"
    ).selectExpr(
        *KEYS,
        "CAST(n_obs AS INT) AS n_obs",
        f"CAST(n_obs - {h} AS INT) AS cutoff",
        "CAST(observed_moves AS INT) AS observed_moves",
        "CAST(target_moves AS INT) AS target_moves",
        f"{target} AS target_var",
        f"sqrt(greatest({target}, 0D)) AS target_vol",
    )


def usable_columns(features: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """F8 as one aggregate pass: a column is usable when it has no null, no
    non-finite value and at least two distinct values over the whole table.
    Returns one row per feature column: ``column, position, usable``."""
    cols = [c for c in feature_columns(cfg) if c in features.columns]
    aggs = []
    for i, c in enumerate(cols):
        bad = f"(`{c}` IS NULL OR isnan(`{c}`) OR abs(`{c}`) = double('inf'))"
        aggs += [
            F.expr(f"count_if({bad}) AS b{i}"),
            F.expr(f"min(CASE WHEN NOT {bad} THEN `{c}` END) AS lo{i}"),
            F.expr(f"max(CASE WHEN NOT {bad} THEN `{c}` END) AS hi{i}"),
        ]
    stats = features.agg(*aggs)
    entries = ", ".join(
        f"struct('{c}' AS column, {i + 1} AS position, coalesce(b{i} = 0 AND lo{i} < hi{i}, false) AS usable)"
        for i, c in enumerate(cols)
    )
    return stats.selectExpr(f"inline(array({entries}))")
