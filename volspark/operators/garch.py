"""Per-window GARCH(1,1) / GJR-GARCH(1,1) forecasts (M12) and the legacy
cross-window GARCH calibrated to log RV (M13).

A window becomes one row with its returns as an array (at most 600 values).
The zero-mean Gaussian likelihood is maximised for many windows at once, time
as first axis and windows as last: the variance recursion and, beside it, the
recursion of its derivatives give the score and the expected information; every
window takes scoring steps with its own set of active bounds and its own step
length, from the best starting points of three ranges of beta.  The space is
omega > 0, alpha and beta in [0, 1], gamma in [-1, 2], alpha + gamma >= 0,
alpha + beta + gamma/2 <= 1.
The fit returns parameters and the state after the last training return; the
gates, the multi-step path and the output row are Spark columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import GARCH_STABILITY_LIMIT, MAX_REASONABLE_GARCH_VAR
from ..functions.quantiles import in_blocks, ranked_in_group
from ..session import cut_lineage
from .book import book_runs

OUT_COLS = (
    "model model_type fold stock_id time_id pred_var pred_vol actual_var actual_vol inference_ms feature_cols prediction_kind "
    "forecast_seconds forecast_vol_path"
).split()
#: Starting points: (alpha, gamma, persistence).
STARTS = [(a, g, p) for a in (0.02, 0.1, 0.3, 0.6, 0.85) for g in (0.0, 0.2, 0.7) for p in (0.3, 0.7, 0.9, 0.97) if a + g / 2 <= p]
FIT = "stock_id string, time_id bigint, seconds array<int>, actual_var double, omega double, alpha double, beta double, gamma double, last_var double, last_ret double"


def backcast(eps: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Starting variance per row: exponentially weighted mean of the first
    squared returns (decay 0.94 over at most 75 values)."""
    m = min(75, eps.shape[1])
    w = 0.94 ** np.arange(m) * (np.arange(m) < n[:, None])
    return (w * eps[:, :m] ** 2).sum(axis=1) / np.maximum(w.sum(axis=1), 1e-300)


def carry(u: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """``u`` with ``u[t] += beta * u[t - 1]`` from the first row to the last (beta is
    for the last axis): stretches of equal length side by side, then the end of
    each is carried into the next one by the powers of beta."""
    t, length = len(u), int(np.ceil(np.sqrt(len(u))))
    steps = -(-t // length)
    flat = np.zeros((steps * length, *u.shape[1:]))
    flat[:t] = u
    v = flat.reshape(steps, length, *u.shape[1:])
    moved = np.empty_like(v[:, 0])
    for j in range(1, length):
        np.multiply(v[:, j - 1], beta, out=moved)
        v[:, j] += moved
    powers = np.multiply.accumulate(np.broadcast_to(beta, (length, *beta.shape)), axis=0)
    powers = np.where(np.abs(powers) < 1e-200, 0.0, powers).reshape(length, *(1,) * (u.ndim - 2), len(beta))
    for i in range(1, len(v)):
        v[i] += powers * v[i - 1, -1]
    return flat[:t]


def variances(square: np.ndarray, minus: np.ndarray, s0: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """Conditional variances (time, rows) under ``theta`` (rows; omega, alpha,
    beta, gamma); ``minus`` holds the squares of negative returns, else 0."""
    omega, alpha, beta, gamma = theta.T
    out = np.empty((len(square), len(theta)))
    out[0] = np.maximum(s0, 1e-12)
    np.multiply(alpha, square[:-1], out=out[1:])
    out[1:] += omega
    if gamma.any():
        out[1:] += gamma * minus[:-1]
    return np.maximum(carry(out, beta), 1e-12)


def likelihood(square: np.ndarray, on: np.ndarray, sig: np.ndarray) -> np.ndarray:
    return -0.5 * ((np.log(sig) + square / sig + np.log(2 * np.pi)) * on).sum(axis=0)


def recursion(eps: np.ndarray, n: np.ndarray, s0: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood and last variance of each row under ``theta``; row ``i``
    has ``n[i]`` returns."""
    square = np.ascontiguousarray(eps.T**2)
    sig = variances(square, np.where(eps.T < 0, square, 0.0), s0, theta)
    return likelihood(square, np.arange(len(square))[:, None] < n, sig), sig[np.maximum(n - 1, 0), np.arange(len(eps))]


def feasible(theta: np.ndarray) -> np.ndarray:
    omega, alpha, beta, gamma = theta.T
    return (omega > 0) & (alpha >= 0) & (alpha <= 1) & (beta >= 0) & (beta <= 1) & (np.abs(gamma - 0.5) <= 1.5) & (alpha + gamma >= 0) & (alpha + beta + gamma / 2 <= 1)


#: Bounds ``A x <= b`` on x = (log(omega / var), alpha, beta, gamma); the others follow.
BOUNDS_A = np.array([[0, -1, 0, 0], [0, 1, 0, 0], [0, 0, -1, 0], [0, 1, 1, 0.5], [0, -1, 0, -1], [1, 0, 0, 0], [-1, 0, 0, 0]], float)
BOUNDS_B = np.array([0, 1, 0, 1, 0, 5, 20], float)


#: Candidates whose variances are held at a time: their arrays stay in the cache.
AT_ONCE = 64
#: How near two candidates of a window must come to go on as one.
NEAR = np.array([0.1, 0.02, 0.02, 0.02])


class Windows:
    """Padded windows, time first, with what their likelihood needs."""

    def __init__(self, eps: np.ndarray, n: np.ndarray, free: int):
        on = np.arange(eps.shape[1]) < n[:, None]
        eps = np.where(on, eps, 0.0)
        self.on, self.square = np.ascontiguousarray(on.T), np.ascontiguousarray(eps.T**2)
        self.minus = np.where(eps.T < 0, self.square, 0.0)
        self.var = np.maximum(self.square.sum(axis=0) / np.maximum(n, 1), 1e-12)
        self.s0, self.free = backcast(eps, n), free

    def theta(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), 4))
        out[:, 0] = np.exp(x[:, 0]) * self.var[at]
        out[:, 1 : self.free] = x[:, 1:]
        return out

    def loss(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.concatenate([self._loss(x[i : i + AT_ONCE], at[i : i + AT_ONCE]) for i in range(0, max(len(x), 1), AT_ONCE)])

    def score(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Loss, its gradient and the expected information in ``x``."""
        parts = [self._score(x[i : i + AT_ONCE], at[i : i + AT_ONCE]) for i in range(0, max(len(x), 1), AT_ONCE)]
        return tuple(np.concatenate(p) for p in zip(*parts))

    def _loss(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        square = self.square[:, at]
        return -likelihood(square, self.on[:, at], variances(square, self.minus[:, at], self.s0[at], self.theta(x, at)))

    def _score(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        square, on, theta = self.square[:, at], self.on[:, at], self.theta(x, at)
        sig = variances(square, self.minus[:, at], self.s0[at], theta)
        change = np.zeros((len(sig), self.free, len(at)))
        change[1:, 0], change[1:, 1], change[1:, 2] = theta[:, 0], square[:-1], sig[:-1]
        if self.free > 3:
            change[1:, 3] = self.minus[:-1, at]
        change = carry(change, theta[:, 2])
        change *= (on / sig)[:, None]
        off, k = 1 - square / sig, self.free
        gradient, h = np.empty((len(at), k)), np.empty((len(at), k, k))
        for i in range(k):
            gradient[:, i] = 0.5 * (change[:, i] * off).sum(axis=0)
            for j in range(i + 1):
                h[:, i, j] = h[:, j, i] = 0.5 * (change[:, i] * change[:, j]).sum(axis=0)
        return -likelihood(square, on, sig), gradient, h


def inside(x: np.ndarray) -> np.ndarray:
    """``x`` without the last digits by which rounding leaves the bounds."""
    x = x.copy()
    x[:, 0], x[:, 1] = np.clip(x[:, 0], -20, 5), np.clip(x[:, 1], 0, 1)
    skew = np.maximum(x[:, 3], -x[:, 1]) if x.shape[1] > 3 else np.zeros(len(x))
    x[:, 3:] = skew[:, None][:, : x.shape[1] - 3]
    x[:, 2] = np.clip(np.minimum(x[:, 2], 1 - 1e-15 - x[:, 1] - skew / 2), 0, 1)
    return x


def met(x: np.ndarray, value: np.ndarray, each: int) -> np.ndarray:
    """Rows near a better one of their window; ``each`` candidates of all windows
    lie one after the other."""
    points, losses = x.reshape(each, -1, x.shape[1]), np.where(np.isnan(value), np.inf, value).reshape(each, -1)
    out = np.zeros(losses.shape, bool)
    for i in range(each):
        for j in range(each):
            better = (losses[j] < losses[i]) | ((losses[j] == losses[i]) & (j < i))
            out[i] |= better & (np.abs(points[i] - points[j]) < NEAR[: x.shape[1]]).all(axis=1)
    return out.ravel()


def climb(windows: Windows, x: np.ndarray, at: np.ndarray, rounds: int, tolerance: float = 1e-8, each: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Points of least loss, and the losses, from ``x`` for the windows ``at``.

    A row's step solves the scoring equations on its active bounds and goes at
    most to the next bound, which then is active; where steps gain nothing any
    more, the bound that holds it back the most is let go, and without such a
    bound it ends.  Where ``x`` holds ``each`` candidates of
    every window, a row ends, too, when a better one of its window is near."""
    k = windows.free
    a, b = BOUNDS_A[:, :k], BOUNDS_B
    if k == 3:
        a, b = np.delete(a, 4, axis=0), np.delete(b, 4)
    x, active = x.copy(), np.zeros((len(x), len(a)), bool)
    value, before = np.full(len(x), np.inf), np.full(len(x), np.inf)
    rested, tries = np.full(len(x), np.inf), np.zeros(len(x), int)
    curve, slow, rows = np.ones(len(x)), np.zeros(len(x), int), np.arange(len(x))
    for turn in range(rounds):
        if each > 1 and turn > 1:
            rows = rows[~met(x, value, each)[rows]]
        if not len(rows):
            break
        f, g, h = windows.score(x[rows], at[rows])
        slow[rows] = np.where(before[rows] - f < tolerance, slow[rows] + 1, 0)
        before[rows] = value[rows] = f
        w, m = active[rows], len(a)
        scale = np.einsum("rii->ri", h) + 1e-12
        h = (h + np.eye(k) * (scale * 1e-9)[:, :, None]) * curve[rows, None, None]
        system = np.zeros((len(rows), k + m, k + m))
        system[:, :k, :k] = h
        held = np.where(w[:, :, None], a, 0.0)
        system[:, k:, :k], system[:, :k, k:] = held, held.transpose(0, 2, 1)
        system[:, k:, k:] = np.eye(m) * ~w[:, :, None]
        # bounds that depend on each other may be active together
        system[:, k:, k:] -= 1e-13 * np.eye(m) * w[:, :, None]
        solved = np.linalg.solve(system, np.concatenate([-g, np.zeros((len(rows), m))], axis=1)[:, :, None])[:, :, 0]
        d, push = solved[:, :k], np.where(w, solved[:, k:], 0.0)
        gain = np.einsum("ri,rij,rj->r", d, h, d)  # without what rounding at the active bounds adds
        rest = (gain <= tolerance) | (slow[rows] > 3)
        helped = rested[rows] - f > tolerance  # since the bound let go last
        tries[rows[rest]] = np.where(helped[rest], 0, tries[rows[rest]] + 1)
        rested[rows[rest]] = f[rest]
        pull = push.min(axis=1)
        loosen = (rest & (pull < -1e-7) & (tries[rows] < 3)) | ((gain < 1e-4) & (pull < -1e-2) & (tries[rows] < 3))
        active[rows[loosen], push[loosen].argmin(axis=1)] = False
        slow[rows[loosen]] = 0
        ended = rest & ~loosen
        go = np.flatnonzero(~rest & ~loosen)
        # the largest step within the bounds that are not active
        speed, room = d[go] @ a.T, b - x[rows[go]] @ a.T
        with np.errstate(divide="ignore", invalid="ignore"):
            until = np.where(~w[go] & (speed > 1e-14), np.maximum(room, 0) / speed, np.inf)
        limit = until.min(axis=1)
        first = np.minimum(1.0, limit)
        t = first.copy()
        open_ = np.arange(len(go))
        for _ in range(25):
            trial = x[rows[go[open_]]] + t[open_, None] * d[go[open_]]
            f_trial = windows.loss(trial, at[rows[go[open_]]])
            ok = (t[open_] == 0) | (f_trial <= f[go[open_]] - 0.3 * t[open_] * gain[go[open_]])
            done = open_[ok]
            x[rows[go[done]]] = inside(trial[ok])
            value[rows[go[done]]] = np.where(t[done] == 0, f[go[done]], f_trial[ok])
            hit = done[t[done] == limit[done]]
            active[rows[go[hit]], until[hit].argmin(axis=1)] = True
            # the expected information may be far from the curvature along the way
            part = np.where(first[done] > 0, t[done] / np.maximum(first[done], 1e-300), 1.0)
            curve[rows[go[done]]] = np.clip(np.where(part < 1, curve[rows[go[done]]] / part, curve[rows[go[done]]] * 0.7), 0.5, 1e6)
            open_ = open_[~ok]
            if not len(open_):
                break
            t[open_] /= 2
        ended[go[open_]] = True  # no step helped
        rows = rows[~ended]
    return x, windows.loss(x, at)


def fit_rows(eps: np.ndarray, n: np.ndarray, asymmetric: bool) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood parameters and last variance of each (padded) row."""
    rows, free = len(eps), 4 if asymmetric else 3
    windows, every = Windows(eps, n, free), np.arange(len(eps))
    starts = np.array([[np.log(max(1 - p, 1e-3)), a, p - a - g / 2, g][:free] for a, g, p in STARTS if asymmetric or not g])
    values = np.array([windows.loss(np.tile(s, (rows, 1)), every) for s in starts])
    values = np.where(np.isnan(values), np.inf, values)
    # the likelihood may have several maxima: from the two best starts of each range of beta
    chosen = []
    for low, high in ((-1.0, 0.15), (0.15, 0.55), (0.55, 2.0)):
        own = np.flatnonzero((starts[:, 2] >= low) & (starts[:, 2] < high))
        order = np.argsort(values[own], axis=0, kind="stable")
        chosen += [starts[own[order[i]]] for i in range(2)]
    # and from variances that only drift away from their first value
    chosen += [np.tile(np.array([np.log(w), 0.001, b, 0.0][:free]), (rows, 1)) for w, b in ((0.003, 0.99), (0.03, 0.95))]
    found, reached = climb(windows, np.concatenate(chosen), np.tile(every, len(chosen)), 100, each=len(chosen))
    best = np.where(np.isnan(reached), np.inf, reached).reshape(len(chosen), rows).argmin(axis=0)
    theta = windows.theta(climb(windows, found.reshape(len(chosen), rows, free)[best, every], every, 500)[0], every)
    return theta, recursion(np.where(np.arange(eps.shape[1]) < n[:, None], eps, 0.0), n, windows.s0, theta)[1]


def padded(lists: list) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(x) for x in lists])
    out = np.zeros((len(lists), max(1, n.max(initial=0))))
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out, n


def fit_windows(windows: DataFrame, asymmetric: bool, together: int = 2000) -> DataFrame:
    """Parameters and final state per window of :func:`garch_windows`."""
    kept = ["stock_id", "time_id", "seconds", "actual_var"]

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, together):
                part = b.slice(i, together)
                eps, n = padded(part.column("train").to_pylist())
                theta, last = fit_rows(eps, n, asymmetric)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], *[pa.array(theta[:, j]) for j in range(4)], pa.array(last), pa.array(eps[np.arange(len(n)), n - 1])],
                    names=[*kept, "omega", "alpha", "beta", "gamma", "last_var", "last_ret"],
                )

    return windows.select(*kept, "train").mapInArrow(run, FIT)


def persistence() -> Column:
    return F.col("alpha") + F.col("beta") + F.col("gamma") / 2


def usable_fit() -> Column:
    """Gate on the parameters: finite, variance never negative, and both every
    coefficient and the persistence below the stability limit."""
    finite = F.forall(F.array("omega", "alpha", "beta", "gamma"), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    lowest = F.least("omega", "alpha", "beta", F.col("alpha") + F.col("gamma"), persistence())
    highest = F.greatest("alpha", "beta", F.abs("gamma"), persistence())
    return finite & (lowest >= 0) & (highest < GARCH_STABILITY_LIMIT)


def variance_path(horizon: int) -> Column:
    """Expected variances 1..horizon steps ahead: the first from the last
    return and variance, the others drawn to the long-run level."""
    first = F.col("omega") + (F.col("alpha") + F.when(F.col("last_ret") < 0, F.col("gamma")).otherwise(0.0)) * F.col("last_ret") * F.col("last_ret") + F.col("beta") * F.col("last_var")
    level = F.col("omega") / (1 - persistence())
    return F.transform(F.sequence(F.lit(0), F.lit(horizon - 1)), lambda i: level + F.pow(persistence(), i) * (first - level))


def credible(path: Column) -> Column:
    """Gate on a path: every variance between 0 and the limit."""
    return F.forall(path, lambda v: ~F.isnan(v) & v.between(0.0, MAX_REASONABLE_GARCH_VAR))


def forecasts_from_fits(fits: DataFrame, horizon: int) -> DataFrame:
    """``fits`` with ``path`` (null where a gate fails) and ``pred_var``."""
    out = fits.withColumn("path", F.when(usable_fit(), variance_path(horizon)))
    out = out.withColumn("path", F.when(credible(F.col("path")), F.col("path")))
    return out.withColumn("pred_var", F.aggregate("path", F.lit(0.0), lambda a, v: a + v) / horizon)


def garch_windows(book: DataFrame, horizon: int = 30) -> DataFrame:
    """One row per window long enough to fit: training returns, and the seconds
    and mean square of the ``horizon`` held-out ones."""
    # a run's returns are its own second's and zeros; at most 600 returns a window
    second = "seconds_in_bucket + CASE WHEN ret_first IS NULL THEN 1 ELSE 0 END"
    runs = book_runs(book).where("n_valid > 0").selectExpr(
        "stock_id", "time_id", "n_total",
        f"struct(pos_before, concat(array(coalesce(ret_first, 0D)), array_repeat(0D, n_valid - 1)) AS ret, sequence({second}, {second} + n_valid - 1) AS second) AS r",
    )
    rows = runs.where(F.col("n_total") >= horizon + 10).groupBy("stock_id", "time_id").agg(F.array_sort(F.collect_list("r")).alias("r"))
    rows = rows.select("stock_id", "time_id", F.flatten("r.ret").alias("ret"), F.flatten("r.second").alias("second"))
    cut = F.size("ret") - horizon
    return rows.select(
        "stock_id", "time_id", F.slice("ret", F.lit(1), cut).alias("train"),
        F.transform(F.slice("second", cut + 1, horizon), lambda v: v.cast("int")).alias("seconds"),
        (F.aggregate(F.slice("ret", cut + 1, horizon), F.lit(0.0), lambda a, v: a + v * v) / horizon).alias("actual_var"),
    )


def garch_forecasts(book: DataFrame, folds: DataFrame, model_type: str = "GARCH(1,1)", horizon: int = 30, name: str | None = None) -> DataFrame:
    """One forecast row per window (F4's weaker bound only, no F5)."""
    windows = garch_windows(book, horizon)
    fits = fit_windows(windows, model_type == "GJR-GARCH(1,1)")
    done = forecasts_from_fits(fits, horizon).join(folds, "time_id")
    as_json = lambda c: F.concat(F.lit("["), F.array_join(c, ", "), F.lit("]"))
    path = F.transform(F.coalesce("path", F.array().cast("array<double>")), lambda v: F.sqrt(v))
    return done.select(
        F.lit(name or model_type).alias("model"), F.lit(model_type).alias("model_type"), F.col("fold").cast("int").alias("fold"), "stock_id", "time_id",
        F.coalesce("pred_var", F.lit(float("nan"))).alias("pred_var"), F.coalesce(F.sqrt("pred_var"), F.lit(float("nan"))).alias("pred_vol"),
        "actual_var", F.sqrt("actual_var").alias("actual_vol"), F.lit(None).cast("double").alias("inference_ms"), F.lit("").alias("feature_cols"),
        F.lit("garch_path").alias("prediction_kind"), as_json(F.col("seconds")).alias("forecast_seconds"), as_json(path).alias("forecast_vol_path"),
    )


# ---------------------------------------------------------------- across windows
#: Returns of a stock that one task filters at a time (75 at least, for the first variance).
BLOCK = 4096
SERIES = "stock_id string, block long, blocks long, time_id array<bigint>, ret array<double>, y array<double>, mean double"


def series_blocks(series: DataFrame, block: int | None = None) -> DataFrame:
    """Schema SERIES: 100 x log returns of ``last_wap`` from window to window of
    a stock with the labels of the later window, cut into blocks; ``mean`` is the
    mean return of the stock."""
    block = block or BLOCK
    w = "PARTITION BY stock_id, _block ORDER BY time_id"
    rows = in_blocks(series, "stock_id", "time_id", 1).selectExpr(
        "stock_id", "time_id", "_own", "CAST(log_rv_second AS DOUBLE) AS y", f"100 * (ln(last_wap) - lag(ln(last_wap)) OVER ({w})) AS ret"
    )
    ranked = ranked_in_group(rows.where("_own AND ret IS NOT NULL").drop("_own"), "stock_id", "time_id")
    cells = ranked.groupBy("stock_id", F.floor((F.col("_r") - 1) / block).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("time_id", "ret", "y"))).alias("v"), F.first(F.ceil(F.col("_n") / block)).alias("blocks"), F.sum("ret").alias("s")
    )
    means = cells.groupBy("stock_id").agg((F.sum("s") / F.sum(F.size("v"))).alias("mean"))
    return cut_lineage(cells.join(means, "stock_id").select("stock_id", "block", "blocks", *[F.col(f"v.{c}").alias(c) for c in ("time_id", "ret", "y")], "mean"))


def block_end(square: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Last variance of a block and its derivatives by omega, alpha and beta for
    a first variance of zero without derivatives; a row per row of ``theta``."""
    omega, alpha, beta = theta[:, :3].T
    s, d = np.zeros(len(theta)), np.zeros((3, len(theta)))
    for x in square[:-1]:
        d = beta * d + np.stack([np.ones(len(s)), np.full(len(s), x), s])
        s = omega + alpha * x + beta * s
    return s, d


def first_states(ends: list, s0: dict[str, float], theta: dict[str, np.ndarray]) -> dict[tuple, tuple[np.ndarray, np.ndarray]]:
    """First variance and derivatives of every block: a variance is affine in
    the one before, so a block maps its first state to its last one by the
    powers of beta, and the blocks are joined one after the other.  ``ends``:
    (stock, block, length, last square, last variance, last derivatives)."""
    out = {}
    for stock, block, m, square, s_end, d_end in sorted(ends, key=lambda e: e[:2]):
        t = theta[stock]
        beta, k = t[:, 2], len(t)
        if block == 0:
            s, d = np.full(k, max(s0[stock], 1e-12)), np.zeros((3, k))
        out[stock, block] = (s, d)
        power, before = beta ** (m - 1), (m - 1) * beta ** max(m - 2, 0)
        last, slope = power * s + s_end, power * d + d_end
        slope[2] += before * s
        # on to the first return of the next block
        d = beta * slope + np.stack([np.ones(k), np.full(k, square), last])
        s = t[:, 0] + t[:, 1] * square + beta * last
    return out


class LongSeries:
    """The likelihood of stocks with several blocks, in the form that
    :func:`climb` asks for; two jobs an evaluation, a few numbers per block and
    candidate reach the driver."""

    free = 3

    def __init__(self, blocks: DataFrame):
        self.blocks = blocks

        def about(batches):
            for b in batches:
                square = [(np.asarray(r.values) - m) ** 2 for r, m in zip(b.column("ret"), b.column("mean").to_pylist())]
                first = [float(backcast(np.sqrt(q)[None], np.array([len(q)]))[0]) if k == 0 else None for q, k in zip(square, b.column("block").to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column("stock_id"), pa.array([float(q.sum()) for q in square]), pa.array([len(q) for q in square], pa.int64()), pa.array(first, pa.float64())], names=["stock_id", "sum", "n", "s0"])

        got = blocks.mapInArrow(about, "stock_id string, sum double, n long, s0 double").groupBy("stock_id").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"), F.max("s0").alias("s0")).orderBy("stock_id").collect()
        self.names = [r["stock_id"] for r in got]
        self.var = np.maximum([r["sum"] / r["n"] for r in got], 1e-12)
        self.s0 = {r["stock_id"]: r["s0"] for r in got}

    def theta(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.column_stack([np.exp(x[:, 0]) * self.var[at], x[:, 1], x[:, 2], np.zeros(len(x))])

    def states(self, by_stock: dict[str, np.ndarray]) -> dict[tuple, tuple[np.ndarray, np.ndarray]]:
        def run(batches):
            for b in batches:
                out = []
                for stock, block, ret, mean in zip(*(b.column(c) for c in ("stock_id", "block", "ret", "mean"))):
                    theta = by_stock.get(stock.as_py())
                    if theta is not None:
                        square = (np.asarray(ret.values) - mean.as_py()) ** 2
                        s, d = block_end(square, theta)
                        out.append((stock.as_py(), block.as_py(), len(square), float(square[-1]), s.tolist(), d.ravel().tolist()))
                yield pa.RecordBatch.from_pylist([dict(zip(("stock_id", "block", "m", "square", "s", "d"), r)) for r in out], schema=pa.schema([("stock_id", pa.string()), ("block", pa.int64()), ("m", pa.int64()), ("square", pa.float64()), ("s", pa.list_(pa.float64())), ("d", pa.list_(pa.float64()))]))

        rows = self.blocks.mapInArrow(run, "stock_id string, block long, m long, square double, s array<double>, d array<double>").collect()
        ends = [(r["stock_id"], r["block"], r["m"], r["square"], np.array(r["s"]), np.array(r["d"]).reshape(3, -1)) for r in rows]
        return first_states(ends, self.s0, by_stock)

    def score(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        theta = self.theta(x, at)
        rows = {self.names[i]: np.flatnonzero(at == i) for i in np.unique(at)}
        by_stock = {s: theta[r] for s, r in rows.items()}
        first = self.states(by_stock)

        def run(batches):
            for b in batches:
                out = []
                for stock, block, ret, mean in zip(*(b.column(c) for c in ("stock_id", "block", "ret", "mean"))):
                    t = by_stock.get(stock.as_py())
                    if t is None:
                        continue
                    square, (s, d) = (np.asarray(ret.values) - mean.as_py()) ** 2, first[stock.as_py(), block.as_py()]
                    omega, alpha, beta = t[:, :3].T
                    f, g, h = np.zeros(len(t)), np.zeros((len(t), 3)), np.zeros((len(t), 3, 3))
                    for q in square:
                        s = np.maximum(s, 1e-12)
                        e = (d * np.stack([omega, np.ones(len(t)), np.ones(len(t))]) / s).T  # by log omega
                        f += 0.5 * (np.log(2 * np.pi * s) + q / s)
                        g += 0.5 * e * (1 - q / s)[:, None]
                        h += 0.5 * e[:, :, None] * e[:, None, :]
                        d = beta * d + np.stack([np.ones(len(t)), np.full(len(t), q), s])
                        s = omega + alpha * q + beta * s
                    out.append({"stock_id": stock.as_py(), "sums": np.concatenate([f[:, None], g, h.reshape(-1, 9)], axis=1).ravel().tolist()})
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("stock_id", pa.string()), ("sums", pa.list_(pa.float64()))]))

        total = np.zeros((len(x), 13))
        for r in self.blocks.mapInArrow(run, "stock_id string, sums array<double>").collect():
            total[rows[r["stock_id"]]] += np.array(r["sums"]).reshape(-1, 13)
        return total[:, 0], total[:, 1:4], total[:, 4:].reshape(-1, 3, 3)

    def loss(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.score(x, at)[0]


def fit_series(blocks: DataFrame) -> DataFrame:
    """``stock_id, omega, alpha, beta`` of each stock: those of one block in
    their task, longer ones by distributed sums."""

    def run(batches):
        for b in batches:
            eps, n = padded([np.asarray(r.values) - m for r, m in zip(b.column("ret"), b.column("mean").to_pylist())])
            theta = fit_rows(eps, n, False)[0] if len(n) else np.zeros((0, 4))
            yield pa.RecordBatch.from_arrays([b.column("stock_id"), *[pa.array(theta[:, j]) for j in range(3)]], names=["stock_id", "omega", "alpha", "beta"])

    schema = "stock_id string, omega double, alpha double, beta double"
    found = blocks.where("blocks = 1 AND size(ret) > 1").mapInArrow(run, schema)
    long = LongSeries(blocks.where("blocks > 1"))
    if not long.names:
        return found
    rows = len(long.names)
    starts = np.array([[np.log(max(1 - p, 1e-3)), a, p - a] for a, g, p in STARTS if not g])
    every = np.arange(rows)
    values = long.loss(np.tile(starts, (rows, 1)), np.repeat(every, len(starts))).reshape(rows, -1)
    best = np.argsort(values, axis=1)[:, :3]
    x, f = climb(long, starts[best].reshape(-1, 3), np.repeat(every, 3), 40)
    theta = long.theta(x.reshape(rows, 3, 3)[every, f.reshape(rows, 3).argmin(axis=1)], every)
    more = blocks.sparkSession.createDataFrame([(s, *map(float, t[:3])) for s, t in zip(long.names, theta)], schema)
    return found.unionByName(more)


def filtered(blocks: DataFrame, parameters: DataFrame) -> DataFrame:
    """``stock_id, time_id, y, r, n, sig``: the conditional variance of every
    return under its stock's ``omega, alpha, beta``; ``r`` counts a stock's
    returns from 1 to ``n``.  Block ends are computed first, joined in order,
    and every block is then filtered from its own first state."""
    rows = cut_lineage(blocks.join(parameters, "stock_id"))
    ends = "stock_id string, block long, m long, square double, s double, s0 double, omega double, alpha double, beta double"

    def to_ends(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                eps = np.array(r["ret"]) - r["mean"]
                s, _ = block_end(eps**2, np.array([[r["omega"], r["alpha"], r["beta"], 0.0]]))
                first = float(backcast(eps[None], np.array([len(eps)]))[0]) if r["block"] == 0 else 0.0
                out.append((r["stock_id"], r["block"], len(eps), float(eps[-1] ** 2), float(s[0]), first, r["omega"], r["alpha"], r["beta"]))
            kinds = (pa.string(), pa.int64(), pa.int64(), *[pa.float64()] * 6)
            names = [c.split()[0] for c in ends.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 9, kinds)], names=names)

    # a row per block; the scan along a stock's blocks as a running state
    cells = rows.mapInArrow(to_ends, ends).groupBy("stock_id").agg(F.array_sort(F.collect_list(F.struct("block", "m", "square", "s", "s0", "omega", "alpha", "beta"))).alias("v"))
    step = lambda acc, e: F.struct(
        F.concat(acc["firsts"], F.array(F.struct(e["block"], F.when(e["block"] == 0, F.greatest(e["s0"], F.lit(1e-12))).otherwise(acc["next"]).alias("first"), (acc["seen"]).alias("seen")))).alias("firsts"),
        (e["omega"] + e["alpha"] * e["square"] + e["beta"] * (F.pow(e["beta"], e["m"] - 1) * F.when(e["block"] == 0, F.greatest(e["s0"], F.lit(1e-12))).otherwise(acc["next"]) + e["s"])).alias("next"),
        (acc["seen"] + e["m"]).alias("seen"),
    )
    start = F.struct(F.array().cast("array<struct<block: bigint, first: double, seen: bigint>>").alias("firsts"), F.lit(0.0).alias("next"), F.lit(0).cast("bigint").alias("seen"))
    scanned = cells.select("stock_id", F.aggregate("v", start, step).alias("a")).select("stock_id", F.col("a.seen").alias("n"), F.explode("a.firsts").alias("f")).select("stock_id", "n", "f.*")

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                square = (np.array(r["ret"]) - r["mean"])[:, None] ** 2
                sig = variances(square, 0 * square, np.array([r["first"]]), np.array([[r["omega"], r["alpha"], r["beta"], 0.0]]))[:, 0]
                k = len(sig)
                yield pa.RecordBatch.from_arrays([pa.array([r["stock_id"]] * k), pa.array(r["time_id"], pa.int64()), pa.array(r["y"], pa.float64()), pa.array(np.arange(k) + r["seen"] + 1), pa.array([r["n"]] * k, pa.int64()), pa.array(sig)], names=["stock_id", "time_id", "y", "r", "n", "sig"])

    return rows.join(scanned, ["stock_id", "block"]).mapInArrow(run, "stock_id string, time_id bigint, y double, r long, n long, sig double")


def calibrated(variance: DataFrame, train_frac: float = 0.8) -> DataFrame:
    """``stock_id, time_id, y_true, y_pred, split``: the line of ``y`` on half the
    log variance, by least squares over each stock's first returns; a stock
    without a slope is predicted by the mean of its training values."""
    rows = variance.withColumn("train", F.col("r") <= F.greatest(F.floor(F.lit(float(train_frac)) * F.col("n")), F.lit(1))).withColumn("x", 0.5 * F.log(F.greatest("sig", F.lit(1e-12))))
    t = lambda c: F.when(F.col("train"), F.col(c))
    line = rows.groupBy("stock_id").agg(F.avg(t("x")).alias("mx"), F.avg(t("y")).alias("my"), F.covar_pop(t("x"), t("y")).alias("c"), F.var_pop(t("x")).alias("v"), F.min(t("x")).alias("low"), F.max(t("x")).alias("high"))
    slope = F.when((F.col("low") < F.col("high")) & (F.floor(F.lit(float(train_frac)) * F.col("n")) >= 2), F.col("c") / F.col("v")).otherwise(0.0)
    split = F.when(F.col("r") <= F.floor(F.lit(float(train_frac)) * F.col("n")), "train").otherwise("test")
    # one row per stock on the small side; the large side is dealt by its windows where a stock is hot
    return join_per_stock(rows, line).select("stock_id", "time_id", F.col("y").alias("y_true"), (F.col("my") + slope * (F.col("x") - F.col("mx"))).alias("y_pred"), split.alias("split"))


def join_per_stock(rows: DataFrame, per_stock: DataFrame, parts: int = 16) -> DataFrame:
    """Rows joined to one row per stock, each stock's rows in ``parts`` keys."""
    copies = per_stock.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return rows.withColumn("_part", F.pmod(F.xxhash64("time_id"), F.lit(parts)).cast("int")).join(copies, ["stock_id", "_part"]).drop("_part")


def legacy_garch(series: DataFrame) -> DataFrame:
    """Per stock, GARCH(1,1) with constant mean on 100 x log returns of
    the last WAP across windows (in time_id order), conditional variance
    calibrated to ``log_rv_second`` by least squares on the first 80 %.
    Input: ``stock_id, time_id, last_wap, log_rv_second`` (one row per window).
    Output: ``stock_id, time_id, y_true, y_pred, split``; a stock of one return
    is predicted by its value."""
    blocks = series_blocks(series)
    # a single return has no fit: any parameters do, its line has no slope
    single = blocks.where("blocks = 1 AND size(ret) = 1").selectExpr("stock_id", "1D AS omega", "0D AS alpha", "0D AS beta")
    return calibrated(filtered(blocks, fit_series(blocks).unionByName(single)))
