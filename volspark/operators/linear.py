"""Linear forecasters from sufficient statistics.

One pass over the data gives, per fold, the count, the sums and the
cross-products of the features and the target about a common shift.  The
training set of a fold is the total less the fold, so scaling, principal
components (a symmetric eigen-decomposition of the d x d correlation matrix),
least squares, ridge and LASSO of all folds follow on the driver from d x d
numbers (d <= 256); ridge's exact leave-one-out errors take one more pass for
all folds and penalties, and all predictions are made in a last one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..functions.arrays import PARTS, add_arrays, array_parts

RIDGE_ALPHAS = np.logspace(-4, 4, 25)


def as_rows(data: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """``keep`` columns and the features as one array ``x`` (NaN for null)."""
    return data.select(*keep, F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols]).alias("x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass
class Moments:
    """n, sum and cross-products of the columns about ``shift``."""

    n: float
    s: np.ndarray
    ss: np.ndarray
    shift: np.ndarray

    def __sub__(self, other: "Moments") -> "Moments":
        return Moments(self.n - other.n, self.s - other.s, self.ss - other.ss, self.shift)

    @property
    def mean(self) -> np.ndarray:
        return self.shift + self.s / max(self.n, 1)

    @property
    def centred(self) -> np.ndarray:
        """Sum of products of deviations from the mean."""
        return self.ss - np.outer(self.s, self.s) / max(self.n, 1)


def column_means(rows: DataFrame, width: int, y: str | None) -> np.ndarray:
    """Means of the present values of every feature (and of ``y``, last)."""

    def run(batches):
        total, count = np.zeros(width + 1), np.zeros(width + 1)
        for b in batches:
            x = matrix(b.column("x"), width)
            if y:
                x = np.column_stack([x, b.column(y).to_numpy(zero_copy_only=False)])
            ok = np.isfinite(x)
            total[: x.shape[1]] += np.where(ok, x, 0).sum(axis=0)
            count[: x.shape[1]] += ok.sum(axis=0)
        yield from array_parts({"total": total, "count": count}, TaskContext.get().partitionId())

    sums = add_arrays(rows.select("x", *([y] if y else [])).mapInArrow(run, PARTS))
    if not sums:
        return np.zeros(width + bool(y))
    return (sums["total"] / np.maximum(sums["count"], 1))[: width + bool(y)]


def fold_moments(rows: DataFrame, width: int, y: str | None = None, fold: str | None = None) -> dict[int, Moments]:
    """Moments per fold (one entry, 0, without ``fold``); ``y`` is the last
    column; missing values count as the column's mean."""
    shift = column_means(rows, width, y)
    m = len(shift)

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            x = matrix(b.column("x"), width)
            if y:
                x = np.column_stack([x, b.column(y).to_numpy(zero_copy_only=False)])
            x = np.where(np.isfinite(x), x - shift, 0.0)
            which = b.column(fold).to_numpy(zero_copy_only=False) if fold else np.zeros(len(x), int)
            for f in np.unique(which):
                z = x[which == f]
                part = np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).ravel()])
                sums[int(f)] = sums.get(int(f), 0) + part
        yield from array_parts({str(f): v for f, v in sums.items()}, TaskContext.get().partitionId())

    got = add_arrays(rows.select("x", *([y] if y else []), *([fold] if fold else [])).mapInArrow(run, PARTS))
    return {int(f): Moments(v[0], v[1 : 1 + m], v[1 + m :].reshape(m, m), shift) for f, v in sorted(got.items(), key=lambda e: int(e[0]))}


def principal(corr: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues and their vectors; the largest loading of each
    is positive, so the signs are defined."""
    values, vectors = np.linalg.eigh((corr + corr.T) / 2)
    order = np.argsort(-values, kind="stable")[:k]
    values, vectors = np.maximum(values[order], 0.0), vectors[:, order]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * np.where(sign == 0, 1.0, sign)


class Design:
    """Standardised (population deviation) features of a training set, or
    their leading principal components, with the normal equations."""

    def __init__(self, train: Moments, n_pca: int | None):
        c = train.centred
        d = c.shape[0] - 1
        self.n, self.mean, self.y_mean = train.n, train.mean[:d], float(train.mean[d])
        deviation = np.sqrt(np.maximum(np.diag(c)[:d], 0) / max(train.n, 1))
        self.scale = np.where(deviation > 0, deviation, 1.0)
        gram = c[:d, :d] / np.outer(self.scale, self.scale)
        xy = c[:d, d] / self.scale
        self.basis = np.eye(d)
        if n_pca is not None:
            self.basis = principal(gram / max(train.n, 1), max(1, min(int(n_pca), d, int(train.n))))[1]
        self.gram = self.basis.T @ gram @ self.basis
        self.xy = self.basis.T @ xy

    def transform(self, x: np.ndarray) -> np.ndarray:
        return (np.where(np.isfinite(x), x, self.mean) - self.mean) / self.scale @ self.basis

    def spectrum(self) -> tuple[np.ndarray, np.ndarray]:
        e, u = np.linalg.eigh((self.gram + self.gram.T) / 2)
        return np.maximum(e, 0.0), u

    def least_squares(self) -> np.ndarray:
        """The solution of least norm, also for dependent features."""
        e, u = self.spectrum()
        keep = e > e.max(initial=0) * len(e) * np.finfo(float).eps
        return u[:, keep] @ ((u[:, keep].T @ self.xy) / e[keep])

    def ridge(self, alpha: float) -> np.ndarray:
        e, u = self.spectrum()
        return u @ ((u.T @ self.xy) / (e + alpha))

    def lasso_path(self, alphas, rounds: int = 1000, tol: float = 1e-7) -> list[np.ndarray]:
        """Solutions for falling penalties, each started at the one before."""
        out: list[np.ndarray] = []
        for a in alphas:
            out.append(self.lasso(a, rounds, tol, out[-1] if out else None))
        return out

    def lasso(self, alpha: float, rounds: int = 5000, tol: float = 1e-10, start: np.ndarray | None = None) -> np.ndarray:
        """The minimum of 1/(2n) |y - Xw|^2 + alpha |w|_1: an active set with
        signs is solved exactly, the point moves towards that solution as far
        as it gets better, and the set changes until the conditions of
        optimality hold; after ``rounds`` / 10 changes by coordinate descent."""
        g, q = self.gram / self.n, self.xy / self.n
        w = np.zeros(len(q)) if start is None else start.copy()
        worth = lambda v: 0.5 * v @ (g @ v) - q @ v + alpha * np.abs(v).sum()
        near = tol + 1e-9 * np.abs(q).max(initial=0)
        sign = np.sign(w)
        for _ in range(max(rounds // 10, 50)):
            slope = g @ w - q
            if np.all(np.abs(slope + alpha * sign)[sign != 0] <= near):
                outside = np.where((sign == 0) & (np.diag(g) > 0), np.abs(slope) - alpha, -np.inf)
                j = int(outside.argmax()) if len(outside) else 0
                if not len(outside) or outside[j] <= near:
                    return w
                sign[j] = -np.sign(slope[j])
            on = np.flatnonzero(sign)
            inner = g[np.ix_(on, on)]
            to = np.zeros(len(q))
            to[on] = np.linalg.solve(inner + 1e-12 * np.trace(inner) / len(on) * np.eye(len(on)), q[on] - alpha * sign[on])
            # the points on the way where a coefficient becomes zero, and the end
            step = to - w
            with np.errstate(divide="ignore", invalid="ignore"):
                zero = np.where((w != 0) & (step != 0), -w / step, np.inf)
            crossings = [t for t in np.unique(zero) if 0 < t < 1]
            points = [np.where(zero == t, 0.0, w + t * step) for t in crossings] + [to]
            best = min(points, key=worth)
            if worth(best) >= worth(w) - 1e-15 * abs(worth(w)) and np.array_equal(np.sign(best), sign):
                w = best if worth(best) <= worth(w) else w
                break
            w, sign = best, np.sign(best)
        return self._descend(alpha, rounds, tol, w)

    def _descend(self, alpha: float, rounds: int, tol: float, w: np.ndarray) -> np.ndarray:
        g, q = self.gram / self.n, self.xy / self.n
        gw = g @ w
        for _ in range(rounds):
            change = 0.0
            for j in np.flatnonzero(np.diag(g) > 0):
                r = q[j] - gw[j] + g[j, j] * w[j]
                new = np.sign(r) * max(abs(r) - alpha, 0.0) / g[j, j]
                if new != w[j]:
                    gw += g[:, j] * (new - w[j])
                    change = max(change, abs(new - w[j]))
                    w[j] = new
            if change < tol:
                break
        return w


def ridge_penalties(rows: DataFrame, designs: dict[int, Design], width: int, y: str, fold: str, alphas=RIDGE_ALPHAS) -> dict[int, float]:
    """Per fold the penalty with the least exact leave-one-out error over the
    fold's training rows: the sum of (residual / (1 - leverage))^2."""
    spectra = {f: d.spectrum() for f, d in designs.items()}

    def run(batches):
        sums = {str(f): np.zeros(len(alphas)) for f in designs}
        for b in batches:
            x, target = matrix(b.column("x"), width), b.column(y).to_numpy(zero_copy_only=False)
            which = b.column(fold).to_numpy(zero_copy_only=False)
            for f, d in designs.items():
                train = which != f
                if not train.any():
                    continue
                e, u = spectra[f]
                t = d.transform(x[train]) @ u
                inverse = 1 / (e[:, None] + alphas[None, :])
                leverage = 1 / d.n + t**2 @ inverse
                fitted = t @ ((u.T @ d.xy)[:, None] * inverse)
                error = (target[train, None] - d.y_mean - fitted) / np.maximum(1 - leverage, 1e-12)
                sums[str(f)] += (error**2).sum(axis=0)
        yield from array_parts(sums, TaskContext.get().partitionId())

    errors = add_arrays(rows.select("x", y, fold).mapInArrow(run, PARTS))
    return {int(f): float(alphas[int(np.argmin(e))]) for f, e in errors.items()}


def predict(rows: DataFrame, keep: list[str], width: int, fold: str, models: dict[str, dict[int, tuple[Design, np.ndarray]]]) -> DataFrame:
    """``keep, model, raw``: for each model the prediction of the fold's own fit."""
    schema = rows.select(*keep).schema
    names = list(models)
    lines = {}
    for name, by_fold in models.items():
        for f, (d, w) in by_fold.items():
            slope = (d.basis @ w) / d.scale
            lines[name, f] = (slope, d.y_mean, d.mean)

    def run(batches):
        for b in batches:
            x, which = matrix(b.column("x"), width), b.column(fold).to_numpy(zero_copy_only=False)
            out = np.full((len(x), len(names)), np.nan)
            for j, name in enumerate(names):
                for f in np.unique(which):
                    if (name, int(f)) in lines:
                        slope, at, mean = lines[name, int(f)]
                        own = which == f
                        out[own, j] = at + (np.where(np.isfinite(x[own]), x[own], mean) - mean) @ slope
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(list(out), pa.list_(pa.float64()))], names=[*keep, "raw"])

    done = rows.mapInArrow(run, schema.add("raw", ArrayType(DoubleType())))
    label = F.array(*[F.lit(n) for n in names])
    return done.select(*keep, F.posexplode("raw").alias("_j", "raw")).select(*keep, label[F.col("_j")].alias("model"), "raw")


def component_scores(rows: DataFrame, keep: list[str], width: int, design: Design) -> DataFrame:
    """``keep`` and the transformed features ``t`` (array)."""
    schema = rows.select(*keep).schema

    def run(batches):
        for b in batches:
            t = design.transform(matrix(b.column("x"), width))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(list(t), pa.list_(pa.float64()))], names=[*keep, "t"])

    return rows.mapInArrow(run, schema.add("t", ArrayType(DoubleType())))
