"""Volatility forecasters on the feature table
and the legacy models per cluster and per stock (M15).

Every learner trains on ``target_vol = sqrt(target_var)`` and reports
``pred_vol`` (floored, P13) and ``pred_var = pred_vol^2``.  The linear family
and all principal components come from sufficient statistics
(:mod:`.linear`): one pass gives the moments of every fold.  Trees of all folds
(or clusters, or stocks) and models are grown together by :mod:`.trees`.

``inference_ms`` is null: a lazy plan has no per-row predict call to time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HAR_COLUMNS, LINEAR_FLOOR_MODELS, MIN_PRED_VOL, PRED_VOL_FLOOR_QUANTILE, ModelSpec, columns_for_labels
from ..functions.quantiles import complement_quantile, ranked_in_group
from ..session import cut_lineage
from . import linear as LN
from . import trees as TR
from .trees import Learner

KEEP = ["stock_id", "time_id", "fold", "target_var", "target_vol"]


def usable_feature_list(usable: DataFrame) -> list[str]:
    """F8 result (one row per column, <= 255 rows) -> ordered column list."""
    return [r["column"] for r in usable.where("usable").orderBy("position").collect()]


#: Model type -> weights of the linear fit from its design and options.
LINEAR_SOLVERS = {
    "Linear Regression": lambda d, o: d.least_squares(),
    "HAR-RV": lambda d, o: d.least_squares(),
    "LASSO": lambda d, o: d.lasso(float(o.get("alpha", 0.01)), int(o.get("max_iter", 5000))),
    "Ridge Regression": lambda d, o: d.ridge(o["chosen_alpha"]),
}

#: Model type -> tree learner; option names as in the model catalogue.
TREE_LEARNERS = {
    "Decision Tree": lambda o: Learner("tree", depth=o.get("max_depth", 6), min_leaf=o.get("min_samples_leaf", 20)),
    "Random Forest": lambda o: Learner("forest", o.get("n_estimators", 60), o.get("max_depth"), seed=o.get("random_state", 42)),
    "XGBoost": lambda o: Learner(
        "boosted", o.get("n_estimators", 180), o.get("max_depth", 4), o.get("learning_rate", 0.05), o.get("subsample", 0.8),
        o.get("colsample_bytree", 0.8), l2=1.0, seed=o.get("random_state", 42),
    ),
}


def feature_choice(spec: ModelSpec, available: list[str], mode: str, manual=()) -> list[str]:
    """M2/M8: HAR-RV reads its own lags, manual models the labelled columns,
    the others every usable column; an empty choice means every column too."""
    wanted = list(HAR_COLUMNS) if spec.model_type == "HAR-RV" else []
    if not set(wanted) & set(available) and (spec.feature_mode or mode) == "Manual":
        wanted = columns_for_labels(spec.manual_features or manual, available)
    chosen = [c for c in wanted if c in set(available)]
    return chosen or available


def _result(scored: DataFrame, spec: ModelSpec, floors: dict[int, float], columns: list[str]) -> DataFrame:
    """D5 prediction rows from ``KEEP`` and a raw prediction ``raw``."""
    floor = F.lit(MIN_PRED_VOL)
    if spec.model_type in LINEAR_FLOOR_MODELS and floors:
        by_fold = F.create_map(*[F.lit(v) for f, q in floors.items() for v in (int(f), float(max(q, MIN_PRED_VOL)))])
        floor = F.coalesce(by_fold[F.col("fold").cast("int")], floor)
    vol = F.greatest(F.col("raw"), floor)
    return scored.select(
        F.lit(spec.name).alias("model"), F.lit(spec.model_type).alias("model_type"), F.col("fold").cast("int").alias("fold"), "stock_id", "time_id",
        (vol * vol).alias("pred_var"), vol.alias("pred_vol"), F.col("target_var").alias("actual_var"), F.col("target_vol").alias("actual_vol"),
        F.lit(None).cast("double").alias("inference_ms"), F.lit(",".join(columns)).alias("feature_cols"), F.lit("horizon_line").alias("prediction_kind"),
        F.lit("").alias("forecast_seconds"), F.lit("").alias("forecast_vol_path"),
    )


def _union(frames: list[DataFrame]) -> DataFrame | None:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


def run_models(features_with_fold: DataFrame, specs, cols: list[str], mode: str = "PCA", n_pca: int = 12, manual=()):
    """Every (fold, model) pair; returns (predictions, importance).

    Models that share columns and component count share one set of moments."""
    spark = features_with_fold.sparkSession
    groups: dict[tuple, list[ModelSpec]] = {}
    for spec in specs:
        use = tuple(feature_choice(spec, cols, mode, manual))
        k = (spec.n_pca_components or n_pca) if (spec.feature_mode or mode) == "PCA" else None
        groups.setdefault((use, k), []).append(spec)
    numbered = features_with_fold.withColumn("row", F.monotonically_increasing_id()).withColumn("draw", F.xxhash64("stock_id", "time_id"))
    wide = cut_lineage(LN.as_rows(numbered, cols, [*KEEP, "row", "draw"]))
    floors = complement_quantile(wide, "fold", "target_vol", PRED_VOL_FLOOR_QUANTILE)
    predictions, importance = [], []
    for (use, k), members in groups.items():
        use = list(use)
        at = [cols.index(c) for c in use]
        rows = wide if use == cols else wide.select(*KEEP, "row", "draw", F.transform(F.array(*[F.lit(i) for i in at]), lambda i: F.get("x", i)).alias("x"))
        moments = LN.fold_moments(rows, len(use), "target_vol", "fold")
        if not moments:
            continue
        total = None
        for m in moments.values():
            total = m if total is None else LN.Moments(total.n + m.n, total.s + m.s, total.ss + m.ss, m.shift)
        designs = {f: LN.Design(total - m, k) for f, m in moments.items() if total.n > m.n}
        names = use if k is None else [f"PC{i + 1}" for i in range(next(iter(designs.values())).basis.shape[1])] if designs else []
        alphas = LN.ridge_penalties(rows, designs, len(use), "target_vol", "fold") if any(s.model_type == "Ridge Regression" for s in members) else {}
        fitted = {}
        for spec in members:
            if spec.model_type in LINEAR_SOLVERS:
                solve = LINEAR_SOLVERS[spec.model_type]
                fitted[spec.name] = {f: (d, solve(d, {**spec.parameters, "chosen_alpha": alphas.get(f)})) for f, d in designs.items()}
                importance += [(spec.name, f, c, float(abs(v))) for f, (_, w) in fitted[spec.name].items() for c, v in zip(names, w)]
            elif spec.model_type not in TREE_LEARNERS:
                raise ValueError(f"no learner is registered for model type {spec.model_type!r}; known: {sorted([*LINEAR_SOLVERS, *TREE_LEARNERS])}")
        if fitted:
            scored = LN.predict(rows, KEEP, len(use), "fold", fitted)
            predictions += [_result(scored.where(F.col("model") == s.name), s, floors, names) for s in members if s.name in fitted]

        trees = {s.name: s for s in members if s.model_type in TREE_LEARNERS}
        if trees and designs:
            # a fold is a unit; its training rows are those of the other folds
            units = _union([
                LN.component_scores(rows, ["fold", "row", "draw", "target_vol"], len(use), design)
                .select(F.lit(str(f)).alias("unit"), "row", "draw", (F.col("fold") != f).alias("train"), F.col("t").alias("x"), F.col("target_vol").alias("y"))
                for f, design in designs.items()
            ])
            units = cut_lineage(units)  # sizes and rows are read from it
            fits = cut_lineage(TR.fit_units(units, {n: TREE_LEARNERS[s.model_type](s.parameters) for n, s in trees.items()}, len(names)))
            scored = rows.select(*KEEP, "row").join(fits.where("row IS NOT NULL").select("model", "row", "raw"), "row")
            predictions += [_result(scored.where(F.col("model") == n), s, floors, names) for n, s in trees.items()]
            gains = fits.where("feature IS NOT NULL").select("model", "unit", "feature", "weight").collect()  # folds x models x features
            importance += [(r["model"], int(r["unit"]), names[r["feature"]], r["weight"]) for r in gains]
    imp = spark.createDataFrame(importance, "model string, fold int, feature string, importance double") if importance else None
    return _union(predictions), imp


def pca_variance(features: DataFrame, cols: list[str], k: int) -> DataFrame:
    """M3: explained-variance ratios of the pooled, mean-imputed, standardised
    usable features (component, explained_variance_ratio)."""
    rows = LN.as_rows(features, cols, [])
    moments = LN.fold_moments(rows, len(cols))
    ratios: list[float] = []
    if moments:
        c = moments[0].centred
        sd = np.sqrt(np.maximum(np.diag(c), 0))
        corr = c / np.outer(np.where(sd > 0, sd, 1), np.where(sd > 0, sd, 1))
        values, _ = LN.principal(corr, max(1, min(int(k), len(cols))))
        ratios = (values / max(np.trace(corr), 1e-300)).tolist()
    return features.sparkSession.createDataFrame([(f"PC{i + 1}", float(r)) for i, r in enumerate(ratios)], "component string, explained_variance_ratio double")


def stock_pca_map(features: DataFrame, cols: list[str]) -> DataFrame:
    """M4: per-stock mean features -> drop constant -> impute -> scale -> PCA
    with ``min(stocks, features)`` components; one row per stock."""
    per = cut_lineage(features.groupBy("stock_id").agg(*[F.avg(c).alias(c) for c in cols]))
    span = per.agg(F.count(F.lit(1)).alias("_n"), *[F.expr(f"min(`{c}`) < max(`{c}`)").alias(c) for c in cols]).first()  # one row
    keep = [c for c in cols if span[c]]
    if span["_n"] < 2 or len(keep) < 2:
        return features.sparkSession.createDataFrame([], "stock_id string")
    rows = LN.as_rows(per, keep, ["stock_id"])
    moments = LN.fold_moments(rows, len(keep))[0]
    # a design without target: the target column is zero
    d = len(keep)
    padded = LN.Moments(moments.n, np.append(moments.s, 0.0), np.pad(moments.ss, ((0, 1), (0, 1))), np.append(moments.shift, 0.0))
    k = min(int(span["_n"]), d)
    out = LN.component_scores(rows, ["stock_id"], d, LN.Design(padded, k))
    return out.select("stock_id", *[F.col("t")[i].alias(f"PC{i + 1}") for i in range(k)])


# Explicit penalty grids for the cross-validated legacy models
# (the original relied on library default grids).
LEGACY_RIDGE_GRID = (1e-1, 1.0, 10.0)
LEGACY_LASSO_PENALTIES = 100
#: Most values that one group of linear fits holds, as doubles in several forms.
LINEAR_CELLS = 8_000_000


#: The legacy tree models.  The second boosted one grows the best leaf first and
#: draws no rows, as its library does unless told how often to draw.
LEGACY_TREES = {
    "DT": Learner("tree", depth=6),
    "RF": Learner("forest", 200),
    "XGB": Learner("boosted", 300, 6, 0.05, 0.8, 0.8, l2=1.0),
    "LGBM": Learner("boosted", 300, 6, 0.05, 1.0, 0.8, min_leaf=20, leaves=31),
}


def _cross_validated(moments: dict[int, LN.Moments], candidates, fit) -> float:
    """The candidate with the least mean squared error over the CV folds, from
    moments alone: the error of weights on a fold is a quadratic form."""
    total = None
    for m in moments.values():
        total = m if total is None else LN.Moments(total.n + m.n, total.s + m.s, total.ss + m.ss, m.shift)
    errors = np.zeros(len(candidates))
    for m in moments.values():
        design = LN.Design(total - m, None)
        shift = m.shift
        for i, w in enumerate(fit(design, candidates)):
            slope = w / design.scale
            # residual = (y - y0) - slope . (x - x0), with y0, x0 the training means
            v = np.append(-slope, 1.0)
            off = v @ (shift - np.append(design.mean, design.y_mean))
            errors[i] += v @ m.ss @ v + 2 * off * (v @ m.s) + off * off * m.n
    return candidates[int(np.argmin(errors))]


def _linear_zoo(folds: dict[int, LN.Moments]) -> dict[str, tuple[LN.Design, np.ndarray]]:
    """Least squares, LASSO (100 penalties down from the one that empties the
    model) and ridge, both chosen over the folds, from the folds' moments."""
    total = None
    for m in folds.values():
        total = m if total is None else LN.Moments(total.n + m.n, total.s + m.s, total.ss + m.ss, m.shift)
    design = LN.Design(total, None)
    top = float(np.abs(design.xy).max(initial=0) / design.n)
    grid = list(np.geomspace(top, top * 1e-3, LEGACY_LASSO_PENALTIES)) if top > 0 else [0.0]
    lasso = _cross_validated(folds, grid, lambda s, grid: s.lasso_path(grid))
    ridge = _cross_validated(folds, list(LEGACY_RIDGE_GRID), lambda s, grid: [s.ridge(a) for a in grid])
    return {"MLR": (design, design.least_squares()), "Lasso": (design, design.lasso_path([a for a in grid if a >= lasso])[-1]), "Ridge": (design, design.ridge(ridge))}


def _moments_of(x: np.ndarray, y: np.ndarray, cv: np.ndarray) -> dict[int, LN.Moments]:
    full = np.column_stack([x, y])
    shift = full.mean(axis=0)
    return {int(f): LN.Moments(float(len(z)), z.sum(axis=0), z.T @ z, shift) for f in np.unique(cv) for z in [full[cv == f] - shift]}


def linear_units(units: DataFrame, features: int, bound: int | None = None) -> DataFrame:
    """The linear legacy models of every unit (``unit, row, draw, train, x, y``),
    in the schema of :func:`.trees.fit_units`; units of more than ``bound``
    rows from moments that Spark adds up."""

    def whole(t: pa.Table) -> pa.Table:
        train = t["train"].to_numpy()
        if not train.any():
            return TR.empty_result()
        x = pa.concat_arrays([c.flatten() for c in t["x"].chunks]).to_numpy().reshape(len(t), features)
        y, row, cv, out = t["y"].to_numpy(), t["row"].to_numpy(), t["draw"].to_numpy() % 5, []
        for name, (design, w) in _linear_zoo(_moments_of(x[train], y[train], cv[train])).items():
            raw = design.y_mean + design.transform(x[~train]) @ w
            out.append(TR.result(t["unit"][0].as_py(), name, row[~train], raw, np.abs(w)))
        return pa.concat_tables(out)

    small, large, stats = TR.split_by_size(units, bound or TR.rows_in_a_group(features, LINEAR_CELLS))
    out = [small.groupBy("unit").applyInArrow(whole, TR.OUT)]
    for s in stats:
        if not s["n_train"]:
            continue
        own = large.where(F.col("unit") == s["unit"]).withColumn("cv", F.pmod("draw", F.lit(5)).cast("int"))
        fitted = _linear_zoo(LN.fold_moments(own.where("train"), features, "y", "cv"))
        asked = own.where("NOT train").withColumn("one", F.lit(0))
        scored = LN.predict(asked, ["unit", "row", "one"], features, "one", {n: {0: f} for n, f in fitted.items()})
        none = [F.lit(None).cast("int").alias("feature"), F.lit(None).cast("double").alias("weight")]
        out.append(scored.select("unit", "model", "row", "raw", *none))
        out.append(units.sparkSession.createDataFrame([(s["unit"], n, None, None, i, float(v)) for n, (_, w) in fitted.items() for i, v in enumerate(np.abs(w) / max(np.abs(w).sum(), 1e-300))], TR.OUT))
    return _union(out)


def legacy_units(data: DataFrame, feature_cols: list[str], label: str, group: str, min_rows: int = 100, train_frac: float = 0.8) -> DataFrame:
    """The rows of every fit: a unit per ``group`` and one per stock of at least
    ``min_rows`` rows.  Within a unit the windows up to the ordinal
    ``int(train_frac * n)`` of its distinct ``time_id`` are for training."""
    keep = [group, "stock_id", "time_id", "label"]
    rows = LN.as_rows(data.withColumn("label", F.col(label).cast("double")), feature_cols, keep)
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("draw", F.xxhash64("stock_id", "time_id")))
    bad = rows.where(F.col("label").isNull() | F.exists("x", lambda v: F.isnan(v))).count()
    if bad:
        raise ValueError(f"{bad} rows lack a feature or the label; impute or drop them before fitting")
    many = rows.groupBy("stock_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_rows).select("stock_id")
    of_group = rows.withColumn("unit", F.concat(F.lit(f"{group}:"), F.col(group).cast("string")))
    of_stock = rows.join(many, "stock_id", "left_semi").withColumn("unit", F.concat(F.lit("stock:"), "stock_id"))
    units = of_group.unionByName(of_stock)
    ids = ranked_in_group(units.select("unit", "time_id").distinct(), "unit", "time_id")
    split = ids.select("unit", "time_id", (F.col("_r") <= F.floor(F.lit(float(train_frac)) * F.col("_n"))).alias("train"))
    return cut_lineage(units.join(split, ["unit", "time_id"]).withColumn("y", F.col("label")))


def legacy_zoo(data: DataFrame, feature_cols: list[str], label: str = "log_rv_second", group: str = "cluster", trees: dict[str, Learner] | None = None, only: str | None = None):
    """The seven legacy models of every cluster and of every stock with at
    least 100 rows (of units whose name starts with ``only``, if given), all
    fitted in the same jobs.  Returns the predictions of
    the test rows ``(unit, model, stock_id, time_id, y_true, y_pred)``; a unit
    is ``<group>:<value>`` or ``stock:<id>``.  Rows with a missing feature or
    label are an error."""
    units, d = legacy_units(data, feature_cols, label, group), len(feature_cols)
    if only is not None:
        units = units.where(F.col("unit").startswith(only))
    inputs = units.select("unit", "row", "draw", "train", "x", "y")
    fits = linear_units(inputs, d).unionByName(TR.fit_units(inputs, trees or LEGACY_TREES, d))
    asked = units.where("NOT train").select("unit", "row", "stock_id", "time_id", F.col("y").alias("y_true"))
    return asked.join(fits.where("row IS NOT NULL").select("unit", "row", "model", F.col("raw").alias("y_pred")), ["unit", "row"]).drop("row")
