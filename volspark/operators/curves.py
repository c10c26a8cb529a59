"""Per-second series and forecast curves (W7, F12, F13, U7, J18, J19, P18,
P19, A46, O9).

Computed for every window at once (distributed by ``(stock_id, time_id)``);
a single-window page view is the same plan with an equality filter, which
Spark pushes down to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import stock_number
from .book import KEYS, book_runs, return_positions


def realised_series(book: DataFrame, horizon: int = 30, rolling: int = 30, min_periods: int = 5) -> DataFrame:
    """W7 + U7: rolling realised vol ``sqrt(mean(r^2))`` over the last
    ``rolling`` usable returns (at least ``min_periods``) of the whole series,
    labelled ``observed`` before the cutoff and ``heldout_actual`` after it;
    windows with at most ``horizon`` returns are skipped (F4, series form)."""
    pos = return_positions(book_runs(book))
    frame = f"PARTITION BY stock_id, time_id ORDER BY pos ROWS BETWEEN {rolling - 1} PRECEDING AND CURRENT ROW"
    rolled = pos.selectExpr(
        *KEYS,
        "pos",
        "n_total",
        "second",
        f"avg(ret * ret) OVER ({frame}) AS _ms",
        f"count(ret) OVER ({frame}) AS _cnt",
        f"min(CASE WHEN pos = n_total - {horizon} + 1 THEN second END) OVER (PARTITION BY stock_id, time_id) AS split_second",
    )
    return rolled.where(f"n_total > {horizon} AND _cnt >= {min_periods}").selectExpr(
        *KEYS,
        "second AS seconds_in_bucket",
        "sqrt(_ms) AS realized_vol",
        f"CASE WHEN pos <= n_total - {horizon} THEN 'observed' ELSE 'heldout_actual' END AS segment",
        "split_second",
        f"{horizon} AS forecast_horizon",
    )


def with_bridge(series: DataFrame) -> DataFrame:
    """The series with the last observed point of each window also as the
    first of its held-out segment (``bridge`` true), if it has both."""
    following = f"lead(segment) OVER (PARTITION BY {', '.join(KEYS)} ORDER BY seconds_in_bucket)"
    own = F.struct("segment", F.lit(False).alias("bridge"))
    again = F.struct(F.col("_next").alias("segment"), F.lit(True).alias("bridge"))
    meets = (F.col("segment") == "observed") & (F.col("_next") == "heldout_actual")
    points = F.explode(F.when(meets, F.array(own, again)).otherwise(F.array(own))).alias("_p")
    marked = series.selectExpr("*", f"{following} AS _next").select(*series.columns, points)
    return marked.select(*[F.col("_p.segment") if c == "segment" else F.col(c) for c in series.columns], "_p.bridge")


def json_list(col: str, element: str = "double") -> str:
    """Tolerant JSON list decode -- anything unparsable is an empty list."""
    return f"coalesce(try_cast(from_json({col}, 'array<{element}>') AS array<{element}>), CAST(array() AS array<{element}>))"


def prediction_curves(series: DataFrame, pred: DataFrame) -> DataFrame:
    """J18 + J19: horizon lines repeat ``pred_vol`` over the held-out seconds;
    GARCH paths zip their JSON seconds and volatilities, preceded by an anchor
    at the last observed point.  The series is read once: a window becomes one
    row with its held-out seconds (at most the horizon) and its anchor, and
    one join on the window serves both kinds of forecast."""
    point = F.struct(F.col("seconds_in_bucket"), F.col("realized_vol").alias("pred_vol"))
    observed = F.when(F.col("segment") == "observed", point)
    windows = series.groupBy(*KEYS).agg(
        F.array_sort(F.collect_list(F.when(F.col("segment") == "heldout_actual", F.col("seconds_in_bucket")))).alias("_held"),
        F.max(observed).alias("_anchor"),
    )
    is_path = F.coalesce("prediction_kind", F.lit("horizon_line")) == "garch_path"
    rows = pred.select(
        *KEYS, "model", "model_type", "pred_vol", F.when(is_path, "garch_path").otherwise("horizon_line").alias("prediction_kind"),
        F.expr(json_list("forecast_seconds", "int")).alias("_s"), F.expr(json_list("forecast_vol_path")).alias("_v"),
    ).join(windows, KEYS, "left")
    points = F.expr(
        """CASE WHEN prediction_kind = 'garch_path' THEN
               CASE WHEN size(_s) > 0 AND size(_v) > 0 THEN concat(
                   filter(array(_anchor), p -> p IS NOT NULL),
                   transform(filter(arrays_zip(_s, _v), z -> z._s IS NOT NULL AND z._v IS NOT NULL AND NOT isnan(z._v) AND abs(z._v) < double('inf')),
                             z -> named_struct('seconds_in_bucket', z._s, 'pred_vol', z._v))) END
           WHEN pred_vol IS NOT NULL AND NOT isnan(pred_vol) AND abs(pred_vol) < double('inf') THEN
               transform(_held, s -> named_struct('seconds_in_bucket', s, 'pred_vol', pred_vol)) END"""
    )
    return rows.select(*KEYS, "model", "model_type", "prediction_kind", F.explode(points).alias("_p")).select(
        *KEYS, "model", "model_type", "_p.seconds_in_bucket", "_p.pred_vol", "prediction_kind"
    )


def window_payload(series: DataFrame, curves: DataFrame) -> DataFrame:
    """Per window, ordered JSON arrays of seconds and values for the
    observed series, the held-out series and each model curve."""
    s = series.selectExpr(*KEYS, "segment AS curve", "seconds_in_bucket", "realized_vol AS value")
    c = curves.selectExpr(*KEYS, "model AS curve", "seconds_in_bucket", "pred_vol AS value")
    both = s.unionByName(c)
    grouped = both.groupBy(*KEYS, "curve").agg(
        F.expr("array_sort(collect_list(struct(seconds_in_bucket, value))) AS _pts")
    )
    return grouped.selectExpr(
        *KEYS,
        "curve",
        "to_json(transform(_pts, p -> p.seconds_in_bucket)) AS seconds_json",
        "to_json(transform(_pts, p -> round(p.value, 6))) AS values_json",
        "size(_pts) AS n_points",
    )


def first_keys_with_forced(df: DataFrame, key: str, n: int, forced) -> DataFrame:
    """The first ``n`` distinct keys in numeric order, the forced key
    always included (it sorts first)."""
    number = stock_number(key) if key == "stock_id" else F.col(key).cast("bigint")
    order = [(F.col(key) != F.lit(forced)).cast("int"), number, F.col(key)]
    return df.join(df.select(key).distinct().orderBy(*order).limit(int(n)), key, "left_semi")
