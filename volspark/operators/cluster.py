"""Cluster validation statistics (A37-A40, A47, J14-J16, U5, F9, F11, M20,
M21).  Cluster labels are a small table ``(stock_id, cluster)`` joined on
``stock_id``; everything else is grouped aggregates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import group_quantiles, in_blocks
from ..session import cut_lineage
from . import linear as LN
from .legacy import _kurt, _skew

BEHAVIOUR = ["mean_rv", "std_rv", "skew_rv", "kurt_rv", "rv_autocorr", "p90_rv", "mean_rel_spread", "std_rel_spread", "mean_imbalance"]


def common_windows(rv: DataFrame) -> DataFrame:
    """Windows present for every stock (count of distinct stocks)."""
    n = rv.select(F.countDistinct("stock_id").alias("_n")).withColumn("_one", F.lit(1))
    per = rv.groupBy("time_id").agg(F.countDistinct("stock_id").alias("_c")).withColumn("_one", F.lit(1))
    return per.join(F.broadcast(n), "_one").where("_c = _n").select("time_id")


def cluster_rv_series(rv: DataFrame, labels: DataFrame) -> DataFrame:
    """A37 + J14: mean RV per (cluster, window) on the common windows."""
    common = rv.join(common_windows(rv), "time_id", "left_semi")
    return common.join(labels, "stock_id").groupBy("cluster", "time_id").agg(F.expr("avg(rv) AS mean_rv"))


def behaviour(rv: DataFrame, legacy: DataFrame) -> DataFrame:
    """The nine behavioural features per stock: moments of per-window RV
    (sample std, bias-corrected skew/kurtosis, lag-1 autocorrelation over
    ``time_id`` order, exact 90th percentile) and first-half spread and
    imbalance means."""
    w = "PARTITION BY stock_id, _block ORDER BY time_id"
    lagged = in_blocks(rv, "stock_id", "time_id", 1).selectExpr("*", f"lag(rv) OVER ({w}) AS rv_prev").where("_own")
    g = lagged.groupBy("stock_id").agg(
        F.expr("avg(rv) AS mean_rv"), F.expr("stddev_samp(rv) AS std_rv"), F.expr("count(rv) AS _n"),
        F.expr("skewness(rv) AS _g1"), F.expr("kurtosis(rv) AS _g2"), F.expr("var_pop(rv) AS _v"),
        F.expr("CASE WHEN count(rv_prev) > 1 AND stddev_pop(rv_prev) > 0 AND stddev_pop(CASE WHEN rv_prev IS NOT NULL THEN rv END) > 0 "
               "THEN covar_pop(rv_prev, CASE WHEN rv_prev IS NOT NULL THEN rv END) / (stddev_pop(rv_prev) * stddev_pop(CASE WHEN rv_prev IS NOT NULL THEN rv END)) END AS rv_autocorr"),
    )
    g = g.join(group_quantiles(rv, ["stock_id"], "rv", {"p90_rv": 0.9}), "stock_id", "left")
    spread = legacy.groupBy("stock_id").agg(
        F.expr("avg(mean_rel_spread) AS mean_rel_spread"), F.expr("avg(std_rel_spread) AS std_rel_spread"),
        F.expr("avg(mean_imbalance) AS mean_imbalance"),
    )
    return g.join(spread, "stock_id").selectExpr(
        "stock_id", "mean_rv", "std_rv",
        f"{_skew('_n', '_g1', '_v')} AS skew_rv", f"{_kurt('_n', '_g2', '_v')} AS kurt_rv",
        "rv_autocorr", "p90_rv", "mean_rel_spread", "std_rel_spread", "mean_imbalance",
    )


def standardised(feats: DataFrame) -> DataFrame:
    """``stock_id`` and the population z-scores of the behaviour columns; the
    means and deviations are one row."""
    number = {c: f"CAST({c} AS DOUBLE)" for c in BEHAVIOUR}
    stats = feats.agg(*[F.expr(f"struct(avg({x}) AS m, stddev_pop({x}) AS s) AS _{c}") for c, x in number.items()])
    return feats.join(F.broadcast(stats)).selectExpr("stock_id", *[f"({x} - _{c}.m) / nullif(_{c}.s, 0D) AS {c}" for c, x in number.items()])


def variance_ratio(feats: DataFrame, labels: DataFrame) -> DataFrame:
    """between = sum_c n_c |mean_c - grand|^2, within = sum |x - mean_c|^2
    on standardised features, and their ratio.  One aggregate per cluster, from
    which the grand means and the sums follow."""
    z = standardised(feats).join(labels, "stock_id")
    per = z.groupBy("cluster").agg(*[F.expr(f"struct(count({c}) AS n, avg({c}) AS m, var_pop({c}) * count({c}) AS w) AS {c}") for c in BEHAVIOUR])
    cells = per.selectExpr("cluster", "inline(array(" + ", ".join(f"struct('{c}' AS feature, {c}.n AS n, {c}.m AS m, {c}.w AS w)" for c in BEHAVIOUR) + "))").where("n > 0")
    grand = cells.groupBy("feature").agg(F.expr("sum(n * m) / sum(n) AS g"))  # one row per cluster and feature
    sums = cells.join(grand, "feature").agg(F.expr("sum(n * power(m - g, 2)) AS between_var"), F.expr("sum(w) AS within_var"))
    return sums.selectExpr("between_var", "within_var", "between_var / nullif(within_var, 0D) AS ratio")


def cluster_summary(feats: DataFrame, labels: DataFrame) -> DataFrame:
    """Stocks per cluster and their mean ``mean_rv``."""
    return feats.join(labels, "stock_id").groupBy("cluster").agg(
        F.expr("CAST(count(1) AS BIGINT) AS n_stocks"), F.expr("avg(mean_rv) AS mean_rv")
    )


def cluster_rmse(stock_losses: DataFrame, labels: DataFrame) -> DataFrame:
    """Average, least and largest RMSE of the stocks of a cluster, by model."""
    return stock_losses.join(labels, "stock_id").groupBy("cluster", "model").agg(
        F.expr("avg(rmse) AS avg_rmse"), F.expr("min(rmse) AS min_rmse"), F.expr("max(rmse) AS max_rmse"), F.expr("CAST(count(1) AS BIGINT) AS n_stocks")
    )


def win_rate(stock_losses: DataFrame, bench: DataFrame, labels: DataFrame, min_rows: int = 100) -> DataFrame:
    """J15 + A40 + F11: share of stocks (with at least ``min_rows`` rows)
    whose RMSE beats their cluster's benchmark RMSE (missing -> infinity)."""
    s = stock_losses.where(f"n >= {min_rows}").join(labels, "stock_id")
    j = s.join(bench, ["cluster", "model"], "left").selectExpr(
        "cluster", "model", "stock_id", "rmse < coalesce(bench_rmse, CAST('Infinity' AS DOUBLE)) AS beats"
    )
    return j.groupBy("cluster", "model").agg(
        F.expr("avg(CAST(beats AS DOUBLE)) AS win_rate"), F.expr("CAST(count(1) AS BIGINT) AS n_stocks")
    )


def loss_quartiles(stock_losses: DataFrame, labels: DataFrame, metric: str) -> DataFrame:
    """Box-plot five numbers of a per-stock loss by (cluster, model)."""
    q = stock_losses.join(labels, "stock_id").groupBy("cluster", "model").agg(
        F.expr(f"percentile({metric}, array(0D, 0.25D, 0.5D, 0.75D, 1D)) AS _q")
    )
    return q.selectExpr("cluster", "model", *[f"_q[{i}] AS {n}" for i, n in enumerate(("min", "q1", "median", "q3", "max"))])


def kmeans_silhouette(feats: DataFrame, ks=range(2, 7)) -> DataFrame:
    """M20 (re-aimed): k-means for k = 2..6 on standardised behaviour (a missing
    value counts as the mean, so no stock is left out), with MLlib's
    squared-Euclidean silhouette per k."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    z = cut_lineage(_components(feats, None)).withColumn("features", array_to_vector("t"))
    n = z.count()
    rows = []
    for k in ks:
        if k >= n:
            break
        model = KMeans(k=k, seed=42).fit(z)
        sil = ClusteringEvaluator().evaluate(model.transform(z))
        rows.append((int(k), float(sil)))
    return feats.sparkSession.createDataFrame(rows, "k int, silhouette double")


def silhouette_given(feats: DataFrame, labels: DataFrame, block: int = 1024) -> DataFrame:
    """Exact Euclidean silhouette of given labels on population z-scores (over
    the features that both stocks have).  Stocks are vectors dealt to blocks; a
    pair of blocks is one task, which returns each stock's sum of distances to
    the stocks of each cluster; the sums are added."""
    z = standardised(feats).join(labels, "stock_id").select("stock_id", "cluster", F.array(*[F.coalesce(c, F.lit(float("nan"))) for c in BEHAVIOUR]).alias("z"))
    z = cut_lineage(z.where(F.col("cluster").isNotNull()))
    blocks = max(1, -(-z.count() // block))
    z = z.withColumn("own", F.pmod(F.xxhash64("stock_id"), F.lit(blocks)).cast("int"))
    left = z.withColumn("a", F.col("own")).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = z.select(*[F.col(c).alias(f"r_{c}") for c in ("stock_id", "cluster", "z")], F.col("own").alias("r_b"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("r_a"))
    d = len(BEHAVIOUR)

    def tile(lt: pa.Table, rt: pa.Table) -> pa.Table:
        vectors = lambda c: pa.concat_arrays([v.flatten() for v in c.chunks]).to_numpy().reshape(-1, d) if len(c) else np.zeros((0, d))
        x, y = vectors(lt["z"]), vectors(rt["r_z"])
        ids, others, theirs = lt["stock_id"].to_pylist(), rt["r_stock_id"].to_pylist(), np.array(rt["r_cluster"].to_pylist())
        out = []
        for i in range(0, len(x), 128):
            gap = x[i : i + 128, None, :] - y[None, :, :]
            none = np.isnan(gap)
            far = np.sqrt(np.where(none, 0.0, gap**2).sum(axis=2))
            ok = ~none.all(axis=2) & (np.array(ids[i : i + 128], object)[:, None] != np.array(others, object)[None, :])
            for c in np.unique(theirs):
                on = ok & (theirs == c)
                n, total = on.sum(axis=1), (far * on).sum(axis=1)
                out += [(ids[i + j], lt["cluster"][i + j].as_py(), c.item(), float(total[j]), int(n[j])) for j in np.flatnonzero(n)]
        cols = list(zip(*out)) if out else [[]] * 5
        return pa.table({"stock_id": pa.array(cols[0], pa.string()), "ca": pa.array(cols[1], lt.schema.field("cluster").type), "cb": pa.array(cols[2], lt.schema.field("cluster").type), "total": pa.array(cols[3], pa.float64()), "n": pa.array(cols[4], pa.int64())})

    kind = z.schema["cluster"].dataType.simpleString()
    sums = left.groupBy("a", "b").cogroup(right.groupBy("r_a", "r_b")).applyInArrow(tile, f"stock_id string, ca {kind}, cb {kind}, total double, n long")
    means = sums.groupBy("stock_id", "ca", "cb").agg(F.expr("sum(total) / sum(n) AS md"))
    s = means.groupBy("stock_id", "ca").agg(
        F.expr("max(CASE WHEN ca = cb THEN md END) AS a_"), F.expr("min(CASE WHEN ca <> cb THEN md END) AS b_")
    ).selectExpr("CASE WHEN a_ IS NULL THEN 0D ELSE (b_ - a_) / greatest(a_, b_) END AS s")
    return s.agg(F.expr("avg(s) AS silhouette"))


def _components(feats: DataFrame, k: int | None) -> DataFrame:
    """``stock_id, t``: standardised behaviour, or its ``k`` leading components."""
    rows, d = LN.as_rows(feats, BEHAVIOUR, ["stock_id"]), len(BEHAVIOUR)
    found = LN.fold_moments(rows, d)
    if not found:
        return rows.select("stock_id", F.col("x").alias("t"))
    m = found[0]
    padded = LN.Moments(m.n, np.append(m.s, 0.0), np.pad(m.ss, ((0, 1), (0, 1))), np.append(m.shift, 0.0))
    return LN.component_scores(rows, ["stock_id"], d, LN.Design(padded, k))


def pca_2d(feats: DataFrame) -> DataFrame:
    """Two principal components of the standardised behaviour."""
    t = _components(feats, 2)
    return t.select("stock_id", F.get("t", F.lit(0)).alias("PC1"), F.get("t", F.lit(1)).alias("PC2"))
