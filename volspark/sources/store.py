"""Feature table and run artifacts on storage (S5, S8, S9, S12, S13, S14,
S16, S17, A41, W10, O1).

The feature table is written as parquet partitioned by ``stock_id`` and sorted
by ``(stock_id, time_id)`` inside the files; reads prune columns and push the
stock filter down to the partition directories.  Writes go through Spark's
commit protocol (a failed job leaves no half-written table), and a small
manifest (counts per stock, config) is written next to it.
"""

from __future__ import annotations

import hashlib
import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FeatureConfig, feature_columns
from ..functions.quantiles import ranked_in_group
from ..session import cut_lineage, ensure_checkpoint_dir

_MEMO: dict[tuple, DataFrame] = {}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _code_version() -> str:
    """Hash of the modules that define the feature table, so a stored table
    is never reused by a different version of the kernel."""
    import os

    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha1()
    for rel in ("config.py", "operators/book.py", "operators/features.py", "sources/book.py", "functions/columns.py"):
        with open(os.path.join(here, rel), "rb") as fh:
            h.update(fh.read())
    return h.hexdigest()[:12]


def source_stamp(spark: SparkSession, source: str) -> str:
    """Length and modification time of the source files (cheap listing)."""
    fs, p = _fs(spark, source)
    stats = fs.listStatus(p)
    return ",".join(sorted(f"{st.getPath().getName()}:{st.getLen()}:{st.getModificationTime()}" for st in stats))


def config_key(cfg: FeatureConfig, source: str, stamp: str = "", salt: str = "") -> str:
    payload = json.dumps(
        {"source": source, "cfg": cfg.__dict__, "code": _code_version(), "stamp": stamp, "salt": salt},
        sort_keys=True, default=list,
    )
    return hashlib.sha1(payload.encode()).hexdigest()[:16]


def feature_table_path(spark: SparkSession, sf_dir: str, cfg: FeatureConfig = FeatureConfig()) -> str:
    base = ensure_checkpoint_dir(spark)
    salt = spark.conf.get("volspark.store.salt", "")
    key = config_key(cfg, sf_dir, source_stamp(spark, sf_dir), salt)
    return f"{base.rstrip('/')}/feature_table/{key}"


def manifest(features: DataFrame) -> DataFrame:
    """Rows and distinct windows per stock, plus a total row."""
    per = features.groupBy("stock_id").agg(
        F.expr("CAST(count(1) AS BIGINT) AS n_rows"), F.expr("CAST(count(DISTINCT time_id) AS BIGINT) AS n_windows")
    )
    total = features.agg(
        F.expr("CAST(count(1) AS BIGINT) AS n_rows"), F.expr("CAST(count(DISTINCT time_id) AS BIGINT) AS n_windows")
    ).select(F.lit("__all__").alias("stock_id"), "n_rows", "n_windows")
    return per.unionByName(total)


def write_feature_table(features: DataFrame, path: str, cfg: FeatureConfig = FeatureConfig(), mode: str = "overwrite",
                        manifest_path: str | None = None, row_group_bytes: int = 16 << 20) -> None:
    """S8 + O1: parquet partitioned by ``stock_id``, in ranges of (stock, window);
    then the manifest (A41) as JSON.  A task writes one range: a file per task
    and stock it meets, so files number at most tasks plus stocks, are sorted by
    window, and their row groups' statistics skip windows.  The rows are written
    once before, so that sampling the ranges does not run the kernel again."""
    spark = features.sparkSession
    ordered = cut_lineage(features).repartitionByRange("stock_id", "time_id").sortWithinPartitions("stock_id", "time_id")
    ordered.write.mode(mode).option("parquet.block.size", row_group_bytes).partitionBy("stock_id").parquet(path)
    written = spark.read.parquet(path)
    man = manifest(written).withColumn("created_at_utc", F.lit(datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")))
    man = man.withColumn("config", F.lit(json.dumps(cfg.__dict__, default=list)))
    man.coalesce(1).write.mode("overwrite").json(manifest_path or path + "_manifest")


def write_new_stocks(features: DataFrame, path: str) -> None:
    """S9 resume: write the stocks that carry no completion mark.  A stock is
    marked, in ``<path>_done``, after its partition is committed; rows of an
    unmarked stock come from a build that broke off and are overwritten."""
    spark = features.sparkSession
    marks = path + "_done"
    if path_exists(spark, marks):
        features = features.join(spark.read.schema("stock_id string").parquet(marks), "stock_id", "left_anti")
    features = cut_lineage(features)  # built once, for the table and for the marks
    writer = features.sortWithinPartitions("stock_id", "time_id").write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("stock_id").parquet(path)
    features.select("stock_id").distinct().write.mode("append").parquet(marks)


def load_feature_table(spark: SparkSession, path: str, columns=None, stocks=None, max_windows: int | None = None) -> DataFrame:
    """S5 + S16 + W10 + F2: read only the requested columns, only the
    requested stock partitions; refuse when a requested stock is missing;
    optionally the first ``max_windows`` windows per stock."""
    df = spark.read.parquet(path)
    if columns is not None:
        keep = ["stock_id", "time_id", *[c for c in columns if c not in ("stock_id", "time_id")]]
        df = df.select(*keep)
    if stocks:
        wanted = [s if str(s).startswith("stock_") else f"stock_{s}" for s in stocks]
        df = df.where(F.col("stock_id").isin(wanted))
        present = {r[0] for r in df.select("stock_id").distinct().collect()}  # <= len(stocks) rows
        missing = sorted(set(wanted) - present)
        if missing:
            raise ValueError(f"feature table has no rows for: {missing}")
    if max_windows is not None:
        # ranks of the keys alone, from range partitions: a stock may have any number of windows
        keys = ranked_in_group(df.select("stock_id", "time_id"), "stock_id", "time_id")
        df = df.join(keys.where(f"_r <= {int(max_windows)}").select("stock_id", "time_id"), ["stock_id", "time_id"], "left_semi")
    return df


def materialized_features(spark: SparkSession, sf_dir: str, build, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """The feature table for ``sf_dir``: built once with ``build()`` and
    written under the session's shared checkpoint folder, then read back.
    Downstream plans start from the stored table instead of re-running the
    per-second kernel in every branch."""
    path = feature_table_path(spark, sf_dir, cfg)
    key = (id(spark), path)
    if key in _MEMO:
        return _MEMO[key]
    if not path_exists(spark, path + "/_SUCCESS"):
        # publish atomically: write a private folder, then rename it into
        # place; if another job published first, its table is used
        import uuid

        tmp = f"{path}.tmp-{uuid.uuid4().hex[:8]}"
        write_feature_table(build(), tmp, cfg, manifest_path=f"{tmp}/_manifest")
        fs, _ = _fs(spark, path)
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        moved = not fs.exists(target) and fs.rename(jvm.org.apache.hadoop.fs.Path(tmp), target)
        if not moved and not path_exists(spark, path + "/_SUCCESS"):
            raise RuntimeError(f"the feature table could not be published as {path}; it was written to {tmp}")
    df = spark.read.parquet(path).select("stock_id", "time_id", "target_var", "target_vol", *feature_columns(cfg))
    _MEMO[key] = df
    return df


#: The frames of a run and their columns.
RUN_FRAMES = {
    "predictions": "model string, model_type string, fold int, stock_id string, time_id bigint, pred_var double, pred_vol double, actual_var double, "
    "actual_vol double, inference_ms double, feature_cols string, prediction_kind string, forecast_seconds string, forecast_vol_path string",
    "metrics": "fold int, model string, n bigint, mse double, rmse double, mae double, mape double, rmspe double, qlike double, pearson_r double",
    "feature_importance": "model string, fold int, feature string, importance double",
    "universe_summary": "stock_id string, mean_volatility double, mean_variance double, n_windows bigint, best_model string, "
    "mse double, rmse double, mae double, mape double, rmspe double, qlike double",
    "stock_similarity": "stock_a string, stock_b string, corr double",
}


class RunStore:
    """Runs as folders of Parquet frames with a config and a status document
    (S12-S14).  The status is written last: a run without one broke off."""

    def __init__(self, spark: SparkSession, runs_dir: str):
        self.spark, self.runs_dir = spark, runs_dir.rstrip("/")

    def _has(self, *parts: str) -> bool:
        return path_exists(self.spark, "/".join([self.runs_dir, *parts]))

    def _documents(self, name: str) -> DataFrame:
        """``run_id, doc`` of every run that has the document; whatever it holds."""
        folder = f"{self.runs_dir}/*/{name}"
        fs, p = _fs(self.spark, folder)
        if not self._has() or not fs.globStatus(p):
            return self.spark.createDataFrame([], "run_id string, doc string")
        run = F.regexp_extract(F.col("_metadata.file_path"), rf"/([^/]+)/{name}/[^/]*$", 1)
        return self.spark.read.option("wholetext", True).text(folder).select(run.alias("run_id"), F.col("value").alias("doc"))

    def write(self, run_id: str, frames: dict[str, DataFrame], config: dict, status: dict) -> None:
        """The five frames, the config, and at last the status."""
        missing = set(RUN_FRAMES) - set(frames)
        if missing:
            raise ValueError(f"a run has the frames {', '.join(RUN_FRAMES)}; missing: {', '.join(sorted(missing))}")
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{self.runs_dir}/{run_id}/{name}")
        for name, doc in (("config", config), ("status", status)):
            text = json.dumps(doc, default=str)
            self.spark.createDataFrame([(text,)], "doc string").coalesce(1).write.mode("overwrite").text(f"{self.runs_dir}/{run_id}/{name}")

    def runs(self) -> DataFrame:
        """``run_id, status, has_results``, newest first; a run whose status
        is missing or not readable has a null one."""
        if not self._has():
            return self.spark.createDataFrame([], "run_id string, status string, has_results boolean")
        fs, p = _fs(self.spark, self.runs_dir)
        found = [(f.getPath().getName(),) for f in fs.listStatus(p) if f.isDirectory()]
        rows = [(r, self._has(r, "metrics", "_SUCCESS") and self._has(r, "predictions", "_SUCCESS")) for (r,) in found]
        listed = self.spark.createDataFrame(rows, "run_id string, has_results boolean")
        status = self._documents("status").select("run_id", F.get_json_object("doc", "$.status").alias("status"))
        return listed.join(status, "run_id", "left").select("run_id", "status", "has_results").orderBy(F.desc("run_id"))

    def resolve(self, requested: str | None = None) -> str | None:
        """The requested run if there is one; else the newest completed one,
        else the newest with metrics and predictions, else None."""
        runs = self.runs()
        if requested:
            chosen = runs.where(F.col("run_id") == requested)
        else:
            grade = F.when(F.lower("status") == "completed", 0).when(F.col("has_results"), 1)
            chosen = runs.where(grade.isNotNull()).orderBy(grade, F.desc("run_id"))
        first = chosen.select("run_id").first()
        return first[0] if first else None

    def frame(self, name: str, run_id: str | None = None) -> DataFrame:
        """A frame of a run (of the resolved one by default); without rows,
        but with its columns, where it was not written to the end."""
        run = run_id or self.resolve()
        if run is None or not self._has(run, name, "_SUCCESS"):
            return self.spark.createDataFrame([], RUN_FRAMES[name])
        return self.spark.read.parquet(f"{self.runs_dir}/{run}/{name}")

    def config(self, run_id: str) -> dict:
        """The run's configuration, empty if it has none."""
        row = self._documents("config").where(F.col("run_id") == run_id).first()
        return json.loads(row["doc"]) if row else {}


def write_csv(df: DataFrame, path: str) -> None:
    """Result tables as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def melt_benchmarks(wide: DataFrame, id_col: str, value_cols: list[str], name: str = "metric", value: str = "value") -> DataFrame:
    """S17 (re-read side): wide benchmark table -> long ``(id, metric, value)``."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in value_cols)
    ids = [c.strip() for c in id_col.split(",")]
    return wide.selectExpr(*ids, f"stack({len(value_cols)}, {pairs}) AS ({name}, {value})")
