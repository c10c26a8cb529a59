"""Session helpers: a local session for tests/bench and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: list[str] = []


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "volspark") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UTC, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("VOLSPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.codegen.methodSplitThreshold", "1024")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a single-process ``local`` master, where the driver is the executor,
    may do without the setting (one scratch folder per Python process then).
    On a cluster a missing setting is an error: a machine-local folder would
    be a different folder on every node.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL_SCRATCH:
        _LOCAL_SCRATCH.append(tempfile.mkdtemp(prefix="volspark-"))
    return _LOCAL_SCRATCH[0]


def scratch_path(spark: SparkSession, prefix: str) -> str:
    """A new, not yet existing folder name under the shared folder."""
    return f"{shared_dir(spark)}/{prefix}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Set the context's checkpoint folder to the shared one and return it."""
    path = shared_dir(spark)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back: later
    plans start from the files, which outlive any executor."""
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
