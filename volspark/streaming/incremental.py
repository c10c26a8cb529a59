"""Incremental feature build with Structured Streaming.

The original has no stream; this is the natural live form of the batch job:
book files arriving in a folder are read as a file stream, and every
micro-batch recomputes the windows that it touches from all their rows so far,
so a window may arrive in any number of files.  Rows and features are kept per
batch, in a folder of the batch's own that a replay overwrites; the newest
version of a window counts.  Rows lie in folders by span of ``SPAN`` windows, and
a batch reads only the spans it touches.  Progress lives in the checkpoint
location.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FeatureConfig
from ..operators.features import build_features
from ..sources.book import BOOK_SCHEMA

KEYS = ["stock_id", "time_id"]
#: Windows (consecutive ``time_id``) whose rows share a folder.
SPAN = 64


def absorb_batch(batch: DataFrame, table_path: str, epoch: int, cfg: FeatureConfig = FeatureConfig()) -> None:
    """Keep the batch's rows, then write the features of its windows."""
    spark = batch.sparkSession
    own = f"{table_path}/rows/epoch={epoch}"
    spanned = batch.where(F.col("time_id").isNotNull()).withColumn("span", F.floor(F.col("time_id") / SPAN))
    # a span's rows together, or every task leaves a file in every folder
    spanned.hint("rebalance", "span").write.mode("overwrite").partitionBy("span").parquet(own)
    touched = spark.read.schema(spanned.schema).parquet(own)
    spans = [r[0] for r in touched.select("span").distinct().collect()]  # folders of this batch
    kept = T.StructType([*spanned.schema.fields, T.StructField("epoch", T.IntegerType())])
    rows = spark.read.schema(kept).parquet(f"{table_path}/rows").where(F.col("span").isin(spans) & (F.col("epoch") <= epoch))
    known = rows.drop("epoch", "span").join(touched.select(*KEYS).distinct(), KEYS, "left_semi")
    build_features(known, cfg).write.mode("overwrite").parquet(f"{table_path}/features/epoch={epoch}")


def read_features(spark: SparkSession, table_path: str) -> DataFrame:
    """The newest version of every window (a window has a row per batch that
    touched it, so the ranking is over a handful of rows)."""
    df = spark.read.parquet(f"{table_path}/features")
    newest = F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.desc("epoch")))
    return df.withColumn("_newest", newest).where("_newest = 1").drop("_newest", "epoch")


def start_incremental_build(
    spark: SparkSession,
    source_dir: str,
    table_path: str,
    checkpoint: str,
    cfg: FeatureConfig = FeatureConfig(),
    files_per_batch: int = 16,
    available_now: bool = True,
):
    """Start the stream; with ``available_now`` it processes what is there
    and stops (``query.awaitTermination()`` to wait)."""
    stream = (
        spark.readStream.schema(BOOK_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source_dir)
    )

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        absorb_batch(batch, table_path, epoch_id, cfg)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
