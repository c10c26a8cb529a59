"""The corpus pipeline: quality, exact copies, near copies, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volspark.llm import exact_dedup, jaccard_join, packing, pii, quality
from volspark.llm.common import table
from volspark.llm.queries import tokenizer_path
from volspark.session import scratch_path

#: The classifier and the tokenizer are not SQL; the stages are tested against
#: brute-force versions instead.
ORACLE_SQL = None

QUALITY_AT_LEAST = 0.3


def _rows(docs: DataFrame) -> DataFrame:
    """Every column in one struct, beside the id: later columns cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def _back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least QUALITY_AT_LEAST; learned
    on labelled documents outside the held-out fold."""
    return quality.keep(docs, quality.train(docs, table(spark, sf_dir, "labels"), "quality"), QUALITY_AT_LEAST)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that with the largest doc_id."""
    return exact_dedup.keep_unique(docs, exact_dedup.new_index(spark))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group, that with the smallest doc_id;
    rows without words or without id are no one's duplicates and stay."""
    groups = jaccard_join.group(docs)
    first = groups.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    rows = _rows(docs)
    named = rows.join(first, rows["_id"] == first["doc_id"], "left_semi")
    return _back(named.unionByName(rows.filter(F.col("_id").isNull())), docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the personal data in its text replaced by its kind."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece and its place in a sequence of 2048 tokens."""
    return packing.pack(docs, tokenizer_path(), capacity=2048)


STAGES = [
    ("quality_trees", quality_stage),
    ("exact_dedup", exact_stage),
    ("jaccard_rtree", near_stage),
    ("pii_weak_supervision", pii_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
