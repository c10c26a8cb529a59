"""Exact deduplication with a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 of the
normalised text.  New data is reduced to one row per digest (partial
aggregation before the shuffle, so a text that fills a third of the rows costs
one row per map task), deduplicated against the index by a sort-merge anti
join -- the index side is read by bucket, without an exchange -- and appended.
Built-in functions only.

Defined results: a null text equals the empty text; of equal texts of one
batch the largest doc_id stays (null ids rank below all others; a text that
only null ids carry keeps the null id); rows that share doc_id and text are
one record and get one decision; a text that is already indexed keeps the
document that the index names.  Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from volspark.llm.common import ascii_lower, texts_of
from volspark.session import cut_lineage, scratch_path

#: A digest is hot when it has at least this share of the rows; so there are
#: at most HOT_DIGESTS of them, and their decisions can be broadcast.
HOT_DIGESTS = 1000


def text_digest(text: Column) -> Column:
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256)


class DigestIndex:
    """Bucketed table ``(text_sha256, keep_id, group_size)`` in folder ``path``.

    The folder outlives the session: opening the same path with the same
    number of buckets in a later session continues the index.  ``group_size``
    counts the rows of the batch that brought the text.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"llm_digest_index_{zlib.crc32(path.encode()):08x}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (text_sha256 STRING, keep_id BIGINT, group_size BIGINT) "
            f"USING parquet CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {self.buckets} BUCKETS "
            f"LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, digests: DataFrame) -> None:
        """Add the digests of ``(doc_id, text_sha256)`` that are not indexed yet."""
        groups = digests.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        # An anti join, as an outer join and a null test: Catalyst would push a
        # left_anti below the aggregation and shuffle every copy of a hot text.
        known = self.table().select("text_sha256", F.lit(True).alias("known"))
        new = groups.join(known.hint("merge"), "text_sha256", "left").filter(F.col("known").isNull())
        new.select("text_sha256", "keep_id", "group_size").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)


def digests_of(docs: DataFrame) -> DataFrame:
    return texts_of(docs).select("doc_id", text_digest(F.col("text")).alias("text_sha256"))


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Index ``docs`` and return one row per document:
    ``doc_id, keep_id, group_size, kept, text_sha256``."""
    digests = cut_lineage(digests_of(docs))  # the texts are read once
    index.append(digests)
    known = index.table()
    total = digests.count()
    hot = known.filter(F.col("group_size") * HOT_DIGESTS >= max(total, 1))
    marked = digests.join(F.broadcast(hot), "text_sha256", "left")
    is_hot = F.col("group_size").isNotNull()
    cold = marked.filter(~is_hot).select("doc_id", "text_sha256").join(known.hint("merge"), "text_sha256")
    both = marked.filter(is_hot).unionByName(cold)
    return both.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index in a folder of its own under the shared one."""
    return DigestIndex(spark, scratch_path(spark, "digest-index"))


def keep_unique(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The documents that stay, with all their columns, one row per record."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("_id"), text_digest(F.col("text")).alias("_sha"))
    index.append(digests_of(docs))
    kept = index.table().select(F.col("text_sha256").alias("_k_sha"), F.col("keep_id").alias("_k_id"))
    joined = rows.join(kept.hint("merge"), (F.col("_sha") == F.col("_k_sha")) & F.col("_id").eqNullSafe(F.col("_k_id")), "left_semi")
    return joined.dropDuplicates(["_sha", "_id"]).select("row.*")
