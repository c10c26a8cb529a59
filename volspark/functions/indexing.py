"""Global ordinal index without a single-partition window.

``row_number()`` over an un-partitioned window moves every row into one task.
Here the keys are range-partitioned and sorted, each row gets its rank inside
its partition from ``monotonically_increasing_id``, and a per-partition offset
table (one row per partition -- its size is bounded by the partition count,
so broadcasting it is safe) turns that into a global index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def ordered_index(keys: DataFrame, order_cols: list[str], name: str = "idx", partitions: int | None = None) -> DataFrame:
    """Append a 0-based ``name`` by ascending ``order_cols`` and a column
    ``n_rows`` with the total count.  ``keys`` should hold distinct keys."""
    spark = keys.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = keys.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    # written once, so that the positions are the same whenever they are read
    tagged = cut_lineage(ranged.select(
        "*",
        F.spark_partition_id().alias("_pid"),
        F.monotonically_increasing_id().alias("_mid"),
    )).withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_c").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
        F.sum("_c").over(Window.partitionBy(F.lit(0))).alias("n_rows"),
    )
    out = tagged.join(F.broadcast(offsets), "_pid")
    return out.select(
        *keys.columns, (F.col("_off") + F.col("_local")).alias(name), "n_rows"
    )


def ntile_from_index(idx: str, n: str, k: str) -> str:
    """SQL for ``ntile(k)`` given a 0-based index: the first ``n % k`` tiles
    hold one extra row (same sizes as ``numpy.array_split``)."""
    q = f"({n} DIV {k})"
    r = f"({n} % {k})"
    big = f"({r} * ({q} + 1))"
    return f"CAST(CASE WHEN {idx} < {big} THEN {idx} DIV ({q} + 1) + 1 ELSE {r} + ({idx} - {big}) DIV {q} + 1 END AS INT)"
