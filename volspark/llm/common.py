"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id's decimal text modulo ``mod``; -1 for a null id, which
    therefore belongs to no held-out fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod, F.lit(-1)).cast("int")


def texts_of(docs: DataFrame) -> DataFrame:
    """The two columns every text operator works on; a null text is empty.
    Taking only these keeps further columns, whatever their names, out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def give_back() -> None:
    """Return freed memory to the system: Python workers serve many stages, and
    what one leaves in its allocator counts against the next one's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def small(batches, rows: int = 500):
    """The Arrow batches in slices, so that a worker turns few texts at a time
    into Python objects."""
    seen = 0
    for b in batches:
        seen += b.num_rows
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
    if seen >= rows:
        give_back()


def numbered(words: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The distinct words, and each word's number among them."""
    coded = pa.array(words, pa.large_binary()).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


#: Arrays that tasks add up travel in chunks of this many numbers.
CHUNK = 8192
PARTS = "chunk int, task int, values array<double>"


def array_parts(values: np.ndarray, task: int):
    """Arrow batches of schema PARTS that hold ``values``."""
    for c in range(0, len(values), CHUNK):
        yield pa.RecordBatch.from_arrays([pa.array([c // CHUNK], pa.int32()), pa.array([task], pa.int32()), pa.array([values[c : c + CHUNK].astype(float)], pa.list_(pa.float64()))], names=["chunk", "task", "values"])


def in_few(rows: DataFrame) -> DataFrame:
    """``rows`` in at most twice as many partitions as there are cores: tasks that
    each leave a large array of sums then leave no more of them as the input grows."""
    return rows.coalesce(max(16, 2 * rows.sparkSession.sparkContext.defaultParallelism))


def add_arrays(parts: DataFrame, fan: int = 8) -> DataFrame:
    """Sums ``values`` by ``chunk`` over ``task``, in two rounds; the second moves
    at most ``fan`` arrays."""

    def add(t: pa.Table) -> pa.Table:
        total = np.sum([np.asarray(v) for v in t["values"].to_numpy()], axis=0)
        return pa.table({"chunk": pa.array([t["chunk"][0].as_py()], pa.int32()), "task": pa.array([t["task"][0].as_py()], pa.int32()), "values": pa.array([total], pa.list_(pa.float64()))})

    some = parts.withColumn("task", F.pmod("task", F.lit(fan)).cast("int")).groupBy("chunk", "task").applyInArrow(add, PARTS)
    return some.withColumn("task", F.lit(0)).groupBy("chunk", "task").applyInArrow(add, PARTS)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, most: int = 1000) -> DataFrame:
    """``rows`` joined to ``groups`` (one row per ``key``, with the number of
    rows of the key in ``size``).  Keys that hold 1 / ``most`` of the ``total``
    rows or more -- so at most ``most`` keys -- are joined by broadcast, the
    others by a shuffle in which no key is hot.  Both inputs are read twice."""
    hot = groups.filter(F.col(size) * most >= max(total, 1))
    marked = rows.join(F.broadcast(hot), key, "left")
    is_hot = F.col(size).isNotNull()
    cold = marked.filter(~is_hot).select(*rows.columns).join(groups, key)
    return marked.filter(is_hot).unionByName(cold)
