"""Exact top-k inner products by tiled matrix products.

Queries are dealt to blocks and candidates to shards by a hash of the id (not
of the vector, so repeated vectors do not pile up).  Each (block, shard) cell
is one cogrouped task that multiplies tiles of the two, selects k per query
and tile, and returns k rows per query; the lists of a query are then merged
in a tree of fixed fan-in.  A cell holds at most about ``query_block`` queries
and ``shard_rows`` candidates, whatever the size of the tables.

Defined results: a vector that is null or holds a null or non-finite component,
and a row with a null id, takes no part; vectors are compared with those of the
same length; rows with the query's own id are never its candidates; of equal
scores the smaller id comes first; repeated candidate ids are separate rows,
while repeated query ids are one query (its smallest vector in array order).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT = 2.0**53


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id, v`` with v = floor(scale * x) per component, valid rows only."""
    big = F.lit(float("inf"))
    return (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x"))
        .filter(F.col("id").isNotNull() & F.col("x").isNotNull())
        .filter(F.coalesce(F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)), F.lit(False)))
        .select("id", F.size("x").alias("dim"), F.transform("x", lambda x: F.floor(x * scale).cast("double")).alias("v"))
    )


def _matrix(t: pa.Table, prefix: str = "") -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of one side, by ascending id."""
    if not len(t):
        return np.zeros(0, np.int64), np.zeros((0, 0))
    ids = t[prefix + "id"].to_numpy()
    flat = pa.concat_arrays([c.flatten() for c in t[prefix + "v"].chunks]).to_numpy()
    m = flat.reshape(len(ids), -1) if flat.size else np.zeros((len(ids), 0))
    order = np.argsort(ids, kind="stable")
    return ids[order], m[order]


def best_of_tile(q_ids, q, c_ids, c, k: int):
    """The k best (score, id) per query; c is sorted by id, so the first of
    equal maxima is the one with the smallest id."""
    if max(np.abs(q).max(initial=0), 1) * max(np.abs(c).max(initial=0), 1) * max(q.shape[1], 1) < EXACT:
        scores, low = q @ c.T, -np.inf
    else:
        scores, low = q.astype(np.int64) @ c.astype(np.int64).T, np.iinfo(np.int64).min
    scores[q_ids[:, None] == c_ids[None, :]] = low
    rows, out = np.arange(len(q_ids)), []
    for _ in range(min(k, len(c_ids))):
        at = scores.argmax(axis=1)
        best = scores[rows, at]
        ok = best != low
        out.append((q_ids[ok], best[ok].astype(np.int64), c_ids[at[ok]]))
        scores[rows, at] = low
    return out


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256, query_block: int = 8192, shard_rows: int = 65536, tile: tuple[int, int] = (512, 4096), fan_in: int = 16) -> DataFrame:
    """``query_id, rank, <id_col>, score`` of the k best candidates of every
    row for which ``is_query`` (an expression over ``id``) holds."""
    spark = vectors.sparkSession
    v = quantised(vectors, id_col, vec_col, scale)
    asked = v.filter(is_query)
    n_q, n_c = asked.count(), v.count()
    blocks = max(1, -(-n_q // query_block))
    shards = max(4 * spark.sparkContext.defaultParallelism, -(-n_c // shard_rows))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    left = asked.groupBy("id", "dim").agg(F.min("v").alias("v"))
    left = left.withColumn("block", deal(blocks)).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = v.withColumn("shard", deal(shards)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "block", "shard"]
    left = left.select(*keys, "id", "v")
    right = right.select(*[F.col(c).alias(f"c_{c}") for c in (*keys, "id", "v")])

    def cell(key, lt: pa.Table, rt: pa.Table) -> pa.Table:
        q_ids, q = _matrix(lt)
        c_ids, c = _matrix(rt, "c_")
        if not len(q_ids) or not len(c_ids):
            q_ids = q_ids[:0]
        found = []
        for i in range(0, len(q_ids), tile[0]):
            part = []
            for j in range(0, len(c_ids), tile[1]):
                part += best_of_tile(q_ids[i : i + tile[0]], q[i : i + tile[0]], c_ids[j : j + tile[1]], c[j : j + tile[1]], k)
            if part:
                a, s, b = (np.concatenate(x) for x in zip(*part))
                order = np.lexsort((b, -s, a))
                a, s, b = a[order], s[order], b[order]
                start = np.r_[0, np.flatnonzero(a[1:] != a[:-1]) + 1] if len(a) else np.zeros(0, int)
                rank = np.arange(len(a)) - np.repeat(start, np.diff(np.r_[start, len(a)]))
                found.append((a[rank < k], s[rank < k], b[rank < k]))
        a, s, b = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        shard = int(key[2].as_py()) if hasattr(key[2], "as_py") else int(key[2])
        return pa.table({"query_id": pa.array(a, pa.int64()), "shard": pa.array(np.full(len(a), shard), pa.int32()), "score": pa.array(s, pa.int64()), "id": pa.array(b, pa.int64())})

    lists = left.groupBy(*keys).cogroup(right.groupBy(*[f"c_{c}" for c in keys])).applyInArrow(cell, "query_id long, shard int, score long, id long")
    n, last = shards, False
    while not last:
        last, n = n <= fan_in, -(-n // fan_in)
        merged = lists.withColumn("shard", F.floor(F.col("shard") / fan_in).cast("int")).groupBy("query_id", "shard").agg(
            F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("neg"), "id"))), 1, k).alias("top")
        )
        if last:
            ranked = merged.select("query_id", F.posexplode("top").alias("pos", "hit"))
            return ranked.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.id").alias(id_col), (-F.col("hit.neg")).alias("score"))
        lists = merged.select("query_id", "shard", F.explode("top").alias("hit")).select("query_id", "shard", (-F.col("hit.neg")).alias("score"), F.col("hit.id").alias("id"))
