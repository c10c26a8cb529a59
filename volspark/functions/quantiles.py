"""Exact quantiles without a buffer of all values and without one task per
group: values are range-partitioned and sorted (a large group is spread over
several partitions), ranks follow from per-partition counts, and only the rows
at the wanted ranks are read.  Linear interpolation, as ``percentile``."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def _sorted_rows(df: DataFrame, keep: list[str], order: list[str], value: str) -> DataFrame:
    """``keep, _v, _pid, _local`` in range partitions by ``order`` and value;
    written once, so that the positions are the same whenever they are read."""
    rows = df.select(*keep, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)")
    ranged = rows.repartitionByRange(*[F.col(k) for k in order], F.col("_v")).sortWithinPartitions(*order, "_v")
    place = F.monotonically_increasing_id()
    return cut_lineage(ranged.select("*", F.shiftright(place, 33).cast("int").alias("_pid"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_local")))


def group_quantiles(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """``keys`` and one column per named quantile; groups without values are absent."""
    rows = _sorted_rows(df, keys, keys, value)
    parts = rows.groupBy(*keys, "_pid").agg(F.min("_local").alias("_lo"), F.count(F.lit(1)).alias("_c"))
    per_key = Window.partitionBy(*keys)
    parts = parts.select("*", (F.sum("_c").over(per_key.orderBy("_pid")) - F.col("_c")).alias("_off"), F.sum("_c").over(per_key).alias("_n"))
    asked = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(q)).alias("q")) for n, q in quantiles.items()])).alias("_a")
    wanted = parts.select("*", asked).select("*", (F.col("_a.q") * (F.col("_n") - 1)).alias("_pos"))
    wanted = wanted.select("*", F.explode(F.array_distinct(F.array(F.floor("_pos"), F.ceil("_pos")))).alias("_r")).where("_r >= _off AND _r < _off + _c")
    wanted = wanted.select(*keys, "_pid", F.col("_a.name").alias("_name"), "_pos", "_r", (F.col("_lo") + F.col("_r") - F.col("_off")).alias("_local"))
    found = rows.join(wanted, [*keys, "_pid", "_local"])
    # weights of the two ranks around the position
    weight = F.lit(1.0) - F.abs(F.col("_pos") - F.col("_r"))
    return found.groupBy(*keys).agg(*[F.sum(F.when(F.col("_name") == n, F.col("_v") * weight)).alias(n) for n in quantiles])


def complement_quantile(df: DataFrame, fold: str, value: str, q: float) -> dict:
    """For every fold the ``q`` quantile of the values of all other folds.

    Only counts per (range partition, fold) reach the driver."""
    rows = _sorted_rows(df, [fold], [], value)
    counts = rows.groupBy("_pid", fold).agg(F.count(F.lit(1)).alias("c")).collect()
    total: dict[int, int] = {}
    own: dict[tuple, int] = {}
    for r in counts:
        total[r["_pid"]] = total.get(r["_pid"], 0) + r["c"]
        own[r["_pid"], r[fold]] = r["c"]
    folds = sorted({r[fold] for r in counts})
    wanted, place = [], {}
    for f in folds:
        n = sum(c for p, c in total.items()) - sum(c for (p, g), c in own.items() if g == f)
        if n < 1:
            continue
        pos = q * (n - 1)
        place[f] = pos
        for rank in {math.floor(pos), math.ceil(pos)}:
            seen = 0
            for p in sorted(total):
                c = total[p] - own.get((p, f), 0)
                if rank < seen + c:
                    wanted.append((f, p, rank - seen + 1, rank))
                    break
                seen += c
    if not wanted:
        return {}
    small = df.sparkSession.createDataFrame(wanted, "for_fold int, _pid int, nth int, rank long")
    near = rows.join(F.broadcast(small.select("for_fold", "_pid").distinct()), "_pid").where(F.col(fold) != F.col("for_fold"))
    nth = near.withColumn("nth", F.row_number().over(Window.partitionBy("for_fold", "_pid").orderBy("_local")))
    got = nth.join(F.broadcast(small), ["for_fold", "_pid", "nth"]).select("for_fold", "rank", "_v").collect()
    out = dict.fromkeys(place, 0.0)
    for r in got:
        out[r["for_fold"]] += r["_v"] * (1.0 - abs(place[r["for_fold"]] - r["rank"]))
    return out


def ranked_in_group(df: DataFrame, group: str, order: str) -> DataFrame:
    """``df`` with ``_r``, the 1-based rank of the row in its group by ``order``
    (ties in any order), and ``_n``, the group's size -- without a window over
    a whole group: a large group is spread over range partitions."""
    ranged = df.repartitionByRange(F.col(group), F.col(order)).sortWithinPartitions(group, order)
    place = F.monotonically_increasing_id()
    rows = cut_lineage(ranged.select("*", F.shiftright(place, 33).cast("int").alias("_pid"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_local")))
    parts = rows.groupBy(group, "_pid").agg(F.min("_local").alias("_lo"), F.count(F.lit(1)).alias("_c"))
    per = Window.partitionBy(group)
    parts = parts.select(group, "_pid", "_lo", (F.sum("_c").over(per.orderBy("_pid")) - F.col("_c")).alias("_off"), F.sum("_c").over(per).alias("_n"))
    return rows.join(parts, [group, "_pid"]).withColumn("_r", F.col("_off") + F.col("_local") - F.col("_lo") + 1).select(*df.columns, "_r", "_n")


def in_blocks(df: DataFrame, group: str, order: str, halo: int, block: int = 4096, rank: str | None = None) -> DataFrame:
    """``df`` with ``_block`` and ``_own``: each group cut into blocks of rows
    consecutive in ``order``; the last ``halo`` rows of a block also stand, not
    own, at the head of the next one.  A window over ``(group, _block)`` that
    looks at most ``halo`` rows back is then right on the own rows, and no task
    holds more than a block of a large group.  ``rank`` names a column for the
    row's rank in its group."""
    ranked = ranked_in_group(df, group, order)
    at = F.floor((F.col("_r") - 1) / block).cast("long")
    tail = (F.col("_r") - 1) % block >= block - halo
    copies = F.explode(F.when(tail, F.array(at, at + 1)).otherwise(F.array(at))).alias("_block")
    ranks = [F.col("_r").alias(rank)] if rank else []
    names = [*df.columns, *([rank] if rank else [])]
    return ranked.select(*df.columns, *ranks, at.alias("_home"), copies).select(*names, "_block", (F.col("_home") == F.col("_block")).alias("_own"))
