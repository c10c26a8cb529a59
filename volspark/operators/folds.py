"""Fold assignment and splits.

Folds are contiguous tiles of the sorted distinct ``time_id`` (or, shuffled,
of a seeded hash order), with ``numpy.array_split`` sizes.  The key table is
small (one row per distinct key) but it still never passes through one task:
the ordinal comes from :func:`volspark.functions.indexing.ordered_index`.
Train/test selection is a join with the fold table -- Spark picks broadcast
only when its runtime size allows (AQE), never by assumption.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SplitConfig
from ..functions.indexing import ntile_from_index, ordered_index
from ..functions.quantiles import ranked_in_group


def fold_table(df: DataFrame, split: SplitConfig = SplitConfig()) -> DataFrame:
    """W11 + U6: ``(key, fold)`` for every distinct key (``time_id`` by
    default, ``stock_id`` for the stock-held-out variant)."""
    key = split.by
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    if split.shuffle:
        keys = keys.withColumn("_o", F.xxhash64(F.col(key), F.lit(int(split.random_state))))
        order = ["_o", key]
    else:
        order = [key]
    indexed = ordered_index(keys, order)
    k = f"least(greatest(2, {int(split.n_folds)}), n_rows)"
    return indexed.selectExpr(key, f"{ntile_from_index('idx', 'n_rows', k)} AS fold")


def with_folds(df: DataFrame, split: SplitConfig = SplitConfig()) -> DataFrame:
    """Attach ``fold`` to every row (inner join on the split key)."""
    return df.join(fold_table(df, split), split.by)


def train_test(df_with_fold: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the other folds vs rows of ``fold``."""
    return df_with_fold.where(F.col("fold") != fold), df_with_fold.where(F.col("fold") == fold)


def temporal_split(df: DataFrame, train_frac: float = 0.8, time_col: str = "time_id") -> DataFrame:
    """``train`` when ``time_col <= ids[int(n * frac) - 1]`` over the
    sorted distinct ids, i.e. when the id's ordinal is below ``int(n * frac)``.
    Adds ``split`` ('train'/'test')."""
    ids = ordered_index(df.select(time_col).where(F.col(time_col).isNotNull()).distinct(), [time_col])
    labels = ids.selectExpr(
        time_col,
        f"CASE WHEN idx <= CAST(n_rows * {float(train_frac)} AS BIGINT) - 1 THEN 'train' ELSE 'test' END AS split",
    )
    return df.join(labels, time_col)


def positional_split(df: DataFrame, order_cols: list[str], group: str = "stock_id", train_frac: float = 0.8) -> DataFrame:
    """Per group, the first ``int(frac * n)`` rows (by ``order_cols``) are
    ``train``; ranks come from range partitions, so a group is never one task."""
    packed = df.withColumn("_o", F.struct(*order_cols))
    ranked = ranked_in_group(packed, group, "_o")
    split = F.when(F.col("_r") <= F.floor(F.lit(float(train_frac)) * F.col("_n")), "train").otherwise("test")
    return ranked.select(*df.columns, split.alias("split"))
