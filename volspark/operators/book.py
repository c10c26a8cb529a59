"""Book regularisation and returns (U2, J1, W1, P1-P4, W2, F3): D1 -> D2.

Plan shape (two exchanges):

1. ``dedupe_seconds``: ``groupBy(stock_id, time_id, second)`` with the minimum
   struct of the book columns.  The minimum runs map-side first, so copies of a
   row, however many, collapse before the shuffle; at most 600 rows a window
   are left.
2. ``book_runs``: partitioned by ``(stock_id, time_id)``, one sort by second,
   and window functions over the observed rows only (<= 600 per window):
   per-column forward fill, weighted price, log return against the previous
   observed row, the next observed second, and the count of usable returns
   each observed row stands for.  A row observed at second ``s`` and followed
   by the next observation at ``s'`` covers grid seconds ``s .. s'-1``; after
   forward fill all of them carry the same price, so their returns are exactly
   zero except at ``s``.
3. The 600-second grid (``regular_grid``) and the positions of usable returns
   (``return_positions``) are generated from the runs with ``explode`` -- no
   join against a seconds table and no second sort.  The output keeps the
   ``(stock_id, time_id)`` hash partitioning, so the per-window aggregates that
   follow run without another exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import BOOK_VALUE_COLUMNS, RETURN_SCALE, SECONDS_PER_WINDOW
from ..functions.columns import safe_div, safe_log

KEYS = ["stock_id", "time_id"]
SEC = "seconds_in_bucket"


def window_spec():
    return Window.partitionBy(*KEYS).orderBy(SEC)


def collapse_copies(book: DataFrame) -> DataFrame:
    """The smallest row of each second of each window, as ``_row``: one row of
    state per second, and the minimum runs map-side first, so copies collapse
    before the shuffle however many a window has.  Seconds outside ``0..599``
    are dropped like a reindex would."""
    in_grid = book.where(F.col(SEC).between(0, SECONDS_PER_WINDOW - 1) & F.col("time_id").isNotNull())
    return in_grid.groupBy(*KEYS, SEC).agg(F.min(F.struct(*BOOK_VALUE_COLUMNS)).alias("_row"))


def dedupe_seconds(book: DataFrame) -> DataFrame:
    """One row per second -- the smallest under a total order of all book
    columns, so the choice is deterministic (the original kept an arbitrary
    one)."""
    return collapse_copies(book).select(*KEYS, SEC, "_row.*")


def weighted_price(b1, a1, b2, a2, bs1, as1, bs2, as2):
    """Two-level size-weighted price; zero total size gives null."""
    num = b1 * as1 + a1 * bs1 + b2 * as2 + a2 * bs2
    return safe_div(num, bs1 + as1 + bs2 + as2)


def book_runs(book: DataFrame, partitions: int | None = None) -> DataFrame:
    """Observed rows with forward-filled values and run bookkeeping.

    Columns: keys, ``seconds_in_bucket``, the eight book columns (filled),
    ``weighted_price``, ``mid_price``, ``log_price``, ``ret_first`` (bp return
    at the row's own second, null when not finite), ``next_sec``,
    ``is_first_obs``, ``n_valid`` (usable returns in this run), ``pos_before``
    (usable returns before the run) and ``n_total`` (usable returns in the
    window).  All window functions share one sort by ``(stock_id, time_id,
    seconds_in_bucket)``.
    """
    if partitions:
        book = book.repartition(partitions, *KEYS)
    deduped = dedupe_seconds(book)
    over = f"OVER (PARTITION BY stock_id, time_id ORDER BY {SEC})"
    upto = f"OVER (PARTITION BY stock_id, time_id ORDER BY {SEC} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    filled = deduped.selectExpr(
        *KEYS,
        SEC,
        *[f"last({c}, true) {upto} AS {c}" for c in BOOK_VALUE_COLUMNS],
        f"lead({SEC}, 1, {SECONDS_PER_WINDOW}) {over} AS next_sec",
        f"row_number() {over} = 1 AS is_first_obs",
    )
    wap = (
        "(bid_price1 * ask_size1 + ask_price1 * bid_size1 + bid_price2 * ask_size2 + ask_price2 * bid_size2)"
        " / nullif(bid_size1 + ask_size1 + bid_size2 + ask_size2, 0D)"
    )
    priced = filled.selectExpr("*", f"{wap} AS weighted_price", "(bid_price1 + ask_price1) / 2 AS mid_price")
    priced = priced.selectExpr("*", "CASE WHEN weighted_price > 0 THEN ln(weighted_price) END AS log_price")
    with_ret = priced.selectExpr("*", f"(log_price - lag(log_price) {over}) * {RETURN_SCALE}D AS ret_first")
    counted = with_ret.selectExpr(
        "*",
        f"CASE WHEN log_price IS NULL THEN 0 ELSE next_sec - {SEC} - 1 + CAST(ret_first IS NOT NULL AS INT) END AS n_valid",
    )
    return counted.selectExpr(
        "*",
        f"CAST(coalesce(sum(n_valid) OVER (PARTITION BY stock_id, time_id ORDER BY {SEC} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS pos_before",
        "CAST(sum(n_valid) OVER (PARTITION BY stock_id, time_id) AS INT) AS n_total",
    )


def regular_grid(runs: DataFrame) -> DataFrame:
    """J1 + W1: 600 rows per window, forward filled; the leading gap (before
    the first observation) stays null.  Adds P1-P3 and W2 (D2)."""
    start = F.when(F.col("is_first_obs"), F.lit(0)).otherwise(F.col(SEC))
    grid = runs.select(
        "*", F.explode(F.sequence(start, F.col("next_sec") - 1)).alias("_g")
    )
    observed = F.col("_g") >= F.col(SEC)
    diff = (
        F.when(~observed, F.lit(None).cast("double"))
        .when(F.col("_g") == F.col(SEC), F.col("ret_first") / F.lit(RETURN_SCALE))
        .when(F.col("log_price").isNotNull(), F.lit(0.0))
    )
    vals = [F.when(observed, F.col(x)).alias(x) for x in BOOK_VALUE_COLUMNS]
    derived = [F.when(observed, F.col(x)).alias(x) for x in ("weighted_price", "mid_price", "log_price")]
    return grid.select(
        "time_id",
        F.col("_g").cast("int").alias(SEC),
        *vals,
        "stock_id",
        *derived,
        diff.alias("log_price_diff"),
    )


def return_positions(runs: DataFrame) -> DataFrame:
    """F3 + W3: one row per usable (finite) return, in order.

    ``pos`` is the 1-based index among the window's usable returns, ``n_total``
    their count, ``ret`` the return in basis points, ``second`` its grid
    second, ``run_first`` whether the row is the run's own second (only those
    can be non-zero).  Book columns are the forward-filled values that belong
    to the same second (the reference aligns the book to usable returns).
    """
    first_ok = F.col("ret_first").isNotNull()
    j = F.explode(F.sequence(F.lit(0), F.col("n_valid") - 1)).alias("_j")
    expanded = runs.where(F.col("n_valid") > 0).select("*", j)
    run_first = first_ok & (F.col("_j") == 0)
    second = F.col(SEC) + F.col("_j") + F.when(first_ok, F.lit(0)).otherwise(F.lit(1))
    return expanded.select(
        *KEYS,
        (F.col("pos_before") + F.col("_j") + 1).alias("pos"),
        "n_total",
        second.cast("int").alias("second"),
        F.when(run_first, F.col("ret_first")).otherwise(F.lit(0.0)).alias("ret"),
        run_first.alias("run_first"),
        *BOOK_VALUE_COLUMNS,
        *[c for c in runs.columns if c.startswith("_x_")],
    )
