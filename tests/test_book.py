import math

from conftest import BOOK_SCHEMA

from volspark.operators.book import book_runs, regular_grid, return_positions


def test_grid_dedupe_and_forward_fill(spark):
    rows = [
        (1, 5, 1.0, 1.2, 0.9, 1.3, 10.0, 10.0, 10.0, 10.0, "stock_0"),
        (1, 5, 1.0, 1.2, 0.9, 1.3, 10.0, 10.0, 10.0, 10.0, "stock_0"),  # exact copy
        (1, 9, 1.1, 1.3, 1.0, 1.4, 20.0, 10.0, 10.0, 10.0, "stock_0"),
        (1, 700, 9.0, 9.0, 9.0, 9.0, 1.0, 1.0, 1.0, 1.0, "stock_0"),  # outside the grid
    ]
    grid = regular_grid(book_runs(spark.createDataFrame(rows, BOOK_SCHEMA))).orderBy("seconds_in_bucket").collect()
    assert len(grid) == 600
    assert grid[0]["bid_price1"] is None and grid[4]["bid_price1"] is None  # leading gap stays empty
    assert grid[5]["bid_price1"] == 1.0 and grid[8]["bid_price1"] == 1.0  # forward filled
    assert grid[599]["bid_price1"] == 1.1
    assert grid[5]["log_price_diff"] is None  # first observation has no return
    assert grid[6]["log_price_diff"] == 0.0
    w5 = (1.0 * 10 + 1.2 * 10 + 0.9 * 10 + 1.3 * 10) / 40
    w9 = (1.1 * 10 + 1.3 * 20 + 1.0 * 10 + 1.4 * 10) / 50
    assert math.isclose(grid[9]["log_price_diff"], math.log(w9) - math.log(w5), rel_tol=1e-12)


def test_positions_skip_non_finite(spark):
    rows = [
        (1, 0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, "stock_0"),
        (1, 3, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0, "stock_0"),  # zero size -> no price
        (1, 6, 2.0, 2.0, 2.0, 2.0, 1.0, 1.0, 1.0, 1.0, "stock_0"),
    ]
    pos = return_positions(book_runs(spark.createDataFrame(rows, BOOK_SCHEMA))).orderBy("pos").collect()
    # seconds 1,2 (zeros), 3..6 not finite (no price at 3,4,5; 6 diff against null), 7..599 zeros
    assert [r["second"] for r in pos[:3]] == [1, 2, 7]
    assert pos[-1]["second"] == 599 and pos[0]["n_total"] == 2 + 593
    assert all(r["ret"] == 0.0 for r in pos)
