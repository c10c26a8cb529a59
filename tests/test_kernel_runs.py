"""The feature kernel works on runs: no row per second, nulls where the
definitions have none, any order of rows."""

import numpy as np

from conftest import BOOK_SCHEMA
from test_features_numpy import CFG, random_book, reference

from volspark.operators.book import book_runs
from volspark.operators.features import build_features, feature_table_from_runs


def test_kernel_has_no_row_per_second(spark):
    book = spark.createDataFrame(random_book(windows=1), BOOK_SCHEMA)
    plan = feature_table_from_runs(book_runs(book), CFG)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_short_windows_and_missing_books(spark):
    rows = random_book(seed=3, windows=2)
    rows = [r if r[0] == 0 else (1, 240 + i, *r[2:]) for i, r in enumerate(rows) if r[0] == 0 or i < 360]
    cut = [(t, s, *p, float(b1), float(a1), None if t == 0 else b2, a2, k) for t, s, *p, b1, a1, b2, a2, k in rows]
    got = {r["time_id"]: r for r in build_features(spark.createDataFrame(rows[::-1], BOOK_SCHEMA), CFG).collect()}
    want = reference([r for r in rows if r[0] == 0], CFG)[0]
    assert all(np.isclose(got[0][c], v, rtol=1e-9, atol=1e-9) for c, v in want.items())
    assert got[1]["RV_120"] is None and got[1]["mean_spread_60"] is not None and got[1]["RV_30"] is not None
    # without the second level's size no price is known, so no window is left
    assert 0 not in {r["time_id"] for r in build_features(spark.createDataFrame(cut, BOOK_SCHEMA), CFG).collect()}
