import math

from conftest import BOOK_SCHEMA, book_rows

from volspark.config import FeatureConfig
from volspark.operators.features import build_features, window_targets

CFG = FeatureConfig(forecast_horizon=30, return_windows=(5, 30), acf_windows=(30,), book_windows=(30,), ewma_lambdas=(0.9,))


def prices(n_obs_moves, n_target_moves):
    """600 seconds; 1 bp log moves at chosen seconds (observed part is before
    second 570 because 599 usable returns leave a cutoff of 569)."""
    p, out = 1.0, []
    obs = set(range(10, 10 + n_obs_moves))
    tgt = set(range(575, 575 + n_target_moves))
    for s in range(600):
        if s in obs or s in tgt:
            p *= math.exp(1e-4)
        out.append(p)
    return out


def test_movement_filter_and_target(spark):
    rows = book_rows("stock_0", 1, prices(19, 5)) + book_rows("stock_0", 2, prices(20, 4)) + book_rows("stock_0", 3, prices(20, 5))
    df = spark.createDataFrame(rows, BOOK_SCHEMA)
    out = build_features(df, CFG).collect()
    assert [r["time_id"] for r in out] == [3]
    assert math.isclose(out[0]["target_var"], 5 / 30, rel_tol=1e-6)
    t = window_targets(df, CFG).collect()
    assert [(r["time_id"], r["observed_moves"], r["target_moves"]) for r in t] == [(3, 20, 5)]
