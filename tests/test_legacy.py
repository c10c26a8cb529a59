"""Legacy first-half features against pandas' own statistics."""

import numpy as np
import pandas as pd

from conftest import BOOK_SCHEMA

from volspark.operators.legacy import window_features


def test_legacy_moments_match_pandas(spark):
    rng = np.random.default_rng(11)
    rows = []
    for s in sorted(rng.choice(600, size=200, replace=False)):
        b = float(1 + rng.normal(0, 1e-3))
        rows.append((1, int(s), b, b + 2e-4, b - 1e-4, b + 3e-4, float(rng.integers(1, 50)), float(rng.integers(1, 50)),
                     10.0, 10.0, "stock_0"))
    got = window_features(spark.createDataFrame(rows, BOOK_SCHEMA)).first()
    df = pd.DataFrame(rows, columns=["t", "s", "b1", "a1", "b2", "a2", "bs1", "as1", "bs2", "as2", "stock"])
    first = df[df.s < 300]
    wap = (first.b1 * first.as1 + first.a1 * first.bs1) / (first.bs1 + first.as1)
    lr = np.log(wap).diff().dropna()
    assert np.isclose(got["rv_first"], np.sqrt((lr ** 2).sum()))
    assert np.isclose(got["std_log_return"], lr.std())
    assert np.isclose(got["skew_log_return"], lr.skew())
    assert np.isclose(got["kurt_log_return"], lr.kurt())
    assert np.isclose(got["wap_momentum"], wap.iloc[-1] - wap.iloc[0])
    assert np.isclose(got["acf1"], ((lr - lr.mean()) * (lr.shift(-1) - lr.mean())).sum() / ((lr - lr.mean()) ** 2).sum())
    second = df[df.s >= 300]
    w2 = (second.b1 * second.as1 + second.a1 * second.bs1) / (second.bs1 + second.as1)
    rv2 = np.sqrt((np.log(w2).diff().dropna() ** 2).sum())
    assert np.isclose(got["log_rv_second"], np.log(rv2 + 1e-8))


def test_large_windows_in_blocks(spark, monkeypatch):
    """A window of 9000 raw rows, cut into blocks, gives the features of the whole."""
    from pyspark.sql import functions as F

    from volspark.operators import legacy as LG

    n = F.col("id")
    book = spark.range(9000 + 700).select(
        F.when(n < 9000, 1).otherwise(2).cast("bigint").alias("time_id"), F.expr("CAST(CASE WHEN id < 9000 THEN id DIV 15 ELSE (id - 9000) * 6 DIV 7 END AS INT) AS seconds_in_bucket"),
        *[(1 + (n * k % 97) / 1e4).alias(c) for k, c in ((7, "bid_price1"), (11, "ask_price1"), (13, "bid_price2"), (17, "ask_price2"))],
        *[F.when(n % 50 == 3, 0.0).otherwise((1 + n * k % 31).cast("double")).alias(c) for k, c in ((3, "bid_size1"), (5, "ask_size1"), (1, "bid_size2"), (9, "ask_size2"))],
        F.lit("stock_1").alias("stock_id"),
    ).repartition(6)
    made = {}
    for limit in (10**9, 1000):
        monkeypatch.setattr(LG, "LARGE", limit)
        made[limit] = [{r["time_id"]: r.asDict() for r in f(book).collect()} for f in (LG.window_features, LG.har_base, LG.window_rv)]
    for whole, parts in zip(made[10**9], made[1000]):
        assert set(whole) == set(parts) == {1, 2}
        for t, row in whole.items():
            for c, v in row.items():
                assert v == parts[t][c] or abs(v - parts[t][c]) <= 1e-9 * max(1, abs(v)), (t, c)
