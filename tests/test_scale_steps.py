"""Steps that grow with the input: runs instead of seconds, one evaluation, few files, bounded groups."""

import numpy as np
from pyspark.sql import functions as F

from conftest import BOOK_SCHEMA, book_rows
from test_features_numpy import random_book

from volspark.operators import garch as GA
from volspark.operators import trees as TR
from volspark.sources.store import write_new_stocks
from volspark.streaming.incremental import absorb_batch


def test_garch_windows_without_a_row_per_second(spark):
    rows = GA.garch_windows(spark.createDataFrame(random_book(windows=1), BOOK_SCHEMA))
    assert "Generate" not in rows._jdf.queryExecution().optimizedPlan().toString()
    r = rows.first()
    assert len(r["seconds"]) == 30 and r["seconds"] == sorted(r["seconds"]) and r["seconds"][-1] == 599


def test_carry_is_the_recursion():
    u, beta = np.random.default_rng(1).normal(size=(23, 3, 5)), np.linspace(0, 1, 5)
    want = u.copy()
    for t in range(1, len(u)):
        want[t] += beta * want[t - 1]
    assert np.allclose(GA.carry(u, beta), want, rtol=1e-12)


def test_candidates_that_meet_go_on_as_one():
    x = np.array([[0.0, 0.1, 0.5], [0.0, 0.1, 0.5], [0.01, 0.1, 0.5], [3.0, 0.1, 0.5]])  # two candidates of two windows
    assert GA.met(x, np.array([1.0, 1.0, 2.0, 0.5]), 2).tolist() == [False, False, True, False]


def test_groups_are_bounded_by_values():
    assert TR.rows_in_a_group(255) * 255 <= TR.CELLS and TR.rows_in_a_group(1) == TR.BOUND


def test_new_stocks_are_built_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([("stock_1", 1, 0.5), ("stock_2", 1, 0.5)], "stock_id string, time_id bigint, v double")
    write_new_stocks(rows.mapInArrow(count, rows.schema), str(tmp_path / "t"))
    assert seen.value == 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_a_batch_leaves_one_file_per_span(spark, tmp_path):
    rows = [r for t in (1, 2, 3) for r in book_rows("stock_0", t, [1.0 + i * 1e-4 for i in range(40)])]
    absorb_batch(spark.createDataFrame(rows, BOOK_SCHEMA).repartition(6), str(tmp_path), 0)
    assert len(list(tmp_path.glob("rows/epoch=0/span=0/*.parquet"))) == 1


def test_a_forest_is_shared_out(spark, monkeypatch):
    """More groups than units, of which none holds all trees; the fit is the same."""
    monkeypatch.setattr(TR, "ROW_TREES", 160)
    rng = np.random.default_rng(3)
    rows = [("u", i, int(rng.integers(2**40)), i % 5 > 0, rng.normal(size=3).tolist(), float(rng.normal())) for i in range(80)]
    df = spark.createDataFrame(rows, "unit string, row long, draw long, train boolean, x array<double>, y double")
    learners = {"RF": TR.Learner("forest", 7), "XGB": TR.Learner("boosted", 4, 3, 0.3, 0.8, 0.8, l2=1.0)}
    shares = spark.range(1).select(TR.shares_of(learners, F.lit(80)).alias("s")).first()["s"]
    assert [tuple(s) for s in shares] == [("RF", 0, 2), ("RF", 2, 4), ("RF", 4, 6), ("RF", 6, 7), ("XGB", 0, 4)]
    got = TR.fit_units(df, learners, 3).collect()
    x, y, draw, train = (np.array([r[i] for r in rows]) for i in (4, 5, 2, 3))
    for name, learner in learners.items():
        raw, gains = TR.fit_in_memory(x, y, draw, train, learner)
        assert np.allclose([r.raw for r in sorted((r for r in got if r.model == name and r.row is not None), key=lambda r: r.row)], raw[~train], rtol=0, atol=1e-12)
        assert np.allclose([r.weight for r in sorted((r for r in got if r.model == name and r.row is None), key=lambda r: r.feature)], gains / gains.sum())


def test_a_legacy_query_fits_its_own_units(spark, monkeypatch):
    """Each of the two queries on the legacy models fits its units alone."""
    from volspark.operators import models as MO

    rng = np.random.default_rng(5)
    rows = [(i % 2, f"stock_{i % 2}", i, rng.normal(size=2).tolist(), float(rng.normal())) for i in range(240)]
    data = spark.createDataFrame([(c, s, t, *x, y) for c, s, t, x, y in rows], "cluster int, stock_id string, time_id long, a double, b double, y double")
    seen = []
    fit = TR.fit_units
    monkeypatch.setattr(TR, "fit_units", lambda rows, *a: (seen.append({r.unit for r in rows.select("unit").distinct().collect()}), fit(rows, *a))[1])
    learners = {"DT": TR.Learner("tree", depth=2)}
    own = MO.legacy_zoo(data, ["a", "b"], "y", trees=learners, only="stock:")
    every = MO.legacy_zoo(data, ["a", "b"], "y", trees=learners)
    assert seen == [{"stock:stock_0", "stock:stock_1"}, {"cluster:0", "cluster:1", "stock:stock_0", "stock:stock_1"}]
    key = lambda df: sorted((r.unit, r.model, r.time_id, round(r.y_pred, 9)) for r in df.where("unit LIKE 'stock:%'").collect())
    assert key(own) == key(every) and len(key(own)) == 4 * 48
