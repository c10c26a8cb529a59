"""Runs on storage: which one is chosen, and what is there of it."""

import pytest
from pyspark.sql import functions as F

from volspark.session import scratch_path
from volspark.sources.book import list_stocks, read_book
from volspark.sources.store import RUN_FRAMES, RunStore


def frames(spark, n):
    return {name: spark.range(n).select(*[F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in cols.split(", "))]) for name, cols in RUN_FRAMES.items()}


def test_resolution_and_fall_back(spark):
    store = RunStore(spark, scratch_path(spark, "test-runs"))
    assert store.resolve() is None and store.resolve("x") is None and store.runs().count() == 0
    assert store.frame("metrics").count() == 0 and store.frame("metrics").columns[0] == "fold"
    store.write("b", frames(spark, 2), {"k": [1, 2]}, {"status": "failed"})
    frames(spark, 3)["metrics"].write.parquet(f"{store.runs_dir}/c/metrics")  # broke off: no status, no predictions
    assert store.resolve() == "b" and store.resolve("c") == "c" and store.resolve("d") is None
    store.write("a", frames(spark, 5), {}, {"status": "COMPLETED"})
    assert store.resolve() == "a"
    assert [(r["run_id"], r["status"], r["has_results"]) for r in store.runs().collect()] == [("c", None, False), ("b", "failed", True), ("a", "COMPLETED", True)]
    assert [store.frame(n).count() for n in RUN_FRAMES] == [5] * 5
    assert store.frame("metrics", "c").count() == 3 and store.frame("predictions", "c").count() == 0
    assert store.config("b") == {"k": [1, 2]} and store.config("c") == {}
    with pytest.raises(ValueError, match="missing: predictions"):
        store.write("e", {n: f for n, f in frames(spark, 1).items() if n != "predictions"}, {}, {})


def test_stock_names_from_file_names(spark, tmp_path):
    head = "time_id,seconds_in_bucket,bid_price1,ask_price1,bid_price2,ask_price2,bid_size1,ask_size1,bid_size2,ask_size2"
    for s in (3, 12):
        (tmp_path / f"stock_{s}.csv").write_text(f"{head}\n5,{s},1,2,1,2,3,4,5,6\n")
    (tmp_path / "notes.txt").write_text("not a stock")
    assert [r[0] for r in list_stocks(spark, str(tmp_path)).collect()] == ["stock_12", "stock_3"]
    rows = read_book(spark, str(tmp_path)).collect()
    assert sorted((r["stock_id"], r["seconds_in_bucket"]) for r in rows) == [("stock_12", 12), ("stock_3", 3)]
    (tmp_path / "stock_4.csv").write_text("time_id,seconds_in_bucket\n1,2\n")
    with pytest.raises(Exception):
        read_book(spark, str(tmp_path)).collect()


def test_feature_table_files_are_few_and_sorted(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from volspark.sources.store import write_feature_table

    rows = spark.range(6000).select(F.concat(F.lit("stock_"), (F.col("id") % 3).cast("string")).alias("stock_id"), ((F.col("id") * 7919) % 2000).alias("time_id"), *[F.rand(i).alias(f"f{i}") for i in range(40)])
    path = str(tmp_path / "table")
    write_feature_table(rows.repartition(32), path, row_group_bytes=64 << 10)
    files = glob.glob(f"{path}/stock_id=*/*.parquet")
    assert len(files) <= 8 + 3  # shuffle partitions and stocks
    ranges, skipped = {}, 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index("time_id")
        groups = [(s.min, s.max) for s in (meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups))]
        assert all(a[1] <= b[0] for a, b in zip(groups, groups[1:]))  # sorted by window
        skipped += sum(not lo <= 1000 <= hi for lo, hi in groups)
        ranges.setdefault(f.split("stock_id=")[1].split("/")[0], []).append((groups[0][0], groups[-1][1]))
    for own in ranges.values():
        own.sort()
        assert all(a[1] < b[0] for a, b in zip(own, own[1:]))  # files of a stock hold separate windows
    assert skipped > 3 and spark.read.parquet(path).where("time_id = 1000").count() == 3
