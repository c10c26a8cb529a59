import tempfile

from pyspark.sql import functions as F

from volspark.config import FeatureConfig
from volspark.operators.features import build_features
from volspark.sources.book import derived_book
from volspark.streaming.incremental import absorb_batch, read_features, start_incremental_build

CFG = FeatureConfig(return_windows=(5, 30), acf_windows=(30,), book_windows=(30,), ewma_lambdas=(0.9,))


def test_stream_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="vs-stream-")
    book = derived_book(spark, "/root/testdata/sf0.001")
    book.repartition(3).write.parquet(f"{base}/book")
    q = start_incremental_build(spark, f"{base}/book", f"{base}/feat", f"{base}/ckpt", CFG, files_per_batch=1)
    q.awaitTermination()
    got = read_features(spark, f"{base}/feat").select("stock_id", "time_id", "RV_30").orderBy("stock_id", "time_id").collect()
    want = build_features(book, CFG).select("stock_id", "time_id", "RV_30").orderBy("stock_id", "time_id").collect()
    assert [(r[0], r[1]) for r in got] == [(r[0], r[1]) for r in want]
    assert all(abs(a[2] - b[2]) < 1e-12 for a, b in zip(got, want))


def test_replayed_batch_changes_nothing(spark):
    base = tempfile.mkdtemp(prefix="vs-stream-")
    book = derived_book(spark, "/root/testdata/sf0.001").where("time_id < 2")
    halves = [book.where("seconds_in_bucket % 2 = 0"), book.where("seconds_in_bucket % 2 = 1")]
    for epoch, half in [(0, halves[0]), (1, halves[1]), (1, halves[1])]:
        absorb_batch(half, f"{base}/t", epoch, CFG)
    got = {(r[0], r[1]): r[2] for r in read_features(spark, f"{base}/t").select("stock_id", "time_id", "RV_30").collect()}
    want = {(r[0], r[1]): r[2] for r in build_features(book, CFG).select("stock_id", "time_id", "RV_30").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_a_batch_reads_only_the_spans_it_touches(spark):
    import glob
    import shutil

    base = tempfile.mkdtemp(prefix="vs-stream-")
    book = derived_book(spark, "/root/testdata/sf0.001").withColumn("time_id", F.col("time_id") * 64)
    absorb_batch(book, f"{base}/t", 0, CFG)
    assert len(glob.glob(f"{base}/t/rows/epoch=0/span=*")) == book.select("time_id").distinct().count() > 2
    for other in glob.glob(f"{base}/t/rows/epoch=0/span=*"):
        if not other.endswith("span=1"):
            shutil.move(other, f"{base}/{other.rsplit('=', 1)[1]}")  # gone: not needed for span 1
    again = book.where("time_id = 64")
    absorb_batch(again, f"{base}/t", 1, CFG)
    got = {(r[0], r[1]): r[2] for r in read_features(spark, f"{base}/t").select("stock_id", "time_id", "RV_30").collect()}
    want = {(r[0], r[1]): r[2] for r in build_features(book, CFG).select("stock_id", "time_id", "RV_30").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
