"""Registration, and the pipeline's stages."""

import corpus_pipeline
import __spark_entry__
from volspark.llm.common import table

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_stages_keep_columns_and_rows_of_documents(spark, tmp_path):
    docs = table(spark, SF, "documents")
    seen = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns
        ids = [r.doc_id for r in after.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= set(seen) and len(ids) > 100
        docs = after
    texts = [r.text.lower() for r in docs.collect()]
    assert len(set(texts)) == len(texts)
    placed = corpus_pipeline.packing_stage(spark, docs, SF)
    assert {r.doc_id for r in placed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_stages_handle_nulls_clashes_and_empty_tables(spark):
    rows = [(1, "a b c d e f g", "_row", 1), (2, "A b c d e f g", None, 2), (3, None, "x", 3), (None, "mail a@b.example.com", "y", 4), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `kind` string, _id int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert out.count() >= 1
        assert stage(spark, docs.limit(0), SF).count() == 0
