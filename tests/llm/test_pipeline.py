import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"


def test_eleven_queries_are_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not here")
def test_stages_keep_columns_and_end_in_pieces(spark, tmp_path):
    docs = source = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    counts = [docs.count()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if number < 4:
            assert docs.columns == source.columns
            counts.append(docs.count())
    assert counts[0] >= counts[1] > counts[2] >= counts[3] == counts[4] > 0
    texts = [r.text for r in spark.read.parquet(f"{tmp_path}/1").collect()]
    assert len(set(texts)) == counts[2]
    assert docs.select("doc_id").distinct().count() == counts[4]


def test_stages_take_odd_rows(spark, odd_docs, no_docs, tmp_path):
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, odd_docs, SF_DIR)
        out.write.parquet(f"{tmp_path}/{number}")
        assert number == 4 or out.columns == odd_docs.columns, name
        assert stage(spark, no_docs, SF_DIR).count() == 0
