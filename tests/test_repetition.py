"""State that is written again, late, or under another checkpoint."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from conftest import rows
from tidemark.operators.drift import header_key_set
from tidemark.operators.ranking import auc_exact
from tidemark.state import LatestTable, ReplacedTable
from tidemark.streaming.index import TextIndex, newest_versions
from tidemark.streaming.ingest import check_ownership

SCHEMA = "k string, v long"


def test_a_batch_with_a_lower_name_counts_after_compaction(spark, tmp_path):
    table = LatestTable(spark, f"file://{tmp_path}/t", SCHEMA, "k", ["v"])
    table.update(spark.createDataFrame([("a", 1)], SCHEMA), "b2")
    table.compact()
    table.update(spark.createDataFrame([("b", 1), ("a", 0)], SCHEMA), "b1")
    assert table.pending_batches() == 1
    want = [{"k": "a", "v": 1}, {"k": "b", "v": 1}]
    assert rows(table.read(), "k") == want
    table.compact()
    table.compact()
    assert table.pending_batches() == 0 and rows(table.read(), "k") == want


def test_the_tenth_version_is_newer_than_the_ninth(spark, tmp_path):
    table = ReplacedTable(spark, f"file://{tmp_path}/t", "k long")
    for i in (9, 10):
        table.overwrite(spark.range(i).toDF("k"), f"v{i}")
    assert table.current_version() == "v10" and table.read().count() == 10


def test_streams_own_their_numbered_batches(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    table = LatestTable(spark, path, SCHEMA, "k", ["v"])
    table.update(spark.createDataFrame([("a", 1)], SCHEMA), "by-hand")
    check_ownership(spark, f"{path}/delta", f"file://{tmp_path}/new")
    table.update(spark.createDataFrame([("a", 1)], SCHEMA), "m000000000000")
    with pytest.raises(ValueError, match="another checkpoint"):
        check_ownership(spark, f"{path}/delta", f"file://{tmp_path}/new")


def test_scores_without_rank_fail(spark):
    for bad in (None, float("nan")):
        scored = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, bad)], "label int, s double")
        with pytest.raises(PySparkException, match="NULL or NaN"):
            auc_exact(scored, "label", "s").collect()


def test_quoted_header_names_keep_their_commas(spark):
    headers = spark.createDataFrame([('\ufeff"a,b",c, "say ""x""" \r',)], "value string")
    assert {r.column_key for r in header_key_set(headers).collect()} == {"a,b", "c", 'say "x"'}


def test_versions_decide_between_texts_of_a_document(spark):
    docs = spark.createDataFrame([(1, "zebra old", 1), (1, "alpha new", 2), (2, None, 1)], "doc_id long, text string, v int")
    assert {tuple(r) for r in newest_versions(docs, "v").collect()} == {(1, "alpha new"), (2, None)}
    with pytest.raises(PySparkException, match="several texts"):
        newest_versions(docs, None).collect()


def test_null_texts_are_indexed_in_every_refresh(spark, tmp_path):
    index, at = TextIndex(spark, f"file://{tmp_path}/index"), dt.datetime(2024, 1, 1)
    index.refresh(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), "r1", at)
    index.refresh(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), "r2", at)
    assert {r.doc_id for r in index.current().collect()} == {1, 2}
