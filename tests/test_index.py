"""The segmented text index: searches against the direct form, merging, and several writers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.commits import CommitConflict, CommitLog
from tidemark.operators import blockmax, search
from tidemark.streaming import index as index_module
from tidemark.streaming.index import TextIndex

AT = dt.datetime(2024, 1, 1)
SCHEMA = "doc_id long, text string, status string, kind string"


def made_docs(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    return [
        (i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 30))), rng.choice(["OPEN", "CLOSED", None]), rng.choice("ab"))
        for i in range(n)
    ]


QUERIES = [(1, "w0 w1"), (2, "w55"), (3, "w3 w17 w40 w2 w59"), (4, "unknown"), (5, "w0 w0 w58 W30")]


def asked(spark):
    return spark.createDataFrame(QUERIES, "query_id long, query string")


def hits(df):
    return rows(df.select("query_id", "rank", "doc_id", "score"), "query_id", "rank")


@pytest.fixture
def small_cells(monkeypatch):
    monkeypatch.setattr(blockmax, "CELL_BITS", 2)
    monkeypatch.setattr(index_module, "SEED_CELLS", 2)


@pytest.mark.parametrize("k", [1, 4])
def test_searches_equal_the_direct_form(spark, tmp_path, small_cells, k):
    docs = spark.createDataFrame(made_docs(1, 300), SCHEMA).repartition(3)
    index = TextIndex(spark, f"file://{tmp_path}/i")
    index.refresh(docs, "r1", AT)
    direct = search.search(docs, asked(spark), k, "doc_id", "text", [])
    assert hits(index.search(asked(spark), k)) == hits(direct)
    for where, condition in [
        ({"status": ["OPEN"]}, F.col("status") == "OPEN"),
        ({"status": ["OPEN", "CLOSED"], "kind": ["b"]}, F.col("status").isin("OPEN", "CLOSED") & (F.col("kind") == "b")),
        ({"status": ["NONE"]}, F.lit(False)),
    ]:
        direct = search.search(docs, asked(spark), k, "doc_id", "text", [], condition)
        assert hits(index.search(asked(spark), k, where)) == hits(direct)
    assert index.opened_share(asked(spark), 1) < 0.9


def test_many_words_are_joined_not_listed(spark, tmp_path, monkeypatch, small_cells):
    docs = spark.createDataFrame(made_docs(2, 120), SCHEMA)
    index = TextIndex(spark, f"file://{tmp_path}/i")
    index.refresh(docs, "r1", AT)
    want = hits(index.search(asked(spark), 3))
    monkeypatch.setattr(index_module, "FEW_TERMS", 2)
    monkeypatch.setattr(index_module, "fits_broadcast", lambda *a, **k: False)
    assert hits(index.search(asked(spark), 3)) == want


def test_only_asked_words_are_read(spark, tmp_path):
    index = TextIndex(spark, f"file://{tmp_path}/i")
    index.refresh(spark.createDataFrame(made_docs(3, 50), SCHEMA), "r1", AT)
    terms = search.query_terms(spark.createDataFrame([(1, "w5 w7")], "query_id long, query string"))
    plan = index._asked(index._state(), terms)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "shard" in plan.split("PartitionFilters", 1)[1] and "In(term, [w5,w7])" in plan


def test_many_refreshes_leave_few_segments_and_right_results(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index_module, "TIER_BASE", 4)
    index = TextIndex(spark, f"file://{tmp_path}/i")
    made, rng = {}, random.Random(5)
    for turn in range(8):
        changed = {rng.randrange(40): r[1:] for r in made_docs(turn + 10, 4)}
        made |= changed
        index.refresh(spark.createDataFrame([(i, *r) for i, r in changed.items()], SCHEMA), f"r{turn}", AT + dt.timedelta(hours=turn), complete=False)
        segments = index._state()["segments"]
        assert len(segments) <= 6
    docs = spark.createDataFrame([(i, *r) for i, r in made.items()], SCHEMA)
    assert index.current().count() == len(made) == index._state()["n"]
    want = hits(search.search(docs, asked(spark), 5, "doc_id", "text", []))
    assert hits(index.search(asked(spark), 5)) == want
    condition = F.col("kind") == "a"
    assert hits(index.search(asked(spark), 5, {"kind": ["a"]})) == hits(search.search(docs, asked(spark), 5, "doc_id", "text", [], condition))
    index.vacuum()
    assert hits(index.search(asked(spark), 5)) == want
    kept = spark.createDataFrame([(i, *r) for i, r in made.items() if i % 2], SCHEMA)
    index.refresh(kept, "last", AT + dt.timedelta(days=1))
    assert index.current().count() == kept.count()
    assert hits(index.search(asked(spark), 5)) == hits(search.search(kept, asked(spark), 5, "doc_id", "text", []))


def test_changed_attributes_count_as_changes(spark, tmp_path):
    index = TextIndex(spark, f"file://{tmp_path}/i")
    index.refresh(spark.createDataFrame([(1, "a b", "OPEN", "x"), (2, "a", "OPEN", "x")], SCHEMA), "r1", AT)
    index.refresh(spark.createDataFrame([(1, "a b", "CLOSED", "x"), (2, "a", "OPEN", "x")], SCHEMA), "r2", AT)
    query = spark.createDataFrame([(1, "a b")], "query_id long, query string")
    assert [r.doc_id for r in index.search(query, 5, {"status": ["OPEN"]}).collect()] == [2]
    found = index.search(query, 5, {"status": ["CLOSED"]}, ["status", "kind"]).first()
    assert (found.doc_id, found.status, found.kind) == (1, "CLOSED", "x")


def test_an_empty_index_finds_nothing(spark, tmp_path):
    index = TextIndex(spark, f"file://{tmp_path}/i")
    assert index.search(asked(spark), 3).count() == 0
    index.refresh(spark.createDataFrame([], SCHEMA), "r1", AT)
    assert index.search(asked(spark), 3, {"status": ["OPEN"]}).count() == 0 and index.current().count() == 0


def test_bits(spark):
    numbers = [0, 1, 7, 8, 63, 32767, 32768, 70000, 1 << 33]
    df = spark.createDataFrame([(i,) for i in numbers], "ord long")
    maps = df.groupBy(blockmax.bucket_of(F.col("ord")).alias("bucket")).agg(blockmax.bitmap_of(F.col("ord")).alias("bitmap"))
    probe = spark.createDataFrame([(i,) for n in numbers for i in (n - 1, n, n + 1) if i >= 0], "ord long").distinct()
    joined = probe.withColumn("bucket", blockmax.bucket_of(F.col("ord"))).join(maps, "bucket", "left")
    assert {r.ord for r in joined.where(blockmax.has_bit(F.col("bitmap"), F.col("ord"))).collect()} == set(numbers)


def test_of_two_writers_one_wins_and_the_other_retries(spark, tmp_path):
    log = CommitLog(spark, f"file://{tmp_path}/log")
    assert log.newest() == (0, {}) and log.publish(1, {"v": ["a"]}) and not log.publish(1, {"v": ["b"]})
    tried = []

    def build(number, state):
        tried.append(number)
        if len(tried) == 1:
            assert log.publish(2, {"v": [*state["v"], "other"]})
        return {"v": [*state["v"], "own"]}

    assert log.change(build) == {"v": ["a", "other", "own"]} and tried == [2, 3]
    assert log.newest() == (3, {"v": ["a", "other", "own"]})
    assert log.change(lambda n, s: None) == {"v": ["a", "other", "own"]}
    log.publish = lambda *a: False
    with pytest.raises(CommitConflict):
        log.change(build)


def test_two_refreshes_at_once_both_count(spark, tmp_path):
    index, other = TextIndex(spark, f"file://{tmp_path}/i"), TextIndex(spark, f"file://{tmp_path}/i")
    index.refresh(spark.createDataFrame([(1, "one", "", "")], SCHEMA), "r1", AT)
    real, between = index._next, []

    def slow(*args):
        if not between:
            between.append(1)
            other.refresh(spark.createDataFrame([(2, "two", "", "")], SCHEMA), "theirs", AT, complete=False)
        return real(*args)

    index._next = slow
    index.refresh(spark.createDataFrame([(3, "three", "", "")], SCHEMA), "ours", AT, complete=False)
    assert {r.doc_id for r in index.current().collect()} == {1, 2, 3}


def test_words_are_counted_where_their_cell_is(spark, monkeypatch):
    """Blocks of every cell, however the rows come; words are not shuffled one by one."""
    monkeypatch.setattr(blockmax, "BATCH_WORDS", 50)
    rng = random.Random(8)
    texts = {n: [rng.choice("abcdeé") * rng.randint(1, 2) for _ in range(rng.choice([0, 1, 7, 40]))] for n in [*range(0, 400, 3), *range(1000, 1070)]}
    bags = spark.createDataFrame(rng.sample(list(texts.items()), len(texts)), "ord long, words array<string>").repartition(5)
    blocks = blockmax.word_blocks(bags)
    assert "Generate" not in blocks._jdf.queryExecution().executedPlan().toString()
    want = {}
    for number, words in sorted(texts.items()):
        for word in set(words):
            want.setdefault((word, number >> 6), []).append((number, words.count(word), len(words)))
    got = {(b.term, b.cell): b for b in blocks.collect()}
    assert {key: [tuple(p) for p in b.postings] for key, b in got.items()} == want and blocks.count() == len(want)
    for key, found in want.items():
        assert (got[key].n, got[key].max_tf, got[key].min_len) == (len(found), max(f[1] for f in found), min(f[2] for f in found))
    assert blockmax.word_blocks(bags.limit(0)).count() == 0
