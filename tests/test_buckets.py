"""Bucketed state: what is rewritten, what readers open, and several writers."""

import random

from conftest import rows
from tidemark.buckets import BucketTable

SCHEMA = "k string, v long, t long"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def table(spark, tmp_path, **more):
    return BucketTable(spark, f"file://{tmp_path}/t", SCHEMA, "k", ["t"], ["v"], **{"buckets": 8} | more)


def test_batches_in_any_cut_equal_the_newest_rows(spark, tmp_path):
    rng = random.Random(3)
    data = [(f"k{rng.randrange(25)}", rng.randrange(9), rng.randrange(40)) for _ in range(120)]
    own = table(spark, tmp_path)
    assert own.read().isEmpty()
    for n in range(4):
        own.update(frame(spark, data[n * 30 : (n + 1) * 30]), f"b{n}")
    own.update(frame(spark, []), "b9")
    newest = {}
    for n, (k, v, t) in enumerate(data):
        newest[k] = max(newest.get(k, (-1,)), (t, n // 30, v))
    assert {(r["k"], r["t"], r["v"]) for r in rows(own.read())} == {(k, t, v) for k, (t, _, v) in newest.items()}


def test_only_touched_buckets_are_written_and_one_list_is_read(spark, tmp_path):
    own = table(spark, tmp_path)
    own.update(frame(spark, [(f"k{i}", i, 1) for i in range(60)]), "b1")
    before = own.log.newest()[1]["files"]
    own.update(frame(spark, [("k5", 99, 2)]), "b2")
    after = own.log.newest()[1]["files"]
    assert sum(before[b] != after[b] for b in before) == 1 and set(before) == set(after)
    for n in range(3, 6):
        own.update(frame(spark, [("k5", n, n)]), f"b{n}")
    assert len({f.rsplit("/", 1)[0] for f in own.read().inputFiles()}) <= 8
    assert len(own.stale()) == 3
    state = rows(own.read(), "k")
    own.vacuum()
    assert own.stale() == [] and rows(own.read(), "k") == state and len(state) == 60


def test_a_merged_batch_is_not_merged_again(spark, tmp_path):
    own = BucketTable(spark, f"file://{tmp_path}/t", SCHEMA, "k", tie_break=["v"], buckets=2)
    own.update(frame(spark, [("a", 1, 1)]), "b1")
    own.update(frame(spark, [("a", 2, 1)]), "b2")
    number = own.log.newest()[0]
    own.update(frame(spark, [("a", 1, 1)]), "b1")
    assert own.log.newest()[0] == number and rows(own.read()) == [{"k": "a", "v": 2, "t": 1}]


def test_of_two_writers_one_retries_and_nothing_is_lost(spark, tmp_path):
    own, other = table(spark, tmp_path), table(spark, tmp_path)
    own.update(frame(spark, [("a", 1, 1), ("b", 1, 1)]), "b1")
    real, tries = own.log.publish, []

    def slow(number, content):
        tries.append(number)
        if len(tries) == 1:
            other.update(frame(spark, [("a", 5, 5), ("c", 1, 1)]), "theirs")
        return real(number, content)

    own.log.publish = slow
    own.update(frame(spark, [("a", 3, 3), ("b", 3, 3)]), "ours")
    assert tries == [2, 3]
    assert {(r["k"], r["v"]) for r in rows(own.read())} == {("a", 5), ("b", 3), ("c", 1)}


def test_the_number_of_buckets_is_kept(spark, tmp_path):
    table(spark, tmp_path).update(frame(spark, [("a", 1, 1)]), "b1")
    other = table(spark, tmp_path, buckets=3)
    other.update(frame(spark, [("a", 2, 2), ("b", 1, 1)]), "b2")
    assert other.log.newest()[1]["buckets"] == 8 and other.read().count() == 2
