import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import routing
from tidemark.state import LatestTable, ReplacedTable
from tidemark.streaming import cdc, ingest as S
from tidemark.streaming.index import TextIndex, index_stream

T0 = dt.datetime(2024, 1, 1)


def lines(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(r if isinstance(r, str) else json.dumps(r) + "\n" for r in records))


def event(i, **more):
    base = {"event_id": f"e{i}", "account_id": "a", "merchant_id": "m"}
    return {k: v for k, v in {**base, **more}.items() if v != "absent"}


def test_landing_and_restart(spark, tmp_path, run_ts):
    src, out = tmp_path / "in", f"file://{tmp_path}/out"
    lines(src, "a.json", [event(1), "{broken\n", event(2)])

    def run():
        return S.land_stream(S.read_line_stream(spark, str(src)), out, f"{out}/checkpoint", run_ts)

    run()
    assert S.landed(spark, out).count() == 2 and S.landed(spark, out, "rejects").count() == 1
    assert [(r["row_count"], r["error_count"]) for r in rows(S.history(spark, out))] == [(3, 1)]
    assert run().lastProgress is None or run().lastProgress["numInputRows"] == 0
    lines(src, "b.json", [event(3)])
    run()
    assert sorted(json.loads(r["raw_payload"])["event_id"] for r in rows(S.landed(spark, out))) == ["e1", "e2", "e3"]


def test_repeated_micro_batch_is_not_seen_twice(spark, tmp_path, run_ts):
    src, out, routed = tmp_path / "in", f"file://{tmp_path}/out", f"file://{tmp_path}/routed"
    lines(src, "a.json", [event(1), event(2)])

    def run():
        S.land_stream(S.read_line_stream(spark, str(src)), out, f"{out}/checkpoint", run_ts)
        S.route_stream(S.raw_stream(spark, out), routed, f"{routed}/checkpoint")

    run()
    for commit in (tmp_path / "out" / "checkpoint" / "commits").iterdir():
        commit.unlink()  # as if the driver was lost just before it noted the batch as done
    lines(src, "b.json", [event(3)])
    run()
    assert S.landed(spark, out).count() == 3
    assert S.landed(spark, routed, "clean").count() == 3


def test_output_of_another_checkpoint_is_refused(spark, tmp_path, run_ts):
    src, out = tmp_path / "in", f"file://{tmp_path}/out"
    lines(src, "a.json", [event(1)])
    S.land_stream(S.read_line_stream(spark, str(src)), out, f"{out}/one", run_ts)
    with pytest.raises(ValueError, match="another checkpoint"):
        S.land_stream(S.read_line_stream(spark, str(src)), out, f"{out}/two", run_ts)


def test_routing_is_complete_and_disjoint(spark, tmp_path, run_ts):
    src, out, routed = tmp_path / "in", f"file://{tmp_path}/out", f"file://{tmp_path}/routed"
    lines(src, "a.json", [event(1), event(2, account_id="absent"), event(3, merchant_id=None), "5\n"])
    S.land_stream(S.read_line_stream(spark, str(src)), out, f"{out}/checkpoint", run_ts)
    S.route_stream(S.raw_stream(spark, out), routed, f"{routed}/checkpoint")
    clean, held = S.landed(spark, routed, "clean"), S.landed(spark, routed, "quarantine")
    assert (clean.count(), held.count()) == (1, 3)
    assert clean.unionByName(held).exceptAll(S.landed(spark, out)).isEmpty()


def test_micro_batches_are_read_in_splits_not_from_the_cache(spark, tmp_path, run_ts, monkeypatch):
    """A cached batch is as large per task as the batch makes it; files are read in splits, and go when they are done."""
    src, out, routed = tmp_path / "in", f"file://{tmp_path}/out", f"file://{tmp_path}/routed"
    lines(src, "a.json", [event(i, account_id="absent" if i % 5 == 0 else "a") for i in range(200)] + ["{broken\n"])
    parts, read = [], S.write_batch_once

    def write(df, path, batch_id):
        parts.append((path.rsplit("/", 1)[1], "InMemoryRelation" in df._jdf.queryExecution().toString()))
        read(df, path, batch_id)

    monkeypatch.setattr(S, "write_batch_once", write)
    S.land_stream(S.read_line_stream(spark, str(src)), out, f"{out}/checkpoint", run_ts)
    S.route_stream(S.raw_stream(spark, out), routed, f"{routed}/checkpoint")
    assert parts == [(n, False) for n in ("raw", "rejects", "history", "clean", "quarantine")]
    assert [S.landed(spark, o, n).count() for o, n in ((out, "rejects"), (routed, "clean"), (routed, "quarantine"))] == [1, 160, 40]
    scratch = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/tidemark"
    assert not [n for n in os.listdir(scratch) if n.startswith(("landing-", "routing-"))]


def test_explicit_null_key(spark):
    df = spark.createDataFrame([(json.dumps(event(1, event_id=None)),), (json.dumps(event(2, event_id="absent")),)], "raw_payload string")
    assert routing.clean_split(df).count() == 0
    assert routing.clean_split(df, literal=True).count() == 1
    variant = df.select(F.parse_json("raw_payload").alias("raw_payload"))
    assert routing.quarantine_split(variant).count() == 2


def activity(spark, data):
    payloads = [
        (json.dumps({"account_id": a, "account_status": s, "current_balance": 1, "updated_at": str(T0 + dt.timedelta(hours=h))}),)
        for a, s, h in data
    ]
    return spark.createDataFrame(payloads, "raw_payload string")


def state(table):
    return {r["account_id"]: r["account_status"] for r in rows(table.read())}


def test_older_event_does_not_replace_newer(spark, tmp_path, run_ts):
    for guard, expected in ((True, "FROZEN"), (False, "OPEN")):
        table = cdc.accounts_current(spark, f"file://{tmp_path}/{guard}", guard)
        cdc.merge_batch(table, activity(spark, [("a", "FROZEN", 5)]), "m1", run_ts)
        cdc.merge_batch(table, activity(spark, [("a", "OPEN", 1), ("b", "OPEN", 1)]), "m2", run_ts)
        assert state(table) == {"a": expected, "b": "OPEN"}


def test_several_events_of_an_account_in_one_batch(spark, tmp_path, run_ts):
    table = cdc.accounts_current(spark, f"file://{tmp_path}/s")
    cdc.merge_batch(table, activity(spark, [("a", "OPEN", 1), ("a", "CLOSED", 3), ("a", "FROZEN", 2)]), "m1", run_ts)
    assert state(table) == {"a": "CLOSED"} and table.read().count() == 1


def test_result_does_not_depend_on_how_batches_are_cut(spark, tmp_path, run_ts):
    events = [(f"a{i % 7}", ["OPEN", "FROZEN", "CLOSED"][i % 3], (i * 37) % 101) for i in range(60)]
    whole = cdc.accounts_current(spark, f"file://{tmp_path}/whole")
    cdc.merge_batch(whole, activity(spark, events), "m1", run_ts)
    parts = cdc.accounts_current(spark, f"file://{tmp_path}/parts")
    for n, lo in enumerate(range(0, 60, 20)):
        cdc.merge_batch(parts, activity(spark, events[lo : lo + 20]), f"m{n}", run_ts)
        if n == 1:
            parts.vacuum()
    assert state(whole) == state(parts)


def test_replayed_batch_changes_nothing(spark, tmp_path, run_ts):
    table = cdc.accounts_current(spark, f"file://{tmp_path}/s")
    for _ in range(2):
        cdc.merge_batch(table, activity(spark, [("a", "OPEN", 1)]), "m1", run_ts)
    assert table.versions().count() == 1


def test_removing_old_files_keeps_the_state(spark, tmp_path, run_ts, monkeypatch):
    monkeypatch.setattr(cdc, "VACUUM_AFTER", 2)
    table = cdc.accounts_current(spark, f"file://{tmp_path}/s")
    for i in range(5):
        cdc.merge_batch(table, activity(spark, [("a", "OPEN", i), (f"b{i}", "FROZEN", 1)]), f"m{i}", run_ts)
    assert len(state(table)) == 6 and len(table.stale()) < 2


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    table = LatestTable(spark, path, "k string, v long", "k", ["v"])
    table.update(spark.createDataFrame([("a", 1)], "k string, v long"), "m1")
    (tmp_path / "t" / "snapshot" / "upto_m9").mkdir(parents=True)
    assert rows(table.read()) == [{"k": "a", "v": 1}]


def test_replaced_table_shows_the_newest_complete_version(spark, tmp_path):
    table = ReplacedTable(spark, f"file://{tmp_path}/t", "k long")
    assert table.read().isEmpty()
    table.overwrite(spark.range(2).toDF("k"), "v1")
    table.overwrite(spark.range(5).toDF("k"), "v2")
    (tmp_path / "t" / "v3").mkdir()
    assert table.current_version() == "v2" and table.read().count() == 5


def test_cdc_stream_takes_only_what_is_new(spark, tmp_path, run_ts):
    src, out, kept = tmp_path / "in", f"file://{tmp_path}/out", f"file://{tmp_path}/state"

    def run(name, data):
        lines(src, name, [r.raw_payload + "\n" for r in activity(spark, data).collect()])
        S.land_stream(S.read_line_stream(spark, str(src)), out, f"{out}/checkpoint", run_ts)
        cdc.merge_stream(S.raw_stream(spark, out), kept, f"{kept}/checkpoint", merged_at=run_ts)

    run("a.json", [("a", "OPEN", 1), ("a", "FROZEN", 2)])
    run("b.json", [("a", "CLOSED", 1), ("b", "OPEN", 1)])
    table = cdc.accounts_current(spark, kept)
    assert state(table) == {"a": "FROZEN", "b": "OPEN"}
    before = table.log.newest()
    cdc.merge_stream(S.raw_stream(spark, out), kept, f"{kept}/checkpoint", merged_at=run_ts)
    assert table.log.newest() == before


def test_dedup(spark, tmp_path):
    src, out = f"file://{tmp_path}/src", f"file://{tmp_path}/out"
    data = [("a", T0), ("a", T0 + dt.timedelta(minutes=5)), ("b", T0)]
    df = spark.createDataFrame(data * 50, "event_id string, t timestamp")
    df.repartition(5).write.parquet(src)
    S.dedup_stream(spark.readStream.schema(df.schema).parquet(src), "event_id", "t", out, f"file://{tmp_path}/cp")
    assert sorted(r.event_id for r in S.deduplicated(spark, out, "event_id string").collect()) == ["a", "b"]
    assert {tuple(r)[:2] for r in spark.read.parquet(f"{out}/copies").collect()} == {("a", 99), ("b", 49)}


def test_late_events_arrive_and_copies_are_counted(spark, tmp_path):
    src, out = f"file://{tmp_path}/src", f"file://{tmp_path}/out"
    day = dt.timedelta(days=1)
    batches = [
        [("new", T0 + 40 * day), ("new", T0 + 40 * day), (None, T0)],
        [("late", T0), ("new", T0 + 39 * day), ("untimed", None)],
        [("late", T0), ("later", T0 - 400 * day), ("untimed", None), (None, T0)],
    ]
    for batch in batches:
        df = spark.createDataFrame(batch, "event_id string, t timestamp")
        df.write.mode("append").parquet(src)
        S.dedup_stream(spark.readStream.schema(df.schema).parquet(src), "event_id", "t", out, f"file://{tmp_path}/cp")
    kept = [(r.event_id, r.t) for r in S.deduplicated(spark, out, "event_id string, t timestamp").collect()]
    assert len(kept) == 5 and set(kept) == {("new", T0 + 40 * day), (None, T0), ("late", T0), ("untimed", None), ("later", T0 - 400 * day)}
    counted = {}
    for r in spark.read.parquet(f"{out}/copies").collect():
        counted[r.event_id] = counted.get(r.event_id, 0) + r.copies
    assert counted == {"new": 2, "late": 1, "untimed": 1, None: 1}


def docs(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string")


def words_of(index):
    return {(r.doc_id, r.term): r.tf for r in index.postings().collect()}


def test_index_follows_changes_and_deletions(spark, tmp_path, run_ts):
    index = TextIndex(spark, f"file://{tmp_path}/i")
    index.refresh(docs(spark, {1: "red red fox", 2: "blue fox", 3: "gone"}), "r1", run_ts)
    index.refresh(docs(spark, {1: "red red fox", 2: "green fox", 4: "new"}), "r2", run_ts)
    assert words_of(index) == {(1, "red"): 2, (1, "fox"): 1, (2, "green"): 1, (2, "fox"): 1, (4, "new"): 1}
    assert {r.doc_id: r.refresh for r in index.current().collect()} == {1: "r1", 2: "r2", 4: "r2"}
    index.refresh(docs(spark, {1: "red red fox", 2: "green fox", 4: "new"}), "r3", run_ts)
    assert "r3" not in {r.refresh for r in index.current().collect()}
    index.refresh(docs(spark, {1: "red red fox", 2: "green fox", 4: "new"}), "r2", run_ts)
    assert words_of(index)[(2, "green")] == 1
    assert index.lag(run_ts + dt.timedelta(hours=3), dt.timedelta(hours=2)).first().status == "warn"
    index.refresh(docs(spark, {3: "gone"}), "r4", run_ts, complete=False)
    assert index.current().count() == 4


def test_index_answers_like_a_full_search(spark, tmp_path, run_ts):
    from tidemark.operators.search import bm25_topk, corpus_stats, tokenise

    texts = {i: f"alpha beta{i % 3} gamma{i % 5} " * (1 + i % 2) for i in range(12)}
    index = TextIndex(spark, f"file://{tmp_path}/i")
    index.refresh(docs(spark, {**texts, 1: "old"}), "r1", run_ts)
    index.refresh(docs(spark, texts), "r2", run_ts)
    asked = spark.createDataFrame([(1, "beta1 gamma2"), (2, "alpha gamma4")], "query_id long, query string")
    all_docs = docs(spark, texts)
    direct = bm25_topk(tokenise(all_docs, "doc_id", "text"), corpus_stats(all_docs, "text"), asked, 4)
    assert rows(index.search(asked, 4), "query_id", "rank") == rows(direct, "query_id", "rank")


def test_index_stream(spark, tmp_path, run_ts):
    src = f"file://{tmp_path}/src"
    df = docs(spark, {1: "one", 2: "two two"})
    df.write.parquet(src)
    path = f"file://{tmp_path}/i"
    index_stream(spark.readStream.schema(df.schema).parquet(src), path, f"{path}/checkpoint", run_ts)
    assert words_of(TextIndex(spark, path)) == {(1, "one"): 1, (2, "two"): 2}
