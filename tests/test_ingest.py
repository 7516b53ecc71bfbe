import datetime as dt
import json
import os

import pytest

from conftest import rows
from tidemark.catalog.queries import QUERIES
from tidemark.plans import ingest
from tidemark.plans.health import CLEAN, check_stream_health, load_history
from tidemark.plans.ingest import NO_NEW_FILES, Lake, ValidationFailed, validate_and_load
from tidemark.sources import files

DAY = dt.timedelta(days=1)
HEADER = (
    "settlement_id,transaction_id,account_id,merchant_id,transaction_timestamp,settlement_date,"
    "amount,currency,settlement_status,fee_amount"
)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, f"file://{tmp_path}/lake")


@pytest.fixture
def stage(tmp_path):
    folder = tmp_path / "stage"
    folder.mkdir()
    return folder


def settlement(i, **more):
    base = dict(zip(HEADER.split(","), [f"s{i}", f"t{i}", "a", "m", "2024-01-30 10:00:00", "2024-01-31", "10.50", "USD", "SETTLED", '"0.10"']))
    return ",".join({**base, **more}.values())


def put_csv(stage, name, lines, header=HEADER):
    (stage / name).write_text("\n".join([header, *lines]) + "\n")


def case(i, **more):
    base = {"case_id": f"k{i}", "customer_id": "c", "priority": "LOW"}
    return {k: v for k, v in {**base, **more}.items() if v != "absent"}


def put_json(stage, name, records):
    (stage / name).write_text("".join(r if isinstance(r, str) else json.dumps(r) + "\n" for r in records))


def load(spark, spec, stage, lake, ts, **how):
    return validate_and_load(spark, spec, str(stage), lake, ts, **how)


def audit(lake):
    return rows(lake.audit(), "load_timestamp")


def test_first_load_and_rerun(spark, stage, lake, run_ts):
    put_csv(stage, "a.csv", [settlement(1), settlement(2)])
    put_csv(stage, "b.csv", [settlement(3)])
    (stage / "notes.txt").write_text("not a settlement file")
    got = load(spark, ingest.SETTLEMENTS, stage, lake, run_ts)
    assert got.message == "Success: loaded 3 new row(s)."
    assert got.loaded_files.count() == 2
    again = load(spark, ingest.SETTLEMENTS, stage, lake, run_ts + DAY)
    assert again.message == NO_NEW_FILES
    assert len(audit(lake)) == 1 and audit(lake)[0]["status"] == "Success"
    assert lake.baseline("settlements").count() == 10
    raw = rows(lake.raw("settlements"), "settlement_id")
    assert [r["settlement_id"] for r in raw] == ["s1", "s2", "s3"]
    assert raw[0]["_source_file"].endswith("/a.csv") and str(raw[0]["fee_amount"]) == "0.10"


def test_same_name_in_another_folder_is_a_new_file(spark, stage, lake, run_ts):
    put_csv(stage, "a.csv", [settlement(1)])
    load(spark, ingest.SETTLEMENTS, stage, lake, run_ts)
    (stage / "sub").mkdir()
    put_csv(stage / "sub", "a.csv", [settlement(2)])
    assert load(spark, ingest.SETTLEMENTS, stage, lake, run_ts + DAY).rows_loaded == 1
    assert lake.raw("settlements").count() == 2


def test_files_are_read_in_groups(spark, stage, lake, run_ts, monkeypatch):
    monkeypatch.setattr(ingest, "FILES_PER_READ", 2)
    for i in range(5):
        put_csv(stage, f"{i}.csv", [settlement(i)])
    assert load(spark, ingest.SETTLEMENTS, stage, lake, run_ts).rows_loaded == 5
    assert lake.raw("settlements").select("settlement_id").distinct().count() == 5


def test_changed_header_stops_before_any_load(spark, stage, lake, run_ts):
    put_csv(stage, "a.csv", [settlement(1)])
    load(spark, ingest.SETTLEMENTS, stage, lake, run_ts)
    os.remove(stage / "a.csv")
    put_csv(stage, "b.csv", [settlement(2)], HEADER.replace("amount,currency", "Amount,currency"))
    with pytest.raises(ValidationFailed, match="^Schema drift: missing/changed columns amount$"):
        load(spark, ingest.SETTLEMENTS, stage, lake, run_ts + DAY)
    last = audit(lake)[-1]
    assert (last["status"], last["rows_loaded"], last["null_rows"], last["duplicate_rows"]) == ("Failed", 0, 0, 0)
    assert lake.raw("settlements").count() == 1


def test_header_only_file_is_empty(spark, stage, lake, run_ts):
    put_csv(stage, "a.csv", [])
    with pytest.raises(ValidationFailed, match="No rows found"):
        load(spark, ingest.SETTLEMENTS, stage, lake, run_ts)


def test_bad_value_lands_nothing(spark, stage, lake, run_ts):
    put_csv(stage, "a.csv", [settlement(1), settlement(2, amount="1x")])
    with pytest.raises(Exception, match="cannot read amount"):
        load(spark, ingest.SETTLEMENTS, stage, lake, run_ts)
    assert lake.raw("settlements").isEmpty() and lake.ledger("settlements").isEmpty() and not audit(lake)


def test_new_key_joins_the_baseline(spark, stage, lake, run_ts):
    put_json(stage, "a.json", [case(1)])
    load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts)
    put_json(stage, "b.json", [case(2, mood="calm")])
    load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts + DAY)
    known = {r["column_key"]: r for r in rows(lake.baseline("support_cases"))}
    assert set(known) == {"CASE_ID", "CUSTOMER_ID", "PRIORITY", "MOOD"}
    assert (known["CASE_ID"]["first_seen_at"], known["CASE_ID"]["last_seen_at"]) == (run_ts, run_ts + DAY)


def test_keys_survive_a_run_that_breaks_off(spark, stage, lake, run_ts, monkeypatch):
    put_json(stage, "a.json", [case(1)])
    for step in ("remember_keys", "append"):
        with monkeypatch.context() as patch:
            real = getattr(Lake, step)

            def broken(self, *args, step=step, real=real):
                if step == "remember_keys" or args[0].startswith("ledger/"):
                    raise RuntimeError("lost")
                return real(self, *args)

            patch.setattr(Lake, step, broken)
            with pytest.raises(RuntimeError, match="lost"):
                load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts)
        assert lake.baseline("support_cases").isEmpty() and lake.raw("support_cases").isEmpty()
    load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts + DAY)
    assert lake.baseline("support_cases").count() == 3
    put_json(stage, "b.json", [case(2, priority="absent")])
    with pytest.raises(ValidationFailed, match="missing fields PRIORITY"):
        load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts + 2 * DAY)


def test_missing_key_refuses_and_a_replaced_file_loads(spark, stage, lake, run_ts):
    put_json(stage, "a.json", [case(1)])
    load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts)
    put_json(stage, "b.json", [case(2, priority="absent")])
    with pytest.raises(ValidationFailed, match="^Schema drift: missing fields PRIORITY$"):
        load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts + DAY)
    assert lake.raw("support_cases").count() == 1
    assert audit(lake)[-1]["error_message"] == "Schema drift: missing fields PRIORITY"
    put_json(stage, "b.json", [case(2)])
    assert load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts + 2 * DAY).rows_loaded == 1


def test_failed_files_can_count_as_loaded(spark, stage, lake, run_ts):
    put_json(stage, "a.json", [case(1), case(1)])
    with pytest.raises(ValidationFailed):
        load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts, ledger_on_failure=True)
    assert load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts + DAY).message == NO_NEW_FILES
    assert lake.raw("support_cases").isEmpty()


def test_retired_key_is_no_longer_expected(spark, stage, lake, run_ts):
    put_json(stage, "a.json", [case(1)])
    load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts)
    lake.retire_key("support_cases", "PRIORITY", run_ts + dt.timedelta(hours=1))
    put_json(stage, "b.json", [case(2, priority="absent")])
    assert load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts + DAY).rows_loaded == 1


@pytest.mark.parametrize(
    "records, message",
    [
        ([case(1, case_id=None), case(2, case_id="absent"), case(3)], "2 rows with missing case_id/customer_id."),
        ([case(1), case(1), case(1)], "2 duplicate case_id(s) found."),
        ([case(1, customer_id=None), case(1)], "1 rows with missing case_id/customer_id."),
    ],
)
def test_refused_batches(spark, stage, lake, run_ts, records, message):
    put_json(stage, "a.json", records)
    with pytest.raises(ValidationFailed) as error:
        load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts)
    assert str(error.value) == message
    assert lake.baseline("support_cases").isEmpty()


def test_drift_is_named_before_nulls_and_duplicates(spark, stage, lake, run_ts):
    put_json(stage, "a.json", [case(1)])
    load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts)
    put_json(stage, "b.json", [case(2, priority="absent", customer_id=None), case(2, priority="absent")])
    with pytest.raises(ValidationFailed, match="Schema drift"):
        load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts + DAY)


def test_empty_file(spark, stage, lake, run_ts):
    put_json(stage, "a.json", ["\n"])
    with pytest.raises(ValidationFailed, match="No rows found"):
        load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts)
    put_json(stage, "a.json", [case(1)])
    load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts + DAY)
    put_json(stage, "b.json", ["\n"])
    with pytest.raises(ValidationFailed, match="missing fields CASE_ID, CUSTOMER_ID, PRIORITY"):
        load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts + 2 * DAY)


def test_broken_line_fails_the_strict_load(spark, stage, lake, run_ts):
    put_json(stage, "a.json", [case(1), "{oops\n"])
    with pytest.raises(Exception, match="not JSON"):
        load(spark, ingest.SUPPORT_CASES, stage, lake, run_ts)
    assert lake.raw("support_cases").isEmpty()


def test_broken_line_is_set_aside_by_the_lenient_load(spark, stage):
    put_json(stage, "a.json", [case(1), "{oops\n", "\n", case(2)])
    put_csv(stage, "a.csv", [settlement(1), "too,short", settlement(2, amount='"1,5"'), settlement(3, settlement_date="soon")])
    got = rows(files.read_ndjson_lenient(spark, str(stage), "*.json"))
    assert sorted(r["_is_bad"] for r in got) == [False, False, True]
    got = {r["settlement_id"]: r["_is_bad"] for r in rows(files.read_csv_lenient(spark, str(stage)))}
    assert got == {"s1": False, "too": True, "s2": True, "s3": True}


def test_rates_need_their_payload(spark, stage, lake, run_ts):
    good = {"base_currency": "USD", "payload": {"date": "2024-01-01", "rates": {"EUR": 0.9}}}
    put_json(stage, "a.json", [good])
    assert load(spark, ingest.EXCHANGE_RATES, stage, lake, run_ts).message == "Success: loaded 1 new file(s)."
    put_json(stage, "b.json", [{**good, "payload": {"date": "2024-01-02"}}])
    with pytest.raises(ValidationFailed, match="1 rows with null/empty rates payload."):
        load(spark, ingest.EXCHANGE_RATES, stage, lake, run_ts + DAY)


def test_arrival(spark, stage, lake):
    today = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    with pytest.raises(files.NothingArrived):
        load(spark, ingest.SUPPORT_CASES, stage, lake, today, expect_arrival=True)
    put_json(stage, "a.json", [case(1)])
    files.arrival_check(spark, str(stage), today.date())
    with pytest.raises(files.NothingArrived):
        files.arrival_check(spark, str(stage), dt.date(2020, 1, 1))
    (stage / "2020-01-01").mkdir()
    put_json(stage / "2020-01-01", "b.json", [case(1)])
    files.arrival_check(spark, str(stage), dt.date(2020, 1, 1))


def test_listing_and_documents(spark, stage, run_ts):
    (stage / "in").mkdir()
    (stage / "in" / "one.txt").write_bytes(b"page one\fpage two")
    (stage / "two.txt").write_bytes(b"x" * 300)
    listed = rows(files.list_files(spark, str(stage)), "relative_path")
    assert [(r["relative_path"], r["size"]) for r in listed] == [("in/one.txt", 17), ("two.txt", 300)]

    def pages(content: bytes) -> tuple[str, int]:
        parts = content.decode().split("\f")
        return " ".join(parts), len(parts)

    docs = files.load_documents(spark, str(stage), "*.txt", pages, run_ts)
    got = rows(docs, "file_name")
    assert [(r["file_name"], r["page_count"]) for r in got] == [("one.txt", 2), ("two.txt", 1)]
    assert got[0]["extracted_text"] == "page one page two" and got[0]["_loaded_at"] == run_ts
    assert max(len(r["preview"]) for r in rows(files.preview(docs))) == 200


def test_stream_health(spark, lake, run_ts):
    schema = "raw_payload string, _source_file string, _loaded_at timestamp_ntz, _is_bad boolean"
    day_one = spark.createDataFrame([('{"a":1,"b":2}', "f1", run_ts, False)], schema)
    assert check_stream_health(lake, day_one, load_history(day_one), run_ts) == CLEAN
    later = run_ts + DAY + dt.timedelta(hours=1)
    bad = spark.createDataFrame([('{"a":1}', "f2", later, False), ("{", "f3", later, True)], schema)
    text = check_stream_health(lake, bad.where("NOT _is_bad"), load_history(bad), later)
    assert text == "1 file(s) failed to parse. Schema drift: missing B. "
    quiet = later + 2 * DAY
    assert check_stream_health(lake, bad, load_history(bad), quiet) == "Schema drift: missing A, B. "


def test_run_records(spark, lake, run_ts):
    ingest.record_run(lake, "one", "MANUAL", "SUCCESS", run_ts, run_ts)
    got = rows(ingest.record_run(lake, "two", "SCHEDULED", "FAILED", run_ts, run_ts + DAY), "pipeline_name")
    assert [(r["pipeline_name"], r["status"]) for r in got] == [("one", "SUCCESS"), ("two", "FAILED")]


def test_pages_of_one_url_are_documents_of_their_own(spark, tmp_path):
    pages = [("http://a/x?b=1&c", "<p>first</p>"), ("http://a/x?b=1&c", "<p>second</p>"), ("http://a/y", None)]
    spark.createDataFrame(pages, "url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = rows(QUERIES["document_load"](spark, str(tmp_path)), "file_name", "preview")
    assert [(r["file_name"], r["preview"]) for r in got] == [
        ("http://a/x?b=1&c", "first"), ("http://a/x?b=1&c", "second"), ("http://a/y", "")
    ]


def test_documents_lie_many_to_a_folder_and_are_loaded_in_groups(spark, tmp_path, monkeypatch):
    """A folder a page cost a process and a listing task each, and an address longer than a file name failed."""
    urls = [f"http://a/{i % 7}?x=1+2%20&y=ü" for i in range(40)] + ["http://b/" + "long/" * 80 + "=1.txt", "", None]
    pages = [(url, f"<p>{i}</p>") for i, url in enumerate(urls)]
    spark.createDataFrame(pages, "url string, html string").repartition(2).write.parquet(f"{tmp_path}/pages.parquet")
    monkeypatch.setattr(files, "FILES_PER_FOLDER", 10)
    monkeypatch.setattr(files, "FOLDERS_PER_LOAD", 2)
    got = rows(QUERIES["document_load"](spark, str(tmp_path)), "file_name", "preview")
    none = "__HIVE_DEFAULT_PARTITION__"
    assert [(r["file_name"], r["preview"]) for r in got] == sorted((url or none, str(i)) for i, url in enumerate(urls))

    pages = spark.read.parquet(f"{tmp_path}/pages.parquet").withColumnRenamed("url", "name").coalesce(1)
    folders = files.stage_documents(pages, f"file://{tmp_path}/staged", "name", "html")
    listed = files.list_files(spark, f"file://{tmp_path}/staged", "*.txt")
    assert len(folders) == 5 and listed.count() == len(urls)


def test_rows_are_written_once(spark, stage, lake, run_ts, monkeypatch):
    """Landed rows are the raw rows: the ledger promotes them, and no file holds them a second time."""
    monkeypatch.setattr(ingest, "FILES_PER_READ", 1)
    for i in range(3):
        put_csv(stage, f"{i}.csv", [settlement(i)])
    load(spark, ingest.SETTLEMENTS, stage, lake, run_ts)
    root = lake.root.removeprefix("file://")
    found = [os.path.join(folder, name) for folder, _, names in os.walk(root) for name in names if name.endswith(".parquet")]
    whole = [f for f in found if "settlement_status" in spark.read.parquet(f).columns]
    assert sum(spark.read.parquet(f).count() for f in whole) == 3
    raw = lake.raw("settlements")
    assert raw.columns == [*[n for n, _ in ingest.files.SETTLEMENT_CSV], "_source_file", "_loaded_at", "batch_id"]
    assert sorted(r.settlement_id for r in raw.collect()) == ["s0", "s1", "s2"]


def test_a_load_at_the_same_time_keeps_the_rows_of_the_first(spark, stage, lake, run_ts):
    put_csv(stage, "a.csv", [settlement(1)])
    load(spark, ingest.SETTLEMENTS, stage, lake, run_ts)
    put_csv(stage, "b.csv", [settlement(2)])
    load(spark, ingest.SETTLEMENTS, stage, lake, run_ts)
    assert sorted(r.settlement_id for r in lake.raw("settlements").collect()) == ["s1", "s2"]
    put_csv(stage, "c.csv", [settlement(3), settlement(3)])
    with pytest.raises(ValidationFailed, match="duplicate"):
        load(spark, ingest.SETTLEMENTS, stage, lake, run_ts)
    assert lake.raw("settlements").count() == 2


def test_compressed_files_are_loaded_like_plain_ones(spark, tmp_path, run_ts):
    import gzip

    stage = tmp_path
    put_csv(stage, "a.csv", [settlement(1), settlement(2)])
    (stage / "b.csv.gz").write_bytes(gzip.compress((stage / "a.csv").read_bytes().replace(b"s1", b"s3").replace(b"s2", b"s4")))
    (stage / "c.txt").write_text("no settlements")
    assert files.read_csv_strict(spark, str(stage)).count() == 4
    headers = rows(files.csv_headers(spark, str(stage)), "_source_file")
    assert len(headers) == 2 and headers[0]["value"] == headers[1]["value"]


def test_staged_settlements_are_compressed(spark):
    from tidemark.catalog import queries

    stage = queries._stage_csv(queries.Models(spark, "/root/testdata/sf0.001"))
    assert files.read_csv_strict(spark, stage).count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert all(r["relative_path"].endswith(".csv.gz") for r in rows(files.list_files(spark, stage, "part-*")))
