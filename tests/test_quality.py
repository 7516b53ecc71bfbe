import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import drift, quality as Q
from tidemark.plans import health, inventory
from tidemark.plans.suite import PARITY, SUITE


def test_unique(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows(Q.unique_failures(df, "k")) == [{"value": "a", "n_records": 2}]
    assert Q.unique_failures(df.distinct(), "k").isEmpty()


def test_not_null_counts_columns_together(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
    assert rows(Q.not_null_failures(df, ["x", "y"])) == [
        {"column_name": "x", "failures": 1},
        {"column_name": "y", "failures": 2},
    ]


def test_accepted_values_let_null_pass(spark):
    df = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "s string")
    assert rows(Q.accepted_values_failures(df, "s", ["A"])) == [{"value": "B", "n_records": 2}]
    assert Q.accepted_values_failures(df, "s", ["A", "B"]).isEmpty()


def test_relationships(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "id string")
    assert rows(Q.relationship_failures(child, "k", parent, "id")) == [{"value": "x", "n_records": 2}]
    assert Q.relationship_failures(child.where("k = 'a'"), "k", parent, "id").isEmpty()


def test_parity(spark):
    three, two = spark.range(3), spark.range(2)
    assert Q.rowcount_parity_failures(three, three).isEmpty()
    assert rows(Q.rowcount_parity_failures(three, two)) == [{"summary_row_count": 3, "source_row_count": 2}]


def test_suite_has_every_promised_test():
    count = lambda kind: sum(len(getattr(t, kind)) for t in SUITE.values())
    assert (count("not_null"), count("accepted"), count("unique"), count("parents"), len(PARITY)) == (46, 22, 13, 9, 2)


def test_run_tests_reports_pass_and_fail(spark, run_ts):
    models = {
        "m": spark.createDataFrame([("a", "x"), ("a", None)], "k string, s string"),
        "p": spark.createDataFrame([("b",)], "k string"),
    }
    suite = {"m": Q.ModelTests(unique=("k",), not_null=("k", "s"), accepted={"s": ("x",)}, parents={"k": ("p", "k")})}
    out = Q.as_results(Q.run_tests(models, suite, [("m", "p")]), "r", run_ts)
    assert {(r["test_name"], r["test_status"], r["failures_count"]) for r in rows(out)} == {
        ("unique_k", "fail", 1),
        ("not_null_k", "pass", 0),
        ("not_null_s", "fail", 1),
        ("accepted_values_s", "pass", 0),
        ("relationships_k", "fail", 2),
        ("rowcount_parity", "fail", 1),
    }


def test_tests_observed_while_writing_equal_those_run_after(spark, run_ts, tmp_path):
    from tidemark.plans.graph import _settled

    raw = {
        "m": spark.createDataFrame([("a", "x"), ("a", None), (None, "y")] * 20, "k string, s string").repartition(5),
        "p": spark.createDataFrame([("b", "x")], "k string, s string"),
    }
    suite = {"m": Q.ModelTests(unique=("k",), not_null=("k", "s"), accepted={"s": ("x",)}), "p": Q.ModelTests(not_null=("k",))}
    observed = Q.Observed(suite)
    written = {n: _settled(spark, n, df, f"file://{tmp_path}", observed) for n, df in raw.items()}
    assert observed.rows("m") == 60 and len(observed.failures("m")) == 3
    results = [
        {tuple(r) for r in Q.run_tests(models, suite, [("m", "p")], seen).collect()} for models, seen in ((raw, None), (written, observed))
    ]
    assert results[0] == results[1] and ("m", "not_null", "s", 20) in results[0] and ("m", "rowcount_parity", "", 1) in results[0]


def test_models_that_do_not_need_each_other_are_written_at_once(spark, tmp_path, monkeypatch):
    """And with tests taken while writing, no month is dealt out if not asked for, and payloads are parsed once."""
    import threading

    from tidemark.plans import graph
    from tidemark.plans.suite import SUITE
    from tidemark.sources import tables as R

    raw = R.raw_tables(spark, "/root/testdata/sf0.001")
    both, settled = threading.Barrier(2, timeout=60), graph._settled

    def meet(spark, name, df, *how):
        if name in ("int_accounts_enriched", "int_transactions_unified"):
            both.wait()
        return settled(spark, name, df, *how)

    monkeypatch.setattr(graph, "_settled", meet)
    observed = Q.Observed(SUITE)
    folder = f"file://{tmp_path}/m"
    built = graph.build_models(spark, raw, R.AS_OF, folder, observed, by_month=False)
    plain = graph.build_models(spark, raw, R.AS_OF)
    assert set(built) == set(plain) and all(df.inputFiles()[0].startswith("file:///") for df in built.values())
    for name in ("stg_accounts_current", "int_transactions_unified", "mart_customer_360"):
        assert built[name].columns == plain[name].columns
        assert built[name].exceptAll(plain[name]).isEmpty() and plain[name].exceptAll(built[name]).isEmpty()


def test_values_are_compared_whole_where_a_hash_repeats(spark, monkeypatch):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("c",), ("c",), (None,), (None,)], "k string")
    assert Q.repeated_values(df, "k") == Q.unique_failures(df, "k").count() == 2
    assert Q.repeated_values(df.distinct(), "k") == Q.repeated_values(df.limit(0), "k") == 0
    monkeypatch.setattr(Q.F, "xxhash64", lambda c: F.length(c).cast("bigint"))  # all hashes alike
    assert Q.repeated_values(df, "k") == 2 and Q.repeated_values(df.distinct(), "k") == 0


def _raw_rows(spark):
    """A few rows of every raw table: a settlement twice, an account without customer, an unknown merchant."""
    import json

    def landed(*payloads):
        rows = [(json.dumps(p), dt.datetime(2024, 1, 2), "f") for p in payloads]
        return spark.createDataFrame(rows, "raw_payload string, _loaded_at timestamp_ntz, _source_file string")

    stamp = "2024-01-05 10:00:00"
    settled = [(f"s{i % 5}", f"Ss{i % 5}", f"a{i % 3}", "m1" if i else "m9", dt.datetime(2024, 1, 3), dt.date(2024, 1, 4)) for i in range(6)]
    columns = "settlement_id string, transaction_id string, account_id string, merchant_id string, transaction_timestamp timestamp_ntz, settlement_date date"
    settlements = spark.createDataFrame(settled, columns).selectExpr(
        "*", "cast(12.5 as decimal(12,2)) amount", "'USD' currency", "'SETTLED' settlement_status",
        "cast(1 as decimal(12,2)) fee_amount", "transaction_timestamp _loaded_at", "'f' _source_file",
    )
    event = {"amount": "3.50", "currency": "USD", "merchant_id": "m1", "event_timestamp": stamp, "channel": "ATM", "device_id": "D1"}
    account = {"account_type": "SAVINGS", "account_status": "OPEN", "current_balance": "5.00", "currency": "USD", "created_at": stamp, "updated_at": stamp}
    activity = {"account_status": "FROZEN", "current_balance": "7.00", "currency": "USD", "customer_id": "c1"}
    case = {"category": "FEE_INQUIRY", "priority": "HIGH", "status": "OPEN", "narrative": "text", "opened_at": stamp}
    return {
        "settlements": settlements,
        "partner_transactions": landed(*[event | {"event_id": f"{i}", "transaction_id": f"T{i}", "account_id": "a1", "authorization_status": x} for i, x in enumerate(("APPROVED", "ODD"))]),
        "customers_api_raw": landed({"records": [{"customer_id": c, "customer_status": "ACTIVE", "risk_rating": "LOW", "created_at": stamp, "updated_at": stamp} for c in ("c1", "c2")]}),
        "accounts_api_raw": landed({"records": [account | {"account_id": f"a{i}", "customer_id": f"c{i}"} for i in range(3)]}),
        "merchants_api_raw": landed({"records": [{"merchant_id": "m1", "merchant_name": "M", "industry": "FUEL", "risk_category": "LOW"}]}),
        "support_cases": landed(case | {"case_id": "1", "customer_id": "c1"}, case | {"case_id": "1", "customer_id": "c8"}),
        "external_exchange_rates": landed({"base_currency": "USD", "ingested_at": stamp, "payload": {"date": "2024-01-05", "rates": {"C1": 0.5}}}),
        "account_activity": landed(*[activity | {"account_id": f"a{i}", "updated_at": stamp} for i in (1, 1, 7)]),
    }


def test_models_are_tested_when_written_and_tables_go_that_nothing_reads(spark, tmp_path, monkeypatch):
    from tidemark.plans import graph
    from tidemark.sources.tables import AS_OF

    monkeypatch.setattr(Q, "HASHED_FROM", 1)
    raw, folder, observed = _raw_rows(spark), tmp_path / "m", Q.Observed(SUITE)
    found, beside = [], {}

    def test(models, names):
        suite = {n: tests for n, tests in SUITE.items() if n in names}
        beside.update({n: {p.name for p in folder.iterdir()} for n in names})
        found.extend(Q.run_tests(models, suite, [p for p in PARITY if p[0] in names], observed).collect() if suite else [])

    left = graph.build_models(spark, raw, AS_OF, f"file://{folder}", observed, by_month=False, written=test)
    assert set(beside) == set(graph.build_models(spark, raw, AS_OF))
    assert "stg_settlements" not in beside["int_transactions_unified"] and "stg_settlements" not in left
    assert "int_transactions_unified" not in beside["mart_customer_360"]
    assert {p.name for p in folder.iterdir()} == set(left)
    want = Q.run_tests(graph.build_models(spark, raw, AS_OF), SUITE, PARITY).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, want)) and len(found) == 92
    failed = {tuple(r)[:3]: r.failures for r in found if r.failures}
    assert failed[("stg_settlements", "unique", "settlement_id")] == 1
    assert failed[("int_transactions_unified", "relationships", "merchant_id")] == 1


def test_shuffle_files_are_removed_only_within(spark):
    from tidemark.session import REMOVE_SHUFFLES, shuffles_removed

    before = spark.conf.get(REMOVE_SHUFFLES, None)
    try:
        with shuffles_removed(spark):
            assert spark.conf.get(REMOVE_SHUFFLES) == "true"
            raise KeyError
    except KeyError:
        assert spark.conf.get(REMOVE_SHUFFLES, None) == before


def test_prints_of_months_are_whole_sums(spark):
    from tidemark.plans import monthly as M

    df = spark.range(3000).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 7 > 0, F.lit("2024-01")).alias("month"))
    hashed = df.select("month", F.xxhash64("k").alias("a"), F.xxhash64(F.lit(1), "k").alias("b")).collect()
    want = {}
    for r in hashed:
        n, a, b = want.get(r.month or M._NO_MONTH, (0, 0, 0))
        want[r.month or M._NO_MONTH] = (n + 1, a + r.a, b + r.b)
    assert M._prints(df) == {m: [str(x) for x in found] for m, found in want.items()}


def test_a_month_opens_its_folders_only(spark, tmp_path):
    from tidemark.plans.graph import _settled

    days = spark.range(90).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("transaction_date"), "id")
    stored = _settled(spark, "int_transactions_unified", days, f"file://{tmp_path}")
    march = stored.where("month = '2024-03'")
    assert march.count() == 30
    assert "PartitionFilters: [isnotnull(month" in march._jdf.queryExecution().executedPlan().toString()


def test_duplicates_count_rows_beyond_the_first(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert Q.duplicate_rows(df, F.col("k")).first().duplicate_rows == 3
    assert Q.duplicate_rows(df.limit(0), F.col("k")).first().duplicate_rows == 0


def test_verdict_names_the_first_failing_check(spark):
    labels = Q.BatchLabels("drift: ", " nulls", " dups", "empty")
    data = [("K", 1, 1, 0), ("", 2, 1, 9), ("", 0, 3, 9), ("", 0, 0, 0), ("", 0, 0, 9)]
    df = spark.createDataFrame(data, "missing_keys string, null_rows long, duplicate_rows long, rows_loaded long")
    got = [r.error_message for r in Q.batch_verdict(df, labels).collect()]
    assert got == ["drift: K", "2 nulls", "3 dups", "empty", None]


def test_freshness_by_age(spark, run_ts):
    warn, error = dt.timedelta(hours=12), dt.timedelta(hours=48)
    for hours, expected in ((11, "pass"), (13, "warn"), (49, "error")):
        df = spark.createDataFrame([(run_ts - dt.timedelta(hours=hours),)], "t timestamp_ntz")
        assert Q.freshness(df, "t", run_ts, warn, error).first().status == expected
    assert Q.freshness(df.limit(0), "t", run_ts, warn, error).first().status == "error"


def test_json_keys_are_upper_cased_headers_are_not(spark):
    lines = spark.createDataFrame([('{"a":1,"B":{"c":2}}',), ('{"d":null}',)], "raw_payload string")
    assert {r.column_key for r in drift.json_key_set(lines).collect()} == {"A", "B", "D"}
    header = spark.createDataFrame([('Id,"Amount",x\r',)], "value string")
    assert {r.column_key for r in drift.header_key_set(header).collect()} == {"Id", "Amount", "x"}


def test_baseline_only_grows(spark, run_ts):
    schema = "source_name string, column_key string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz"
    old = dt.datetime(2024, 1, 1)
    baseline = spark.createDataFrame([("s", "A", old, old), ("s", "B", old, old)], schema)
    actual = spark.createDataFrame([("B",), ("C",)], "column_key string")
    stamp = F.lit("2024-01-31 08:00:00").cast("timestamp_ntz")
    got = {r["column_key"]: (r["first_seen_at"], r["last_seen_at"]) for r in rows(drift.snapshot_upsert(baseline, actual, "s", stamp))}
    assert got == {"A": (old, old), "B": (old, run_ts), "C": (run_ts, run_ts)}


def test_missing_keys_ignore_additions(spark):
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "column_key string")
    assert [r.column_key for r in drift.missing_keys(keys("A", "B"), keys("B", "C")).collect()] == ["A"]
    assert drift.key_list(drift.missing_keys(keys("A"), keys("A"))).first().missing_keys == ""


def test_history_lists_recent_files_with_errors(spark, run_ts):
    day = dt.timedelta(days=1)
    data = [("old", run_ts - 2 * day, True), ("bad", run_ts, True), ("bad", run_ts, False), ("good", run_ts, False)]
    history = health.load_history(spark.createDataFrame(data, "_source_file string, _loaded_at timestamp_ntz, _is_bad boolean"))
    got = rows(health.load_history_errors(history, run_ts))
    assert [(r["_source_file"], r["row_count"], r["error_count"]) for r in got] == [("bad", 2, 1)]


def test_inventory_is_in_order_of_name(spark, run_ts):
    a = spark.createDataFrame([(run_ts,)], "t timestamp_ntz")
    got = [tuple(r) for r in inventory.table_inventory({"b": (a, "t"), "a": (a.limit(0), "t")}).collect()]
    assert got == [("a", 0, None), ("b", 1, run_ts)]
