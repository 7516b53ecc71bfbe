"""Metric layer, log triage and the extra reports."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import log_triage as L
from tidemark.plans import extras, semantic


@pytest.fixture
def marts(spark):
    customers = spark.createDataFrame(
        [("a", "ACTIVE", "ACTIVE", 10, 4), ("b", "ACTIVE", "DORMANT", 20, 1), ("c", "CLOSED", "ACTIVE", 5, 0)],
        "customer_id string, customer_status string, engagement_segment string, total_balance long, transaction_count_all_time long",
    )
    merchants = spark.createDataFrame(
        [("m", "FUEL", "US", 7)], "merchant_id string, industry string, country string, total_transaction_amount long"
    )
    return {"mart_customer_360": customers, "mart_merchant_performance": merchants}


def test_metrics_by_synonym(marts):
    got = semantic.metric_query(marts, ["Total Deposits", "customer_count", "avg_transactions_per_customer"], ["account status"])
    assert rows(got, "status") == [
        {"status": "ACTIVE", "total_customer_balance": 30, "customer_count": 2, "avg_transactions_per_customer": 2.5},
        {"status": "CLOSED", "total_customer_balance": 5, "customer_count": 1, "avg_transactions_per_customer": 0.0},
    ]


def test_metric_filters(marts):
    got = semantic.metric_query(marts, ["customer_count"], [], [("engagement", "=", "ACTIVE"), ("status", "in", ["ACTIVE"])])
    assert rows(got) == [{"customer_count": 1}]


def test_metric_requests_that_make_no_sense(marts):
    ask = lambda m, d=(): semantic.metric_query(marts, m, d)
    for metrics, dims in (
        (["customer_count", "merchant_count"], ()),
        (["customer_count"], ["country"]),
        (["customer_count"], ["merchants.country"]),
        (["no such thing"], ()),
        ([], ()),
    ):
        with pytest.raises(semantic.MetricError):
            ask(metrics, dims)
    assert semantic.resolve_table("Vendor") == "merchants"
    assert semantic.resolve("merchants.country", "dimensions") == ("merchants", "country")
    with pytest.raises(semantic.MetricError, match="unknown"):
        semantic.resolve("country", "dimensions", "customers")


def triage(spark, lines):
    df = spark.createDataFrame([("t", i, v) for i, v in enumerate(lines)], "task string, pos long, value string")
    return L.log_triage(df.repartition(3), ["task"]).first().error_summary


def test_triage_keeps_the_first_five_in_order(spark):
    lines = ["Failure in test z", "noise", "Failure in test z"] + [f"Failure in test t{i}" for i in range(6)]
    assert triage(spark, lines) == "; ".join(f"Test failed: {n}" for n in ("z", "t0", "t1", "t2", "t3"))


def test_triage_reads_through_colour_and_takes_all_hits_of_a_line(spark):
    line = "\x1b[31mDatabase Error in \x1b[0mmodel stg_a Failure in test uniq; ERROR creating sql view model core.m"
    assert triage(spark, [line]) == "Model failed to build: core.m; Database error: stg_a; Test failed: uniq"


def test_triage_without_a_hit(spark):
    assert triage(spark, ["all fine"]) == L.FALLBACK


def test_triage_of_files(spark, tmp_path):
    (tmp_path / "a.log").write_text("x\nFailure in test b\nFailure in test a\n")
    (tmp_path / "b.log").write_text("ok\n")
    got = rows(L.log_triage(L.read_log_lines(spark, str(tmp_path)), ["log"]), "log")
    assert [r["error_summary"] for r in got] == ["Test failed: b; Test failed: a", L.FALLBACK]
    log = L.log_triage(L.read_log_lines(spark, str(tmp_path)), ["log"]).select(
        F.lit("d").alias("dag_id"), F.col("log").alias("task_id"), F.lit("1").alias("attempt"), "error_summary"
    )
    out = f"file://{tmp_path}/errors"
    L.error_log_append(spark, out, log, "b1")
    assert L.error_log_append(spark, out, log, "b1").count() == 2


def test_conversion_takes_the_rate_of_the_day_or_the_last_before(spark):
    day = lambda d: dt.date(2024, 1, d)
    rates = spark.createDataFrame(
        [
            ("EUR", day(2), Decimal("0.500000"), dt.datetime(2024, 1, 2)),
            ("EUR", day(4), Decimal("0.800000"), dt.datetime(2024, 1, 4)),
            ("EUR", day(4), Decimal("0.400000"), dt.datetime(2024, 1, 5)),
        ],
        "quote_currency string, rate_date date, exchange_rate decimal(12,6), ingested_at timestamp_ntz",
    )
    data = [("EUR", day(1)), ("EUR", day(2)), ("EUR", day(3)), ("EUR", day(9)), ("USD", day(3)), ("XXX", day(3))]
    txns = spark.createDataFrame([(c, d, Decimal("2.00")) for c, d in data], "currency string, transaction_date date, amount decimal(12,2)")
    got = [r["amount_usd"] for r in rows(extras.fx_to_usd(txns, rates, F.col("amount")), "currency", "transaction_date")]
    assert got == [None, Decimal("4.00"), Decimal("4.00"), Decimal("5.00"), Decimal("2.00"), None]


def test_state_changes_across_slices(spark):
    rng = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    events = [("hot" if rng.random() < 0.5 else f"a{rng.randrange(9)}", rng.choice(["OPEN", "FROZEN"]), m) for m in rng.sample(range(20000), 600)]
    df = spark.createDataFrame(
        [(a, s, Decimal(m), t0 + dt.timedelta(minutes=m), "f") for a, s, m in events],
        "account_id string, account_status string, balance decimal(12,2), activity_timestamp timestamp_ntz, _source_file string",
    )
    expected, last = set(), {}
    for a, s, m in sorted(events, key=lambda e: e[2]):
        if a in last and last[a][0] != s:
            expected.add((a, t0 + dt.timedelta(minutes=m), last[a][0], s, Decimal(m) - last[a][1]))
        last[a] = (s, Decimal(m))
    for merged in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merged)
        try:
            got = extras.activity_state_changes(df)
            assert {tuple(r) for r in got.collect()} == expected
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranges_are_even_where_a_third_of_all_rows_are_alike(spark, monkeypatch):
    t0 = dt.datetime(2024, 1, 1)
    made = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 700)).alias("account_id"),
        F.when(F.col("id") % 2 == 0, "OPEN").otherwise("FROZEN").alias("account_status"),
        F.lit(1).cast("decimal(12,2)").alias("balance"),
        F.lit(t0).cast("timestamp_ntz").alias("activity_timestamp"),
        F.lit("f").alias("_source_file"),
    )
    kept = {}
    real = extras.settle
    monkeypatch.setattr(extras, "settle", lambda df, name: kept.setdefault(name, real(df, name)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        changes = extras.activity_state_changes(made).groupBy("account_id").count().collect()
        sizes = sorted(r["count"] for r in kept["ranges"].groupBy("_range").count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and sizes[-1] < 1.5 * sizes[0]
    assert {r["account_id"]: r["count"] for r in changes}["hot"] == 1  # all frozen rows sort before the open ones


def test_transactions_are_read_once_for_their_rates(spark):
    txns = spark.range(5).select(F.lit("C1").alias("currency"), F.lit(dt.date(2024, 3, 1)).alias("transaction_date"), F.col("id").cast("decimal(12,2)").alias("amount"))
    rates = spark.createDataFrame([("C1", dt.date(2024, 1, 30), Decimal("2"), dt.datetime(2024, 1, 30))], "quote_currency string, rate_date date, exchange_rate decimal(12,6), ingested_at timestamp_ntz")
    plan = extras.fx_to_usd(txns, rates, F.col("amount"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


def test_audit_hash_tells_null_from_empty(spark):
    schema = (
        "settlement_id string, account_id string, merchant_id string, settlement_date date, amount decimal(12,2), "
        "currency string, settlement_status string, fee_amount decimal(12,2)"
    )
    base = ["s", "a", "m", dt.date(2024, 1, 1), Decimal("1.00"), "", "SETTLED", None]
    other = [*base[:5], None, *base[6:]]
    hashes = [r.audit_hash for r in extras.settlement_audit_hash(spark.createDataFrame([base, other, base], schema)).collect()]
    assert hashes[0] == hashes[2] != hashes[1]


def test_balance_check_reports_a_missing_fee(spark):
    df = spark.createDataFrame(
        [("a", Decimal("1.00"), Decimal("0.10")), ("b", Decimal("1.00"), None)],
        "settlement_id string, amount decimal(12,2), fee_amount decimal(12,2)",
    )
    assert [r.settlement_id for r in extras.assert_balance(df).collect()] == ["b"]


def _spending(spark, hot=0):
    day = lambda n: None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)
    rng = random.Random(4)
    spent = [(rng.choice(["a1", "a2", "b1", "x"]), day(rng.randrange(200)), Decimal(rng.randrange(-5000, 9000)) / 100, rng.random() < 0.3) for _ in range(150)]
    spent += [("a1", day(20), Decimal("1e9"), True)] * hot
    spent += [("c1", day(5), None, None), ("c1", day(40), Decimal("2.50"), True), ("a2", None, Decimal("7.77"), False), ("a2", None, None, True), (None, day(3), Decimal(1), True)]
    asked = [("a", day(n)) for n in (3, 3, 33, 95)] + [("b", day(150)), ("d", day(1)), ("a", None)]
    owners = {"a1": "a", "a2": "a", "b1": "b", "c1": "c"}
    accounts = spark.createDataFrame(list(owners.items()), "account_id string, customer_id string")
    transactions = spark.createDataFrame(spent, "account_id string, transaction_date date, amount decimal(12,2), is_declined_or_failed boolean")
    cases = spark.createDataFrame([(c, d and dt.datetime(d.year, d.month, d.day, 9)) for c, d in asked], "customer_id string, opened_at timestamp_ntz")
    return (accounts, transactions, cases), [(owners[a], *r) for a, *r in spent if a in owners], asked


@pytest.mark.parametrize("hot", [0, 400])
def test_trailing_sums_equal_brute_force(spark, hot):
    tables, spent, asked = _spending(spark, hot)
    got = {(r["customer_id"], r["day"]): r for r in extras.rolling_30_60_90(*tables, spans=(1, 30, 90)).collect()}
    assert set(got) == {(c, d) for c, d, *_ in spent} | set(asked)
    for (customer, day), r in got.items():
        for span in (1, 30, 90):
            near = lambda d: d is None if day is None else d is not None and 0 <= (day - d).days < span
            of = [x for x in spent if x[0] == customer and near(x[1])]
            tickets = sum(c == customer and near(d) for c, d in asked)
            amounts = [x[2] for x in of if x[2] is not None] + [Decimal(0)] * tickets
            failed = sum(bool(x[3]) for x in of)
            micro = of and (failed * 2_000_000 + len(of)) // (2 * len(of))
            assert r[f"volume_{span}d"] == (sum(amounts) if amounts else None)
            assert r[f"tickets_{span}d"] == tickets
            assert r[f"failure_pct_{span}d"] == ((micro + 50) // 100 / 100 if of else None)


def test_trailing_sums_shuffle_and_add_each_row_a_fixed_number_of_times(spark):
    tables, _, _ = _spending(spark)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        plan = extras.rolling_30_60_90(*tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    # rows and accounts by account, days by customer and day, days by customer
    assert plan.count("Exchange hashpartitioning") == 4
    # no frame drops days again, which would add up the days of a window for every day
    assert "specifiedwindowframe(RangeFrame, -" not in plan and "specifiedwindowframe(RangeFrame, unboundedpreceding$(), -" in plan
