import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions.columns import outcome_flags
from tidemark.plans import intermediate as I
from tidemark.plans import marts as M

AS_OF = dt.date(2024, 1, 31)


def transactions(spark, data):
    """(account, merchant, days before the reference date, status) rows with an amount of 10."""
    days = [(f"t{i}", a, m, AS_OF - dt.timedelta(days=d), s, Decimal("10.00")) for i, (a, m, d, s) in enumerate(data)]
    df = spark.createDataFrame(
        days, "transaction_id string, account_id string, merchant_id string, transaction_date date, status string, amount decimal(12,2)"
    )
    return df.withColumns(outcome_flags(F.col("status")))


def test_live_state_goes_before_the_snapshot(spark):
    t0, t1 = dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 5)
    accounts = spark.createDataFrame(
        [(i, "c", "CREDIT", "USD", t0, "OPEN", Decimal("5.00")) for i in ("a", "b", "c")],
        "account_id string, customer_id string, account_type string, currency string, created_at timestamp_ntz, "
        "account_status_at_creation string, balance_at_creation decimal(12,2)",
    )
    current = spark.createDataFrame(
        [("a", "FROZEN", Decimal("7.00"), t1), ("b", None, None, None)],
        "account_id string, account_status string, current_balance decimal(12,2), updated_at timestamp_ntz",
    )
    got = {r["account_id"]: r for r in rows(I.int_accounts_enriched(accounts, current))}
    assert (got["a"]["account_status"], got["a"]["current_balance"], got["a"]["last_updated_at"]) == ("FROZEN", Decimal("7.00"), t1)
    assert (got["b"]["account_status"], got["b"]["last_updated_at"], got["b"]["has_activity_history"]) == ("OPEN", t0, True)
    assert got["c"]["has_activity_history"] is False


def _customers(spark, ids, rating="LOW"):
    return spark.createDataFrame(
        [(i, "F", "L", "ACTIVE", rating, dt.datetime(2023, 1, 31)) for i in ids],
        "customer_id string, first_name string, last_name string, customer_status string, risk_rating string, created_at timestamp_ntz",
    )


def _accounts(spark, pairs):
    return spark.createDataFrame(
        [(a, c, s, Decimal("2.50"), dt.datetime(2024, 1, 1)) for a, c, s in pairs],
        "account_id string, customer_id string, account_status string, current_balance decimal(12,2), last_updated_at timestamp_ntz",
    )


CASES = "case_id string, customer_id string, priority string, status string"


def test_recency_and_segments(spark):
    ages = {"c30": 30, "c31": 31, "c90": 90, "c91": 91}
    ids = [*ages, "none", "noaccount"]
    accounts = _accounts(spark, [(f"a{c}", c, "OPEN") for c in ids if c != "noaccount"])
    txns = transactions(spark, [(f"a{c}", "m", d, "SETTLED") for c, d in ages.items()])
    cases = spark.createDataFrame([], CASES)
    out = I.int_customer_activity_summary(_customers(spark, ids), accounts, txns, cases, AS_OF)
    got = {r["customer_id"]: r for r in rows(out)}
    assert {c: got[c]["engagement_segment"] for c in ids} == {
        "c30": "ACTIVE",
        "c31": "AT_RISK",
        "c90": "AT_RISK",
        "c91": "DORMANT",
        "none": "NEVER_TRANSACTED",
        "noaccount": "NEVER_TRANSACTED",
    }
    assert got["none"]["days_since_last_transaction"] == 9999 and got["none"]["last_transaction_date"] is None
    assert (got["c30"]["transaction_count_30d"], got["c31"]["transaction_count_30d"]) == (1, 0)
    assert got["noaccount"]["total_accounts"] == 0 and got["noaccount"]["avg_account_balance"] == 0.0
    assert got["c30"]["account_age_days"] == 365


def test_risk_flag_is_three_valued(spark):
    customers = _customers(spark, ["unrated", "frozen", "case"], rating=None).unionByName(_customers(spark, ["low"]))
    accounts = _accounts(spark, [("a", "frozen", "FROZEN"), ("b", "unrated", "OPEN")])
    cases = spark.createDataFrame([("1", "case", "HIGH", "OPEN")], CASES)
    out = I.int_customer_activity_summary(customers, accounts, transactions(spark, [("a", "m", 1, "FAILED")]), cases, AS_OF)
    assert {r["customer_id"]: r["has_risk_flag"] for r in rows(out)} == {
        "unrated": None,
        "frozen": True,
        "case": True,
        "low": False,
    }


def test_decline_flag_needs_volume_and_share(spark):
    def part(merchant, failed, total):
        return [("a", merchant, 40, "FAILED" if i < failed else "SETTLED") for i in range(total)]

    txns = transactions(spark, part("few", 3, 19) + part("edge", 3, 20) + part("high", 4, 20))
    merchants = spark.createDataFrame(
        [(m, "n", "1", "FUEL", "X", "LOW") for m in ("few", "edge", "high", "idle")],
        "merchant_id string, merchant_name string, merchant_category_code string, industry string, country string, risk_category string",
    )
    got = {r["merchant_id"]: r for r in rows(I.int_merchant_risk_summary(merchants, txns, AS_OF))}
    assert {m: r["is_high_decline_merchant"] for m, r in got.items()} == {
        "few": False,
        "edge": False,
        "high": True,
        "idle": False,
    }
    assert got["edge"]["decline_rate_pct"] == 15.0 and got["edge"]["decline_rate_30d_pct"] is None
    assert got["idle"]["decline_rate_pct"] is None and got["idle"]["total_transaction_amount"] == 0


def test_separate_and_joint_summaries_agree(spark):
    accounts = _accounts(spark, [("a", "x", "OPEN"), ("b", "x", "CLOSED"), ("c", "y", "FROZEN")])
    txns = transactions(spark, [("a", "m", 1, "FAILED"), ("a", "m", 50, "SETTLED"), ("c", "m", 2, "PENDING"), ("zz", "m", 2, "FAILED")])
    both = I.account_and_transaction_summary(accounts, txns, AS_OF)
    apart = I.account_summary(accounts).join(I.transaction_summary(accounts, txns, AS_OF), "customer_id")
    assert rows(both, "customer_id") == rows(apart, "customer_id")


def _unified(spark):
    t = dt.datetime(2024, 1, 6, 3)
    settlements = spark.createDataFrame(
        [("s1", "a", "m", t, Decimal("10.00"), "USD", "FAILED"), ("s2", "a", "m", t, Decimal("20.00"), "USD", "SETTLED")],
        "settlement_id string, account_id string, merchant_id string, transaction_timestamp timestamp_ntz, amount decimal(12,2), currency string, settlement_status string",
    )
    partner = spark.createDataFrame(
        [("e1", "t1", "a", "m", t, Decimal("5.00"), "USD", "APPROVED", "ATM")],
        "event_id string, transaction_id string, account_id string, merchant_id string, event_timestamp timestamp_ntz, amount decimal(12,2), currency string, authorization_status string, channel string",
    )
    return I.int_transactions_unified(settlements, partner)


def test_daily_kpi_adds_up_to_the_transactions(spark):
    day = M.mart_daily_transaction_kpi(_unified(spark)).first()
    assert (day.total_transaction_count, day.settlement_count, day.partner_event_count) == (3, 2, 1)
    assert (day.total_transaction_amount, day.weekend_amount) == (Decimal("35.00"), Decimal("35.00"))
    assert (day.declined_or_failed_count, day.successful_count, day.late_night_transaction_count) == (1, 2, 3)
    assert day.decline_rate_pct == 33.33


def test_one_origin_reads_one_branch(spark, tmp_path):
    unified = _unified(spark)
    plan = unified.where("transaction_source = 'PARTNER_EVENT'")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    assert [r["transaction_channel"] for r in rows(unified, "transaction_id")] == [None, None, "ATM"]


def test_busy_account_reaches_the_join_as_one_row(spark):
    accounts = _accounts(spark, [(f"a{i}", f"c{i % 5}", "OPEN") for i in range(50)])
    busy = spark.range(0, 3000).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "a0").otherwise(F.concat(F.lit("a"), F.col("id") % 50)).alias("account_id"),
        F.lit("m").alias("merchant_id"),
        F.lit(AS_OF).alias("transaction_date"),
        F.lit("FAILED").alias("status"),
        F.lit("1.00").cast("decimal(12,2)").alias("amount"),
    ).withColumns(outcome_flags(F.col("status")))
    got = {r.customer_id: r.transaction_count_all_time for r in I.transaction_summary(accounts, busy, AS_OF).collect()}
    direct = busy.join(accounts, "account_id").groupBy("customer_id").count()
    assert got == {r.customer_id: r["count"] for r in direct.collect()}
