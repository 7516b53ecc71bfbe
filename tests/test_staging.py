import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.latest import latest_per_key
from tidemark.plans import staging as S

LOADED = dt.datetime(2024, 1, 1)


def raw(spark, payloads, loaded=None):
    data = [(p if isinstance(p, str) else json.dumps(p), loaded or LOADED, f"f{i}.json") for i, p in enumerate(payloads)]
    return spark.createDataFrame(data, "raw_payload string, _loaded_at timestamp_ntz, _source_file string")


def account(i, updated, **more):
    base = {
        "account_id": i,
        "customer_id": "c",
        "account_type": "CREDIT",
        "account_status": "OPEN",
        "current_balance": 1.005,
        "currency": "USD",
        "created_at": "2020-01-01T00:00:00Z",
        "updated_at": updated,
    }
    return {**base, **more}


def test_flatten_and_latest(spark):
    df = S.stg_accounts(
        raw(
            spark,
            [
                {"records": [account("a", "2024-01-01 00:00:00"), account("b", "2024-01-01 00:00:00")]},
                {"records": [account("a", "2024-02-01 00:00:00", account_status="FROZEN")]},
                {"records": []},
                {"other": 1},
            ],
        )
    )
    got = rows(df, "account_id")
    assert [(r["account_id"], r["account_status_at_creation"]) for r in got] == [("a", "FROZEN"), ("b", "OPEN")]
    assert got[0]["balance_at_creation"] == Decimal("1.01")
    assert got[0]["created_at"] == dt.datetime(2020, 1, 1)


def test_version_without_time_loses_unless_asked(spark):
    df = raw(spark, [{"records": [account("a", "2024-01-01 00:00:00"), account("a", None, account_status="CLOSED")]}])
    assert S.stg_accounts(df).first().account_status_at_creation == "OPEN"
    assert S.stg_accounts(df, nulls="first").first().account_status_at_creation == "CLOSED"


def test_equal_versions_have_a_stable_winner(spark):
    versions = [account("a", "2024-01-01 00:00:00", account_type=t) for t in ("CREDIT", "SAVINGS", "CHECKING")]
    one = raw(spark, [{"records": versions}])
    other = raw(spark, [{"records": versions[::-1]}]).repartition(3)
    assert S.stg_accounts(one).first().account_type == S.stg_accounts(other).first().account_type


def test_text_and_variant_payloads_agree(spark):
    event = {"account_id": "1", "current_balance": "12.5", "updated_at": "2024-01-01 10:00:00.25", "account_status": None}
    text = raw(spark, [event])
    variant = text.withColumn("raw_payload", F.parse_json("raw_payload"))
    a, b = S.stg_account_activity(text).first(), S.stg_account_activity(variant).first()
    assert a == b
    assert a.balance == Decimal("12.50") and a.account_status is None and a.currency is None


def test_variant_records(spark):
    text = raw(spark, [{"records": [account("a", "2024-01-01 00:00:00")]}])
    variant = text.withColumn("raw_payload", F.parse_json("raw_payload"))
    assert rows(S.stg_accounts(text)) == rows(S.stg_accounts(variant))


def test_wrong_type_fails_the_read(spark):
    with pytest.raises(Exception, match="cannot read current_balance"):
        S.stg_account_activity(raw(spark, [{"account_id": "1", "current_balance": "lots"}])).collect()


def test_exchange_rates_one_row_per_quote(spark):
    payload = {
        "base_currency": "USD",
        "ingested_at": "2024-01-02T06:00:00",
        "payload": {"date": "2024-01-02", "rates": {"EUR": 0.91, "JPY": 150.123456}},
    }
    got = rows(S.stg_exchange_rates(raw(spark, [payload, {"payload": {}}])), "quote_currency")
    assert [(r["quote_currency"], r["exchange_rate"]) for r in got] == [
        ("EUR", Decimal("0.910000")),
        ("JPY", Decimal("150.123456")),
    ]
    assert got[0]["rate_date"] == dt.date(2024, 1, 2)


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    latest = latest_per_key(df, "k", ["id"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    expected = df.groupBy("k").agg(F.max("id").alias("id"))
    assert latest.exceptAll(expected).isEmpty() and expected.exceptAll(latest).isEmpty()


def test_settlements_keep_every_row(spark):
    data = [("s1",) * 4 + (LOADED, LOADED.date(), Decimal("1.00"), "USD", "SETTLED", Decimal("0.01"), LOADED, "f")] * 2
    schema = (
        "settlement_id string, transaction_id string, account_id string, merchant_id string, "
        "transaction_timestamp timestamp_ntz, settlement_date date, amount decimal(12,2), currency string, "
        "settlement_status string, fee_amount decimal(12,2), _loaded_at timestamp_ntz, _source_file string"
    )
    assert S.stg_settlements(spark.createDataFrame(data, schema)).count() == 2


def test_a_payload_that_is_not_json_fails(spark):
    from py4j.protocol import Py4JJavaError

    with pytest.raises(Py4JJavaError, match="(?i)malformed"):
        S.stg_support_cases(raw(spark, ["{broken"])).collect()
