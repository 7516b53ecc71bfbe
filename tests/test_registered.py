"""Registered queries against their SQL, at the smallest scale.

The quick ones run always; TIDEMARK_ALL_QUERIES=1 runs every one.
"""

import math
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("TIDEMARK_SF_DIR", "/root/testdata/sf0.001")
QUICK = [
    "scan_ndjson_variant",
    "load_lenient",
    "document_text",
    "sink_upsert",
    "validate_and_load_settlements",
    "batch_verdict",
    "stream_health",
    "test_relationships",
    "log_triage_summary",
    "stg_customers",
    "stg_accounts",
    "stg_exchange_rates",
    "int_transactions_unified",
    "mart_customer_360",
    "mart_merchant_performance",
    "mart_daily_transaction_kpi",
    "metric_query",
    "search_policy_docs",
    "vector_topk",
    "auc_by_rank",
    "churn_outcome_counts",
    "stream_partner_ingest",
    "stream_cdc_merge",
    "rolling_30_60_90",
]
ORACLE = entry.oracle_sql()
NAMES = sorted(ORACLE) if os.environ.get("TIDEMARK_ALL_QUERIES") else QUICK

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        if file.endswith(".parquet"):
            con.sql(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(round(value, 9)) if isinstance(value, float) else str(value)


def table_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    expected = duck.execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    assert table_of(df.columns, df.collect()) == table_of(columns, expected.fetchall())


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "transaction_date" and df.count() > 0
