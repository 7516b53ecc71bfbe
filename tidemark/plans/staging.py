"""Typed views over the raw tables: flatten, cast, keep the latest version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.payload import Field, explode_records, extract_fields, is_variant
from tidemark.operators.latest import latest_per_key

NTZ = "timestamp_ntz"
LOAD_COLUMNS = ["_loaded_at", "_source_file"]

SETTLEMENT_COLUMNS = [
    "settlement_id",
    "transaction_id",
    "account_id",
    "merchant_id",
    "transaction_timestamp",
    "settlement_date",
    "amount",
    "currency",
    "settlement_status",
    "fee_amount",
]

# JSON field, model column, type.
PARTNER: list[Field] = [
    ("event_id", "event_id", "string"),
    ("transaction_id", "transaction_id", "string"),
    ("account_id", "account_id", "string"),
    ("merchant_id", "merchant_id", "string"),
    ("event_timestamp", "event_timestamp", NTZ),
    ("amount", "amount", "decimal(12,2)"),
    ("currency", "currency", "string"),
    ("authorization_status", "authorization_status", "string"),
    ("channel", "channel", "string"),
    ("device_id", "device_id", "string"),
]
SUPPORT: list[Field] = [
    ("case_id", "case_id", "string"),
    ("customer_id", "customer_id", "string"),
    ("category", "category", "string"),
    ("priority", "priority", "string"),
    ("status", "status", "string"),
    ("narrative", "narrative", "string"),
    ("opened_at", "opened_at", NTZ),
]
ACTIVITY: list[Field] = [
    ("account_id", "account_id", "string"),
    ("customer_id", "customer_id", "string"),
    ("account_status", "account_status", "string"),
    ("current_balance", "balance", "decimal(12,2)"),
    ("currency", "currency", "string"),
    ("updated_at", "activity_timestamp", NTZ),
]
CUSTOMER: list[Field] = [
    ("customer_id", "customer_id", "string"),
    ("first_name", "first_name", "string"),
    ("last_name", "last_name", "string"),
    ("email", "email", "string"),
    ("phone", "phone", "string"),
    ("city", "city", "string"),
    ("state", "state", "string"),
    ("country", "country", "string"),
    ("customer_status", "customer_status", "string"),
    ("risk_rating", "risk_rating", "string"),
    ("created_at", "created_at", NTZ),
    ("updated_at", "updated_at", NTZ),
]
ACCOUNT: list[Field] = [
    ("account_id", "account_id", "string"),
    ("customer_id", "customer_id", "string"),
    ("account_type", "account_type", "string"),
    ("account_status", "account_status_at_creation", "string"),
    ("current_balance", "balance_at_creation", "decimal(12,2)"),
    ("currency", "currency", "string"),
    ("created_at", "created_at", NTZ),
    ("updated_at", "file_updated_at", NTZ),
]
MERCHANT: list[Field] = [
    ("merchant_id", "merchant_id", "string"),
    ("merchant_name", "merchant_name", "string"),
    ("merchant_category_code", "merchant_category_code", "string"),
    ("industry", "industry", "string"),
    ("country", "country", "string"),
    ("risk_category", "risk_category", "string"),
]


def stg_settlements(raw: DataFrame) -> DataFrame:
    return raw.select(*SETTLEMENT_COLUMNS, *LOAD_COLUMNS)


def stg_partner_transactions(raw: DataFrame) -> DataFrame:
    """Reads whichever events it is given: all of them, or only the clean ones."""
    return extract_fields(raw, PARTNER, LOAD_COLUMNS)


def stg_support_cases(raw: DataFrame) -> DataFrame:
    return extract_fields(raw, SUPPORT, LOAD_COLUMNS)


def stg_account_activity(raw: DataFrame) -> DataFrame:
    """Every status and balance change ever sent."""
    return extract_fields(raw, ACTIVITY, LOAD_COLUMNS)


def _row_hash(columns: list[Field]) -> list:
    return ["_source_file", F.xxhash64(*[name for _, name, _ in columns])]


def stg_customers(raw: DataFrame, nulls: str = "last") -> DataFrame:
    rows = explode_records(raw, CUSTOMER, LOAD_COLUMNS)
    return latest_per_key(rows, "customer_id", ["updated_at", "_loaded_at"], _row_hash(CUSTOMER), nulls)


def stg_accounts(raw: DataFrame, nulls: str = "last") -> DataFrame:
    rows = explode_records(raw, ACCOUNT, LOAD_COLUMNS)
    return latest_per_key(rows, "account_id", ["file_updated_at", "_loaded_at"], _row_hash(ACCOUNT), nulls)


def stg_merchants(raw: DataFrame, nulls: str = "last") -> DataFrame:
    rows = explode_records(raw, MERCHANT, LOAD_COLUMNS)
    return latest_per_key(rows, "merchant_id", ["_loaded_at"], _row_hash(MERCHANT), nulls)


def stg_exchange_rates(raw: DataFrame) -> DataFrame:
    """One row per entry of the rates object."""
    schema = T.StructType(
        [
            T.StructField("base_currency", T.StringType()),
            T.StructField("ingested_at", T.StringType()),
            T.StructField(
                "payload",
                T.StructType(
                    [
                        T.StructField("date", T.StringType()),
                        T.StructField("rates", T.MapType(T.StringType(), T.DecimalType(12, 6))),
                    ]
                ),
            ),
        ]
    )
    text = F.to_json("raw_payload") if is_variant(raw, "raw_payload") else F.col("raw_payload")
    parsed = raw.select(F.from_json(text, schema).alias("_obj"), *LOAD_COLUMNS)
    obj = F.col("_obj")
    return parsed.select(
        obj["base_currency"].alias("base_currency"),
        obj["ingested_at"].cast(NTZ).alias("ingested_at"),
        obj["payload"]["date"].cast("date").alias("rate_date"),
        F.explode(obj["payload"]["rates"]).alias("quote_currency", "exchange_rate"),
        *LOAD_COLUMNS,
    )


def stg_accounts_current(raw_activity: DataFrame, nulls: str = "last") -> DataFrame:
    """The newest known state of each account, from the event log."""
    return accounts_current(stg_account_activity(raw_activity), nulls)


def accounts_current(activity: DataFrame, nulls: str = "last") -> DataFrame:
    """The same from the typed events."""
    events = activity.select(
        "account_id",
        "customer_id",
        "account_status",
        F.col("balance").alias("current_balance"),
        "currency",
        F.col("activity_timestamp").alias("updated_at"),
        "_source_file",
    )
    ties = ["_source_file", F.xxhash64("customer_id", "account_status", "current_balance", "currency")]
    return latest_per_key(events, "account_id", ["updated_at"], ties, nulls).drop("_source_file")


def staging_models(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_settlements": stg_settlements(raw["settlements"]),
        "stg_partner_transactions": stg_partner_transactions(raw["partner_transactions"]),
        "stg_support_cases": stg_support_cases(raw["support_cases"]),
        "stg_account_activity": stg_account_activity(raw["account_activity"]),
        "stg_customers": stg_customers(raw["customers_api_raw"]),
        "stg_accounts": stg_accounts(raw["accounts_api_raw"]),
        "stg_merchants": stg_merchants(raw["merchants_api_raw"]),
        "stg_exchange_rates": stg_exchange_rates(raw["external_exchange_rates"]),
        "stg_accounts_current": stg_accounts_current(raw["account_activity"]),
    }
