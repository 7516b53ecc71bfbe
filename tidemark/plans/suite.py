"""The column tests of every model, as fixed values."""

from __future__ import annotations

import datetime as dt

from tidemark.operators.quality import ModelTests

STATUSES_OF_ACCOUNTS = ("OPEN", "FROZEN", "CLOSED")
STATUSES_OF_CUSTOMERS = ("ACTIVE", "DORMANT", "CLOSED")
LEVELS = ("LOW", "MEDIUM", "HIGH")

# Which columns each model promises to keep unique, filled, enumerated or matched.
SUITE: dict[str, ModelTests] = {
    "stg_account_activity": ModelTests(
        not_null=("account_id", "activity_timestamp"),
        accepted={"account_status": STATUSES_OF_ACCOUNTS},
        parents={"account_id": ("stg_accounts", "account_id")},
    ),
    "stg_accounts": ModelTests(
        unique=("account_id",),
        not_null=("account_id", "customer_id", "account_type"),
        accepted={
            "account_type": ("CHECKING", "SAVINGS", "CREDIT"),
            "account_status_at_creation": STATUSES_OF_ACCOUNTS,
            "currency": ("USD",),
        },
        parents={"customer_id": ("stg_customers", "customer_id")},
    ),
    "stg_accounts_current": ModelTests(
        unique=("account_id",),
        not_null=("account_id", "account_status", "current_balance"),
        accepted={"account_status": STATUSES_OF_ACCOUNTS, "currency": ("USD",)},
    ),
    "stg_customers": ModelTests(
        unique=("customer_id",),
        not_null=("customer_id", "customer_status"),
        accepted={"customer_status": STATUSES_OF_CUSTOMERS, "risk_rating": LEVELS},
    ),
    "stg_exchange_rates": ModelTests(
        not_null=("base_currency", "quote_currency", "exchange_rate", "rate_date"),
    ),
    "stg_merchants": ModelTests(
        unique=("merchant_id",),
        not_null=("merchant_id", "merchant_name", "risk_category", "industry"),
        accepted={"risk_category": LEVELS},
    ),
    "stg_partner_transactions": ModelTests(
        unique=("event_id",),
        not_null=("event_id", "account_id", "merchant_id", "authorization_status"),
        accepted={
            "authorization_status": ("APPROVED", "DECLINED", "PENDING"),
            "channel": ("ONLINE", "IN_STORE", "MOBILE_APP", "ATM"),
        },
        parents={
            "account_id": ("stg_accounts", "account_id"),
            "merchant_id": ("stg_merchants", "merchant_id"),
        },
    ),
    "stg_settlements": ModelTests(
        unique=("settlement_id",),
        not_null=("settlement_id", "account_id", "merchant_id", "amount", "settlement_status"),
        accepted={"settlement_status": ("SETTLED", "PENDING", "FAILED")},
        parents={
            "account_id": ("stg_accounts", "account_id"),
            "merchant_id": ("stg_merchants", "merchant_id"),
        },
    ),
    "stg_support_cases": ModelTests(
        unique=("case_id",),
        not_null=("case_id", "customer_id", "category", "narrative"),
        accepted={
            "category": (
                "CARD_DECLINE",
                "UNAUTHORIZED_TRANSACTION",
                "FEE_INQUIRY",
                "ACCOUNT_ACCESS",
                "PAYMENT_FAILURE",
                "ACCOUNT_CLOSURE",
            ),
            "priority": LEVELS,
            "status": ("OPEN", "RESOLVED", "ESCALATED"),
        },
        parents={"customer_id": ("stg_customers", "customer_id")},
    ),
    "int_customer_activity_summary": ModelTests(
        unique=("customer_id",),
        not_null=(
            "customer_id",
            "customer_status",
            "total_accounts",
            "total_balance",
            "transaction_count_all_time",
            "engagement_segment",
            "has_risk_flag",
        ),
        accepted={
            "customer_status": STATUSES_OF_CUSTOMERS,
            "risk_rating": LEVELS,
            "engagement_segment": ("NEVER_TRANSACTED", "ACTIVE", "AT_RISK", "DORMANT"),
        },
    ),
    "int_merchant_risk_summary": ModelTests(
        unique=("merchant_id",),
        not_null=("merchant_id", "is_high_decline_merchant"),
        accepted={"risk_category": LEVELS},
    ),
    "int_transactions_unified": ModelTests(
        unique=("transaction_id",),
        not_null=("transaction_id", "account_id", "merchant_id"),
        accepted={
            "transaction_source": ("SETTLEMENT", "PARTNER_EVENT"),
            "ingestion_channel": ("BATCH", "SNOWPIPE_REALTIME"),
            "amount_bucket": ("MICRO", "SMALL", "MEDIUM", "LARGE"),
        },
        parents={
            "account_id": ("stg_accounts", "account_id"),
            "merchant_id": ("stg_merchants", "merchant_id"),
        },
    ),
    "mart_customer_360": ModelTests(unique=("customer_id",), not_null=("customer_id",)),
    "mart_daily_transaction_kpi": ModelTests(unique=("transaction_date",), not_null=("transaction_date",)),
    "mart_merchant_performance": ModelTests(unique=("merchant_id",), not_null=("merchant_id",)),
}

PARITY = (
    ("int_customer_activity_summary", "stg_customers"),
    ("int_merchant_risk_summary", "stg_merchants"),
)

FRESHNESS = {
    "partner_transactions": (dt.timedelta(hours=12), dt.timedelta(hours=48)),
    "account_activity": (dt.timedelta(days=3), dt.timedelta(days=7)),
}
