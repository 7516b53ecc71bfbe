"""Unified transactions, enriched accounts, and the customer and merchant roll-ups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import columns as C

# Origin tags of a transaction, and the recency of a customer without any.
SETTLEMENT = ("SETTLEMENT", "BATCH")
PARTNER_EVENT = ("PARTNER_EVENT", "SNOWPIPE_REALTIME")
NO_RECENCY_DAYS = 9999
ACTIVE_WITHIN_DAYS = 30
AT_RISK_WITHIN_DAYS = 90
DECLINE_MIN_COUNT = 20
DECLINE_LIMIT_MICRO = 150_000


def int_accounts_enriched(accounts: DataFrame, current: DataFrame) -> DataFrame:
    """Accounts with live state where the activity log knows better."""
    live = current.select(
        "account_id",
        F.col("account_status").alias("_status"),
        F.col("current_balance").alias("_balance"),
        F.col("updated_at").alias("_updated"),
        F.lit(True).alias("_seen"),
    )
    return accounts.join(live, "account_id", "left").select(
        "account_id",
        "customer_id",
        "account_type",
        "currency",
        "created_at",
        F.coalesce("_status", "account_status_at_creation").alias("account_status"),
        F.coalesce("_balance", "balance_at_creation").alias("current_balance"),
        F.coalesce("_updated", "created_at").alias("last_updated_at"),
        F.col("_seen").isNotNull().alias("has_activity_history"),
    )


def _common_shape(
    df: DataFrame, txn_id: str, ts: str, status: str, origin: tuple[str, str], channel: Column
) -> DataFrame:
    return df.select(
        F.col(txn_id).alias("transaction_id"),
        "account_id",
        "merchant_id",
        F.col(ts).alias("transaction_timestamp"),
        "amount",
        "currency",
        F.col(status).alias("status"),
        F.lit(origin[0]).alias("transaction_source"),
        F.lit(origin[1]).alias("ingestion_channel"),
        channel.alias("transaction_channel"),
    )


def int_transactions_unified(settlements: DataFrame, partner: DataFrame) -> DataFrame:
    """Settlements and authorization events in one shape, with features added once."""
    both = _common_shape(
        settlements,
        "settlement_id",
        "transaction_timestamp",
        "settlement_status",
        SETTLEMENT,
        F.lit(None).cast("string"),
    ).unionByName(
        _common_shape(
            partner,
            "transaction_id",
            "event_timestamp",
            "authorization_status",
            PARTNER_EVENT,
            F.col("channel"),
        )
    )
    return both.withColumns(
        {
            **C.time_features(F.col("transaction_timestamp")),
            "amount_bucket": C.amount_bucket(F.col("amount")),
            **C.outcome_flags(F.col("status")),
        }
    )


def _account_measures() -> list[Column]:
    status = F.col("account_status")
    return [
        F.count("*").alias("total_accounts"),
        C.count_where(status == "OPEN").alias("open_accounts"),
        C.count_where(status == "FROZEN").alias("frozen_accounts"),
        C.count_where(status == "CLOSED").alias("closed_accounts"),
        F.sum("current_balance").alias("total_balance_across_accounts"),
        C.mean_amount(F.col("current_balance")).alias("avg_account_balance"),
        F.max("last_updated_at").alias("most_recent_account_update"),
    ]


def account_summary(accounts: DataFrame) -> DataFrame:
    return accounts.groupBy("customer_id").agg(*_account_measures())


def _recent(as_of: dt.date) -> Column:
    return F.col("transaction_date") >= F.lit(as_of - dt.timedelta(days=30))


def _accounts_with_activity(accounts: DataFrame, transactions: DataFrame, as_of: dt.date) -> DataFrame:
    """Accounts next to their transaction totals.

    Transactions shrink to one row per account before they meet the accounts, so the join
    moves account-sized data and a busy account cannot overload a task.
    """
    recent = _recent(as_of)
    per_account = transactions.groupBy("account_id").agg(
        F.count("transaction_id").alias("_n"),
        C.count_where(recent).alias("_n_30d"),
        F.sum(F.when(recent, F.col("amount"))).alias("_amount_30d"),
        C.count_where(F.col("is_declined_or_failed")).alias("_failed"),
        F.max("transaction_date").alias("_last_date"),
    )
    return accounts.join(per_account, "account_id", "left")


def _transaction_measures(as_of: dt.date) -> list[Column]:
    none, last_date = F.lit(0), F.max("_last_date")
    return [
        F.sum(F.coalesce("_n", none)).alias("transaction_count_all_time"),
        F.sum(F.coalesce("_n_30d", none)).alias("transaction_count_30d"),
        F.coalesce(F.sum("_amount_30d"), none).alias("transaction_amount_30d"),
        F.sum(F.coalesce("_failed", none)).alias("failed_payment_count"),
        last_date.alias("last_transaction_date"),
        C.days_between(F.lit(as_of), last_date).alias("days_since_last_transaction"),
    ]


def transaction_summary(accounts: DataFrame, transactions: DataFrame, as_of: dt.date) -> DataFrame:
    """Per customer, over every account including those that never transacted."""
    rows = _accounts_with_activity(accounts, transactions, as_of)
    return rows.groupBy("customer_id").agg(*_transaction_measures(as_of))


def account_and_transaction_summary(
    accounts: DataFrame, transactions: DataFrame, as_of: dt.date
) -> DataFrame:
    """Both summaries in one pass over the accounts and one shuffle by customer."""
    rows = _accounts_with_activity(accounts, transactions, as_of)
    return rows.groupBy("customer_id").agg(*_account_measures(), *_transaction_measures(as_of))


def support_summary(cases: DataFrame) -> DataFrame:
    return cases.groupBy("customer_id").agg(
        F.count("*").alias("support_case_count"),
        C.count_where(F.col("priority") == "HIGH").alias("high_priority_case_count"),
        C.count_where(F.col("status") == "OPEN").alias("open_case_count"),
    )


def engagement_segment(recency: Column) -> Column:
    return (
        F.when(recency.isNull(), "NEVER_TRANSACTED")
        .when(recency <= ACTIVE_WITHIN_DAYS, "ACTIVE")
        .when(recency <= AT_RISK_WITHIN_DAYS, "AT_RISK")
        .otherwise("DORMANT")
    )


def int_customer_activity_summary(
    customers: DataFrame, accounts: DataFrame, transactions: DataFrame, cases: DataFrame, as_of: dt.date
) -> DataFrame:
    """One row per customer, active or not."""
    rows = customers.join(
        account_and_transaction_summary(accounts, transactions, as_of), "customer_id", "left"
    ).join(support_summary(cases), "customer_id", "left")
    or_zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    recency = F.col("days_since_last_transaction")
    risk = (
        (F.col("risk_rating") == "HIGH")
        | (or_zero("frozen_accounts") > 0)
        | (or_zero("high_priority_case_count") > 0)
    )
    return rows.select(
        "customer_id",
        "first_name",
        "last_name",
        "customer_status",
        "risk_rating",
        F.col("created_at").alias("customer_since"),
        C.days_between(F.lit(as_of), F.col("created_at")).alias("account_age_days"),
        *[or_zero(c).alias(c) for c in ("total_accounts", "open_accounts", "frozen_accounts", "closed_accounts")],
        or_zero("total_balance_across_accounts").alias("total_balance"),
        F.coalesce("avg_account_balance", F.lit(0.0)).alias("avg_account_balance"),
        *[
            or_zero(c).alias(c)
            for c in (
                "transaction_count_all_time",
                "transaction_count_30d",
                "transaction_amount_30d",
                "failed_payment_count",
            )
        ],
        "last_transaction_date",
        F.coalesce(recency, F.lit(NO_RECENCY_DAYS)).alias("days_since_last_transaction"),
        *[or_zero(c).alias(c) for c in ("support_case_count", "high_priority_case_count", "open_case_count")],
        engagement_segment(recency).alias("engagement_segment"),
        risk.alias("has_risk_flag"),
    )


def merchant_txn_summary(transactions: DataFrame, as_of: dt.date) -> DataFrame:
    recent, declined = _recent(as_of), F.col("is_declined_or_failed")
    return transactions.groupBy("merchant_id").agg(
        F.count("*").alias("total_transaction_count"),
        F.sum("amount").alias("total_transaction_amount"),
        C.mean_amount(F.col("amount")).alias("avg_transaction_amount"),
        C.count_where(declined).alias("declined_count"),
        C.count_where(F.col("is_successful")).alias("successful_count"),
        C.count_where(recent).alias("transaction_count_30d"),
        C.count_where(recent & declined).alias("declined_count_30d"),
        F.max("transaction_date").alias("last_transaction_date"),
    )


def high_decline(declined: Column, total: Column) -> Column:
    """At least 20 transactions with more than 15 % of them declined."""
    enough = F.coalesce(total, F.lit(0)) >= DECLINE_MIN_COUNT
    return enough & (C.ratio_micro(declined, total) > DECLINE_LIMIT_MICRO)


def int_merchant_risk_summary(merchants: DataFrame, transactions: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per merchant, active or not."""
    rows = merchants.join(merchant_txn_summary(transactions, as_of), "merchant_id", "left")
    or_zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    total, declined = F.col("total_transaction_count"), F.col("declined_count")
    return rows.select(
        "merchant_id",
        "merchant_name",
        "merchant_category_code",
        "industry",
        "country",
        "risk_category",
        or_zero("total_transaction_count").alias("total_transaction_count"),
        or_zero("total_transaction_amount").alias("total_transaction_amount"),
        F.coalesce("avg_transaction_amount", F.lit(0.0)).alias("avg_transaction_amount"),
        or_zero("declined_count").alias("declined_count"),
        or_zero("transaction_count_30d").alias("transaction_count_30d"),
        or_zero("declined_count_30d").alias("declined_count_30d"),
        "last_transaction_date",
        C.ratio_percent(declined, total).alias("decline_rate_pct"),
        C.ratio_percent(F.col("declined_count_30d"), F.col("transaction_count_30d")).alias(
            "decline_rate_30d_pct"
        ),
        high_decline(declined, total).alias("is_high_decline_merchant"),
    )
