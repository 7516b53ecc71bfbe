"""The tables that reports and the metric layer read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import columns as C

# The published columns of the two entity marts.
CUSTOMER_360 = [
    "customer_id",
    "first_name",
    "last_name",
    "customer_status",
    "risk_rating",
    "customer_since",
    "account_age_days",
    "total_accounts",
    "open_accounts",
    "frozen_accounts",
    "closed_accounts",
    "total_balance",
    "avg_account_balance",
    "transaction_count_all_time",
    "transaction_count_30d",
    "transaction_amount_30d",
    "failed_payment_count",
    "last_transaction_date",
    "days_since_last_transaction",
    "support_case_count",
    "high_priority_case_count",
    "open_case_count",
    "engagement_segment",
    "has_risk_flag",
]
MERCHANT_PERFORMANCE = [
    "merchant_id",
    "merchant_name",
    "merchant_category_code",
    "industry",
    "country",
    "risk_category",
    "total_transaction_count",
    "total_transaction_amount",
    "avg_transaction_amount",
    "declined_count",
    "transaction_count_30d",
    "declined_count_30d",
    "last_transaction_date",
    "decline_rate_pct",
    "decline_rate_30d_pct",
    "is_high_decline_merchant",
]


def mart_customer_360(customer_summary: DataFrame) -> DataFrame:
    return customer_summary.select(*CUSTOMER_360)


def mart_merchant_performance(merchant_summary: DataFrame) -> DataFrame:
    return merchant_summary.select(*MERCHANT_PERFORMANCE)


def mart_daily_transaction_kpi(transactions: DataFrame) -> DataFrame:
    """One row per transaction date."""
    declined = C.count_where(F.col("is_declined_or_failed"))
    origin = F.col("transaction_source")
    return transactions.groupBy("transaction_date").agg(
        F.count("*").alias("total_transaction_count"),
        F.sum("amount").alias("total_transaction_amount"),
        C.mean_amount(F.col("amount")).alias("avg_transaction_amount"),
        C.count_where(F.col("is_successful")).alias("successful_count"),
        declined.alias("declined_or_failed_count"),
        C.ratio_percent(declined, F.count("*")).alias("decline_rate_pct"),
        C.count_where(origin == "SETTLEMENT").alias("settlement_count"),
        C.count_where(origin == "PARTNER_EVENT").alias("partner_event_count"),
        F.sum(F.when(F.col("is_weekend"), F.col("amount")).otherwise(0)).alias("weekend_amount"),
        C.count_where(F.col("is_late_night")).alias("late_night_transaction_count"),
    )
