"""Documented capabilities beyond the model graph: conversion to USD, rolling windows, audit hashes."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators.joins import lookup_join
from tidemark.session import settle

HASH_SEPARATOR = "\u0001"
HASH_NULL = "\u0000"
BALANCE_TOLERANCE = 0.005


def rates_by_month(rates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(currency, month, by_day): the rate known on each day from a currency's first to its last rate; and
    (currency, last_day, last_rate), which holds from then on.

    A day's rate is the one received last; a day without one has that of the day before. A window holds the days of
    one currency, however many transactions there are.
    """
    daily = rates.groupBy(F.col("quote_currency").alias("currency"), F.col("rate_date").alias("day")).agg(
        F.max_by("exchange_rate", F.struct("ingested_at", "exchange_rate")).alias("known_rate")
    )
    daily = daily.where(F.col("known_rate").isNotNull() & F.col("day").isNotNull())
    spans = daily.groupBy("currency").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.max_by("known_rate", "day").alias("last_rate")
    )
    days = spans.select("currency", F.explode(F.sequence("first_day", "last_day")).alias("day"))
    upto = Window.partitionBy("currency").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    filled = days.join(daily, ["currency", "day"], "left").withColumn("rate", F.last("known_rate", ignorenulls=True).over(upto))
    by_day = F.map_from_entries(F.collect_list(F.struct(F.dayofmonth("day"), "rate")))
    months = filled.groupBy("currency", F.trunc("day", "month").alias("month")).agg(by_day.alias("by_day"))
    return months, spans.drop("first_day")


def fx_to_usd(transactions: DataFrame, rates: DataFrame, spread_by: Column) -> DataFrame:
    """Transactions with ``amount_usd``; NULL where no rate is known yet.

    Rates say how much of a currency one dollar buys, so amounts are divided by them. The transactions are read
    once: they meet a row per currency and month, and a row per currency for the days after its last rate.
    ``spread_by`` tells transactions apart where a busy currency has to be split.
    """
    months, newest = (settle(t, "rates") for t in rates_by_month(rates))
    day = F.col("transaction_date")
    priced = lookup_join(transactions.withColumn("month", F.trunc(day, "month")), months, ["currency", "month"], spread_by, "left")
    priced = lookup_join(priced, newest, ["currency"], spread_by, "left")
    rate = F.when(day > F.col("last_day"), F.col("last_rate")).otherwise(F.try_element_at("by_day", F.dayofmonth(day)))
    usd = F.when(F.col("currency") == "USD", F.col("amount")).otherwise(F.round(F.col("amount") / F.col("rate"), 2).cast(C.MONEY))
    return priced.withColumn("rate", rate).withColumn("amount_usd", usd).drop("month", "by_day", "last_day", "last_rate")


def rolling_30_60_90(
    accounts: DataFrame, transactions: DataFrame, cases: DataFrame, spans: tuple[int, ...] = (30, 60, 90)
) -> DataFrame:
    """Per customer and active day: volume, failure ratio and tickets of the trailing windows.

    Everything is reduced to days first, so a window holds at most the days of one customer. Amounts are added up as
    whole numbers of their smallest unit. A trailing sum is the sum up to a day less the sum up to the day before the
    span, so a day is added up once per span and not again for every window that holds it.
    """
    scale = transactions.schema["amount"].dataType.scale
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    spent = transactions.select(
        "account_id",
        F.col("transaction_date").alias("day"),
        (F.col("amount") * F.lit(10**scale)).cast("bigint").alias("units"),
        one.alias("n"),
        F.when(F.col("is_declined_or_failed"), one).otherwise(zero).alias("failed"),
        zero.alias("tickets"),
    )
    # Written first, so that both sides of the join are plain shuffles, of which Spark splits those of a busy account.
    owners = settle(accounts.select("account_id", "customer_id"), "owners").hint("merge")
    asked = cases.select(
        "customer_id",
        F.to_date("opened_at").alias("day"),
        zero.alias("units"),
        zero.alias("n"),
        zero.alias("failed"),
        one.alias("tickets"),
    )
    days = spent.join(owners, "account_id").drop("account_id").unionByName(asked).groupBy("customer_id", "day").agg(
        F.count("units").alias("valued"), *[F.sum(c).alias(c) for c in ("units", "n", "failed", "tickets")]
    )
    measures = ["units", "valued", "n", "failed", "tickets"]
    by_day = Window.partitionBy("customer_id").orderBy(F.unix_date("day"))
    upto = by_day.rowsBetween(Window.unboundedPreceding, 0)
    sums = {c: F.sum(c).over(upto) for c in measures}
    for span in spans:
        before = by_day.rangeBetween(Window.unboundedPreceding, -span)
        sums |= {f"{c}_{span}": F.sum(c).over(before) for c in measures}
    days = days.select("customer_id", "day", *[total.alias(name) for name, total in sums.items()])
    out = ["customer_id", "day"]
    for span in spans:

        def within(measure: str, span: int = span) -> Column:
            # rows without a day stand before all others and are not before themselves
            earlier = F.when(F.col("day").isNotNull(), F.col(f"{measure}_{span}"))
            return F.coalesce(measure, F.lit(0)) - F.coalesce(earlier, F.lit(0))

        volume = within("units").cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))
        out += [
            F.when(within("valued") > 0, volume).alias(f"volume_{span}d"),
            C.ratio_percent(within("failed"), within("n")).alias(f"failure_pct_{span}d"),
            within("tickets").alias(f"tickets_{span}d"),
        ]
    return days.select(*out)


def merchant_failed_settlement_ratio(settlements: DataFrame) -> DataFrame:
    """Share of failed settlements per merchant; the sources carry no disputes to take instead."""
    failed = C.count_where(F.col("settlement_status") == "FAILED")
    return settlements.groupBy("merchant_id").agg(
        F.count("*").alias("settlement_count"),
        failed.alias("failed_count"),
        C.ratio_percent(failed, F.count("*")).alias("chargeback_ratio_pct"),
    )


def settlement_audit_hash(settlements: DataFrame) -> DataFrame:
    """A hash over each settlement's business values; NULL differs from an empty text."""
    fields = (
        "settlement_id",
        "account_id",
        "merchant_id",
        "settlement_date",
        "amount",
        "currency",
        "settlement_status",
        "fee_amount",
    )
    texts = [F.coalesce(F.col(f).cast("string"), F.lit(HASH_NULL)) for f in fields]
    return settlements.select("settlement_id", F.sha2(F.concat_ws(HASH_SEPARATOR, *texts), 256).alias("audit_hash"))


def case_open_age(cases: DataFrame, as_of: dt.date) -> DataFrame:
    """Days each unresolved case has been open."""
    return cases.where("status <> 'RESOLVED'").select(
        "case_id", "priority", "status", C.days_between(F.lit(as_of), F.col("opened_at")).alias("open_days")
    )


def _previous_in_ranges(df: DataFrame, key: str, order: Column, values: list[str]) -> DataFrame:
    """Adds ``prev_<value>`` of the row before, per key.

    All rows are put in order of key and time and cut into ranges of about equal numbers of rows, whatever
    the keys; equal rows are told apart by where they were read, so any key can be cut anywhere. The first row
    of a range takes over from the last row of the range before, known from one row per range.
    """
    # written first, as dealing out by range reads its input twice
    placed = settle(df.withColumns({"_order": order, "_place": F.monotonically_increasing_id()}), "placed")
    ranged = placed.repartitionByRange(key, "_order", "_place")
    rows = settle(ranged.withColumn("_range", F.spark_partition_id()), "ranges")  # numbers are given once
    now = F.struct(key, *values)
    within = Window.partitionBy("_range").orderBy(key, "_order", "_place")
    ends = rows.groupBy("_range").agg(F.max_by(now, F.struct(key, "_order", "_place")).alias("_end"))
    # as many rows as there are ranges
    carried = settle(ends.select("_range", F.lag("_end").over(Window.orderBy("_range")).alias("_carried")), "range-ends")
    out = rows.withColumns({"_lag": F.lag(now).over(within), "_nth": F.row_number().over(within)})
    out = out.join(F.broadcast(carried), "_range")
    before = F.when(F.col("_nth") > 1, F.col("_lag")).otherwise(F.col("_carried"))
    of_key = F.when(before[key] == F.col(key), before)
    return out.withColumns({f"prev_{v}": of_key[v] for v in values}).drop("_order", "_place", "_range", "_lag", "_nth", "_carried")


def activity_state_changes(activity: DataFrame) -> DataFrame:
    """Events at which an account's status differs from the one before, with the balance moved since."""
    order = F.struct("activity_timestamp", "_source_file", "account_status", "balance")
    seen = activity.where(F.col("account_id").isNotNull() & F.col("activity_timestamp").isNotNull())
    seen = seen.select("account_id", "activity_timestamp", "_source_file", "account_status", "balance")
    rows = _previous_in_ranges(seen, "account_id", order, ["account_status", "balance"])
    return rows.where(F.col("prev_account_status") != F.col("account_status")).select(
        "account_id",
        "activity_timestamp",
        F.col("prev_account_status").alias("from_status"),
        F.col("account_status").alias("to_status"),
        (F.col("balance") - F.col("prev_balance")).alias("balance_delta"),
    )


def assert_balance(settlements: DataFrame) -> DataFrame:
    """Settlements whose gross is not net plus fee, net being what the fee leaves of it."""
    net = F.col("amount") - F.coalesce("fee_amount", F.lit(0))
    gap = F.abs(F.col("amount") - net - F.col("fee_amount"))
    return settlements.where(gap.isNull() | (gap > BALANCE_TOLERANCE)).select("settlement_id", "amount", "fee_amount")


def dim_customers(mart: DataFrame, scores: DataFrame) -> DataFrame:
    return mart.select(
        "customer_id", "first_name", "last_name", "customer_status", "risk_rating", "engagement_segment"
    ).join(scores.select("customer_id", "churn_probability"), "customer_id", "left")


def dim_merchants(mart: DataFrame) -> DataFrame:
    return mart.select(
        "merchant_id", "merchant_name", "merchant_category_code", "industry", "country", "risk_category"
    )


def fct_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        "transaction_id",
        "account_id",
        "merchant_id",
        "transaction_date",
        "amount",
        "status",
        "transaction_source",
        "amount_bucket",
        "is_declined_or_failed",
    )
