"""Typed casts, transaction features, ratios and text helpers as Columns."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"

# Outcome groups and amount limits of the transaction features.
DECLINED_STATUSES = ("DECLINED", "FAILED")
SUCCESS_STATUSES = ("APPROVED", "SETTLED")
AMOUNT_LIMITS = (("MICRO", 25), ("SMALL", 200), ("MEDIUM", 1000))
LARGEST_BUCKET = "LARGE"


def money_from_cents(cents: Column) -> Column:
    """Whole cents to decimal(12,2) without passing through a double."""
    return (cents.cast("decimal(14,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def cents_of(value: Column, factor: int = 100) -> Column:
    return F.round(value * factor).cast("bigint")


def cast_strict(text: Column, to: str, field: str) -> Column:
    """Cast text, failing the job on a value that does not fit the type."""
    problem = F.concat(F.lit(f"cannot read {field} as {to}: "), text)
    return F.coalesce(text.try_cast(to), F.when(text.isNotNull(), F.raise_error(problem)))


def cast_lenient(text: Column, to: str) -> Column:
    """Cast text, giving NULL for a value that does not fit the type."""
    return text.try_cast(to)


def day_of_week(ts: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(ts) - 1


def time_features(ts: Column) -> dict[str, Column]:
    return {
        "transaction_date": F.to_date(ts),
        "transaction_hour": F.hour(ts),
        "day_of_week": day_of_week(ts),
        "is_weekend": day_of_week(ts).isin(0, 6),
        "is_late_night": F.hour(ts).between(0, 5),
    }


def amount_bucket(amount: Column) -> Column:
    """Size class; a missing amount falls through to the largest one."""
    chain = None
    for name, below in AMOUNT_LIMITS:
        chain = F.when(amount < below, name) if chain is None else chain.when(amount < below, name)
    return chain.otherwise(LARGEST_BUCKET)


def outcome_flags(status: Column) -> dict[str, Column]:
    return {
        "is_declined_or_failed": status.isin(*DECLINED_STATUSES),
        "is_successful": status.isin(*SUCCESS_STATUSES),
    }


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds; 0 rather than NULL over nothing."""
    return F.count_if(condition)


def mean_amount(amount: Column) -> Column:
    """Mean as a double of the exact decimal sum, the same at any partitioning."""
    return F.sum(amount).cast("double") / F.nullif(F.count(amount), F.lit(0))


def whole_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def ratio_micro(part: Column, whole: Column) -> Column:
    """part/whole in millionths, rounded half up, by whole-number arithmetic.

    NULL when whole is 0 or NULL.
    """
    n = F.nullif(whole.cast("bigint"), F.lit(0).cast("bigint"))
    return whole_div(part.cast("bigint") * 2_000_000 + n, n * 2)


def ratio_percent(part: Column, whole: Column) -> Column:
    """A percentage at two decimals of the six-decimal ratio."""
    return whole_div(ratio_micro(part, whole) + 50, F.lit(100)) / F.lit(100.0)


def days_between(later: Column, earlier: Column) -> Column:
    """Midnights crossed from earlier to later."""
    return F.datediff(later, earlier)


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits over the whole text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def html_text(html: Column) -> Column:
    """Visible text of a page: scripts, styles, comments and tags removed."""
    out = F.regexp_replace(html, r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>", " ")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?s)<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"[ \t\r\n]+", " "))
