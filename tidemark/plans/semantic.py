"""Named metrics over the marts: ask for metrics, dimensions and filters by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Metric:
    how: str
    of: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Dimension:
    column: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class LogicalTable:
    mart: str
    key: str
    synonyms: tuple[str, ...]
    facts: dict[str, str]
    dimensions: dict[str, Dimension]
    metrics: dict[str, Metric] = field(default_factory=dict)


# The published names of tables, facts, dimensions and metrics, with other names for them.
CATALOGUE: dict[str, LogicalTable] = {
    "customers": LogicalTable(
        mart="mart_customer_360",
        key="customer_id",
        synonyms=("customer", "client", "accountholder"),
        facts={
            "balance_amount": "total_balance",
            "transaction_count": "transaction_count_all_time",
            "failed_payments": "failed_payment_count",
            "support_cases": "support_case_count",
        },
        dimensions={
            "customer_id": Dimension("customer_id"),
            "status": Dimension("customer_status", ("account status",)),
            "risk_rating": Dimension("risk_rating"),
            "engagement": Dimension("engagement_segment", ("activity level", "churn risk segment")),
            "has_risk_flag": Dimension("has_risk_flag"),
        },
        metrics={
            "total_customer_balance": Metric("sum", "balance_amount", ("total balance", "total deposits")),
            "avg_transactions_per_customer": Metric("avg", "transaction_count"),
            "total_failed_payments": Metric("sum", "failed_payments"),
            "total_support_cases": Metric("sum", "support_cases"),
            "customer_count": Metric("count", "customer_id", ("number of customers", "customer count")),
        },
    ),
    "merchants": LogicalTable(
        mart="mart_merchant_performance",
        key="merchant_id",
        synonyms=("merchant", "vendor", "business"),
        facts={"transaction_amount": "total_transaction_amount", "declined_transactions": "declined_count"},
        dimensions={
            "merchant_id": Dimension("merchant_id"),
            "merchant_name": Dimension("merchant_name"),
            "industry": Dimension("industry"),
            "country": Dimension("country"),
            "risk_category": Dimension("risk_category"),
            "is_high_decline": Dimension("is_high_decline_merchant", ("problem merchant", "risky merchant")),
        },
        metrics={
            "total_merchant_volume": Metric(
                "sum", "transaction_amount", ("total merchant sales", "merchant transaction volume")
            ),
            "total_declines": Metric("sum", "declined_transactions"),
            "merchant_count": Metric("count", "merchant_id"),
        },
    ),
    "daily_kpis": LogicalTable(
        mart="mart_daily_transaction_kpi",
        key="transaction_date",
        synonyms=("daily transactions", "transaction volume"),
        facts={
            "day_transaction_amount": "total_transaction_amount",
            "day_transaction_count": "total_transaction_count",
        },
        dimensions={"date": Dimension("transaction_date")},
        metrics={
            "total_daily_volume": Metric("sum", "day_transaction_amount", ("daily transaction value", "daily revenue")),
            "total_daily_count": Metric("sum", "day_transaction_count"),
        },
    ),
}


class MetricError(ValueError):
    """A name that is unknown, means two things, or reaches across tables."""


def _same(a: str, b: str) -> bool:
    plain = lambda s: " ".join(s.lower().replace("_", " ").split())
    return plain(a) == plain(b)


def _matches(name: str, known: str, synonyms: Sequence[str]) -> bool:
    return any(_same(name, other) for other in (known, *synonyms))


def resolve(name: str, kind: str, table: str | None = None) -> tuple[str, str]:
    """(table, name) a word stands for; ``kind`` is 'metrics' or 'dimensions'.

    Official names go before synonyms; a prefix as in ``merchants.country`` picks the table.
    """
    if "." in name:
        prefix, name = name.split(".", 1)
        table = resolve_table(prefix)
    tables = [table] if table else list(CATALOGUE)
    entries = [(t, n, e) for t in tables for n, e in getattr(CATALOGUE[t], kind).items()]
    found = [(t, n) for t, n, _ in entries if _same(name, n)]
    found = found or [(t, n) for t, n, e in entries if _matches(name, n, e.synonyms)]
    if len(found) != 1:
        problem = "unknown" if not found else "ambiguous"
        raise MetricError(f"{problem} name in {kind}: {name}")
    return found[0]


def resolve_table(name: str) -> str:
    found = [t for t, spec in CATALOGUE.items() if _matches(name, t, spec.synonyms)]
    if len(found) != 1:
        raise MetricError(f"unknown table: {name}")
    return found[0]


def _metric_column(spec: LogicalTable, metric: Metric) -> Column:
    source = spec.facts.get(metric.of)
    column = F.col(source if source else spec.dimensions[metric.of].column)
    if metric.how == "avg":
        return F.sum(column).cast("double") / F.count(column)
    return {"sum": F.sum, "count": F.count}[metric.how](column)


# The comparisons a filter may use.
COMPARISONS = {
    "=": lambda c, v: c == v,
    "<>": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),
}


def metric_query(
    marts: Mapping[str, DataFrame],
    metrics: Sequence[str],
    dimensions: Sequence[str] = (),
    filters: Sequence[tuple[str, str, object]] = (),
) -> DataFrame:
    """Evaluate metrics by dimensions. All names must belong to one table, as none are related."""
    if not metrics:
        raise MetricError("no metric asked for")
    wanted = [resolve(m, "metrics") for m in metrics]
    table = wanted[0][0]
    if any(t != table for t, _ in wanted):
        raise MetricError("metrics of different tables cannot be combined")
    spec = CATALOGUE[table]

    def dimension(name: str) -> tuple[str, str]:
        owner, official = resolve(name, "dimensions", table)
        if owner != table:
            raise MetricError(f"{name} does not belong to {table}")
        return official, spec.dimensions[official].column

    rows = marts[spec.mart]
    for name, comparison, value in filters:
        rows = rows.where(COMPARISONS[comparison](F.col(dimension(name)[1]), value))
    keys = [F.col(column).alias(official) for official, column in map(dimension, dimensions)]
    measures = [_metric_column(spec, spec.metrics[m]).alias(m) for _, m in wanted]
    return rows.groupBy(*keys).agg(*measures)
