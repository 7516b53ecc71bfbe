"""The model graph: raw tables in, every model out; lazily, or written once and read back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quality import Observed
from tidemark.plans import intermediate as I
from tidemark.plans import marts as M
from tidemark.plans.monthly import MonthlyTable
from tidemark.plans.staging import accounts_current, staging_models
from tidemark.state import remove

MONTHLY = {"int_transactions_unified": "transaction_date"}
CODEC = "zstd"


def _settled(
    spark: SparkSession, name: str, df: DataFrame, folder: str | None, observed: Observed | None = None, by_month: bool = True
) -> DataFrame:
    """Write the model as a table and read it back, or hand on the plan as it is.

    A model by month has the column ``month``: a filter on it opens the folders of those months only, and
    with the same folder again only the months that changed are rewritten.
    """
    if folder is None:
        return df
    path, date = f"{folder}/{name}", MONTHLY.get(name) if by_month else None
    watch = (lambda rows: rows) if observed is None else (lambda rows: observed.watch(name, rows))
    if date is None:
        watch(df).write.mode("overwrite").parquet(path, compression=CODEC)
        return spark.read.schema(df.schema).parquet(path)
    if observed is None:
        return MonthlyTable(spark, path, date).refresh(df)
    # Row tests count the rows of a whole model as it is written, so all months are.
    monthly = df.withColumn("month", F.date_format(date, "yyyy-MM"))
    ordered = monthly.hint("rebalance", "month").sortWithinPartitions("month", date)
    watch(ordered).write.mode("overwrite").partitionBy("month").parquet(path, compression=CODEC)
    return spark.read.schema(monthly.schema).parquet(path)


def _together(models: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Models that do not need each other, written at once: small ones fill the cores that large ones leave idle."""
    with ThreadPoolExecutor(len(models)) as pool:
        return dict(zip(models, pool.map(lambda build: build(), map(inheritable_thread_target, models.values()))))


def build_models(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    as_of: dt.date,
    folder: str | None = None,
    observed: Observed | None = None,
    by_month: bool = True,
    written: Callable[[dict[str, DataFrame], list[str]], None] | None = None,
) -> dict[str, DataFrame]:
    """All staging, intermediate and mart models.

    Staging stays lazy. With a folder, each intermediate model and mart is written once there and
    its readers start from the written table instead of repeating the work below it. With ``observed`` staging
    models are written too, and the row tests of all models are counted by the tasks that write them.
    Without ``by_month`` no table is dealt out by month, for models that are written only to be tested.
    With ``observed`` and ``written``, that is called with the models and the names of those just written, and a table that
    no later model reads is removed after it and is not among the models returned. The settlements, a selection of
    their raw columns, are then written on their own and selected again for the transactions, so that the two
    largest tables never lie side by side.
    """
    m = dict(staging_models(raw))
    settlements, passing = m["stg_settlements"], written is not None

    def add(**models: Callable[[], DataFrame]) -> None:
        def settled(name: str, df: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
            return lambda: _settled(spark, name, df(), folder, observed, by_month)

        m.update(_together({name: settled(name, df) for name, df in models.items()}))
        if passing:
            written(m, list(models))

    def drop(*names: str) -> None:
        for name in names if passing else ():
            del m[name]
            remove(spark, f"{folder}/{name}")

    def enriched() -> DataFrame:
        if folder is not None and observed is not None:
            # The written events are read; the payloads are not parsed again.
            add(stg_accounts_current=lambda: accounts_current(m["stg_account_activity"]))
        return I.int_accounts_enriched(m["stg_accounts"], m["stg_accounts_current"])

    if folder is not None and observed is not None:
        later = {"stg_accounts_current", "stg_settlements"} if passing else {"stg_accounts_current"}
        add(**{name: lambda df=df: df for name, df in m.items() if name not in later})
    if passing:
        add(stg_settlements=lambda: settlements)
        drop("stg_settlements", "stg_exchange_rates")
    add(
        int_accounts_enriched=enriched,
        int_transactions_unified=lambda: I.int_transactions_unified(
            settlements if passing else m["stg_settlements"], m["stg_partner_transactions"]
        ),
    )
    drop("stg_partner_transactions", "stg_account_activity", "stg_accounts_current", "stg_accounts")
    add(
        int_customer_activity_summary=lambda: I.int_customer_activity_summary(
            m["stg_customers"],
            m["int_accounts_enriched"],
            m["int_transactions_unified"],
            m["stg_support_cases"],
            as_of,
        ),
        int_merchant_risk_summary=lambda: I.int_merchant_risk_summary(m["stg_merchants"], m["int_transactions_unified"], as_of),
        mart_daily_transaction_kpi=lambda: M.mart_daily_transaction_kpi(m["int_transactions_unified"]),
    )
    drop("int_transactions_unified", "int_accounts_enriched", "stg_support_cases")
    add(
        mart_customer_360=lambda: M.mart_customer_360(m["int_customer_activity_summary"]),
        mart_merchant_performance=lambda: M.mart_merchant_performance(m["int_merchant_risk_summary"]),
    )
    return m
