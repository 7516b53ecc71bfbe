"""The models over the test tables, each built when first asked for."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import intermediate as I
from tidemark.plans import marts as M
from tidemark.plans import staging as S
from tidemark.sources import tables as R
from tidemark.sources.tables import AS_OF


class _Marts(Mapping):
    """The marts by name; only the one asked for is planned."""

    _names = {
        "mart_customer_360": "customer_360",
        "mart_merchant_performance": "merchant_performance",
        "mart_daily_transaction_kpi": "daily_kpi",
    }

    def __init__(self, models: Models):
        self._models = models

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self._models, self._names[name])

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Models:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return getattr(R, f"raw_{name}")(self.spark, self.sf_dir)

    @cached_property
    def stg_settlements(self) -> DataFrame:
        return S.stg_settlements(self.raw("settlements"))

    @cached_property
    def stg_partner_transactions(self) -> DataFrame:
        return S.stg_partner_transactions(self.raw("partner_transactions"))

    @cached_property
    def stg_support_cases(self) -> DataFrame:
        return S.stg_support_cases(self.raw("support_cases"))

    @cached_property
    def stg_account_activity(self) -> DataFrame:
        return S.stg_account_activity(self.raw("account_activity"))

    @cached_property
    def stg_customers(self) -> DataFrame:
        return S.stg_customers(self.raw("customers"))

    @cached_property
    def stg_accounts(self) -> DataFrame:
        return S.stg_accounts(self.raw("accounts"))

    @cached_property
    def stg_merchants(self) -> DataFrame:
        return S.stg_merchants(self.raw("merchants"))

    @cached_property
    def stg_exchange_rates(self) -> DataFrame:
        return S.stg_exchange_rates(self.raw("exchange_rates"))

    @cached_property
    def stg_accounts_current(self) -> DataFrame:
        return S.stg_accounts_current(self.raw("account_activity"))

    @cached_property
    def accounts(self) -> DataFrame:
        return I.int_accounts_enriched(self.stg_accounts, self.stg_accounts_current)

    @cached_property
    def transactions(self) -> DataFrame:
        return I.int_transactions_unified(self.stg_settlements, self.stg_partner_transactions)

    @cached_property
    def customer_summary(self) -> DataFrame:
        return I.int_customer_activity_summary(
            self.stg_customers, self.accounts, self.transactions, self.stg_support_cases, AS_OF
        )

    @cached_property
    def merchant_summary(self) -> DataFrame:
        return I.int_merchant_risk_summary(self.stg_merchants, self.transactions, AS_OF)

    @cached_property
    def customer_360(self) -> DataFrame:
        return M.mart_customer_360(self.customer_summary)

    @cached_property
    def merchant_performance(self) -> DataFrame:
        return M.mart_merchant_performance(self.merchant_summary)

    @cached_property
    def daily_kpi(self) -> DataFrame:
        return M.mart_daily_transaction_kpi(self.transactions)

    @property
    def marts(self) -> _Marts:
        return _Marts(self)
