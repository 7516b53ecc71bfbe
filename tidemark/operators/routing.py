"""Sorting rows into good and bad without losing any."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.payload import has_key, is_variant

KEY_FIELDS = ("event_id", "account_id", "merchant_id")


def keys_present(df: DataFrame, fields: Sequence[str], payload: str, literal: bool) -> Column:
    """True where every key field is there. Never NULL, so the two sides cover all rows."""
    if literal:
        tests = [has_key(F.col(payload), f, literal=True) for f in fields]
        return F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))
    if is_variant(df, payload):
        tests = [F.variant_get(payload, f"$.{f}", "string").isNotNull() for f in fields]
        return F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    obj = F.from_json(payload, schema)
    # one parse: a struct of the key fields has no empty member
    return F.coalesce(~F.exists(F.array(*[obj[f] for f in fields]), lambda v: v.isNull()), F.lit(False))


def classify(
    df: DataFrame, fields: Sequence[str] = KEY_FIELDS, payload: str = "raw_payload", literal: bool = False
) -> DataFrame:
    return df.withColumn("_is_clean", keys_present(df, fields, payload, literal))


def clean_split(df: DataFrame, **how) -> DataFrame:
    return classify(df, **how).where("_is_clean").drop("_is_clean")


def quarantine_split(df: DataFrame, **how) -> DataFrame:
    return classify(df, **how).where("NOT _is_clean").drop("_is_clean")


def readable_json(line: Column) -> Column:
    """Whether a line holds one JSON value."""
    return F.try_parse_json(line).isNotNull()
