"""Key sets of a batch against a remembered baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_key_set(df: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """Distinct top-level keys, upper-cased, over the rows given.

    Rows with the same key list collapse before the keys are spread out.
    """
    lists = df.select(F.json_object_keys(payload).alias("keys")).distinct()
    return lists.select(F.explode("keys").alias("key")).select(F.upper("key").alias("column_key")).distinct()


def header_key_set(headers: DataFrame, line: str = "value") -> DataFrame:
    """Distinct column names of CSV header lines, case kept. A comma within quotes belongs to a name."""
    names = F.split(F.regexp_replace(line, r"^\x{FEFF}|\r$", ""), r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    clean = F.transform(names, lambda n: F.replace(F.regexp_replace(F.trim(n), r'^"|"$', ""), F.lit('""'), F.lit('"')))
    return headers.select(F.explode(clean).alias("column_key")).distinct()


def missing_keys(baseline: DataFrame, actual: DataFrame) -> DataFrame:
    """Baseline keys the batch lacks; keys the baseline does not know are fine."""
    return baseline.select("column_key").distinct().join(actual, "column_key", "left_anti")


def key_list(keys: DataFrame, name: str = "missing_keys") -> DataFrame:
    """One row with the keys in order, comma-separated; empty text for none."""
    return keys.agg(F.array_join(F.sort_array(F.collect_set("column_key")), ", ").alias(name))


def snapshot_upsert(baseline: DataFrame, actual: DataFrame, source: str, seen_at: Column) -> DataFrame:
    """Baseline after a batch: known keys get a new last_seen_at, new keys are added, none is removed."""
    sighted = actual.select(
        F.lit(source).alias("source_name"),
        "column_key",
        seen_at.alias("first_seen_at"),
        seen_at.alias("last_seen_at"),
    )
    return (
        baseline.select("source_name", "column_key", "first_seen_at", "last_seen_at")
        .unionByName(sighted)
        .groupBy("source_name", "column_key")
        .agg(F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"))
    )
