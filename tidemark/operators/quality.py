"""Data-quality tests and batch counters. A test returns its failures; none means it passed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.session import settle

HASHED_FROM = 100_000


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with how often."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_records"))
        .where("n_records > 1")
    )


def repeated_values(df: DataFrame, column: str) -> int:
    """How many values occur more than once, for a column that should have none.

    Eight bytes of hash per row go through the shuffle; whole values are compared where a hash repeats.
    """
    keys = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value"), F.xxhash64(column).alias("_hash"))
    repeated = keys.groupBy("_hash").agg(F.count("*").alias("n")).where("n > 1").select("_hash")
    suspects = settle(repeated, "repeated-hashes")
    if suspects.isEmpty():
        return 0
    return keys.join(suspects, "_hash", "left_semi").groupBy("_hash", "value").agg(F.count("*").alias("n")).where("n > 1").count()


def not_null_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null rows of several columns, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns])
    return counts.select(F.inline(pairs))


def accepted_values_failures(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with how often; NULL passes."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_records"))
    )


def relationship_failures(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null child keys without a parent, with how many rows carry them.

    The child is counted per key first, so a key on a third of the rows joins as one row.
    """
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_records"))
    )
    known = parent.select(F.col(parent_column).alias("value"))
    return keys.join(known, "value", "left_anti")


def rowcount_parity_failures(summary: DataFrame, source: DataFrame) -> DataFrame:
    """One row with both counts if they differ."""
    sides = summary.agg(F.count("*").alias("n")).select(F.lit(True).alias("is_summary"), "n").unionByName(
        source.agg(F.count("*").alias("n")).select(F.lit(False).alias("is_summary"), "n")
    )
    return sides.agg(
        F.max(F.when(F.col("is_summary"), F.col("n"))).alias("summary_row_count"),
        F.max(F.when(~F.col("is_summary"), F.col("n"))).alias("source_row_count"),
    ).where("summary_row_count <> source_row_count")


# --------------------------------------------------------------- batch counters


def batch_counters(keys: DataFrame, required: Sequence[str], unique: str | None = None) -> DataFrame:
    """One row with rows, rows lacking a required key, and rows beyond the first of each unique key.

    All three come from one scan: rows shrink to one per key and task before the shuffle.
    """
    missing = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in required])
    if unique is None:
        return keys.agg(
            F.count("*").alias("rows_loaded"),
            F.count_if(missing).alias("null_rows"),
            F.lit(0).cast("bigint").alias("duplicate_rows"),
        )
    per_key = keys.groupBy(unique).agg(F.count("*").alias("n"), F.count_if(missing).alias("m"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per_key.agg(
        total("n").alias("rows_loaded"), total("m").alias("null_rows"), total(F.col("n") - 1).alias("duplicate_rows")
    )


def duplicate_rows(df: DataFrame, key: Column) -> DataFrame:
    """Rows beyond the first of each key; NULL keys count as one group."""
    per_key = df.groupBy(key.alias("_key")).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def batch_verdict(counters: DataFrame, labels: BatchLabels) -> DataFrame:
    """Adds the message of the first failing check, NULL when all pass.

    Expects ``missing_keys`` (text, empty if none), ``null_rows``, ``duplicate_rows``, ``rows_loaded``.
    """
    message = (
        F.when(F.col("missing_keys") != "", F.concat(F.lit(labels.drift), F.col("missing_keys")))
        .when(F.col("null_rows") > 0, F.concat(F.col("null_rows").cast("string"), F.lit(labels.nulls)))
        .when(
            F.col("duplicate_rows") > 0,
            F.concat(F.col("duplicate_rows").cast("string"), F.lit(labels.duplicates)),
        )
        .when(F.col("rows_loaded") == 0, F.lit(labels.empty))
    )
    return counters.withColumn("error_message", message)


@dataclass(frozen=True)
class BatchLabels:
    """Message texts of one source; counts and key lists are put in front or behind."""

    drift: str
    nulls: str
    duplicates: str = ""
    empty: str = "No rows found for newly loaded file(s)."


# -------------------------------------------------------------------- freshness


def freshness(df: DataFrame, loaded_at: str, run_ts: dt.datetime, warn: dt.timedelta, error: dt.timedelta) -> DataFrame:
    """Age of the newest load against two limits; a table never loaded is an error."""
    now = F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now)
    status = (
        F.when(age.isNull() | (age > int(error.total_seconds())), "error")
        .when(age > int(warn.total_seconds()), "warn")
        .otherwise("pass")
    )
    return newest.select("max_loaded_at", age.alias("age_seconds"), status.alias("status"))


# ------------------------------------------------------------------- test suite


@dataclass(frozen=True)
class ModelTests:
    """The column tests of one model."""

    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()
    accepted: dict[str, Sequence[str]] = field(default_factory=dict)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)


def _checks(tests: ModelTests) -> list[tuple[str, str, Column]]:
    """The tests that look at one row at a time, with how many rows fail."""
    checks = [("not_null", c, F.count_if(F.col(c).isNull())) for c in tests.not_null]
    return checks + [
        ("accepted_values", c, F.count_if(~F.col(c).isin(*values))) for c, values in tests.accepted.items()
    ]


def _row_tests(model: str, df: DataFrame, tests: ModelTests) -> DataFrame | None:
    """not_null and accepted_values of a model together: one scan, no shuffle of rows."""
    checks = _checks(tests)
    if not checks:
        return None
    counts = df.agg(*[failures.alias(f"_{i}") for i, (_, _, failures) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(test).alias("test_name"), F.lit(col).alias("column_name"), F.col(f"_{i}").alias("failures")
            )
            for i, (test, col, _) in enumerate(checks)
        ]
    )
    return counts.select(F.lit(model).alias("model_name"), F.inline(rows))


class Observed:
    """Row tests and row counts of models, counted while the models are written.

    The metrics are taken by the tasks that write, which count once each however often they are repeated.
    """

    def __init__(self, suite: dict[str, ModelTests]):
        self.suite = suite
        self._seen: dict[str, Observation] = {}

    def watch(self, model: str, df: DataFrame) -> DataFrame:
        """The same rows, to be written next."""
        checks = _checks(self.suite[model]) if model in self.suite else []
        counts = [failures.alias(f"_{i}") for i, (_, _, failures) in enumerate(checks)]
        self._seen[model] = Observation(model)
        return df.observe(self._seen[model], F.count(F.lit(1)).alias("_rows"), *counts)

    def rows(self, model: str) -> int | None:
        return self._seen[model].get["_rows"] if model in self._seen else None

    def failures(self, model: str) -> list[tuple[str, str, str, int]] | None:
        """(model, test, column, failures) of a model that was written."""
        if model not in self._seen:
            return None
        found = self._seen[model].get
        return [(model, test, column, found[f"_{i}"]) for i, (test, column, _) in enumerate(_checks(self.suite[model]))]


def _counted(model: str, test: str, column: str, failures: Column, df: DataFrame) -> DataFrame:
    return df.agg(F.coalesce(failures, F.lit(0)).alias("failures")).select(
        F.lit(model).alias("model_name"),
        F.lit(test).alias("test_name"),
        F.lit(column).alias("column_name"),
        "failures",
    )


COUNTED = "model_name string, test_name string, column_name string, failures bigint"


def run_tests(
    models: dict[str, DataFrame],
    suite: dict[str, ModelTests],
    parity: Sequence[tuple[str, str]] = (),
    observed: Observed | None = None,
) -> DataFrame:
    """Failure count of every test: (model_name, test_name, column_name, failures).

    What was ``observed`` while the models were written is not counted again; keys are compared over their own
    columns of the written tables. Unique keys of a model of ``HASHED_FROM`` rows meet by their hashes, at once.
    """
    parts: list[DataFrame] = []
    known: list[tuple[str, str, str, int]] = []
    for model, tests in suite.items():
        df = models[model]
        seen = observed.failures(model) if observed else None
        by_row = _row_tests(model, df, tests) if seen is None else None
        known += seen or []
        if by_row is not None:
            parts.append(by_row)
        for c in tests.unique:
            if seen is not None and observed.rows(model) >= HASHED_FROM:
                known.append((model, "unique", c, repeated_values(df, c)))
            else:
                parts.append(_counted(model, "unique", c, F.count("*"), unique_failures(df, c)))
        for c, (parent, parent_column) in tests.parents.items():
            orphans = relationship_failures(df, c, models[parent], parent_column)
            parts.append(_counted(model, "relationships", c, F.sum("n_records"), orphans))
    for summary, source in parity:
        counts = (observed.rows(summary), observed.rows(source)) if observed else (None, None)
        if None not in counts:
            known.append((summary, "rowcount_parity", "", int(counts[0] != counts[1])))
            continue
        gap = rowcount_parity_failures(models[summary], models[source])
        parts.append(_counted(summary, "rowcount_parity", "", F.count("*"), gap))
    if known:
        spark = next(iter(models.values())).sparkSession
        parts.append(spark.createDataFrame(known, COUNTED))
    return reduce(DataFrame.unionByName, parts)


def as_results(counted: DataFrame, run_id: str, run_ts: dt.datetime) -> DataFrame:
    """Rows for the results table."""
    return counted.select(
        F.lit(run_id).alias("test_run_id"),
        "model_name",
        F.concat_ws("_", "test_name", F.nullif("column_name", F.lit(""))).alias("test_name"),
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("test_status"),
        F.col("failures").alias("failures_count"),
        F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz").alias("executed_at"),
    )
