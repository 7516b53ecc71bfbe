"""Batch loads: land new files, check them, write the audit, promote them or refuse."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.payload import extract_fields
from tidemark.operators import drift
from tidemark.operators.quality import BatchLabels, batch_counters, batch_verdict
from tidemark.sources import files
from tidemark.state import LatestTable, committed_batches, read_batches, remove, write_batch

NO_NEW_FILES = "No new files to load -- all files already loaded previously."
FILES_PER_READ = 5_000

AUDIT_SCHEMA = (
    "source_name string, status string, load_timestamp timestamp_ntz, rows_loaded bigint, "
    "duplicate_rows bigint, null_rows bigint, error_message string"
)
LEDGER_SCHEMA = "file_path string, size bigint, last_modified timestamp"
BASELINE_SCHEMA = (
    "source_name string, column_key string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz, retired boolean"
)
LOAD_AUDIT_SCHEMA = (
    "load_id string, source_system string, target_table string, file_name string, row_count bigint, "
    "load_status string, load_started_at timestamp_ntz, load_completed_at timestamp_ntz, error_message string"
)
RUN_SCHEMA = (
    "run_id string, pipeline_name string, trigger_type string, status string, "
    "started_at timestamp_ntz, ended_at timestamp_ntz"
)
JSON_LANDING = "raw_payload string, _source_file string, _loaded_at timestamp_ntz"
CSV_LANDING = (
    ", ".join(f"{n} {t}" for n, t in files.SETTLEMENT_CSV) + ", _source_file string, _loaded_at timestamp_ntz"
)


class ValidationFailed(RuntimeError):
    """A batch did not pass its checks; nothing of it was promoted."""


@dataclass(frozen=True)
class SourceSpec:
    """What differs between the batch sources."""

    name: str
    labels: BatchLabels
    required: tuple[str, ...]  # columns, top-level JSON fields, or a JSON path starting with $
    unique: str | None = None
    is_csv: bool = False
    counted: str = "row(s)"

    @property
    def glob(self) -> str:
        return files.CSV_FILES if self.is_csv else "*"

    def keys(self, landed: DataFrame) -> DataFrame:
        """The required fields of each row, parsed once."""
        if self.is_csv:
            return landed.select(*self.required)
        paths = [f for f in self.required if f.startswith("$")]
        if paths:
            return landed.select(*[F.get_json_object("raw_payload", p).alias(p) for p in paths])
        return extract_fields(landed, [(f, f, "string") for f in self.required], [])

    @property
    def landing_schema(self) -> str:
        return CSV_LANDING if self.is_csv else JSON_LANDING


# Message texts and key fields of the four sources.
SETTLEMENTS = SourceSpec(
    "settlements",
    BatchLabels(
        "Schema drift: missing/changed columns ",
        " rows with missing settlement_id/account_id/merchant_id.",
        " duplicate settlement_id(s) found.",
    ),
    ("settlement_id", "account_id", "merchant_id"),
    "settlement_id",
    is_csv=True,
)
SUPPORT_CASES = SourceSpec(
    "support_cases",
    BatchLabels(
        "Schema drift: missing fields ",
        " rows with missing case_id/customer_id.",
        " duplicate case_id(s) found.",
    ),
    ("case_id", "customer_id"),
    "case_id",
)
ACCOUNT_ACTIVITY = SourceSpec(
    "account_activity",
    BatchLabels("Schema drift: missing fields ", " rows with missing account_id."),
    ("account_id",),
)
EXCHANGE_RATES = SourceSpec(
    "exchange_rates",
    BatchLabels("Schema drift: missing fields ", " rows with null/empty rates payload."),
    ("$.payload.rates",),
    counted="file(s)",
)
SPECS = {s.name: s for s in (SETTLEMENTS, SUPPORT_CASES, ACCOUNT_ACTIVITY, EXCHANGE_RATES)}


@dataclass
class LoadResult:
    message: str
    rows_loaded: int = 0
    batch_id: str | None = None
    loaded_files: DataFrame | None = field(default=None, repr=False)


class Lake:
    """The folders of one deployment: landing, raw, ledger, audit and baselines."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def ledger(self, source: str) -> DataFrame:
        return read_batches(self.spark, self.path("ledger", source), LEDGER_SCHEMA)

    def audit(self) -> DataFrame:
        """Refused batches, and successful ones whose load has finished: those the ledger knows."""
        rows = read_batches(self.spark, self.path("audit"), AUDIT_SCHEMA)
        done = reduce(
            DataFrame.unionByName,
            [self.ledger(s).select(F.concat("batch_id", F.lit(f"-{s}")).alias("batch_id")) for s in SPECS],
        ).withColumn("status", F.lit("Success"))
        failed = rows.where("status <> 'Success'")
        return failed.unionByName(rows.join(done, ["batch_id", "status"], "left_semi"), allowMissingColumns=True).drop("batch_id")

    def raw(self, source: str) -> DataFrame:
        """Rows of the batches whose load has finished: those the ledger knows.

        Rows are landed once, in the folder of their batch; the ledger is what promotes them. The batch names,
        one per run, become a filter on the folders.
        """
        rows = read_batches(self.spark, self.path("landing", source), SPECS[source].landing_schema)
        return rows.where(F.col("batch_id").isin(committed_batches(self.spark, self.path("ledger", source))))

    def baseline_table(self) -> LatestTable:
        return LatestTable(
            self.spark, self.path("baseline"), BASELINE_SCHEMA, ["source_name", "column_key"], ["last_seen_at"]
        )

    def baseline(self, source: str) -> DataFrame:
        """Keys seen in batches whose load has finished, and not retired since.

        Keys are written before the ledger and count with it, so a run that breaks off in between leaves neither.
        """
        table = self.baseline_table()
        rows = table.versions().where(F.col("source_name") == source)
        if source in SPECS:
            done = self.ledger(source).select(F.concat("batch_id", F.lit(f"-{source}")).alias("batch_id")).distinct()
            retired = rows.where(F.col("batch_id").endswith("-retire"))
            rows = rows.join(done, "batch_id", "left_semi").unionByName(retired)
        return table.newest(rows).where(~F.col("retired")).drop("batch_id")

    def remember_keys(self, source: str, actual: DataFrame, seen_at: dt.datetime, batch_id: str) -> None:
        known = self.baseline(source).drop("retired")
        merged = drift.snapshot_upsert(known, actual, source, files.ntz(seen_at))
        self.baseline_table().update(merged.withColumn("retired", F.lit(False)), f"{batch_id}-{source}")

    def retire_key(self, source: str, column_key: str, at: dt.datetime) -> None:
        """Stop expecting a key that a source has given up on purpose."""
        gone = (
            self.baseline(source)
            .where(F.col("column_key") == column_key)
            .withColumns({"retired": F.lit(True), "last_seen_at": files.ntz(at)})
        )
        self.baseline_table().update(gone, f"{batch_name(at)}-{source}-retire")

    def append(self, table: str, df: DataFrame, batch_id: str) -> None:
        write_batch(df, self.path(table), batch_id)


def batch_name(run_ts: dt.datetime) -> str:
    return "b" + run_ts.strftime("%Y%m%dT%H%M%S%f")


def new_files(spark: SparkSession, stage: str, glob: str, ledger: DataFrame) -> DataFrame:
    """Files below the stage that the ledger does not name; compared by whole path."""
    return files.list_files(spark, stage, glob).join(ledger.select("file_path"), "file_path", "left_anti")


def _in_groups(paths: Iterator[str], size: int) -> Iterator[list[str]]:
    while group := list(islice(paths, size)):
        yield group


def _land(spark: SparkSession, spec: SourceSpec, fresh: DataFrame, target: str, run_ts: dt.datetime) -> None:
    """Strict copy of the new files, some thousand names at a time, into one batch folder.

    The driver holds the names of one group only; each group overwrites its own sub-folder, and what an earlier
    attempt left is removed first.
    """
    remove(spark, target)
    names = (row.file_path for row in fresh.select("file_path").toLocalIterator())
    for i, group in enumerate(_in_groups(names, FILES_PER_READ)):
        rows = (
            files.read_csv_strict(spark, group) if spec.is_csv else files.read_ndjson_strict(spark, group, spec.glob)
        )
        rows.withColumn("_loaded_at", files.ntz(run_ts)).write.mode("overwrite").parquet(f"{target}/group-{i}")


def _audit_row(spark: SparkSession, counters: DataFrame, source: str, run_ts: dt.datetime) -> DataFrame:
    return counters.select(
        F.lit(source).alias("source_name"),
        F.when(F.col("error_message").isNull(), "Success").otherwise("Failed").alias("status"),
        files.ntz(run_ts).alias("load_timestamp"),
        "rows_loaded",
        "duplicate_rows",
        "null_rows",
        "error_message",
    )


def _counters(spec: SourceSpec, landed: DataFrame, missing: DataFrame) -> DataFrame:
    """One row with all counters of a batch."""
    counted = batch_counters(spec.keys(landed), spec.required, spec.unique)
    return counted.withColumn("missing_keys", drift.key_list(missing).scalar())


def validate_and_load(
    spark: SparkSession,
    spec: SourceSpec,
    stage: str,
    lake: Lake,
    run_ts: dt.datetime,
    ledger_on_failure: bool = False,
    expect_arrival: bool = False,
) -> LoadResult:
    """The whole guarded load of one source.

    A refused batch leaves raw, baseline and ledger as they were, so its files are read again once
    replaced; ``ledger_on_failure`` counts them as loaded instead.
    """
    batch_id = batch_name(run_ts)
    if expect_arrival:
        files.arrival_check(spark, stage, run_ts.date(), spec.glob)

    def refuse(counters: DataFrame, message: str) -> None:
        lake.append("audit", _audit_row(spark, counters, spec.name, run_ts), f"{batch_id}-{spec.name}")
        raise ValidationFailed(message)

    # 1. header drift, over every staged file, before anything is read
    if spec.is_csv:
        actual = drift.header_key_set(files.csv_headers(spark, stage))
        gone = drift.key_list(drift.missing_keys(lake.baseline(spec.name), actual))
        early = batch_verdict(
            gone.withColumns({c: F.lit(0).cast("bigint") for c in ("rows_loaded", "duplicate_rows", "null_rows")}),
            spec.labels,
        ).where("missing_keys <> ''")
        stop = early.first()
        if stop is not None:
            refuse(spark.createDataFrame([stop], early.schema), stop.error_message)

    # 2. strict copy of the files not seen before
    fresh = new_files(spark, stage, spec.glob, lake.ledger(spec.name))
    if fresh.isEmpty():
        return LoadResult(NO_NEW_FILES)
    finished = committed_batches(spark, lake.path("ledger", spec.name))
    if batch_id in finished:  # a second load at the same time must not replace the rows of the first
        batch_id = f"{batch_id}-{len(finished)}"
    staged_list = lake.path("arrivals", spec.name, f"batch_id={batch_id}")
    fresh.select("file_path", "size", "last_modified").write.mode("overwrite").parquet(staged_list)
    fresh = spark.read.schema(LEDGER_SCHEMA).parquet(staged_list)
    target = lake.path("landing", spec.name, f"batch_id={batch_id}")
    try:
        _land(spark, spec, fresh, target, run_ts)
    except Exception:
        remove(spark, target)
        raise
    landed = spark.read.schema(spec.landing_schema).option("recursiveFileLookup", True).parquet(target)

    # 3. counters, verdict, audit
    if not spec.is_csv:
        actual = drift.json_key_set(landed)
        missing = drift.missing_keys(lake.baseline(spec.name), actual)
    else:
        missing = lake.baseline(spec.name).select("column_key").where(F.lit(False))
    verdict = batch_verdict(_counters(spec, landed, missing), spec.labels)
    row = verdict.first()
    known = spark.createDataFrame([row], verdict.schema)
    if row.error_message is not None:
        if ledger_on_failure:
            lake.append(f"ledger/{spec.name}", fresh, f"{batch_id}-refused")
        refuse(known, row.error_message)

    # 4. promote, and name the files as loaded at last; audit row, raw rows and keys count with the ledger
    lake.append("audit", _audit_row(spark, known, spec.name, run_ts), f"{batch_id}-{spec.name}")
    lake.append(f"load_audit/{spec.name}", _load_audit(spec, landed, batch_id, run_ts), batch_id)
    lake.remember_keys(spec.name, actual, run_ts, batch_id)
    lake.append(f"ledger/{spec.name}", fresh, batch_id)
    return LoadResult(
        f"Success: loaded {row.rows_loaded} new {spec.counted}.", row.rows_loaded, batch_id, fresh
    )


def _load_audit(spec: SourceSpec, landed: DataFrame, batch_id: str, run_ts: dt.datetime) -> DataFrame:
    """One record per loaded file."""
    return (
        landed.groupBy(F.col("_source_file").alias("file_name"))
        .agg(F.count("*").alias("row_count"))
        .select(
            F.lit(batch_id).alias("load_id"),
            F.lit(spec.name).alias("source_system"),
            F.lit(f"raw.{spec.name}").alias("target_table"),
            "file_name",
            "row_count",
            F.lit("LOADED").alias("load_status"),
            files.ntz(run_ts).alias("load_started_at"),
            files.ntz(run_ts).alias("load_completed_at"),
            F.lit(None).cast("string").alias("error_message"),
        )
    )


def record_run(
    lake: Lake, name: str, trigger: str, status: str, started: dt.datetime, ended: dt.datetime
) -> DataFrame:
    """Append one run of a job and return the table."""
    run_id = batch_name(started)
    row = lake.spark.range(1).select(
        F.concat(F.lit(f"{run_id}-"), F.lit(name)).alias("run_id"),
        F.lit(name).alias("pipeline_name"),
        F.lit(trigger).alias("trigger_type"),
        F.lit(status).alias("status"),
        files.ntz(started).alias("started_at"),
        files.ntz(ended).alias("ended_at"),
    )
    lake.append("runs", row, f"{run_id}-{name}")
    return read_batches(lake.spark, lake.path("runs"), RUN_SCHEMA).drop("batch_id")
