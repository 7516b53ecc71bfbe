"""Daily look at the event stream: files that failed, fields that went missing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import drift
from tidemark.plans.ingest import Lake, batch_name
from tidemark.sources.files import ntz

CLEAN = "Clean: no parse errors, no schema drift in the last 24h."


def load_history(rows: DataFrame) -> DataFrame:
    """Rows and errors of each loaded file, from rows carrying ``_is_bad``."""
    return rows.groupBy("_source_file").agg(
        F.count("*").alias("row_count"),
        F.count_if("_is_bad").alias("error_count"),
        F.max("_loaded_at").alias("last_load_time"),
    )


def load_history_errors(history: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Files of the last day with at least one error."""
    since = ntz(run_ts - dt.timedelta(days=1))
    return history.where((F.col("last_load_time") >= since) & (F.col("error_count") > 0))


def last_day(rows: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return rows.where(F.col("_loaded_at") >= ntz(run_ts - dt.timedelta(days=1)))


def quarantine_recent_count(quarantined: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return last_day(quarantined, run_ts).agg(F.count("*").alias("quarantined_rows"))


def stream_findings(history: DataFrame, recent: DataFrame, baseline: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """One row: failed files, missing keys and the summary text."""
    failed = load_history_errors(history, run_ts).agg(F.count("*").alias("failed_files"))
    missing = drift.missing_keys(baseline, drift.json_key_set(recent))
    both = failed.withColumn("missing_keys", drift.key_list(missing).scalar())
    failed_text = F.when(
        F.col("failed_files") > 0, F.concat(F.col("failed_files").cast("string"), F.lit(" file(s) failed to parse. "))
    ).otherwise("")
    drift_text = F.when(
        F.col("missing_keys") != "", F.concat(F.lit("Schema drift: missing "), "missing_keys", F.lit(". "))
    ).otherwise("")
    text = F.concat(failed_text, drift_text)
    return both.withColumn("summary", F.when(text == "", CLEAN).otherwise(text))


def check_stream_health(
    lake: Lake,
    raw: DataFrame,
    history: DataFrame,
    run_ts: dt.datetime,
    source: str = "partner_transactions",
) -> str:
    """Report on the last day and remember its keys. Never raises for bad data."""
    recent = last_day(raw, run_ts)
    found = stream_findings(history, recent, lake.baseline(source), run_ts).first()
    lake.remember_keys(source, drift.json_key_set(recent), run_ts, batch_name(run_ts))
    return found.summary
