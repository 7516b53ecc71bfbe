"""Live account state, merged from the activity stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.buckets import BucketTable
from tidemark.functions.payload import Field, extract_fields
from tidemark.sources.files import ntz
from tidemark.streaming.ingest import batch_key, check_ownership, claim, run_stream

ACCOUNT_STATE_SCHEMA = (
    "account_id string, customer_id string, account_status string, current_balance decimal(12,2), "
    "currency string, updated_at timestamp_ntz, _merged_at timestamp_ntz"
)
# JSON field, state column, type.
STATE_FIELDS: list[Field] = [
    ("account_id", "account_id", "string"),
    ("customer_id", "customer_id", "string"),
    ("account_status", "account_status", "string"),
    ("current_balance", "current_balance", "decimal(12,2)"),
    ("currency", "currency", "string"),
    ("updated_at", "updated_at", "timestamp_ntz"),
]
TIES = ["account_status", "current_balance", "customer_id", "currency"]
VACUUM_AFTER = 50


def accounts_current(spark: SparkSession, path: str, guard: bool = True) -> BucketTable:
    """The state table. With the guard an older event never replaces a newer one, in whatever order
    the two arrive; without it the last batch to arrive wins."""
    newest = ["updated_at"] if guard else []
    ties = TIES if guard else ["updated_at", *TIES]
    return BucketTable(spark, path, ACCOUNT_STATE_SCHEMA, "account_id", newest, ties)


def merge_batch(table: BucketTable, raw: DataFrame, batch_id: str, merged_at: dt.datetime | None) -> None:
    """Newest event per account of this batch, merged into the state."""
    stamp = ntz(merged_at) if merged_at is not None else F.current_timestamp().cast("timestamp_ntz")
    events = extract_fields(raw, STATE_FIELDS, []).where(F.col("account_id").isNotNull())
    table.update(events.withColumn("_merged_at", stamp), batch_id)
    if len(table.stale()) >= VACUUM_AFTER:
        table.vacuum()


def merge_stream(
    rows: DataFrame,
    state_path: str,
    checkpoint: str,
    guard: bool = True,
    merged_at: dt.datetime | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Merge activity rows as they arrive; a micro-batch runs only when there are new rows."""
    check_ownership(rows.sparkSession, state_path, checkpoint, accounts_current(rows.sparkSession, state_path, guard).batches())

    def write(batch: DataFrame, batch_id: int) -> None:
        claim(batch.sparkSession, state_path, checkpoint)
        table = accounts_current(batch.sparkSession, state_path, guard)
        merge_batch(table, batch, batch_key(batch_id), merged_at)

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return run_stream(writer, every)
