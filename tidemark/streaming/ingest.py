"""Continuous loading of NDJSON files and routing of what arrives."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.routing import KEY_FIELDS, classify, readable_json
from tidemark.plans.health import load_history
from tidemark.session import new_folder, settle
from tidemark.sources.files import ntz
from tidemark.state import committed_batches, exists, read_batches, read_small, remove, write_batch_once, write_small

RAW_SCHEMA = "raw_payload string, _source_file string, _loaded_at timestamp_ntz"
HISTORY_SCHEMA = "_source_file string, row_count bigint, error_count bigint, last_load_time timestamp_ntz"


def batch_key(batch_id: int) -> str:
    """Micro-batch numbers as text that sorts in order."""
    return f"m{batch_id:012d}"


def run_stream(writer, every: str | None) -> StreamingQuery:
    """Keep running at an interval, or take what is there and stop."""
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _stream_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id Spark has given the stream of this checkpoint."""
    path = f"{checkpoint}/metadata"
    return json.loads(read_small(spark, path))["id"] if exists(spark, path) else None


def check_ownership(spark: SparkSession, out: str, checkpoint: str, batches: Sequence[str] | None = None) -> None:
    """Micro-batches are numbered by the checkpoint, so a new one must not write over another's batches.

    The output names the stream that writes it; without that, a checkpoint must be there if batches are.
    """
    own, owner = _stream_id(spark, checkpoint), f"{out}/_owner"
    if exists(spark, owner):
        taken = read_small(spark, owner) != own
    else:
        names = committed_batches(spark, out) if batches is None else batches
        taken = own is None and any(re.fullmatch(r"m\d{12}", name) for name in names)
    if taken:
        raise ValueError(f"{out} was written under another checkpoint than {checkpoint}")


def claim(spark: SparkSession, out: str, checkpoint: str) -> None:
    """Name the running stream as the owner of an output that has none yet."""
    if not exists(spark, f"{out}/_owner"):
        write_small(spark, f"{out}/_owner", _stream_id(spark, checkpoint) or "")


@contextmanager
def _judged(rows: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The rows of a micro-batch, written once for the outputs that share them and removed when these are done."""
    spark, path = rows.sparkSession, new_folder(rows.sparkSession, purpose)
    try:
        rows.write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        remove(spark, path)


def read_line_stream(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    return (
        spark.readStream.format("text")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(folder)
        .withColumn("_source_file", F.col("_metadata.file_path"))
    )


def land_stream(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    run_ts: dt.datetime | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Good lines to ``raw``, unreadable ones to ``rejects``, per-file counts to ``history``.

    ``lines`` has ``value`` and ``_source_file``, and ``_loaded_at`` if the load time is already known.
    Each micro-batch owns its folders, so a repeated one replaces what it wrote before. Lines are judged once into
    compressed files, which the outputs read in splits: cached lines would be as large per task as the batch makes them.
    """

    check_ownership(lines.sparkSession, f"{out}/raw", checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        claim(batch.sparkSession, f"{out}/raw", checkpoint)
        stamp = ntz(run_ts) if run_ts is not None else F.current_timestamp().cast("timestamp_ntz")
        if "_loaded_at" not in batch.columns:
            batch = batch.withColumn("_loaded_at", stamp)
        rows = batch.where(F.trim("value") != "").select(
            F.col("value").alias("raw_payload"),
            "_source_file",
            "_loaded_at",
            (~readable_json(F.col("value"))).alias("_is_bad"),
        )
        with _judged(rows, "landing") as rows:
            write_batch_once(rows.where("NOT _is_bad").drop("_is_bad"), f"{out}/raw", batch_key(batch_id))
            write_batch_once(rows.where("_is_bad").drop("_is_bad"), f"{out}/rejects", batch_key(batch_id))
            write_batch_once(load_history(rows), f"{out}/history", batch_key(batch_id))

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return run_stream(writer, every)


def landed(spark: SparkSession, out: str, part: str = "raw") -> DataFrame:
    return read_batches(spark, f"{out}/{part}", RAW_SCHEMA).drop("batch_id")


def history(spark: SparkSession, out: str) -> DataFrame:
    return read_batches(spark, f"{out}/history", HISTORY_SCHEMA).drop("batch_id")


def raw_stream(spark: SparkSession, out: str, part: str = "raw") -> DataFrame:
    """Rows of a landed table as they are added."""
    return spark.readStream.schema(RAW_SCHEMA).option("recursiveFileLookup", True).parquet(f"{out}/{part}")


def route_stream(
    rows: DataFrame,
    out: str,
    checkpoint: str,
    literal: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Rows with all key fields to ``clean``, the others to ``quarantine``."""

    check_ownership(rows.sparkSession, f"{out}/clean", checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        claim(batch.sparkSession, f"{out}/clean", checkpoint)
        with _judged(classify(batch, KEY_FIELDS, literal=literal), "routing") as tagged:
            write_batch_once(tagged.where("_is_clean").drop("_is_clean"), f"{out}/clean", batch_key(batch_id))
            write_batch_once(tagged.where("NOT _is_clean").drop("_is_clean"), f"{out}/quarantine", batch_key(batch_id))

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return run_stream(writer, every)


def dedup_stream(
    rows: DataFrame, key: str, event_time: str, out: str, checkpoint: str, within: str = "1 day", every: str | None = None
) -> StreamingQuery:
    """First arrival of each key, however late, in ``out/rows``; what was left out is counted per key in ``out/copies``.

    Copies of an event lie at most ``within`` (whole days) apart in event time. Rows are kept by day of event; a
    micro-batch is reduced to one row per key and compared with the stored keys of its own days and those ``within`` of
    them, so an event of long ago opens the folders of its day and no others, and no state grows with the stream.
    A row without event time belongs to a day of its own kind. A repeated micro-batch replaces what it wrote.
    """
    apart = dt.timedelta(days=int(within.split()[0])) if within.split()[1].startswith("day") else dt.timedelta(days=1)
    check_ownership(rows.sparkSession, f"{out}/copies", checkpoint)
    columns = rows.columns
    stored_schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", day string, batch_id string"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, batch_key(batch_id)
        claim(spark, f"{out}/copies", checkpoint)
        day = F.coalesce(F.to_date(event_time).cast("string"), F.lit("none"))
        one = F.min_by(F.struct(*columns), F.struct(F.isnull(event_time), event_time, F.xxhash64(*columns)))
        found = batch.groupBy(key).agg(one.alias("_row"), F.count("*").alias("_n"))
        first = settle(found.select("_row.*", F.col("_n").alias("_n")).withColumn("day", day), "arrived")
        days = sorted(r.day for r in first.select("day").distinct().collect())  # as many as the batch has days
        known = spark.createDataFrame([], f"`{key}` string")
        if exists(spark, f"{out}/rows"):
            stored = spark.read.schema(stored_schema).parquet(f"{out}/rows").where(F.col("batch_id") != name)
            near = {str(dt.date.fromisoformat(d) + dt.timedelta(days=i)) for d in days if d != "none" for i in range(-apart.days, apart.days + 1)}
            known = stored.where(F.col("day").isin(sorted({*near, *days}))).select(key).distinct()
        seen = known.select(F.col(key).alias("_key"), F.lit(True).alias("_seen"))
        told = first.join(seen, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn("_new", F.col("_seen").isNull())
        told = settle(told.drop("_key", "_seen"), "compared")
        new = told.where("_new").select(*columns, "day", F.lit(name).alias("batch_id"))
        (
            new.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "batch_id").parquet(f"{out}/rows")
        )
        copies = told.select(key, (F.col("_n") - F.col("_new").cast("int")).alias("copies")).where("copies > 0")
        write_batch_once(copies, f"{out}/copies", name)

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return run_stream(writer, every)


def deduplicated(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """The rows that ``dedup_stream`` has kept."""
    return spark.read.schema(schema).parquet(f"{out}/rows") if exists(spark, f"{out}/rows") else spark.createDataFrame([], schema)
