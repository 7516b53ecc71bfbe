"""Short error summaries out of job logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.state import read_batches, write_batch

# The error patterns, the text put before what they capture, and the fallback.
ANSI = r"\x1b\[[0-9;]*m"
ERROR_PATTERNS = (
    (r"ERROR creating.*model\s+([A-Za-z0-9_.]+)", "Model failed to build: "),
    (r"Database Error in (?:model|test|snapshot)\s+([A-Za-z0-9_.]+)", "Database error: "),
    (r"Compilation Error in (?:model|test|snapshot)\s+([A-Za-z0-9_.]+)", "Compilation error: "),
    (r"Failure in test\s+([A-Za-z0-9_.]+)", "Test failed: "),
)
FALLBACK = "No specific dbt error pattern matched -- check the full task log."

ERROR_LOG_SCHEMA = "dag_id string, task_id string, status string, attempt string, error_summary string"


def read_log_lines(spark: SparkSession, folder: str, glob: str = "*.log") -> DataFrame:
    """Lines of log files with (block, line) giving their order within a file."""
    return spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(folder).select(
        F.col("_metadata.file_path").alias("log"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
        ).alias("pos"),
        "value",
    )


def _hits(line: Column) -> Column:
    clean = F.regexp_replace(line, ANSI, "")
    found = [
        F.when(clean.rlike(pattern), F.concat(F.lit(label), F.regexp_extract(clean, pattern, 1)))
        for pattern, label in ERROR_PATTERNS
    ]
    return F.filter(F.array(*found), lambda h: h.isNotNull())


def log_triage(lines: DataFrame, group: Sequence[str], pos: str = "pos", value: str = "value", top: int = 5) -> DataFrame:
    """One summary per group: its first distinct errors in the order they appear, or the fallback text.

    A repeated error shrinks to its first position before the shuffle; no more than ``top`` rows of a
    group are ever brought together.
    """
    hits = lines.select(*group, F.col(pos).alias("_pos"), F.posexplode(_hits(F.col(value))).alias("_which", "_hit"))
    first = hits.groupBy(*group, "_hit").agg(F.min(F.struct("_pos", "_which")).alias("_first"))
    order = Window.partitionBy(*group).orderBy("_first")
    kept = first.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= top)
    ordered = F.sort_array(F.collect_list(F.struct("_rank", "_hit")))
    text = F.array_join(F.transform(ordered, lambda h: h["_hit"]), "; ")
    summaries = kept.groupBy(*group).agg(text.alias("error_summary"))
    return (
        lines.select(*group)
        .distinct()
        .join(summaries, list(group), "left")
        .withColumn("error_summary", F.coalesce("error_summary", F.lit(FALLBACK)))
    )


def error_log_append(spark: SparkSession, path: str, summaries: DataFrame, batch_id: str) -> DataFrame:
    """Append summaries (dag_id, task_id, attempt, error_summary) and return the log table."""
    rows = summaries.select("dag_id", "task_id", F.lit("FAILED").alias("status"), "attempt", "error_summary")
    write_batch(rows, path, batch_id)
    return read_batches(spark, path, ERROR_LOG_SCHEMA).drop("batch_id")
