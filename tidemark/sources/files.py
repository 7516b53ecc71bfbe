"""Reading staged CSV and NDJSON files, listing folders, and extracting documents."""

from __future__ import annotations

import datetime as dt
import os
import re
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import quote_from_bytes

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import cast_lenient, cast_strict
from tidemark.operators.routing import readable_json

CORRUPT = "_corrupt"
CSV_FILES = "*.{csv,csv.gz}"  # plain or compressed; a compressed file is read by one task

# The settlement file's columns in order.
SETTLEMENT_CSV: list[tuple[str, str]] = [
    ("settlement_id", "string"),
    ("transaction_id", "string"),
    ("account_id", "string"),
    ("merchant_id", "string"),
    ("transaction_timestamp", "timestamp_ntz"),
    ("settlement_date", "date"),
    ("amount", "decimal(12,2)"),
    ("currency", "string"),
    ("settlement_status", "string"),
    ("fee_amount", "decimal(12,2)"),
]


def ntz(ts: dt.datetime) -> Column:
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def with_source(df: DataFrame) -> DataFrame:
    """Adds the full path of the file each row was read from."""
    return df.withColumn("_source_file", F.col("_metadata.file_path"))


# ------------------------------------------------------------------------- CSV


def _csv_text(spark: SparkSession, paths: str | Sequence[str], columns, mode: str) -> DataFrame:
    """Every field as text; by position, as the header names are checked separately.

    Numbers are converted later because the reader itself takes "1,5" for 15.
    """
    fields = [T.StructField(name, T.StringType()) for name, _ in columns]
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("mode", mode)
        .option("pathGlobFilter", CSV_FILES)
        .option("recursiveFileLookup", True)
    )
    if mode == "PERMISSIVE":
        fields.append(T.StructField(CORRUPT, T.StringType()))
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return with_source(reader.schema(T.StructType(fields)).csv(paths))


def read_csv_strict(
    spark: SparkSession, paths: str | Sequence[str], columns: list[tuple[str, str]] = SETTLEMENT_CSV
) -> DataFrame:
    """Typed rows; one bad row or value fails the read."""
    text = _csv_text(spark, paths, columns, "FAILFAST")
    typed = [F.col(n) if to == "string" else cast_strict(F.col(n), to, n).alias(n) for n, to in columns]
    return text.select(*typed, "_source_file")


def read_csv_lenient(
    spark: SparkSession, paths: str | Sequence[str], columns: list[tuple[str, str]] = SETTLEMENT_CSV
) -> DataFrame:
    """Typed rows with ``_is_bad`` set where the row or one of its values cannot be read."""
    text = _csv_text(spark, paths, columns, "PERMISSIVE")
    bad = F.col(CORRUPT).isNotNull()
    typed = []
    for name, to in columns:
        value = F.col(name) if to == "string" else cast_lenient(F.col(name), to)
        if to != "string":
            bad = bad | (F.col(name).isNotNull() & value.isNull())
        typed.append(value.alias(name))
    return text.select(*typed, "_source_file", F.coalesce(bad, F.lit(False)).alias("_is_bad"))


def csv_headers(spark: SparkSession, folder: str | Sequence[str]) -> DataFrame:
    """First line of every CSV file below a folder.

    The line at offset 0 opens a file. Only the tasks that read a file's first block emit a row.
    """
    lines = (
        spark.read.option("pathGlobFilter", CSV_FILES)
        .option("recursiveFileLookup", True)
        .text(folder)
        .select(
            "value",
            F.col("_metadata.file_path").alias("_source_file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_line"),
        )
        .where("_start = 0")
    )
    return lines.groupBy("_source_file").agg(F.min_by("value", "_line").alias("value"))


# ---------------------------------------------------------------------- NDJSON


def read_lines(spark: SparkSession, paths: str | Sequence[str], glob: str = "*") -> DataFrame:
    """One row per non-empty line, unparsed."""
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(paths)
    return with_source(lines).where(F.trim("value") != "").select("value", "_source_file")


def read_ndjson_strict(spark: SparkSession, paths: str | Sequence[str], glob: str = "*") -> DataFrame:
    """Payload lines; the read fails on one that is not JSON."""
    lines = read_lines(spark, paths, glob)
    problem = F.concat(F.lit("not JSON in "), "_source_file")
    checked = F.when(readable_json(F.col("value")), F.col("value")).otherwise(
        F.raise_error(problem).cast("string")
    )
    return lines.select(checked.alias("raw_payload"), "_source_file")


def read_ndjson_lenient(spark: SparkSession, paths: str | Sequence[str], glob: str = "*") -> DataFrame:
    """Payload lines with ``_is_bad`` set on those that are not JSON."""
    lines = read_lines(spark, paths, glob)
    return lines.select(
        F.col("value").alias("raw_payload"), "_source_file", (~readable_json(F.col("value"))).alias("_is_bad")
    )


def read_ndjson_variant(spark: SparkSession, paths: str | Sequence[str], glob: str = "*") -> DataFrame:
    """Payloads as VARIANT; an outer array stays one value."""
    lines = read_lines(spark, paths, glob)
    return lines.select(F.parse_json("value").alias("raw_payload"), "_source_file")


def parse_payload(df: DataFrame, text: str = "value") -> DataFrame:
    return df.withColumn("raw_payload", F.parse_json(text))


# -------------------------------------------------------------------- listings


def list_files(
    spark: SparkSession,
    folder: str,
    glob: str = "*",
    modified_after: dt.datetime | None = None,
) -> DataFrame:
    """Relative path, size and modification time of the files; their content is not read.

    Files of zero bytes are not listed, as Spark reads nothing from them.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after.strftime("%Y-%m-%dT%H:%M:%S"))
    # the reader reports file:/x where a caller may have written file:///x or /x
    base = folder.rstrip("/").split("://")[-1]
    relative = F.regexp_extract("path", r"\Q" + base + r"\E/(.*)$", 1)
    return reader.load(folder).select(
        F.col("path").alias("file_path"),
        relative.alias("relative_path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )


class NothingArrived(RuntimeError):
    """No file of the day was found where one was expected."""


def arrival_check(spark: SparkSession, folder: str, day: dt.date, glob: str = "*") -> None:
    """A file in the day's sub-folder, or any file changed on that day; otherwise raises."""
    from tidemark.state import exists

    dated = f"{folder}/{day.isoformat()}"
    if exists(spark, dated) and not list_files(spark, dated, glob).isEmpty():
        return
    start = dt.datetime.combine(day, dt.time())
    if exists(spark, folder):
        today = list_files(spark, folder, glob).where(
            (F.col("last_modified") >= F.lit(start)) & (F.col("last_modified") < F.lit(start + dt.timedelta(days=1)))
        )
        if not today.isEmpty():
            return
    raise NothingArrived(f"no file for {day.isoformat()} under {folder}")


# ------------------------------------------------------------------- documents

Extractor = Callable[[bytes], tuple[str, int]]

DOCUMENT_SCHEMA = "file_name string, extracted_text string, page_count int"


def html_document(content: bytes) -> tuple[str, int]:
    """Visible text of an HTML page, and how many pages of 3,000 characters it fills."""
    text = content.decode("utf-8", "replace")
    for pattern in _HIDDEN:
        text = pattern.sub(" ", text)
    for entity, char in _ENTITIES:
        text = text.replace(entity, char)
    text = re.sub(r"[ \t\r\n]+", " ", text).strip(" ")
    return text, len(text) // 3000 + 1


_HIDDEN = [
    re.compile(r"<(?:script|style)[^>]*>.*?</(?:script|style)>", re.S | re.I | re.A),
    re.compile(r"<!--.*?-->", re.S),
    re.compile(r"<[^>]+>"),
]
_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"))


def extract_documents(files: DataFrame, extract: Extractor) -> DataFrame:
    """Text and page count of each file (path, content, file_name if it is not the end of the path).

    A file is never split, and only the extracted text leaves the task.
    """
    if "file_name" not in files.columns:
        files = files.withColumn("file_name", F.element_at(F.split("path", "/"), -1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [extract(content) for content in batch["content"]]
            yield pd.DataFrame(
                {
                    "file_name": batch["file_name"],
                    "extracted_text": [text for text, _ in got],
                    "page_count": [pages for _, pages in got],
                }
            )

    return files.select("file_name", "content").mapInPandas(run, DOCUMENT_SCHEMA)


FILES_PER_FOLDER = 500
FOLDERS_PER_LOAD = 100  # whose file names the driver holds at a time
LONGEST_NAME = 200  # of the 255 bytes that a file system allows
TASKS_PER_CORE = 4
NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def stage_documents(documents: DataFrame, folder: str, name: str, content: str) -> list[str]:
    """Every row as a text file of its own, named after ``name`` as ``name=value=number.txt``; returns the folders that hold them.

    On a shared local file system tasks write the files themselves, in folders of their own attempt, of which only those
    of attempts that ended well are returned. There the Hadoop client starts a process for every file that it creates.
    """
    spark = documents.sparkSession
    jpath = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(jpath).toUri()
    if uri.getScheme() != "file":
        documents.select(name, content).write.option("maxRecordsPerFile", 1).partitionBy(name).text(folder)
        return [folder]
    root = uri.getPath()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, below = TaskContext.get(), 0, ""
        for batch in batches:
            made = []
            for value, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n % FILES_PER_FOLDER == 0:
                    below = f"{root}/{task.partitionId():05d}-{task.taskAttemptId()}/{n // FILES_PER_FOLDER:05d}"
                    os.makedirs(below)
                    made.append(below)
                escaped = quote_from_bytes(value, safe="") if value else NO_NAME
                # a longer name goes on in folders
                parts = [escaped[i : i + LONGEST_NAME] for i in range(0, len(escaped), LONGEST_NAME)]
                path = f"{below}/{name}=" + "/".join(parts) + f"={n % FILES_PER_FOLDER}.txt"
                if len(parts) > 1:
                    os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(path, "wb") as out:
                    out.write(text + b"\n")
                n += 1
            yield pa.RecordBatch.from_pydict({"folder": pa.array(made, pa.string())})

    rows = documents.select(F.col(name).cast("binary"), F.col(content).cast("binary"))
    return sorted(f"file://{r.folder}" for r in rows.mapInArrow(run, "folder string").collect())


def load_documents(
    spark: SparkSession,
    folder: str | Sequence[str],
    glob: str,
    extract: Extractor,
    run_ts: dt.datetime,
    named_by: str | None = None,
) -> DataFrame:
    """Documents below folders. They are named by the end of their path, or by the value of ``named_by=value`` in it,
    which is a sub-folder or, as ``stage_documents`` writes it, the file."""
    paths = folder if isinstance(folder, str) else list(folder)
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(paths)
    )
    if named_by is not None:
        by_file = F.replace(F.regexp_extract("path", rf"/\Q{named_by}\E=([^=]*)=[0-9]+[.][^/=]*$", 1), F.lit("/"), F.lit(""))
        by_folder = F.regexp_extract("path", rf"/\Q{named_by}\E=([^/]*)/", 1)
        escaped = F.when(by_file != "", by_file).otherwise(by_folder)
        # a plus sign stands for itself
        files = files.withColumn("file_name", F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B"))))
    # Spark counts a file as 4 MB at least, so small ones would make many tasks
    files = files.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    return extract_documents(files, extract).withColumn("_loaded_at", ntz(run_ts))


def preview(documents: DataFrame, length: int = 200) -> DataFrame:
    return documents.select("file_name", "page_count", F.left("extracted_text", F.lit(length)).alias("preview"))
