"""State that jobs keep between runs: folders of batches on the shared file system.

Every write goes to a folder named by its batch, with mode overwrite, so a job or task that is
repeated replaces its own output and nothing else.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.latest import latest_per_key


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def remove(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def read_small(spark: SparkSession, path: str) -> str:
    """A small text file."""
    fs, jpath = _fs(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written at once if it is not there."""
    fs, jpath = _fs(spark, path)
    out = fs.create(jpath, False)
    out.write(bytearray(text.encode()))
    out.close()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder that holds one entry per batch."""
    fs, jpath = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


def write_batch(df: DataFrame, path: str, batch_id: str, compression: str | None = None) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}", compression=compression)


def write_batch_once(df: DataFrame, path: str, batch_id: str) -> None:
    """Like ``write_batch``, but leaves a finished batch as it is.

    For streams that others follow: a repeated micro-batch holds the same rows, and rewriting them
    under new file names would show them to the followers a second time.
    """
    if not exists(df.sparkSession, f"{path}/batch_id={batch_id}/_SUCCESS"):
        write_batch(df, path, batch_id)


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All batches with their ``batch_id``; an empty table before the first."""
    fields = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    full = T.StructType([*fields.fields, T.StructField("batch_id", T.StringType())])
    if not exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def committed_batches(spark: SparkSession, path: str) -> list[str]:
    """Names of the batches whose write has finished."""
    names = [n for n in child_names(spark, path) if n.startswith("batch_id=")]
    return [n.removeprefix("batch_id=") for n in names if exists(spark, f"{path}/{n}/_SUCCESS")]


class LatestTable:
    """One row per key, kept as a snapshot plus the batches since.

    An update writes only its own batch. Reading takes the newest row per key over the snapshot and the
    batches it does not hold; ``compact`` writes that result as the next snapshot, and beside it the
    names of the batches in it, so that a batch counts whatever its name. A snapshot counts once its job
    has committed, so an interrupted run leaves the former state readable.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType | str,
        key: str | Sequence[str],
        newest_by: Sequence[str] = (),
        tie_break: Sequence[str] = (),
    ):
        self.spark, self.path = spark, path
        self.schema = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        self.key, self.newest_by, self.tie_break = key, list(newest_by), list(tie_break)

    def _snapshot(self) -> str | None:
        """Newest committed snapshot; snapshots are numbered."""
        for name in reversed(child_names(self.spark, f"{self.path}/snapshot")):
            if exists(self.spark, f"{self.path}/snapshot/{name}/_SUCCESS"):
                return name
        return None

    def newest(self, df: DataFrame) -> DataFrame:
        """Newest by the table's own order; the later batch wins what is left undecided."""
        return latest_per_key(df, self.key, [*self.newest_by, "batch_id"], self.tie_break)

    def update(self, df: DataFrame, batch_id: str) -> None:
        """Matched keys change, new keys are added. Batch ids must sort in order of arrival."""
        batch = latest_per_key(df.select(*self.schema.names), self.key, self.newest_by or self.tie_break, self.tie_break)
        write_batch(batch, f"{self.path}/delta", batch_id)

    def versions(self) -> DataFrame:
        """The rows the current state is chosen from, with the batch each came from."""
        deltas = read_batches(self.spark, f"{self.path}/delta", self.schema)
        name = self._snapshot()
        if name is None:
            return deltas
        held = self.spark.read.schema("batch_id string").parquet(f"{self.path}/covered/{name}")
        columns = T.StructType([*self.schema.fields, T.StructField("batch_id", T.StringType())])
        base = self.spark.read.schema(columns).parquet(f"{self.path}/snapshot/{name}")
        return base.unionByName(deltas.join(held, "batch_id", "left_anti"))

    def read(self, with_batch: bool = False) -> DataFrame:
        state = self.newest(self.versions())
        return state if with_batch else state.drop("batch_id")

    def compact(self) -> None:
        batches = committed_batches(self.spark, f"{self.path}/delta")
        if not batches:
            return
        last = self._snapshot()
        name = f"{int(last) + 1 if last else 1:09d}"
        held = self.spark.createDataFrame([(b,) for b in batches], "batch_id string")
        held.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/covered/{name}")
        known = self.spark.read.schema("batch_id string").parquet(f"{self.path}/covered/{name}")
        state = self.newest(self.versions().join(known, "batch_id", "left_semi"))
        state.write.mode("overwrite").parquet(f"{self.path}/snapshot/{name}")

    def pending_batches(self) -> int:
        """Batches a reader has to merge with the snapshot."""
        name = self._snapshot()
        held = set()
        if name is not None:
            rows = self.spark.read.schema("batch_id string").parquet(f"{self.path}/covered/{name}").collect()
            held = {r.batch_id for r in rows}
        return sum(1 for n in committed_batches(self.spark, f"{self.path}/delta") if n not in held)


class ReplacedTable:
    """A table that is replaced as a whole: each write is a new version, the newest complete one is read."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str):
        self.spark, self.path = spark, path
        self.schema = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)

    def current_version(self) -> str | None:
        numbers = lambda name: [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.split(r"(\d+)", name)]
        for name in sorted(child_names(self.spark, self.path), key=numbers, reverse=True):
            if exists(self.spark, f"{self.path}/{name}/_SUCCESS"):
                return name
        return None

    def overwrite(self, df: DataFrame, version: str) -> None:
        df.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/{version}")

    def read(self) -> DataFrame:
        version = self.current_version()
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{version}")
