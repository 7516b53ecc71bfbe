"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on, under names of its own; a null text is empty.

    Nothing else of the input is carried along, so extra columns can't clash.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(batches: Iterable[pa.RecordBatch], byte_column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in batches of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        lengths = batch.column(byte_column).to_pylist() if batch.num_rows else []
        start = size = 0
        for row, value in enumerate(lengths):
            if row > start and size + len(value) > limit:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += len(value)
        if batch.num_rows > start:
            yield batch.slice(start)


def keep_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids``, sent to all tasks if there are few, joined otherwise."""
    wanted = ids.select(F.col(id_col).alias("_wanted")).where("_wanted is not null")
    if wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    return docs.join(wanted, docs[id_col] == F.col("_wanted"), "left_semi")
