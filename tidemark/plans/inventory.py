"""Row counts and load times across tables and files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_inventory(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Name, row count and newest load of each table, in order of name."""
    parts = [
        df.agg(F.count("*").alias("row_count"), F.max(stamp).alias("last_loaded")).select(
            F.lit(name).alias("source"), "row_count", "last_loaded"
        )
        for name, (df, stamp) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("source")


def per_file_counts(df: DataFrame, top: int = 5) -> DataFrame:
    """Rows per source file, newest load first."""
    return (
        df.groupBy("_source_file")
        .agg(F.count("*").alias("row_count"), F.max("_loaded_at").alias("last_loaded"))
        .orderBy(F.desc("last_loaded"), "_source_file")
        .limit(top)
    )


def sum_check(df: DataFrame, amount: str = "amount") -> DataFrame:
    return df.agg(F.count("*").alias("row_count"), F.sum(amount).alias("total_amount"))
