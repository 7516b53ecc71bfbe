"""A model kept as a table by month, of which a run rewrites only the months that changed."""

from __future__ import annotations

import datetime as dt
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.commits import CommitLog
from tidemark.state import child_names

_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder for rows without a value


def _prints(monthly: DataFrame) -> dict[str, list[str]]:
    """Number of rows and order-free sums of row hashes per month: one row per month reaches the driver."""
    columns = [F.col(f"`{c}`") for c in monthly.columns if c != "month"]
    hashed = monthly.select("month", F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))
    # Summed in pieces of 24 bits and put together here: whole sums would need decimals, which cost several times as much.
    piece = lambda c, bits: F.shiftright(c, bits) if bits == 48 else F.shiftright(c, bits).bitwiseAND(F.lit((1 << 24) - 1))
    parts = [F.sum(piece(c, bits)).alias(f"{c}{bits}") for c in ("a", "b") for bits in (0, 24, 48)]
    sums = hashed.groupBy("month").agg(F.count(F.lit(1)).alias("n"), *parts)
    whole = lambda r, c: str(sum(r[f"{c}{bits}"] << bits for bits in (0, 24, 48)))
    return {r["month"] or _NO_MONTH: [str(r["n"]), whole(r, "a"), whole(r, "b")] for r in sums.collect()}


class MonthlyTable:
    """Rows by month of ``date``, each month in a folder of the run that last changed it.

    A run writes the changed months beside what is there and then publishes which folders count, so
    readers see the table before or after a run, a run that breaks off changes nothing, and of two
    runs at once the later one compares again. Folders that count no longer stay for those who still
    read them. Rows without a date form a month of their own.
    """

    def __init__(self, spark: SparkSession, path: str, date: str):
        self.spark, self.path, self.date = spark, path, date
        self.log = CommitLog(spark, f"{path}/_commits")

    def _with_month(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("month", F.date_format(self.date, "yyyy-MM"))

    def _opened(self, rows: DataFrame, folders: dict[str, str]) -> DataFrame:
        schema = self._with_month(rows).schema
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/month={month}/run={run}" for month, run in sorted(folders.items())]
        whole = self.spark.read.schema(schema.add("run", "string")).option("basePath", self.path).parquet(*paths)
        return whole.drop("run")

    def _write(self, rows: DataFrame, run: str) -> None:
        # Days in order within a file: readers of a period skip folders and row groups. The rebalance
        # gathers a month's rows, and AQE still splits a month too big for a task.
        ordered = rows.hint("rebalance", "month").sortWithinPartitions("month", self.date)
        ordered.withColumn("run", F.lit(run)).write.mode("append").partitionBy("month", "run").parquet(self.path)

    def _written(self, rows: DataFrame, run: str) -> dict[str, list[str]]:
        """What a run wrote, counted in its files: rows may have changed since they were compared."""
        months = [n.partition("=")[2] for n in child_names(self.spark, self.path) if n.startswith("month=")]
        mine = {m: run for m in months if run in {n.partition("=")[2] for n in child_names(self.spark, f"{self.path}/month={m}")}}
        return _prints(self._opened(rows, mine))

    def between(self, table: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
        """Rows of a period; only the folders of its months are opened."""
        months = F.col("month").between(first.strftime("%Y-%m"), last.strftime("%Y-%m"))
        return table.where(months & F.col(self.date).between(F.lit(first), F.lit(last)))

    def refresh(self, rows: DataFrame) -> DataFrame:
        """Bring the table to ``rows`` and return it, with its ``month``."""
        monthly = self._with_month(rows)
        columns = [list(c) for c in monthly.dtypes]

        def next_state(number: int, state: dict[str, Any]) -> dict[str, Any] | None:
            run = f"{number:09d}-{uuid.uuid4().hex[:8]}"
            if not state or state["columns"] != columns:
                self._write(monthly, run)
                written = self._written(rows, run)
                runs = dict.fromkeys(written, run)
                return {"columns": columns, "runs": runs, "prints": written, "changed": sorted(written)}
            before, now = state["prints"], _prints(monthly)
            changed = sorted(m for m, found in now.items() if before.get(m) != found)
            gone = set(before) - set(now)
            if not changed and not gone:
                return None
            runs = {m: r for m, r in state["runs"].items() if m in now}
            prints = {m: p for m, p in before.items() if m in now}
            if changed:
                month = F.coalesce(F.col("month"), F.lit(_NO_MONTH))
                self._write(monthly.where(month.isin(changed)), run)
                written = self._written(rows, run)
                # A month whose rows went away between the comparison and the write has nothing to open.
                runs = {m: r for m, r in runs.items() if m not in changed} | dict.fromkeys(written, run)
                prints = {m: p for m, p in prints.items() if m not in changed} | written
            return {"columns": state["columns"], "runs": runs, "prints": prints, "changed": changed}

        return self._opened(rows, self.log.change(next_state)["runs"])
