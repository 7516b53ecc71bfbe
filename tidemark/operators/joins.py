"""Joins whose strategy depends on a checked size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
SALTS = 32


def fits_broadcast(lookup: DataFrame, rows_each: int = 1, max_rows: int | None = None) -> bool:
    """Whether a table of narrow rows, each standing for ``rows_each``, is small enough; by counting."""
    limit = (BROADCAST_ROWS if max_rows is None else max_rows) // rows_each
    return lookup.limit(limit + 1).count() <= limit


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    spread_by: Column,
    how: str = "inner",
    counted: DataFrame | None = None,
    max_rows: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Inner or left join of many rows with a lookup whose keys may be very unevenly used.

    A lookup counted at ``max_rows`` or fewer narrow rows is broadcast. A larger one is repeated once
    per salt, so the rows of one hot key spread over that many tasks. ``counted`` is a cheaper table
    known to have at least as many rows, to be counted instead.
    """
    on = list(on)
    if fits_broadcast(lookup if counted is None else counted, max_rows=max_rows):
        return rows.join(F.broadcast(lookup), on, how)
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    right = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")
