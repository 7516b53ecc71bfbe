"""Keeping the newest version of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    newest_by: Sequence[str],
    tie_break: Sequence[str | Column] = (),
    nulls: str = "last",
) -> DataFrame:
    """One row per key: the one with the greatest ``newest_by``.

    Each task keeps only its own best row per key before the shuffle, so a key
    holding a large share of the rows sends one row per task. A version without a
    timestamp loses unless ``nulls='first'``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    desc = (lambda c: F.col(c).desc_nulls_first()) if nulls == "first" else (lambda c: F.col(c).desc_nulls_last())
    ties = [t if isinstance(t, Column) else F.col(t) for t in tie_break]
    order = [desc(c) for c in newest_by] + [t.desc_nulls_last() for t in ties]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")
