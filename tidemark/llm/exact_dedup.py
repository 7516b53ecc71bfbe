"""Exact deduplication by skew-safe combining.

Rows with equal text meet in three stages, each of which groups by digest *and* whole text, so equal
means identical content and a digest alone never decides:

1. inside each map task (the partial aggregation), which leaves one row per text and task,
2. by digest and salt; the salt is the number of the map task, so a text that a third of all rows
   share reaches a salt group as a few rows per task,
3. by digest alone, where at most ``salts`` rows per text are left.

Rows then look up the winner of their group by digests, in a join of narrow rows that AQE splits
where a digest is hot.

Defined cases: a null text is the empty text. Of equal texts the largest id stays; a null id loses to
any other. Rows repeated with the same id and text count in ``group_size`` and carry the same labels;
``keep_one`` returns one of them. Empty input gives an empty result. Extra columns are not carried by
``exact_groups`` and stay untouched in ``keep_one``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts_of

SALTS = 16


def _digests(df: DataFrame) -> DataFrame:
    return df.withColumn("sha", F.unhex(F.sha2("text", 256))).withColumn("check", F.xxhash64("text"))


def _winners(rows: DataFrame, salts: int, best, size) -> DataFrame:
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    by_salt = salted.groupBy("sha", "check", "text", "salt").agg(best("row").alias("row"), F.sum(size).alias("size"))
    return by_salt.groupBy("sha", "check", "text").agg(best("row").alias("row"), F.sum("size").alias("size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = _digests(texts_of(docs, id_col, text_col))
    groups = _winners(rows.withColumnRenamed("doc_id", "row"), salts, F.max, F.lit(1))
    found = groups.select("sha", "check", F.col("row").alias("keep_id"), F.col("size").alias("group_size"))
    return rows.select("doc_id", "sha", "check").join(found, ["sha", "check"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One whole input row per distinct text, that with the largest id; columns as they came."""
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    packed = docs.select(
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.struct(
            F.col(id_col).alias("id"),
            F.col(text_col).isNull().alias("was_null"),
            *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)],
        ).alias("row"),
    )
    last = lambda row: F.max_by(row, F.struct(f"{row}.id", f"{row}.was_null"))
    winners = _winners(_digests(packed), salts, last, F.lit(1))
    back = {id_col: F.col("row.id"), text_col: F.when(~F.col("row.was_null"), F.col("text"))}
    back |= {c: F.col(f"row.c{i}") for i, c in enumerate(others)}
    return winners.select(*[back[c].alias(c) for c in docs.columns])
