"""From raw documents to packed token sequences: five stages, each a table of its own.

A stage reads all rows its predecessor kept. Rows the quality filter rejects go; one row stays per
text, then one per group of near copies; strings of 200 bytes and more that occur again are cut out of
the texts; what is left is packed. The number of characters follows the text. All but the last stage
return the columns of ``documents``, extra ones included.

Null or empty texts pass the filters (as equal texts, one of them stays); rows without an id and rows
that share an id are not compared as near copies and stay; repeated rows are equal texts; empty tables
give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, packing, quality_ngram, simhash_wide, suffix_dedup
from tidemark.llm.common import table
from tidemark.session import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose perplexity is within the limit of their language."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    judged = quality_ngram.judge(docs, trusted)
    rejected = judged.where("not keep").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & F.xxhash64(docs["text"]).eqNullSafe(F.col("_hash"))
    return docs.join(rejected, same, "left_anti")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per text."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    copies = simhash_wide.near_duplicates(docs).select(F.col("doc_id").alias("_id"))
    return docs.join(copies, docs["doc_id"] == F.col("_id"), "left_anti")


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that also occur elsewhere."""
    changed = suffix_dedup.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return changed
    return changed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("suffix-array dedup", repeats),
    ("packing", pack),
]

#: Perplexities, fingerprint links and token ids have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
