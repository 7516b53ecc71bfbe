"""Ranked text search (BM25) and nearest vectors (cosine)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import words
from tidemark.operators.joins import fits_broadcast, lookup_join

K1, B = 1.2, 0.75


def tokenise(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, doc_len, term), one row per word of the whole text."""
    return docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("_w")).select(
        "doc_id", F.size("_w").alias("doc_len"), F.explode("_w").alias("term")
    )


def query_terms(queries: DataFrame) -> DataFrame:
    """Distinct words of each query."""
    return queries.select("query_id", F.explode(F.array_distinct(words(F.col("query")))).alias("term"))


def postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, doc_len, term, tf) of every word. A task counts a whole text before the shuffle."""
    return tokenise(docs, id_col, text_col).groupBy("doc_id", "doc_len", "term").agg(F.count("*").alias("tf"))


def _score(tf: Column, df: Column, doc_len: Column, n: Column, avg_len: Column) -> Column:
    idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
    return idf * (tf * (K1 + 1)) / (tf + K1 * (1 - B + B * doc_len / avg_len))


def corpus_stats(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.agg(F.count("*").alias("n"), F.sum(F.size(words(F.col(text_col)))).alias("total_len"))


def rank_top(scored: DataFrame, k: int, score: str = "score", ids: str = "doc_id") -> DataFrame:
    """Best k per query. Tasks cut to k before the shuffle; ties go to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc(score), F.asc(ids))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def bm25_topk(
    posts: DataFrame, stats: DataFrame, queries: DataFrame, k: int, allowed: DataFrame | None = None
) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents of each query.

    ``posts`` are postings or bare words of all documents, ``stats`` their number and total length.
    ``allowed`` (doc_id) restricts which documents may be returned; word statistics still cover all.

    Words no query asks for are dropped before anything is shuffled. One shuffle by document then
    serves the counts and the sums, as both group by the document and more.
    """
    terms = query_terms(queries)
    vocabulary = terms.select("term").distinct()
    hits = lookup_join(posts, vocabulary, ["term"], F.col("doc_id"), counted=terms)
    count = F.sum("tf") if "tf" in posts.columns else F.count("*")
    tf = hits.repartition("doc_id").groupBy("doc_id", "doc_len", "term").agg(count.alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    wanted = terms.join(df, "term")
    candidates = tf if allowed is None else tf.join(allowed.select("doc_id"), "doc_id", "left_semi")
    n, total = stats.select("n").scalar(), stats.select("total_len").scalar()
    partial = lookup_join(candidates, wanted, ["term"], F.col("doc_id"), counted=terms).withColumns({"_n": n, "_total": total})
    scored = (
        partial.groupBy("query_id", "doc_id")
        .agg(
            F.sum(
                _score(F.col("tf"), F.col("df"), F.col("doc_len"), F.col("_n"), F.col("_total") / F.col("_n"))
            ).alias("score")
        )
        .withColumn("score", F.round("score", 6))
    )
    return rank_top(scored, k)


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str,
    text_col: str,
    attributes: Sequence[str],
    where: Column | None = None,
) -> DataFrame:
    """Search a table of documents and return the hits with their attributes.

    The table is read several times, with few columns at a time: pass a stored one.
    """
    stats = corpus_stats(docs, text_col)
    allowed = None if where is None else docs.where(where).select(F.col(id_col).alias("doc_id"))
    top = bm25_topk(tokenise(docs, id_col, text_col), stats, queries, k, allowed)
    shown = docs.select(F.col(id_col).alias("doc_id"), *attributes)
    if fits_broadcast(queries, rows_each=k):
        top = F.broadcast(top)
    return shown.join(top, "doc_id")


# --------------------------------------------------------------------- vectors

QUERIES_PER_PASS = 1024


def _batch_ranker(
    query_ids: np.ndarray, queries: np.ndarray, k: int
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A task's work as one self-contained function: best k of each batch per query."""

    def best(ids: np.ndarray, corpus: np.ndarray) -> Iterator[pd.DataFrame]:
        norms = np.linalg.norm(corpus, axis=1)[:, None]
        unit = np.divide(corpus, norms, out=np.zeros_like(corpus), where=norms > 0)
        for q, row in enumerate(np.round(queries @ unit.T, 6)):
            top = np.lexsort((ids, -row))[:k]
            yield pd.DataFrame({"query_id": query_ids[q], "doc_id": ids[top], "score": row[top]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.isna().any(axis=None):
                raise ValueError("a row has no id or no vector")
            if len(batch):
                vectors = np.stack(batch["vector"].to_numpy()).astype(np.float64)
                yield pd.concat(best(batch["doc_id"].to_numpy(), vectors), ignore_index=True)

    return run


def vector_topk(
    corpus: DataFrame, queries: Sequence[tuple[int, Sequence[float]]], k: int, id_col: str, vector_col: str
) -> DataFrame:
    """(query_id, rank, doc_id, score): exact cosine neighbours of each query vector.

    Tasks multiply their rows with all query vectors and pass on k rows per query and batch. The
    queries of one request travel with the task; long lists are cut into passes, so a task holds no
    more than a thousand query vectors at a time. A row without id or vector fails the job.
    """
    schema = T.StructType(
        [
            T.StructField("query_id", T.LongType()),
            T.StructField("doc_id", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    narrow = corpus.select(F.col(id_col).alias("doc_id"), F.col(vector_col).alias("vector"))

    def one_pass(part: Sequence[tuple[int, Sequence[float]]]) -> DataFrame:
        query_ids = np.array([q for q, _ in part], dtype=np.int64)
        matrix = np.array([v for _, v in part], dtype=np.float64)
        lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
        matrix = np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)
        return narrow.mapInPandas(_batch_ranker(query_ids, matrix, k), schema)

    if not queries:
        raise ValueError("no query vectors")
    passes = [queries[i : i + QUERIES_PER_PASS] for i in range(0, len(queries), QUERIES_PER_PASS)]
    return rank_top(reduce(DataFrame.unionByName, [one_pass(p) for p in passes]), k)
