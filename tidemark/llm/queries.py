"""The registered queries of the training-data operators and the SQL that some are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe_matrix,
    exact_dedup,
    language,
    packing,
    quality_ngram,
    sharded_lloyd,
    simhash_bytes,
    suffix_dedup,
    sum_squares,
    topk_lists,
    turn_repair,
    warc,
    wavelet,
)
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        return function

    return register


@query("op1_quality_kneser_ney")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    judged = quality_ngram.judge(table(spark, sf_dir, "documents"), trusted)
    return judged.select("doc_id", "lang", "n_bytes", "perplexity", "limit", "keep")


@query("op2_language_families")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language.train(documents.where(~language.held_out()).select("doc_id", "text", "lang"))
    found = language.identify(documents, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query("op3_topk_sorted_lists")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_lists.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op4_simhash_bytes")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_bytes.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_pack_first_fit")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op6_warc_revisits")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(table(spark, sf_dir, "pages"))
    return records.selectExpr("page_id", "payload_bytes", "digest AS payload_digest", "record_type", "refers_to")


@query("op7_bpe_matrix")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_matrix.round_trip(table(spark, sf_dir, "documents"))


@query("op8_repeated_strings")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.dedup_strings(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_exact_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query("op10_wavelet_tokens")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.store_tokens(table(spark, sf_dir, "documents"))


@query("op11_audit_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damage(table(spark, sf_dir, "conversations")))


@query("op12_sharded_lloyd")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centers = sharded_lloyd.cluster(table(spark, sf_dir, "embeddings"))
    return sharded_lloyd.with_inertia(assigned, centers)


@query("op13_sum_of_squares")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sum_squares.pack(table(spark, sf_dir, "documents"))


ORACLE = {
    "op11_audit_repair": turn_repair.oracle_sql(),
    "op12_sharded_lloyd": sharded_lloyd.oracle_sql(),
    "op3_topk_sorted_lists": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)]) AS BIGINT) AS score
            FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 20 = 0
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op6_warc_revisits": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS n FROM pages
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM p
        )
        SELECT page_id, n AS payload_bytes, sha256(payload) AS payload_digest,
               CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
        FROM f
    """,
    "op9_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
        g AS (SELECT *, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size FROM d WINDOW w AS (PARTITION BY body))
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
    """,
}
