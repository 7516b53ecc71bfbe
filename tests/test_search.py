import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import joins, search
from tidemark.operators.ranking import auc_exact


def words(text):
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def brute_bm25(docs, queries, k, allowed=None):
    tokens = {d: words(t) for d, t in docs.items()}
    n, avg = len(docs), sum(map(len, tokens.values())) / len(docs)
    df = {}
    for ws in tokens.values():
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    out = set()
    for q, text in queries.items():
        scored = []
        for d, ws in tokens.items():
            shared = set(words(text)) & set(ws)
            if shared and (allowed is None or d in allowed):
                s = sum(
                    math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                    * ws.count(w) * 2.2 / (ws.count(w) + 1.2 * (0.25 + 0.75 * len(ws) / avg))
                    for w in shared
                )
                scored.append((-round(s, 6), d))
        out |= {(q, r, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k], start=1)}
    return out


DOCS = {i: f"common w{i % 4} w{i % 7} " * (1 + i % 3) + "Élan tail" * (i % 2) for i in range(40)}
QUERIES = {1: "Common w3", 2: "w1 w2 élan", 3: "nothing known", 4: "common common w6"}


@pytest.fixture
def tables(spark):
    docs = spark.createDataFrame(list(DOCS.items()), "doc_id long, body string").repartition(3)
    queries = spark.createDataFrame(list(QUERIES.items()), "query_id long, query string")
    return docs, queries


def found(df):
    return {(r.query_id, r["rank"], r.doc_id, r.score) for r in df.collect()}


def test_bm25_against_brute_force(tables):
    docs, queries = tables
    got = search.search(docs, queries, 5, "doc_id", "body", [])
    assert found(got) == brute_bm25(DOCS, QUERIES, 5)


def test_filter_limits_results_but_not_statistics(tables):
    docs, queries = tables
    got = search.search(docs, queries, 5, "doc_id", "body", [], F.col("doc_id") % 3 == 0)
    assert found(got) == brute_bm25(DOCS, QUERIES, 5, {d for d in DOCS if d % 3 == 0})


def test_bm25_without_broadcast_gives_the_same(tables, monkeypatch):
    docs, queries = tables
    real = joins.lookup_join
    monkeypatch.setattr(search, "lookup_join", lambda *a, **k: real(*a, **{**k, "max_rows": 0, "salts": 3}))
    assert found(search.search(docs, queries, 5, "doc_id", "body", [])) == brute_bm25(DOCS, QUERIES, 5)


def test_salted_join_spreads_a_hot_key(spark):
    left = spark.range(9000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("8", 3)], "k string, v long")
    out = joins.lookup_join(left, right, ["k"], F.col("id"), max_rows=0, salts=8)
    plain = left.join(right, "k")
    assert out.count() == plain.count() == 12001
    assert out.exceptAll(plain).isEmpty()
    outer = joins.lookup_join(left, right, ["k"], F.col("id"), "left", max_rows=0, salts=8)
    assert outer.exceptAll(left.join(right, "k", "left")).isEmpty() and outer.count() == 15000


def brute_cosine(vectors, queries, k):
    out = set()
    for q, v in queries:
        scores = []
        for i, w in vectors.items():
            n = np.linalg.norm(v) * np.linalg.norm(w)
            scores.append((-round(float(np.dot(v, w) / n), 6) if n else 0.0, i))
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], start=1)}
    return out


def test_vectors_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    vectors = {i: rng.integers(-4, 5, 6).astype(float).tolist() for i in range(60)}
    vectors[61] = vectors[3]
    vectors[62] = [0.0] * 6
    queries = [(i, rng.integers(1, 5, 6).astype(float).tolist()) for i in range(5)]
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, v array<float>").repartition(4)
    expected = brute_cosine(vectors, queries, 7)
    assert found(search.vector_topk(df, queries, 7, "vec_id", "v")) == expected
    monkeypatch.setattr(search, "QUERIES_PER_PASS", 2)
    assert found(search.vector_topk(df, queries, 7, "vec_id", "v")) == expected


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    pairs = [(float(rng.integers(0, 40)) / 40, int(rng.integers(0, 2))) for _ in range(400)]
    pairs += [(0.25, i % 2) for i in range(200)]  # a third of the rows share one score
    df = spark.createDataFrame(pairs, "s double, y int").repartition(5)
    assert auc_exact(df, "y", "s").first().auc == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_auc_needs_both_classes(spark):
    got = auc_exact(spark.createDataFrame([(0.5, 1)], "s double, y int"), "y", "s").first()
    assert (got.positives, got.negatives, got.auc) == (1, 0, None)
    assert rows(auc_exact(spark.createDataFrame([], "s double, y int"), "y", "s"))[0]["auc"] is None


def test_a_row_without_vector_fails(spark):
    from pyspark.errors import PySparkException

    from tidemark.operators.search import vector_topk

    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "id long, v array<double>")
    with pytest.raises(PySparkException, match="no id or no vector"):
        vector_topk(corpus, [(0, [1.0, 0.0])], 1, "id", "v").collect()
