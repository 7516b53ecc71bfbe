"""Nearest vectors from cells against all products."""

import numpy as np
import pytest
from pyspark.errors import PySparkException

from test_search import brute_cosine, found
from tidemark.operators import vector_index
from tidemark.operators.vector_index import VectorIndex


def made(seed, n, dims=5, spread=0.15):
    """Vectors around a few directions, a third of them one and the same."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (6, dims))
    vectors = {i: (centres[i % 6] + rng.normal(0, spread, dims)).tolist() for i in range(n)}
    vectors |= {i: vectors[0] for i in range(n // 3)}
    return vectors | {n: [0.0] * dims, n + 1: (-centres[1]).tolist()}


@pytest.mark.parametrize("pivots,block,k", [(8, 16, 5), (1, 7, 3), (200, 1024, 1), (8, 4, 400)])
def test_cells_equal_all_products(spark, tmp_path, monkeypatch, pivots, block, k):
    vectors = made(pivots, 150)
    rng = np.random.default_rng(9)
    queries = [(i, rng.normal(0, 1, 5).tolist()) for i in range(12)] + [(20, vectors[3]), (21, [0.0] * 5), (22, vectors[151])]
    monkeypatch.setattr(vector_index, "CHUNK_QUERIES", 4)
    index = VectorIndex(spark, f"file://{tmp_path}/v")
    index.build(spark.createDataFrame(list(vectors.items()), "id long, v array<double>").repartition(3), "id", "v", pivots, block)
    asked = spark.createDataFrame(queries, "query_id long, vector array<double>")
    assert found(index.search(asked, k)) == brute_cosine(vectors, queries, k)


def test_far_cells_are_not_multiplied(spark, tmp_path):
    vectors = made(4, 600, spread=0.02)
    index = VectorIndex(spark, f"file://{tmp_path}/v")
    index.build(spark.createDataFrame(list(vectors.items()), "id long, v array<float>"), "id", "v", 12, 16)
    asked = spark.createDataFrame([(1, vectors[301]), (2, vectors[302])], "query_id long, vector array<double>")
    assert index.multiplied_share(asked, 3) < 0.7


def test_odd_vectors(spark, tmp_path):
    for n, rows in enumerate(([(1, None)], [(None, [1.0])], [(1, [1.0, None])], [(1, [1.0]), (2, [1.0, 2.0])])):
        with pytest.raises(PySparkException, match="no id or no vector|several lengths"):
            VectorIndex(spark, f"file://{tmp_path}/{n}").build(spark.createDataFrame(rows, "id long, v array<double>").coalesce(1), "id", "v")
    empty = VectorIndex(spark, f"file://{tmp_path}/none")
    empty.build(spark.createDataFrame([], "id long, v array<double>"), "id", "v")
    asked = spark.createDataFrame([(1, [1.0])], "query_id long, vector array<double>")
    assert empty.search(asked, 3).count() == 0
