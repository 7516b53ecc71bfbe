import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import sharded_lloyd as lloyd

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, n string"


def plain_lloyd(rows, k, rounds, dims, scale):
    """Rows of (id, whole vector) to (id, cluster, distance), and the centroids, in plain whole numbers."""
    big = lloyd.LIMIT
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == dims and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(min(max(scale * x, -big), big)) for x in vector]))
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    centers = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centers))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for i in range(len(centers)):
            members = [v for (_, v), o in zip(kept, own) if o == i]
            if members:
                centers[i] = [sum(x) // len(members) for x in zip(*members)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], centers


def order(rows):
    return sorted(rows, key=str)


def compare(spark, rows, k, rounds, dims, columns, block):
    df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA)
    assigned, centers = lloyd.cluster(df, k, rounds, dims, 8, shard_columns=columns, block_rows=block)
    want, want_centers = plain_lloyd(rows, k, rounds, dims, 8)
    assert order(map(tuple, assigned.collect())) == order(want)
    found = {(r.cluster, r.dim): r.value for r in centers.collect()}
    assert found == {(i, d): x for i, c in enumerate(want_centers) for d, x in enumerate(c)}
    own = {}
    for _, c, d in want:
        own[c] = own.get(c, 0) + d
    for r in lloyd.with_inertia(assigned, centers).collect():
        assert r.cluster_inertia == own[r.cluster] and r.inertia == sum(own.values())
        digest = ",".join(map(str, want_centers[r.cluster]))
        assert r.centroid_sha256 == hashlib.sha256(digest.encode()).hexdigest()


@pytest.mark.parametrize("dims,columns,block", [(6, 2, 7), (5, 3, 4), (4, 9, 1000)])
def test_rounds_equal_plain_lloyd(spark, dims, columns, block):
    rng = random.Random(dims)
    rows = [(i, [rng.gauss(i % 3, 1) for _ in range(dims)]) for i in range(90)]
    rows += [(200 + i, rows[0][1]) for i in range(40)]  # a third of all rows is one vector
    compare(spark, rows, 7, 4, dims, columns, block)


def test_odd_vectors(spark):
    good = [0.5, -0.25, 1.0]
    rows = [
        (1, good), (2, good), (2, good), (2, [3.0, 2.0, 1.0]), (None, good), (None, [9.0, 9.0, 9.0]), (3, None), (4, []),
        (5, [1.0, 2.0]), (6, [1.0, None, 2.0]), (7, [1.0, math.nan, 2.0]), (8, [math.inf, 0.0, 0.0]), (9, [1e300, -1e300, 5e8]),
        (10, [-0.01, -0.0, 0.124]),
    ]
    compare(spark, rows, 3, 3, 3, 2, 2)
    compare(spark, rows, 50, 2, 3, 1, 3)


def test_no_vectors(spark):
    compare(spark, [], 3, 2, 3, 2, 4)
    compare(spark, [(1, None)], 3, 2, 3, 2, 4)


def test_distances_are_exact_at_the_limit():
    v = np.array([[lloyd.LIMIT] * 4, [-lloyd.LIMIT] * 4], np.int32)
    assert lloyd.squared(v, v.astype(np.int64)).tolist() == [[0, 4 << 56], [4 << 56, 0]]
