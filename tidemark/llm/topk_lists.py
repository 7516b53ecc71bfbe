"""Exact top-k inner products by reading sorted lists, without random access while bounds decide.

Vectors become integers and are dealt into slices; queries are dealt into groups; each task serves one
group on one slice. A slice is walked in blocks, each block with a sorted list per component. A query
reads the lists from their best ends (falling contribution), all to the same depth: what it has seen of
a vector is the seen contributions, what it has not seen is at most the contribution where reading
stopped. Reading goes as deep as it must for a vector seen in no list to stay below the k-th score
known so far; vectors whose upper bound reaches that score are resolved to their final scores, which
raise it for the blocks that follow. A first block, when no score is known, is read to the end, where
lower and upper bounds meet.

The queries of a group are served together. A list read to some depth shows a component as it is if it lies
beyond the value at which reading stops, and as that value if not, so the upper bounds of all queries that
read equally deep are two matrix products, one for the best ends of their positive components and one for
those of their negative ones. Every query is still compared with every vector: work grows with the product.

Slices' results are merged by query, k rows from each. Nothing is approximate and ties go to the smaller
id. Groups and slices are bounded in rows at every size; queries and vectors are each sent once per
slice or group.

Defined cases: vectors that are null, or hold null or non-finite components, take no part; vectors are
compared with those of their own length; a query is not its own candidate, and rows that repeat an id
count as that id; with fewer than k candidates all are returned; empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle

K = 20
BLOCK = 2048
SLICE_ROWS = 16384
GROUP_QUERIES = 2048
AT_ONCE = 512
DEPTHS = 16
_OUT = "query_id long, vec_id long, score long"


class Lists:
    """The sorted lists of a block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.components = vectors if vectors.dtype.kind == "f" else vectors.astype(float)
        n = len(ids)
        self.depths = np.unique(np.ceil(n * np.arange(1, DEPTHS + 1) / DEPTHS).astype(int))
        values = np.sort(self.components, axis=0)
        # The value at which each list stops, for every depth, read from its greatest or its least end.
        self.great, self.small = values[n - self.depths], values[self.depths - 1]
        self.distinct = len(np.unique(ids)) == n

    def candidates(self, queries: np.ndarray, least: np.ndarray, known: np.ndarray, slack: float) -> np.ndarray:
        """By query and place: whether the upper bound reaches ``least``; all places where it is not ``known``."""
        queries = queries.astype(self.components.dtype)
        up, down, reach = np.maximum(queries, 0), np.minimum(queries, 0), least - slack
        enough = (up @ self.great.T + down @ self.small.T < reach[:, None]) & known[:, None]
        enough[:, -1] = True  # read to the end, every vector has been seen
        stop = enough.argmax(axis=1)
        wanted = np.ones((len(queries), len(self.ids)), bool)
        for d in np.unique(stop[stop < len(self.depths) - 1]):
            of = np.flatnonzero(stop == d)
            upper = up[of] @ np.maximum(self.components, self.great[d]).T
            upper += down[of] @ np.minimum(self.components, self.small[d]).T
            wanted[of] = upper >= reach[of, None]
        return wanted


def _exact(q: np.ndarray, v: np.ndarray) -> tuple[np.dtype, float]:
    """The fastest type in which every sum of products is exact, and what bounds may be off by."""
    high = lambda m: max(abs(int(m.max())), abs(int(m.min()))) if m.size else 0
    most = q.shape[1] * high(q) * high(v)
    if most < 1 << 24:
        return np.dtype(np.float32), 0.0
    if most < 1 << 53:
        return np.dtype(float), 0.0
    return np.dtype(np.int64), most * 2.0**-50 * (q.shape[1] + 1)


def _best(found: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """The k best ids of each query, in order of query and rank; an id counts once, with its best score."""
    query, ids, scores = (a[np.lexsort((-found[2], found[1], found[0]))] for a in found)
    first = np.ones(len(query), bool)
    first[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])
    query, ids, scores = query[first], ids[first], scores[first]
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    top = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[top], ids[top], scores[top]


def _serve(queries: pa.Table, vectors: pa.Table, k: int) -> pa.Table:
    """The k best of a slice for each query of a group."""

    def matrix(rows: pa.Table) -> np.ndarray:
        flat = rows.column("v").combine_chunks().flatten().to_numpy()
        return flat.reshape(rows.num_rows, len(flat) // rows.num_rows)

    out: list[tuple[np.ndarray, ...]] = []
    if queries.num_rows and vectors.num_rows:
        asked, q = queries.column("vec_id").to_numpy(), matrix(queries)
        ids, v = vectors.column("vec_id").to_numpy(), matrix(vectors)
        kind, slack = _exact(q, v)
        q, v = q.astype(kind), v.astype(kind)
        lowest = -np.inf if kind.kind == "f" else np.iinfo(kind).min
        parts = range(0, len(asked), AT_ONCE)
        best = {p: (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind)) for p in parts}
        for start in range(0, len(ids), BLOCK):
            block = Lists(ids[start : start + BLOCK], v[start : start + BLOCK])
            for p in parts:
                some, names = q[p : p + AT_ONCE], asked[p : p + AT_ONCE]
                places, _, scores = best[p]
                n = np.bincount(places, minlength=len(some))
                known, least = n == k, np.full(len(some), lowest, kind)
                least[known] = scores[np.cumsum(n)[known] - 1]
                wanted = block.candidates(some, least, known, slack)
                wanted &= block.ids != names[:, None]
                rows = np.flatnonzero(wanted.any(axis=0))
                if not len(rows):
                    continue
                wanted = wanted[:, rows]
                resolved = np.where(wanted, some @ block.vectors[rows].T, lowest)
                if block.distinct and len(rows) > k and not known.all():
                    least = np.maximum(least, np.partition(resolved, len(rows) - k, axis=1)[:, len(rows) - k])
                query, place = np.nonzero(wanted & (resolved >= least[:, None]))
                new = (query, block.ids[rows[place]], resolved[query, place])
                best[p] = _best(tuple(np.concatenate(x) for x in zip(best[p], new)), k)
        out = [(asked[p + query], names, scores) for p, (query, names, scores) in best.items()]
    columns = [np.concatenate(c).astype(np.int64) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
    return pa.table({"query_id": columns[0], "vec_id": columns[1], "score": columns[2]})


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best others of each row for which ``is_query`` holds."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    usable = F.coalesce(F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    rows = vectors.where(usable & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("v"),
        F.size(vector_col).alias("dim"),
        is_query.alias("asks"),
    )
    rows = settle(rows.dropDuplicates(["vec_id", "v"]), "vectors")
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    slices, groups = max(1, -(-n // SLICE_ROWS)), max(1, -(-asked // GROUP_QUERIES))
    deal = lambda name, parts: F.pmod(F.xxhash64(F.lit(name), "vec_id"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = rows.where("asks").select("vec_id", "v", "dim", deal("group", groups).alias("g")).withColumn("s", every(slices))
    right = rows.select("vec_id", "v", "dim", deal("slice", slices).alias("s")).withColumn("g", every(groups))
    keys = ["dim", "g", "s"]
    served = (
        left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda a, b: _serve(a, b, k), _OUT)
    )
    # A repeated id may bring an id into the result twice; its best row counts.
    single = served.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
