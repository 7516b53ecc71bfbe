"""Exact nearest vectors with cells around pivots and triangle-inequality bounds.

Vectors are scaled to unit length (those of zero length stay) and stored in the cell of their nearest pivot, in
order of their distance r to it, in blocks of some thousand with the range of r. A vector x whose score with the
query q is at least s lies within D = sqrt(2 - 2s) of q, and |d(q, p) - d(x, p)| <= d(q, x) for every pivot p. So
once k scores of at least s are known, only blocks and rows with r in d(q, p) -+ D are multiplied; the others
cannot be among the k best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import fits_broadcast
from tidemark.operators.search import rank_top
from tidemark.session import settle

PIVOTS = 64
BLOCK_ROWS = 1024
CHUNK_QUERIES = 128  # queries that meet a block in one row
SEED_CELLS = 2
SLACK = 2e-6  # scores are compared at six decimals
_BLOCK = "cell int, n int, low double, high double, ids array<bigint>, r binary, data binary"
_SCORE = "query_id bigint, doc_id bigint, score double, multiplied bigint"


def _units(vectors: pa.Array) -> np.ndarray:
    """Rows of unit length in double precision. Lists or binary of doubles."""
    if pa.types.is_binary(vectors.type):
        data = np.stack([np.frombuffer(v, "<f8") for v in vectors.to_pylist()])
    else:
        if vectors.null_count or vectors.flatten().null_count:
            raise ValueError("a row has no id or no vector")
        lengths = np.diff(vectors.offsets.to_numpy())
        if len(set(lengths.tolist())) > 1:
            raise ValueError("vectors of several lengths")
        data = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    norms = np.linalg.norm(data, axis=1)[:, None]
    return np.divide(data, norms, out=np.zeros_like(data), where=norms > 0)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0))


def _to_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            if batch.column("id").null_count:
                raise ValueError("a row has no id or no vector")
            data = [u.tobytes() for u in _units(batch.column("vector"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(data, pa.binary())], ["id", "unit"])


def _assigned(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            some = batch.slice(at, BLOCK_ROWS)
            apart = _distances(_units(some.column("unit")), pivots)
            cell = apart.argmin(1)
            arrays = [pa.array(cell, pa.int32()), pa.array(apart[np.arange(len(cell)), cell]), some.column("id"), some.column("unit")]
            yield pa.RecordBatch.from_arrays(arrays, ["cell", "r", "id", "unit"])


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of rows that are in order of cell and distance."""
    names = [x.split()[0] for x in _BLOCK.split(", ")]
    types = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
    for batch in batches:
        cells = batch.column("cell").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
        for first, last in zip(edges, edges[1:]):
            for at in range(first, last, rows):
                some = batch.slice(at, min(rows, last - at))
                r = some.column("r").to_numpy()
                row = (int(cells[at]), len(r), r.min(), r.max(), some.column("id").to_pylist(), r.tobytes(), b"".join(some.column("unit").to_pylist()))
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)


def _to_pivots(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Distance of each query to each pivot."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            some = batch.slice(at, BLOCK_ROWS)
            apart = _distances(_units(some.column("unit")), pivots)
            rows = pa.array(np.repeat(np.arange(len(apart)), len(pivots)))
            cells = pa.array(np.tile(np.arange(len(pivots)), len(apart)), pa.int32())
            arrays = [some.column("id").take(rows), cells, pa.array(apart.ravel())]
            yield pa.RecordBatch.from_arrays(arrays, ["query_id", "cell", "apart"])


def _multiplied(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Best k rows of each block for each of its queries, among rows with r in the query's range."""
    for batch in batches:
        for row in range(batch.num_rows):
            r = np.frombuffer(batch.column("r")[row].as_py(), "<f8")
            ids = batch.column("ids")[row].values.to_numpy()
            data = np.frombuffer(batch.column("data")[row].as_py(), "<f8").reshape(len(r), -1)
            for ask in batch.column("asks")[row].as_py():
                first, last = np.searchsorted(r, ask["low"], "left"), np.searchsorted(r, ask["high"], "right")
                if first == last:
                    continue
                scores = np.round(data[first:last] @ np.frombuffer(ask["unit"], "<f8"), 6)
                top = np.lexsort((ids[first:last], -scores))[:k] if len(scores) <= 4 * k else _best(scores, ids[first:last], k)
                arrays = [np.full(len(top), ask["query_id"]), ids[first:last][top], scores[top], np.full(len(top), 0)]
                arrays[3][0] = last - first
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], [x.split()[0] for x in _SCORE.split(", ")])


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The k best by score, then by smaller id, without ordering all."""
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    some = np.flatnonzero(scores >= least)
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


class VectorIndex:
    """Vectors by cell in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def build(self, vectors: DataFrame, id_col: str, vector_col: str, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> None:
        """Store all vectors. Pivots are those with the smallest hash of their id; any choice gives the same results."""
        rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"))
        units = rows.mapInArrow(_to_units, "id bigint, unit binary")
        first = units.orderBy(F.xxhash64("id"), "id").limit(pivots)  # of bounded number: `pivots` rows
        first.select("unit").write.parquet(f"{self.path}/pivots")
        around = self._pivots()
        placed = units.mapInArrow(lambda b: _assigned(b, around), "cell int, r double, id bigint, unit binary")
        ordered = placed.hint("rebalance", "cell").sortWithinPartitions("cell", "r")
        ordered.mapInArrow(lambda b: _blocks(b, block_rows), _BLOCK).write.partitionBy("cell").parquet(f"{self.path}/blocks")

    def _pivots(self) -> np.ndarray:
        """The pivots in one order; a few dozen vectors, which travel with the tasks."""
        rows = self.spark.read.schema("unit binary").parquet(f"{self.path}/pivots").orderBy("unit").collect()
        return np.stack([np.frombuffer(r.unit, "<f8") for r in rows]) if rows else np.zeros((0, 0))

    def _blocks(self) -> DataFrame:
        return self.spark.read.schema(_BLOCK).parquet(f"{self.path}/blocks")

    def _scored(self, ranges: DataFrame, k: int) -> DataFrame:
        """Rows of the blocks that meet the ranges (query_id, unit, cell, low, high)."""
        ask = F.struct("query_id", "unit", "low", "high")
        chunk = F.pmod(F.xxhash64("query_id"), F.lit(max(1, -(-ranges.select("query_id").distinct().count() // CHUNK_QUERIES))))
        asks = ranges.groupBy("cell", chunk.alias("chunk")).agg(
            F.collect_list(ask).alias("asks"), F.min("low").alias("from_r"), F.max("high").alias("to_r")
        )
        small = F.broadcast(asks) if fits_broadcast(ranges, max_rows=20_000) else asks
        met = self._blocks().join(small, "cell").where((F.col("high") >= F.col("from_r")) & (F.col("low") <= F.col("to_r")))
        return met.select("ids", "r", "data", "asks").mapInArrow(lambda b: _multiplied(b, k), _SCORE)

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, rank, doc_id, score): the k nearest by cosine of each query (query_id, vector); ties to the smaller id."""
        return rank_top(self._candidates(queries, k).drop("multiplied"), k)

    def _candidates(self, queries: DataFrame, k: int) -> DataFrame:
        asked = queries.select(F.col("query_id").cast("bigint").alias("id"), "vector").mapInArrow(_to_units, "id bigint, unit binary")
        asked = settle(asked, "query-units")
        cells = self._blocks().groupBy("cell").agg(F.sum("n").alias("n"), F.min("low").alias("least"), F.max("high").alias("most"))
        around = self._pivots()
        apart = asked.mapInArrow(lambda b: _to_pivots(b, around), "query_id bigint, cell int, apart double")
        near = settle(apart.join(F.broadcast(cells), "cell").join(asked.withColumnRenamed("id", "query_id"), "query_id"), "query-cells")

        # the nearest cells that hold k vectors or more give the first bound
        by_distance = Window.partitionBy("query_id").orderBy("apart", "cell")
        so_far = by_distance.rowsBetween(Window.unboundedPreceding, 0)
        counted = near.withColumns({"_c": F.row_number().over(by_distance), "_n": F.sum("n").over(so_far)})
        first = (F.col("_c") <= SEED_CELLS) | (F.col("_n") - F.col("n") < k)
        everything = {"low": F.lit(-1.0), "high": F.lit(9.0)}
        seeds = counted.where(first).withColumns(everything).select("query_id", "unit", "cell", "low", "high")
        seeded = settle(self._scored(seeds, k), "first-scores")
        kth = Window.partitionBy("query_id").orderBy(F.desc("score"))
        bound = seeded.withColumn("_r", F.row_number().over(kth)).where(F.col("_r") == k)
        within = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * (F.col("score") - SLACK))) + SLACK
        bound = bound.select("query_id", within.alias("within"))

        # all others only where their distance to the pivot allows it; fewer than k in all means no bound
        rest = counted.where(~first).join(bound, "query_id", "left").withColumn("within", F.coalesce("within", F.lit(9.0)))
        ranges = rest.withColumns({"low": F.col("apart") - F.col("within"), "high": F.col("apart") + F.col("within")})
        ranges = ranges.where((F.col("most") >= F.col("low")) & (F.col("least") <= F.col("high"))).select("query_id", "unit", "cell", "low", "high")
        return seeded.unionByName(self._scored(settle(ranges, "query-ranges"), k))

    def multiplied_share(self, queries: DataFrame, k: int) -> float:
        """Products of a query and a vector that were worked out, of all pairs."""
        done = self._candidates(queries, k).agg(F.sum("multiplied")).first()[0] or 0
        return done / max(1, queries.count() * (self._blocks().agg(F.sum("n")).first()[0] or 0))
