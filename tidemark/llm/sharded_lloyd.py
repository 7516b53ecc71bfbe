"""Centroid clustering by Lloyd's rounds with the dimensions dealt out to shards.

Vectors are whole numbers: floor(scale * x) for each component. They are written once as column blocks:
a block is some thousand vectors, and each of its rows holds one shard's columns of them. A round is one job:

* a column-block task adds up the squared distances of its columns to the shard's slice of each centroid;
* these partial distances are added by block, and the nearest centroid (ties: the smaller number) is taken;
* labels go back to the column blocks, whose tasks add up members per centroid, and each shard replaces
  its own slice by floor(sum / count). Centroids without members stay.

All sums are exact: whole numbers in 64 bits within a task, decimals across tasks. The driver holds no
vectors and no centroids; slices are a small table (``k`` numbers per dimension) that is written anew each round.
No step depends on the number of members of a centroid, as rows are dealt by block.

Start centroids are the vectors with the smallest hash of ``seed:id``.

Defined cases: vectors that are null, of another length, or with null or non-finite components take no
part; components beyond 2^27 after scaling count as 2^27 (with their sign), so that distances of up to 512
dimensions fit 64 bits; repeated rows are vectors of their own, equal hashes are ordered by the vectors; a null id is
kept, and such vectors are start centroids only if nothing else is left; fewer vectors than ``k`` give as
many centroids as there are vectors; an empty table gives no rows; extra columns are not read; an inertia beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle

DIMENSIONS, CENTROIDS, ROUNDS = 64, 40, 5
SCALE, SEED = 256, "2"
LIMIT = 1 << 27
SHARD_COLUMNS = 32
BLOCK_ROWS = 4096
PARTIAL_BYTES = 8 << 20  # of one block's partial distances
BROADCAST_BYTES = 32 << 20
_BLOCK = "block long, shard int, n int, ids array<bigint>, data binary"


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """(vec_id, q): the vectors that take part, in whole numbers."""
    vector, big = F.col(vector_col), float(LIMIT)
    sound = (F.size(vector) == dimensions) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    scaled = F.transform(
        vector,
        lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-big)), F.lit(big))).cast("int"),
    )
    return vectors.where(F.coalesce(sound, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("q"))


def _column_blocks(batches: Iterator[pa.RecordBatch], rows: int, dimensions: int, columns: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    types = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
    names = [x.split()[0] for x in _BLOCK.split(", ")]
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            some = batch.slice(at, rows)
            values = some.column("q").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            out = []
            for shard, low in enumerate(range(0, dimensions, columns)):
                data = np.ascontiguousarray(values[:, low : low + columns], "<i4").tobytes()
                ids = some.column("vec_id").to_pylist() if shard == 0 else None
                out.append((number, shard, some.num_rows, ids, data))
            number += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def squared(values: np.ndarray, slices: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row to each row of ``slices``."""
    far = max(int(np.abs(values).max(initial=0)), int(np.abs(slices).max(initial=0)))
    exact = np.float64 if 4 * far * far * values.shape[1] < 1 << 53 else np.int64  # whole numbers either way
    v, c = values.astype(exact), slices.astype(exact)
    if exact is np.float64:
        return ((v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((v - one) ** 2).sum(1) for one in c], axis=1)


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["block", "n", "partial"]
    for batch in batches:
        for row in range(batch.num_rows):
            n = batch.column("n")[row].as_py()
            values = np.frombuffer(batch.column("data")[row].as_py(), "<i4").reshape(n, -1)
            slices = batch.column("slice")[row].values.to_numpy().reshape(-1, values.shape[1])
            partial = squared(values, slices)
            narrow = "<i4" if partial.max(initial=0) < 1 << 31 else "<i8"
            columns = [batch.column("block").slice(row, 1), batch.column("n").slice(row, 1), pa.array([partial.astype(narrow).tobytes()])]
            yield pa.RecordBatch.from_arrays(columns, names)


def _nearest(group: pa.Table, centroids: int) -> pa.Table:
    """One block: partial distances added over the shards, and the least of the sums."""
    n = group.column("n")[0].as_py()
    total = np.zeros((n, centroids), np.int64)
    for part in group.column("partial"):
        data = part.as_py()
        total += np.frombuffer(data, "<i4" if len(data) == 4 * n * centroids else "<i8").reshape(n, centroids)
    labels = total.argmin(1)
    distances = total[np.arange(n), labels]
    return pa.table({"block": group.column("block")[:1], "labels": [labels.astype("<i4").tobytes()], "distances": [distances.tobytes()]})


def _member_sums(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[pa.RecordBatch]:
    """Sums per shard, centroid and dimension over all column blocks of the task."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for row in range(batch.num_rows):
            labels = np.frombuffer(batch.column("labels")[row].as_py(), "<i4")
            values = np.frombuffer(batch.column("data")[row].as_py(), "<i4").reshape(len(labels), -1)
            shard = batch.column("shard")[row].as_py()
            order = np.argsort(labels, kind="stable")
            found, starts = np.unique(labels[order], return_index=True)
            added = np.add.reduceat(values[order].astype(np.int64), starts)
            own = sums.setdefault(shard, np.zeros((0, values.shape[1] + 1), np.int64))
            if len(own) <= found[-1]:
                own = np.concatenate([own, np.zeros((found[-1] + 1 - len(own), own.shape[1]), np.int64)])
                sums[shard] = own
            own[found, :-1] += added
            own[found, -1] += np.diff([*starts, len(labels)])
    names = ["shard", "cluster", "dim", "total", "members"]
    for shard, own in sums.items():
        cluster, column = np.divmod(np.arange(len(own) * (own.shape[1] - 1)), own.shape[1] - 1)
        kept = own[cluster, -1] > 0
        cluster, column = cluster[kept], column[kept]
        arrays = [np.full(len(cluster), shard), cluster, shard * columns + column, own[cluster, column], own[cluster, -1]]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, types)], names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            labels = np.frombuffer(batch.column("labels")[row].as_py(), "<i4")
            distances = np.frombuffer(batch.column("distances")[row].as_py(), "<i8")
            arrays = [batch.column("ids")[row].values, pa.array(labels), pa.array(distances)]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "cluster", "distance"])


def start_centroids(whole: DataFrame, centroids: int, seed: str, columns: int) -> DataFrame:
    """(shard, cluster, dim, value) of the first centroids: at most ``centroids`` vectors meet in one task."""
    hashed = whole.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "q")
    first = hashed.orderBy(F.asc_nulls_last("h"), "q").limit(centroids)
    ordered = first.agg(F.array_sort(F.collect_list(F.struct(F.isnull("h").alias("last"), "h", "q"))).alias("s"))
    numbered = ordered.select(F.posexplode("s").alias("cluster", "s"))
    return numbered.select("cluster", F.posexplode("s.q").alias("dim", "value")).select(
        F.floor(F.col("dim") / columns).cast("int").alias("shard"), "cluster", "dim", F.col("value").cast("long").alias("value")
    )


def _assigned(blocks: DataFrame, centers: DataFrame, centroids: int, dimensions: int) -> DataFrame:
    """(block, labels, distances) of every block."""
    held = F.array_sort(F.collect_list(F.struct("cluster", "dim", "value")))
    slices = centers.groupBy("shard").agg(F.transform(held, lambda x: x["value"]).alias("slice"))
    if 8 * centroids * dimensions <= BROADCAST_BYTES:
        slices = F.broadcast(slices)
    partial = blocks.join(slices, "shard").select("block", "n", "data", "slice").mapInArrow(_partials, "block long, n int, partial binary")
    return partial.groupBy("block").applyInArrow(lambda g: _nearest(g, centroids), "block long, labels binary, distances binary")


def _moved(blocks: DataFrame, labels: DataFrame, centers: DataFrame, columns: int) -> DataFrame:
    """Each shard's slice after its members were averaged."""
    labelled = blocks.join(labels.select("block", "labels"), "block").select("shard", "data", "labels")
    sums = labelled.mapInArrow(
        lambda rows: _member_sums(rows, columns), "shard int, cluster int, dim int, total long, members long"
    )
    added = sums.groupBy("shard", "cluster", "dim").agg(
        F.sum(F.col("total").cast("decimal(28,0)")).alias("total"), F.sum(F.col("members").cast("decimal(28,0)")).alias("members")
    )
    floor = F.expr("(total - pmod(total, members)) div members")
    return centers.join(added, ["shard", "cluster", "dim"], "left").select(
        "shard", "cluster", "dim", F.coalesce(floor, F.col("value")).alias("value")
    )


def cluster(
    vectors: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: str = SEED,
    shard_columns: int = SHARD_COLUMNS,
    block_rows: int = BLOCK_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """One row per vector (vec_id, cluster, distance) after the last round, and the centroids (shard, cluster, dim, value)."""
    whole = whole_vectors(vectors, id_col, vector_col, dimensions, scale)
    rows = max(1, min(block_rows, PARTIAL_BYTES // (8 * centroids)))
    blocks = settle(whole.mapInArrow(lambda b: _column_blocks(b, rows, dimensions, shard_columns), _BLOCK), "column-blocks")
    centers = settle(start_centroids(whole, centroids, seed, shard_columns), "centroids")
    found = centers.agg(F.coalesce(F.max("cluster") + 1, F.lit(0))).first()[0]
    for _ in range(rounds):
        labels = _assigned(blocks, centers, found, dimensions)
        centers = settle(_moved(blocks, labels, centers, shard_columns), "centroids")
    last = settle(_assigned(blocks, centers, found, dimensions), "labels")
    ids = blocks.where("shard = 0").select("block", "ids")
    assigned = last.join(ids, "block").mapInArrow(_rows, "vec_id long, cluster int, distance long")
    return settle(assigned, "clustered"), centers


def with_inertia(assigned: DataFrame, centers: DataFrame) -> DataFrame:
    """Adds the summed distances of each vector's cluster and of all, and a digest of its centroid."""
    exact = F.sum(F.col("distance").cast("decimal(28,0)"))
    per_cluster = assigned.groupBy("cluster").agg(exact.alias("own"))
    total = per_cluster.agg(F.sum("own")).scalar()
    ordered = F.array_sort(F.collect_list(F.struct("dim", "value")))
    digests = centers.groupBy("cluster").agg(
        F.sha2(F.array_join(F.transform(ordered, lambda x: x["value"].cast("string")), ","), 256).alias("centroid_sha256")
    )
    # one row per centroid, however many vectors there are
    figures = per_cluster.join(digests, "cluster").select(
        "cluster",
        F.col("own").try_cast("bigint").alias("cluster_inertia"),
        total.try_cast("bigint").alias("inertia"),
        "centroid_sha256",
    )
    return assigned.join(F.broadcast(figures), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def oracle_sql(centroids: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: str = SEED) -> str:
    """The same clustering as one SQL statement: a pair of tables per round."""
    nearest = (
        "list_min([{{'d': CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(v.q, c.q)]) AS BIGINT), 'c': c.c}}"
        " for c in (SELECT list({{'c': c, 'q': q}} ORDER BY c) FROM {c})])"
    )
    parts = [
        f"""v AS MATERIALIZED (
            SELECT vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q FROM embeddings
            WHERE len(embedding) = {dimensions} AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q
            FROM (SELECT sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h, q FROM v ORDER BY h, q LIMIT {centroids})
        )"""
    ]
    for r in range(rounds):
        parts.append(
            f"""a{r} AS MATERIALIZED (SELECT v.q, {nearest.format(c=f'c{r}')} AS n FROM v),
            s{r} AS (
                SELECT n.c AS c, i, sum(q[i]) AS s, count(*) AS m FROM a{r}, (SELECT unnest(range(1, {dimensions + 1})) AS i) GROUP BY ALL
            ), m{r} AS (
                SELECT c, list(CAST((s - ((s % m) + m) % m) // m AS BIGINT) ORDER BY i) AS q FROM s{r} GROUP BY c
            ), c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(m{r}.q, o.q) AS q FROM c{r} AS o LEFT JOIN m{r} USING (c))"""
        )
    return f"""
        WITH {', '.join(parts)},
        f AS MATERIALIZED (SELECT v.vec_id, {nearest.format(c=f'c{rounds}')} AS n FROM v)
        SELECT vec_id, CAST(n.c AS INTEGER) AS cluster, n.d AS distance,
               CAST(sum(n.d) OVER (PARTITION BY n.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(n.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(q, ',')) AS centroid_sha256
        FROM f JOIN c{rounds} ON n.c = c
    """
