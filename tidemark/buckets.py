"""A table with one row per key, in buckets of keys that are rewritten where they change."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.commits import CommitLog
from tidemark.operators.latest import latest_per_key
from tidemark.session import settle
from tidemark.state import child_names, remove

BUCKETS = 64
REMEMBERED = 200


class BucketTable:
    """The newest row per key. A commit names the folder of each bucket and the batches it was made of.

    An update reads and writes only the buckets its keys fall into, and counts once its commit is
    published; of two writers the slower merges again with what the faster has published. Readers open the
    folders of one commit, one per bucket at most, whatever the number of batches. Order decides as in
    ``latest_per_key``: by ``newest_by``, then by batch name, then by ``tie_break``.

    The number of buckets is set when a table is first written; a later one is not changed by the argument.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType | str,
        key: str | Sequence[str],
        newest_by: Sequence[str] = (),
        tie_break: Sequence[str] = (),
        buckets: int = BUCKETS,
    ):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.schema = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        self.key, self.newest_by, self.tie_break = key, list(newest_by), list(tie_break)
        self.log = CommitLog(spark, f"{path}/commits")

    def _stored(self, files: dict[str, str]) -> DataFrame:
        extra = [("batch_id", T.StringType()), ("commit", T.StringType()), ("bucket", T.IntegerType())]
        full = T.StructType([*self.schema.fields, *[T.StructField(n, t) for n, t in extra]])
        if not files:
            return self.spark.createDataFrame([], full).drop("commit")
        base = f"{self.path}/files"
        paths = [f"{base}/commit={commit}/bucket={bucket}" for bucket, commit in sorted(files.items())]
        return self.spark.read.schema(full).option("basePath", base).parquet(*paths).drop("commit")

    def update(self, df: DataFrame, batch_id: str) -> None:
        """Matched keys change, new keys are added. A batch that has been merged is not merged again."""
        keys = [self.key] if isinstance(self.key, str) else list(self.key)
        newest = latest_per_key(df.select(*self.schema.names), self.key, self.newest_by or self.tie_break, self.tie_break)
        number_of = self.log.newest()[1].get("buckets", self.buckets)
        bucket = F.pmod(F.xxhash64(*keys), F.lit(number_of)).cast("int")
        batch = settle(newest.withColumns({"batch_id": F.lit(batch_id), "bucket": bucket}), "upsert")
        touched = [str(r.bucket) for r in batch.select("bucket").distinct().collect()]  # one per bucket at most

        def build(number: int, state: dict[str, Any]) -> dict[str, Any] | None:
            if batch_id in state.get("batches", []):
                return None
            if state.get("buckets", number_of) != number_of:
                raise ValueError(f"{self.path} was first written with {state['buckets']} buckets")
            files = dict(state.get("files", {}))
            name = f"{number:09d}-{uuid.uuid4().hex[:8]}"
            if touched:
                before = self._stored({b: f for b, f in files.items() if b in touched})
                merged = latest_per_key(before.unionByName(batch), self.key, [*self.newest_by, "batch_id"], self.tie_break)
                merged.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/files/commit={name}")
            files |= {b: name for b in touched}
            return {"buckets": number_of, "files": files, "batches": [*state.get("batches", []), batch_id][-REMEMBERED:]}

        self.log.change(build)

    def versions(self) -> DataFrame:
        """The current rows with the batch each came from."""
        return self._stored(self.log.newest()[1].get("files", {})).drop("bucket")

    def read(self, with_batch: bool = False) -> DataFrame:
        return self.versions() if with_batch else self.versions().drop("batch_id")

    def batches(self) -> list[str]:
        """Names of the last batches."""
        return self.log.newest()[1].get("batches", [])

    def stale(self) -> list[str]:
        """Folders of earlier commits that the newest one does not name."""
        named = set(self.log.newest()[1].get("files", {}).values())
        folders = [n.removeprefix("commit=") for n in child_names(self.spark, f"{self.path}/files")]
        newest = self.log.newest()[0]
        return [f for f in folders if f not in named and int(f.split("-")[0]) <= newest]

    def vacuum(self) -> None:
        """Remove stale folders. Whoever still reads an earlier commit loses its files."""
        for folder in self.stale():
            remove(self.spark, f"{self.path}/files/commit={folder}")
