"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_root: dict[str, str] = {}


def build_session(app: str = "tidemark", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        _local_root[app] = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(_local_root[app] + "/checkpoint")
    return _local_root[app]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the shared root."""
    return f"{shared_root(spark)}/tidemark/{purpose}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, shuffle files go when the query that wrote them has ended, not when the driver happens to collect its garbage."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate result that several steps read, and go on from the written table.

    The work behind it then runs once, and a lost executor costs no more than rereading files.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
