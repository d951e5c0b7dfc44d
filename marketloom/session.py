"""Session helpers: the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster its absence is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _local_folders.setdefault(context.applicationId, tempfile.mkdtemp(prefix="marketloom-"))
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def frugal_session(spark: SparkSession) -> SparkSession:
    """A session of its own that needs little disk, for queries that run once.

    Shuffle files go when the query that wrote them ends, not when the driver happens to collect its garbage: a DataFrame that
    is run twice is computed twice. Stored tables are compressed more. Partitions are small, and where those of one side of a
    join are, rows of the other side need not be sorted. Their number is that of the given session.
    """
    own = spark.newSession()
    for name, value in {
        "shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions"),
        "classic.shuffleDependency.fileCleanup.enabled": "true", "parquet.compression.codec": "zstd",
        "adaptive.advisoryPartitionSizeInBytes": "16m", "adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
    }.items():
        own.conf.set(f"spark.sql.{name}", value)
    return own


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` is read from, all their columns."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))


def side_by_side(run: Callable, items: Iterable) -> list:
    """``run`` of every item, each in a thread of its own: cores that one job leaves idle work for the others.

    Results come in the order of the items; the first error is raised once all have ended.
    """
    items = list(items)
    with ThreadPoolExecutor(max(1, len(items))) as pool:
        return list(pool.map(run, items))


_local_folders: dict[str, str] = {}
