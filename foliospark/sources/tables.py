"""Reading tables, staging intermediate ones in shared storage, and checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side above this many bytes (by the optimizer's estimate) is never hinted for broadcast.
BROADCAST_LIMIT_BYTES = 8 << 20

_staged: set[str] = set()
_own: list[str] = []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table `name` of `folder`."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a frame's size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast only where the estimate is within `limit`; beyond it the join shuffles."""
    return F.broadcast(df) if plan_bytes(df) <= limit else df


def spread(df: DataFrame, rows: int) -> DataFrame:
    """The frame in tasks of about `rows` rows each, for rows that are small themselves but name much work, such as paths to be read.

    The number of tasks is given, else adaptive execution would put such rows into few tasks by their bytes.
    Counts the frame, so it should be a staged or a cheap one.
    """
    return df.repartition(max(1, -(-df.count() // rows)))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir, or a temporary one where that is unset and Spark runs in one process (tests)."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="foliospark-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return _own[0]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, removed when the session's process ends."""
    path = f"{shared_folder(spark)}/foliospark/{name}-{uuid.uuid4().hex}"
    if not _staged:
        atexit.register(_drop_all, spark)
    _staged.add(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged folder through the file system that holds it."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _staged.discard(path)


def _drop_all(spark: SparkSession) -> None:
    for path in list(_staged):
        try:
            remove(spark, path)
        except Exception:  # the session may be gone already
            return


def stage(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage, so a lost executor re-reads the written table and repeats no earlier stage;
    used where a frame feeds several branches.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
