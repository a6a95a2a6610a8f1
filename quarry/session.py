"""Session helpers: shared working folder and size limits."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Largest array of doubles (bytes) that may be copied to every executor. The
# operators measure a side before they broadcast it and take a shuffled plan
# beyond this bound. Set per session with ``quarry.broadcast.bytes``.
BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get("quarry.broadcast.bytes", str(BROADCAST_BYTES)))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where none is named, a local session gets a temporary folder that goes when Python
    ends; a cluster must name one, as its machines do not see each other's folders.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    folder = folder or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("name a folder that all machines share in spark.checkpoint.dir")
        folder = tempfile.mkdtemp(prefix="quarry-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return folder


def shared_path(spark: SparkSession, stem: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{stem}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


_MADE: list[str] = []


def release(spark: SparkSession) -> int:
    """Delete all working tables of this process; results not yet saved must not be read after."""
    gone = 0
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        gone += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def cut_lineage(df: DataFrame, stem: str = "step") -> DataFrame:
    """Write the rows to the shared folder and read them back.

    The result survives lost executors and its size statistics are those of the
    files, whereas a checkpoint in a loop of joins inherits the product of all
    estimates so far.
    """
    path = shared_path(df.sparkSession, stem)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Widen a scanned table before heavy work per row.

    A single unsplittable file is read by one task. Scans that already have a
    partition per core, as any large table does, pass through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


WORK_PER_TASK = 4_000_000


def spread_small(df: DataFrame, rows: int, width: int, work: int) -> DataFrame:
    """Split a table measured as small by the work per row; large ones are split already.

    ``work`` is the rough number of multiplications per row. Little work stays
    in one task, as starting a task costs more.
    """
    spark = df.sparkSession
    if rows * (width + 1) * 8 > broadcast_limit(spark):
        return df
    tasks = 1 + rows * work // WORK_PER_TASK
    return df.repartition(max(1, min(spark.sparkContext.defaultParallelism, tasks)))
