"""Stage tables: results many queries read again are written once to shared storage.

A stage table cuts the lineage, survives the loss of executors and is read back with column
pruning and row-group skipping. It lives in the folder the cluster names in spark.checkpoint.dir.
"""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a private folder only for a local session that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="attain-stage-")
    return _local[app]


def new_folder(spark: SparkSession) -> str:
    """A folder of its own for the stage tables of one model or run."""
    return f"{shared_folder(spark)}/attain-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Delete the stage tables of a model or run that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def store(df: DataFrame, name: str, sort_by: list[str] | None = None, folder: str | None = None, split: str | None = None) -> DataFrame:
    """Write and read back: the write runs now, while the query is still being put together.

    Sorting inside the partitions costs no shuffle and lets readers skip row groups. Rows of each value of the column
    split (of few values) go to folders of their own, and a reader of one value opens only its folder. What the write has
    shuffled is given back at once: Spark deletes it only when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = (df.sortWithinPartitions(*sort_by) if sort_by else df).write.option("compression", "zstd")
    (writer.partitionBy(split) if split else writer).parquet(path)
    release_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Have the files of finished shuffles deleted. Spark does so when the driver's garbage is collected; the first
    collection lets go of the plan, the second finds its shuffles."""
    for wait in (0.2, 0):
        spark.sparkContext._jvm.System.gc()
        time.sleep(wait)


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """Name, size and modification time of the files of a table, so that changed input is not mistaken for old."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(target))

