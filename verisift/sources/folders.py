"""The folder that driver and executors share, and intermediate tables in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders that stored has written and nobody has removed.
STORED: dict[str, None] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Where that is unset, a session on one machine gets a new local folder; on a
    cluster it is an error, as executors would write to disks of their own.
    """
    context = spark.sparkContext
    at = context.getCheckpointDir()
    if at:
        return at
    named = context.getConf().get("spark.checkpoint.dir")
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="checkpoints-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: its lineage ends there and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    STORED[path] = None
    out._stored_at = path
    return out


def forget(table: DataFrame | SparkSession) -> None:
    """Removes a table that ``stored`` has written, or, given a session, all of them. Nothing may read them any more."""
    spark = table if isinstance(table, SparkSession) else table.sparkSession
    for path in list(STORED) if isinstance(table, SparkSession) else [table._stored_at]:
        remove(spark, path)
        STORED.pop(path, None)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
