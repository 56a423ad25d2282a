"""Tables staged in the shared folder the session names."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only where neither that setting nor a checkpoint folder exists (tests on one machine) is a
    temporary folder created and set for the session. On a cluster that is an error: every executor
    would write to its own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textmill-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and return the table read back.

    This cuts the lineage and survives lost executors; unlike a row checkpoint, later jobs read
    only the columns they use.
    """
    path = path or stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a staged table that no later job reads."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    file_system(spark, path).delete(hadoop_path, True)


def file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


#: Spark removes the shuffle files of a query at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Bytes of the Arrow batches that go to Python.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def _held(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_dropped(spark: SparkSession):
    """Queries that run inside leave no shuffle files, so a loop of many steps holds those of one step.
    Meant for tables that are staged at once: a DataFrame that runs again would shuffle again."""
    return _held(spark, SHUFFLE_CLEANUP, "true")


def small_batches(spark: SparkSession):
    """Queries that run inside hand wide rows to Python in batches of about 8 MB: a task holds a batch several
    times, in the JVM and in its worker."""
    return _held(spark, BATCH_BYTES, "8m")
