"""Folders for intermediate tables, in the place that driver and executors share."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_watched: list = []


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir. Only a local session, such as a test's, may go without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/tickloom-{uuid.uuid4().hex}"
    for made in _watched:
        made.append(path)
    return path


def kept(df: DataFrame, *by: str, **options: str) -> DataFrame:
    """df as read again from a table in a scratch folder, in folders of `by` if given: later steps start from the same rows, whatever is computed anew."""
    path = scratch_dir(df.sparkSession)
    df.write.partitionBy(*by).options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Each write inside deletes its shuffle files when it ends; they would else lie there until the driver's JVM collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, True)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def watch():
    """The folders that scratch_dir gives out inside, as a list."""
    made: list = []
    _watched.append(made)
    try:
        yield made
    finally:
        _watched.remove(made)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders through Hadoop's file systems, whatever store they are in."""
    sc = spark.sparkContext
    for p in paths:
        path = sc._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a file within a store, over one that is there; the store's own rename, so no byte passes the driver."""
    sc = spark.sparkContext
    a, b = (sc._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = b.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    fs.delete(b, False)
    if not fs.rename(a, b):
        raise OSError(f"{source} could not be moved to {target}")
