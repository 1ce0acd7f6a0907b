"""The folder that all executors can read and write, and files kept in it for one application."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; without it, one in the warehouse.

    Both are places that the driver and all executors share. A warehouse on the driver's
    own disk is such a place only if the executors run there, too.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        local = warehouse.startswith("file:") or ":" not in warehouse
        if local and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"{warehouse}/_stages"
    return folder.rstrip("/")


def make_folder(spark: SparkSession, path: str, temporary: bool = False) -> str:
    """Create a folder if it is not there; a temporary one goes when the driver ends."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(hadoop)
    if temporary:
        files.deleteOnExit(hadoop)
    return path


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for this application's files, removed when its driver ends."""
    path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    return make_folder(spark, path, temporary=True)


@contextmanager
def _shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it has ended."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what follows neither repeats the work nor sees other values when
    executors are lost. Columnar files let each reader take only the columns it needs.
    The shuffle files that led there are not needed any more and go at once.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, purpose)
    with _shuffles_cleared(spark):
        df.write.mode("overwrite").parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def discard(*staged: DataFrame) -> None:
    """Delete the files of staged rows that nothing will read again."""
    for df in staged:
        hadoop = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        files = hadoop.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
        files.delete(hadoop, True)
