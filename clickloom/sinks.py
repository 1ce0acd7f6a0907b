"""Writing tables, result texts and reports."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickloom.operators.recon import Reconciliation
from clickloom.sources.shared import make_folder

# Tables of a report; each dataset has a folder in each.
REPORT = ("audit", "missing_keys", "duplicate_keys", "field_to_field")

# Tables of a report that are written at the same time.
WRITERS = 4

# Field separator and null of the Hive default text layout.
FIELD_END, NULL_TEXT = "\x01", "\\N"


def _path(spark: SparkSession, folder: str):
    """A folder and its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _drop_others(spark: SparkSession, folder: str, prefix: str, names: set[str]) -> None:
    """Remove the folders below ``folder`` that start with ``prefix`` and are not among ``names``."""
    path, files = _path(spark, folder)
    if files.exists(path):
        for status in files.listStatus(path):
            name = status.getPath().getName()
            if status.isDirectory() and name.startswith(prefix) and name not in names:
                files.delete(status.getPath(), True)


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"describe table extended {table}").where("col_name = 'Location'").first()
    return described["data_type"]


def _create(spark: SparkSession, table: str, schema: StructType, partition_by: str | None, path: str) -> None:
    """A table over the files of a folder."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parted = f" partitioned by (`{partition_by}`)" if partition_by else ""
    escaped = path.replace("'", "\\'")
    make_folder(spark, path)
    spark.sql(f"create table if not exists {table} ({columns}) using parquet{parted} location '{escaped}'")
    if partition_by:
        spark.catalog.recoverPartitions(table)


def replace_table(
    df: DataFrame, table: str, partition_by: str | None = None, path: str | None = None
) -> None:
    """Create or replace a table with the rows of ``df``, in versions below ``path`` if given.

    All rows are first written to a folder of their own; then the table is pointed to it,
    in one step if its columns stay, and the earlier version's files go. If writing fails,
    the table is as it was. With ``partition_by``, rows are first gathered by partition
    value; a rebalance splits values too large for one file.
    """
    spark = df.sparkSession
    root = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_versions/{table}"
    version = f"version-{uuid.uuid4().hex}"
    if partition_by:
        df = df.hint("rebalance", partition_by)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    try:
        writer.parquet(f"{root}/{version}")
    except Exception:
        folder, files = _path(spark, f"{root}/{version}")
        files.delete(folder, True)
        raise
    same = spark.catalog.tableExists(table) and [
        (f.name, f.dataType) for f in spark.table(table).schema
    ] == [(f.name, f.dataType) for f in df.schema]
    if same and not partition_by and not _partitions(spark, table):
        spark.sql(f"alter table {table} set location '{root}/{version}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"drop table if exists {table}")
        _create(spark, table, df.schema, partition_by, f"{root}/{version}")
    _drop_others(spark, root, "version-", {version})


def read_files(spark: SparkSession, table: str) -> DataFrame:
    """Rows of a stored table, read from its files and not through the catalog."""
    return spark.read.schema(spark.table(table).schema).parquet(_location(spark, table))


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def append_result(result: DataFrame, table: str, path: str | None = None) -> None:
    """Put the rows of a task into a result table kept per ``task_id``.

    Rows of other tasks stay; those of the same task are replaced, so a task that runs
    again does not count twice. Different tasks may be written at the same time.
    """
    spark = result.sparkSession
    if not spark.catalog.tableExists(table):
        root = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}"
        _create(spark, table, result.schema, "task_id", root)
    columns = spark.table(table).columns
    _by_task(result.select(*columns), "task_id").parquet(_location(spark, table))
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def _by_task(result: DataFrame, column: str):
    """A writer that replaces the tasks it has rows of, whatever the session's mode is."""
    writer = result.write.mode("overwrite").partitionBy(column)
    return writer.option("partitionOverwriteMode", "dynamic")


def append_result_text(result: DataFrame, path: str) -> None:
    """Put the rows of a task into a folder of texts, in the layout of the recorded results.

    A row is a line: its fields in order, the task first, parted by ``\\x01``, nulls as
    ``\\N``. Each task has a folder; a task that is appended again replaces its lines, and
    tasks may be written at the same time. ``read_ratio_text`` reads the lines back.
    """
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in result.columns]
    lines = result.select(F.concat_ws(FIELD_END, *fields).alias("value"), F.col("task_id").alias("task"))
    _by_task(lines, "task").text(path)


def write_report(reports: Mapping[str, Reconciliation], path: str) -> None:
    """Write all results of every dataset below ``path``, in place of an earlier report.

    Tables other than ``audit`` differ in columns by dataset. Key counts are made once for
    all of them; the tables are independent jobs, of which several run at a time.
    """
    staged = {name: result.staged() for name, result in reports.items()}
    if not staged:
        return
    spark = next(iter(staged.values())).counts.sparkSession

    def write(table: str, name: str) -> None:
        results = getattr(staged[name], table)
        results.write.mode("overwrite").parquet(f"{path}/{table}/dataset={name}")

    with ThreadPoolExecutor(WRITERS) as pool:
        # The longest ones first.
        jobs = [(table, name) for table in reversed(REPORT) for name in staged]
        writing = [pool.submit(inheritable_thread_target(spark)(write), *job) for job in jobs]
        for job in writing:
            job.result()
    for table in REPORT:
        _drop_others(spark, f"{path}/{table}", "", {f"dataset={name}" for name in reports})


def read_report(spark: SparkSession, path: str, table: str, dataset: str) -> DataFrame:
    """One table of one dataset of a stored report."""
    return spark.read.parquet(f"{path}/{table}/dataset={dataset}")


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/audit").withColumn("dataset", F.col("dataset").cast("string"))
