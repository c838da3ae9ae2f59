"""K1, K2, K5-K7: where model results are stored and how they are replaced.

A stored table is a folder of versions, ``<table>/v=<millis>-<id>/``.  A full
rebuild (K1) writes a new version folder; readers take the newest version
whose Spark job committed (it holds ``_SUCCESS``), so a reader never sees a
half-written table and a failed or killed job leaves the old version in
place.  An append (K2) adds files to the current version in one committed
Spark job.  Concurrent writers to one table are out of scope (plain Parquet
has no transaction log).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

VERSION_PREFIX = "v="
#: How long a replaced version stays for readers that have opened it.
RETAIN_SECONDS = 6 * 3600.0


def target_db(default_db: str, custom: str | None = None) -> str:
    """K7: the model's own database name, taken verbatim (trimmed), else the default."""
    return default_db if custom is None or not custom.strip() else custom.strip()


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def committed_versions(spark: SparkSession, table_path: str) -> list[str]:
    """Version folders of a table that finished writing, oldest first."""
    fs, root = _fs(spark, table_path)
    if not fs.exists(root):
        return []
    jvm = spark.sparkContext._jvm
    out = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(VERSION_PREFIX) and \
                fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            out.append(status.getPath().toString())
    return sorted(out, key=lambda p: p.rsplit("/", 1)[-1])


def current_version(spark: SparkSession, table_path: str) -> str | None:
    versions = committed_versions(spark, table_path)
    return versions[-1] if versions else None


def table_exists(spark: SparkSession, table_path: str) -> bool:
    """K3: whether a committed version exists (first run = full build otherwise)."""
    return current_version(spark, table_path) is not None


def publish(df: DataFrame, name: str, default_db: str, custom_db: str | None = None,
            sort_cols: Sequence[str] | None = None, location: str | None = None) -> str:
    """K7: store a model as ``database.name`` in Spark's own catalog; returns the table name.

    The rows go to a new version folder below ``location`` (default: below the
    database's own); then the table is pointed at it, so readers see the old
    rows until all new ones are there, and those who read on keep their files.
    """
    spark = df.sparkSession
    db = target_db(default_db, custom_db)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    home = location or f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/_{name}"
    version = write_table(df, home, sort_cols, range_partition=True)
    table = f"`{db}`.`{name}`"
    if spark.catalog.tableExists(f"{db}.{name}"):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(f"{db}.{name}", path=version, source="parquet", schema=df.schema)
    return f"{db}.{name}"


def read_table(spark: SparkSession, table_path: str) -> DataFrame:
    """Read the current committed version of a stored table."""
    version = current_version(spark, table_path)
    if version is None:
        raise FileNotFoundError(f"no committed version under {table_path}")
    return spark.read.parquet(version)


def _clustered(df: DataFrame, sort_cols: Sequence[str] | None, range_partition: bool) -> DataFrame:
    """K5: the stored sort key (Parquet min/max pruning), not part of the result."""
    if not sort_cols:
        return df
    if range_partition:
        df = df.repartitionByRange(*sort_cols)
    return df.sortWithinPartitions(*sort_cols)


def write_table(df: DataFrame, table_path: str, sort_cols: Sequence[str] | None = None,
                partition_by: Sequence[str] | None = None, range_partition: bool = False,
                retain_seconds: float = RETAIN_SECONDS) -> str:
    """K1: full rebuild into a new version folder.

    A version that was replaced longer than ``retain_seconds`` ago is removed
    afterwards; readers that opened an older one in that time keep its files.
    """
    spark = df.sparkSession
    version = f"{table_path.rstrip('/')}/{VERSION_PREFIX}{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
    writer = _clustered(df, sort_cols, range_partition).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(version)
    _prune(spark, table_path, retain_seconds)
    return version


def append_table(df: DataFrame, table_path: str, sort_cols: Sequence[str] | None = None,
                 partition_by: Sequence[str] | None = None) -> str:
    """K2: add rows to the current version (one committed job)."""
    spark = df.sparkSession
    version = current_version(spark, table_path)
    if version is None:
        return write_table(df, table_path, sort_cols, partition_by)
    writer = _clustered(df, sort_cols, False).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(version)
    return version


def partition_values(spark: SparkSession, folder: str, column: str) -> list[str]:
    """Values of a ``column=value`` partition level directly under ``folder``."""
    fs, root = _fs(spark, folder)
    prefix = f"{column}="
    return sorted(st.getPath().getName()[len(prefix):] for st in fs.listStatus(root)
                  if st.isDirectory() and st.getPath().getName().startswith(prefix))


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file (its name carries the information)."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder; 0 when it is not there."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def list_names(spark: SparkSession, folder: str) -> list[str]:
    fs, root = _fs(spark, folder)
    if not fs.exists(root):
        return []
    return [st.getPath().getName() for st in fs.listStatus(root)]


def _prune(spark: SparkSession, table_path: str, retain_seconds: float) -> None:
    versions = committed_versions(spark, table_path)
    oldest = (time.time() - retain_seconds) * 1000
    for old, successor in zip(versions, versions[1:]):
        replaced = int(successor.rsplit("/", 1)[-1][len(VERSION_PREFIX):].split("-")[0])
        if replaced < oldest:
            fs, p = _fs(spark, old)
            fs.delete(p, True)
