"""Session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the local bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sparkaudit")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a session whose driver and tasks are one process may do without that setting: it
    gets a folder of its machine. On a cluster other executors would not see such files,
    so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _local_root()
    return os.path.join(root, "sparkaudit", f"{purpose}-{uuid.uuid4().hex[:12]}")


@lru_cache(maxsize=1)
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="sparkaudit-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def write_work(
    df: DataFrame, table: str | None = None, by: str | None = None, buckets: tuple[int, str] | None = None, options: dict | None = None
) -> str:
    """The rows written once in the shared folder, in a folder for each value of ``by`` if given; it goes when the driver ends.

    With ``buckets`` (number, column) the rows are bucketed, and ``table`` names them in the
    session's catalog, so that a join on the column does not shuffle them again.
    """
    spark = df.sparkSession
    folder = work_folder(spark, "table")
    writer = df.write.options(**options or {})
    writer = writer.partitionBy(by) if by else writer
    if buckets:
        writer.bucketBy(*buckets).option("path", folder).saveAsTable(table)
    else:
        writer.parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(path)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a table written once in the shared folder.

    For tables that many steps read: later plans start from the files, which outlive any
    executor. The folder goes when the driver ends.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_work(df))


def written(tables: list[DataFrame]) -> DataFrame:
    """The rows of some tables of ``cut_lineage`` with the same columns, as one table."""
    folders = {os.path.dirname(file) for table in tables for file in table.inputFiles()}
    return tables[0].sparkSession.read.schema(tables[0].schema).parquet(*sorted(folders))


def release(df: DataFrame) -> None:
    """Deletes a table of ``cut_lineage``, or of ``written``, that no later step reads."""
    spark = df.sparkSession
    for name in sorted({os.path.dirname(file) for file in df.inputFiles()}):
        folder = spark._jvm.org.apache.hadoop.fs.Path(name)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of each step inside go when the step ends, for steps that write or collect what they make."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def small_batches(spark: SparkSession, most: int = 4_000_000):
    """Arrow batches of at most ``most`` bytes in the steps inside: a batch is held in workers and in the JVM outside its heap."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    held = before.rstrip("bB")
    if not held.isdigit() or int(held) > most:
        spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)
