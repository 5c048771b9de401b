"""Cutting lineage with tables written to the shared folder of the cluster.

A written Parquet table survives the loss of any executor, keeps exact sizes for the optimizer and can be column-pruned,
so every iterative job here stores its rounds this way.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Fixed value: Spark's setting for removing the shuffle files of a finished query.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Fixed value: Spark's setting for the longest generated method; a longer one runs as several operators.
LONGEST_METHOD = "spark.sql.codegen.hugeMethodLimit"
#: The JVM never compiles a method of more bytes than this, so Spark's own limit of 65535 leaves wide rows to its interpreter.
COMPILED_BYTES = "8000"

#: Fixed value: Spark's setting for the bytes of files that one task reads.
TASK_BYTES = "spark.sql.files.maxPartitionBytes"
#: Parsed documents are more than ten times as large in memory as in compressed files, so a task takes less than Spark's own 128 MB of them.
DOCUMENT_BYTES = 32 * 1024 * 1024

#: Fixed value: Spark's setting for the rows that a Python function gets at once.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of whole texts at once: JVM and Python worker each hold a batch of them, in buffers twice as large.
TEXT_ROWS = 1_000

_local_dirs: dict[str, str] = {}


def working_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``; a temporary folder only in a single JVM, as in tests."""
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return f"{configured.rstrip('/')}/kinweave-{app}"
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="kinweave-")
    return _local_dirs[app]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside remove their shuffle files at once, not when the driver happens to collect garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


@contextmanager
def methods_compiled(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside generate only methods that the JVM compiles."""
    before = spark.conf.get(LONGEST_METHOD, "65535")
    spark.conf.set(LONGEST_METHOD, COMPILED_BYTES)
    try:
        yield
    finally:
        spark.conf.set(LONGEST_METHOD, before)


@contextmanager
def documents_split(spark: SparkSession) -> Iterator[None]:
    """Queries and micro-batches that run inside read files of documents in parts small enough to be held parsed; a smaller setting stays."""
    before = spark.conf.get(TASK_BYTES)
    given = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(TASK_BYTES, str(min(given, DOCUMENT_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(TASK_BYTES, before)


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside hand texts to Python in small batches; a smaller setting stays."""
    before = spark.conf.get(BATCH_ROWS)
    given = int(before)
    spark.conf.set(BATCH_ROWS, str(min(given, TEXT_ROWS) if given > 0 else TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def new_path(spark: SparkSession) -> str:
    return f"{working_dir(spark)}/{uuid.uuid4().hex}"


def appended(df: DataFrame, path: str, *partitions: str) -> DataFrame:
    """Add rows to the table at a path of ``new_path`` and read the table, in folders by the columns given."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode("append").partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replaced(df: DataFrame, path: str) -> DataFrame:
    """Write a DataFrame in place of the table at a path of ``new_path``, which it must not read, and read it back."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Write a DataFrame once and read it back."""
    path = new_path(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
