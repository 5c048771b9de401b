"""A keyed table as an append-only log of upserts, one folder per micro-batch.

A micro-batch only writes its own rows, a replay overwrites its own folder, and readers take the newest row per key.
``compact`` folds the log. Where the table format supports MERGE, use ``DataFrame.mergeInto`` instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_upserts(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def current(spark: SparkSession, path: str, keys: list[str], schema, before: int | None = None) -> DataFrame:
    """Newest row per key; an empty table before the first batch. ``before`` leaves out that batch and later ones."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    log = spark.read.option("basePath", path).schema(_with_batch(schema)).parquet(path)
    if before is not None:
        log = log.where(F.col("batch") < before)
    columns = [c for c in log.columns if c != "batch"]
    return log.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.max_by(F.struct(*columns), F.col("batch")).alias("_row")).select("_row.*")


def compact(spark: SparkSession, path: str, keys: list[str], schema, target: str) -> None:
    """Write the folded log as batch 0 of a new table."""
    append_upserts(current(spark, path, keys, schema), target, 0)


def _with_batch(schema):
    from pyspark.sql import types as T
    return T.StructType([*schema.fields, T.StructField("batch", T.LongType())])


def table_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
