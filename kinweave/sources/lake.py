"""Raw event lake, time partitions and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich_ingest(df: DataFrame, as_of: str, ts: str = "datetime") -> DataFrame:
    """Server-side fields: ingestion time and event date."""
    return df.withColumn("ingested_at", F.lit(as_of).cast("timestamp_ntz")).withColumn(
        "event_date", F.to_date(F.col(ts)))


def write_event_lake(df: DataFrame, path: str, mode: str = "append") -> None:
    """Keep every event, partitioned by date and type.

    Rows are rebalanced by partition: small ones are written by one task, and a busy day and type is split by its size.
    """
    spread = df.hint("rebalance", "event_date", "event_type")
    spread.write.mode(mode).partitionBy("event_date", "event_type").parquet(path)


def hour_partition(df: DataFrame, ts: str) -> DataFrame:
    """Hour start and partition name of a row."""
    hour = F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")
    return df.withColumn("hour_start", hour).withColumn("hour_partition", F.date_format(hour, "yyyyMMdd_HH"))


def retention_filter(df: DataFrame, ts: str, keep_days: int, as_of: str) -> DataFrame:
    """Keep whole hour partitions younger than the limit; the literal bound is pushed into the scan.

    A row's hour starts at or after the bound exactly when the row does not lie before the next full hour.
    """
    bound = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(keep_days))
    floor = F.date_trunc("hour", bound).cast("timestamp_ntz")
    first = F.when(floor < bound, floor + F.make_dt_interval(F.lit(0), F.lit(1))).otherwise(floor)
    return df.where(F.col(ts) >= first)


def export_segment(df: DataFrame, path: str, fmt: str = "csv") -> None:
    writer = df.write.mode("overwrite")
    (writer.option("header", "true") if fmt == "csv" else writer).format(fmt).save(path)
