"""Event-time windows and duplicate removal on streams, with state that the watermark bounds.

Spark's own operators keep the state (RocksDB store), so it holds the open windows or the keys of the last ``lateness`` only. What they drop as
too late is not lost: each job's query also carries the rows of the micro-batch themselves, ``foreachBatch`` sees which of them the state did
not take, and puts those into a side table. Readers merge the side table. A replayed batch overwrites its own folders.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.streaming.store import append_upserts, table_exists

LATENESS = "180 minutes"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB: off the heap, and uploaded as changes."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def start_batches(stream: DataFrame, handle, path: str, mode: str, trigger: dict | None, several: bool = True):
    """Run ``handle(batch, batch_id)`` on every micro-batch, which is kept while it is read ``several`` times."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if not several:
            return handle(batch, batch_id)
        batch.persist()
        try:
            handle(batch, batch_id)
        finally:
            batch.unpersist()

    with rocksdb_state(stream.sparkSession):
        return stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(
            **(trigger or {"availableNow": True})).foreachBatch(run).start()


def _newest_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The newest time (microseconds) of all earlier micro-batches: each one's folder holds the maximum so far, so one is read."""
    at = f"{path}/newest/batch={batch_id - 1}"
    return spark.read.parquet(at).first().newest if batch_id and table_exists(spark, at) else None


def start_dedup(events: DataFrame, ts: str, path: str, key: str = "event_id", lateness: str = LATENESS, trigger: dict | None = None):
    """Log the first copy of each key; ``first_copies`` reads it.

    A copy in time meets its key in the state. One that comes later than the watermark, or has no time, goes to the side table and is compared with
    the log when it is read. Copies whose times lie further apart than the lateness are events of their own.
    """
    columns = events.columns
    first = events.where(F.col(ts).isNotNull()).withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key])
    both = first.select(F.lit(True).alias("first"), F.struct(*columns).alias("row")).unionByName(
        events.select(F.lit(False).alias("first"), F.struct(*columns).alias("row")))

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, time = batch.sparkSession, F.unix_micros(F.col(f"row.{ts}").cast("timestamp"))
        before = _newest_before(spark, path, batch_id)
        newest = batch.agg(F.greatest(F.max(time), F.lit(before).cast("long")).alias("newest"))
        append_upserts(newest, f"{path}/newest", batch_id)
        append_upserts(batch.where("first").select("row.*"), f"{path}/on_time", batch_id)
        # At least what the state drops: its watermark is never ahead of the newest time of earlier batches.
        floor = F.lit(before).cast("long") - F.expr(f"unix_micros(timestamp '1970-01-01 00:00:00 UTC' + INTERVAL {lateness})")
        late = batch.where(~F.col("first") & (time.isNull() | F.coalesce(time <= floor, F.lit(False))))
        chosen = late.groupBy(F.col(f"row.{key}").alias("key")).agg(F.min("row").alias("row"))
        append_upserts(chosen.select("row.*"), f"{path}/late", batch_id)

    return start_batches(both, handle, path, "append", trigger)


def _parts(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}")


def first_copies(spark: SparkSession, path: str, key: str = "event_id") -> DataFrame:
    """One row per key. The log is read as it is; only late rows are grouped and looked up."""
    on_time, late = _parts(spark, path, "on_time").drop("batch"), _parts(spark, path, "late")
    rows = late.groupBy(F.col(key).alias("_key")).agg(F.min(F.struct("batch", F.struct(*on_time.columns).alias("row"))).alias("_first"))
    known = on_time.select(F.col(key).alias("_known")).join(rows.select("_key"), F.col("_known").eqNullSafe(F.col("_key")), "left_semi").distinct()
    new = rows.join(known, F.col("_key").eqNullSafe(F.col("_known")), "left_anti").select("_first.row.*")
    return on_time.unionByName(new)


def start_windowed_counts(events: DataFrame, ts: str, size: str, path: str, slide: str | None = None, lateness: str = LATENESS,
                          by: list[str] | None = None, trigger: dict | None = None):
    """Count rows per tumbling or sliding window (and further columns); ``windowed_counts`` reads the counts.

    Every micro-batch logs the new counts of the windows it changed. Rows of windows that the watermark has closed change no state; their
    number per window is logged as a correction. Rows without a time are in no window.
    """
    by = by or []
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    counted = events.withWatermark(ts, lateness).groupBy(window.alias("w"), *by).agg(F.count("*").alias("rows")).select(
        F.lit(True).alias("counted"), F.col("w.start").alias("window_start"), *by, "rows")
    seen = events.select(window.alias("w"), *by).select(
        F.lit(False).alias("counted"), F.col("w.start").alias("window_start"), *by, F.lit(1).cast("long").alias("rows"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        # A closed window takes none of a batch's rows, an open one all of them, and then its count is put out.
        per_window = batch.groupBy("window_start", *by).agg(
            F.max(F.when(F.col("counted"), F.col("rows"))).alias("rows"), F.sum(F.when(~F.col("counted"), F.col("rows"))).alias("seen"))
        append_upserts(per_window.where("rows is not null").drop("seen"), f"{path}/counts", batch_id)
        append_upserts(per_window.where("rows is null").select("window_start", *by, F.col("seen").alias("rows")), f"{path}/late", batch_id)

    return start_batches(counted.unionByName(seen), handle, path, "update", trigger)


def windowed_counts(spark: SparkSession, path: str, by: list[str] | None = None) -> DataFrame:
    """Rows per window so far: the newest count of each plus the corrections; open windows are included."""
    key = ["window_start", *(by or [])]
    newest = _parts(spark, path, "counts").groupBy(*key).agg(F.max_by("rows", "batch").alias("rows"))
    late = _parts(spark, path, "late").groupBy(*key).agg(F.sum("rows").alias("rows"))
    return newest.unionByName(late).groupBy(*key).agg(F.sum("rows").alias("rows"))
