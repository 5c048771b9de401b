"""Resolution jobs with a ledger: every run says what it started, what it finished, how many rows it linked and why it failed.

A run takes all planned windows at once: one resolution over their rows, its count split back by window. Its number names everything it
writes, and the marker of its last ledger folder is the commit: a reader that asks the ledger sees whole runs only. A run that was lost in
between is repeated under its number before anything new is planned, reads what the first attempt read and overwrites what that left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators.jobs import plan_jobs
from kinweave.operators.resolution import pending_raw
from kinweave.plans.asof import last_before, micros
from kinweave.plans.storage import materialize
from kinweave.streaming.resolve import ResolutionStore, resolve_batch
from kinweave.streaming.store import append_upserts, table_exists

WINDOW = ["tenant_id", "data_from_datetime", "data_to_datetime"]
SCHEMA = ("tenant_id string, data_from_datetime timestamp_ntz, data_to_datetime timestamp_ntz, job_status string, processed_count long, "
          "job_started_at timestamp_ntz, job_completed_at timestamp_ntz, error_message string")
STARTED, ENDED = 0, 1
LONGEST_ERROR = 1000


class RunLedger:
    """One folder per run and step; the newest step of a run is its state."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _log(self) -> DataFrame:
        if not table_exists(self.spark, self.path):
            return self.spark.createDataFrame([], f"{SCHEMA}, run long, step long")
        return self.spark.read.option("basePath", self.path).option("recursiveFileLookup", "false").parquet(self.path).select(
            *[f.split()[0] for f in SCHEMA.split(", ")], F.col("run").cast("long").alias("run"), F.col("batch").cast("long").alias("step"))

    def rows(self) -> DataFrame:
        """Newest state of every run and window."""
        log = self._log()
        return log.groupBy("run", *WINDOW).agg(F.max_by(F.struct(*[c for c in log.columns if c not in ("run", *WINDOW)]), "step").alias("s")).select(
            "run", *WINDOW, "s.*").drop("step")

    def lost(self) -> list[int]:
        """Runs that started and never ended."""
        per_run = self._log().groupBy("run").agg(F.max("step").alias("step")).where(F.col("step") == STARTED)
        return [r.run for r in per_run.orderBy("run").collect()]

    def committed(self) -> int:
        """The first run number that is not committed: what a reader passes as ``before``."""
        done = self._log().where((F.col("step") == ENDED) & (F.col("job_status") == "success")).agg(F.max("run").alias("r")).first().r
        return 0 if done is None else done + 1

    def following(self) -> int:
        last = self._log().agg(F.max("run").alias("r")).first().r
        return 0 if last is None else last + 1

    def windows(self, run: int) -> DataFrame:
        return self._log().where((F.col("run") == run) & (F.col("step") == STARTED)).select(*WINDOW, "job_started_at")

    def start(self, run: int, windows: DataFrame, at: str) -> None:
        rows = windows.select(*WINDOW, F.lit("processing").alias("job_status"), F.lit(None).cast("long").alias("processed_count"),
                              F.lit(at).cast("timestamp_ntz").alias("job_started_at"), F.lit(None).cast("timestamp_ntz").alias("job_completed_at"),
                              F.lit(None).cast("string").alias("error_message"))
        append_upserts(rows.coalesce(1), f"{self.path}/run={run}", STARTED)

    def end(self, run: int, counts: DataFrame, status: str, at: str, error: str | None = None) -> None:
        """``counts``: windows with ``processed_count``. The write's marker commits the run."""
        rows = self.windows(run).join(counts.select(*WINDOW, "processed_count"), WINDOW, "left").select(
            *WINDOW, F.lit(status).alias("job_status"), F.coalesce("processed_count", F.lit(0)).alias("processed_count"), "job_started_at",
            F.lit(at).cast("timestamp_ntz").alias("job_completed_at"), F.lit(error).cast("string").alias("error_message"))
        append_upserts(rows.coalesce(1), f"{self.path}/run={run}", ENDED)


def rows_in_windows(raw: DataFrame, windows: DataFrame) -> DataFrame:
    """``raw`` with the window [from, to) of its tenant that a row was received in; rows in none are left out. Windows do not overlap."""
    marks = windows.select("tenant_id", micros("data_from_datetime").alias("at"), F.lit(0).alias("tie"),
                           F.struct(*WINDOW[1:]).alias("value"))
    points = raw.select("raw_profile_id", "tenant_id", micros("received_at").alias("at"))
    met = last_before(points, marks, "tenant_id", "raw_profile_id", bucket_seconds=3600).select(
        "raw_profile_id", "value.*").where("data_from_datetime is not null")
    return raw.join(met, "raw_profile_id").where(F.col("received_at") < F.col("data_to_datetime"))


def _execute(ledger: RunLedger, store: ResolutionStore, raw: DataFrame, run: int, at: str) -> None:
    windows = ledger.windows(run)
    try:
        rows = materialize(rows_in_windows(raw, windows))
        todo = pending_raw(rows, store.links(run))
        counts = materialize(todo.groupBy(*WINDOW).agg(F.count("*").alias("processed_count")))
        resolve_batch(store, rows.select(*raw.columns), run, look_back_minutes=None)
    except Exception as e:
        ledger.end(run, windows.withColumn("processed_count", F.lit(0).cast("long")), "failed", at, f"{type(e).__name__}: {e}"[:LONGEST_ERROR])
        raise
    ledger.end(run, counts, "success", at)


def run_planned(ledger: RunLedger, store: ResolutionStore, raw: DataFrame, windows: DataFrame, at: str) -> int | None:
    """Repeat lost runs, then resolve the windows that the ledger has no successful or running entry for; the new run's number, if any.

    A failed run raises after it was recorded; its windows are planned again next time.
    """
    for run in ledger.lost():
        _execute(ledger, store, raw, run, at)
    planned = plan_jobs(ledger.rows(), windows.select(*WINDOW).distinct())
    if planned.isEmpty():
        return None
    run = ledger.following()
    ledger.start(run, planned, at)
    _execute(ledger, store, raw, run, at)
    return run
