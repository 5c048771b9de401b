"""Resolution jobs: windows, ledger, backfill, comparison of runs, change feed, log pruning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.config import MASTER_ACTIVE, MASTER_TO_NOTIFY, RAW_PENDING
from kinweave.operators.resolution import Resolution, pending_raw, resolve_sequential, resolve_transitive

LOOK_BACK_MINUTES = 180


def ts(value):
    return F.lit(value).cast("timestamp_ntz")


def backlog_window(raw: DataFrame, links: DataFrame) -> DataFrame:
    """Trailing window ending one minute after the newest pending row; no row when nothing is pending."""
    newest = pending_raw(raw, links).agg(F.max("received_at").alias("latest")).where("latest is not null")
    end = F.col("latest") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))
    return newest.select((end - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(LOOK_BACK_MINUTES))).alias("from_ts"),
                         end.alias("to_ts"))


def plan_jobs(ledger: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows without a successful or running entry in the ledger."""
    key = ["tenant_id", "data_from_datetime", "data_to_datetime"]
    busy = ledger.where(F.col("job_status").isin("success", "processing")).select(*key).distinct()
    return windows.join(busy, key, "left_anti")


def ledger_row(spark, tenant: str, window: tuple[str, str], status: str, count: int | None, started: str, ended: str | None,
               error: str | None = None) -> DataFrame:
    schema = ("tenant_id string, data_from_datetime string, data_to_datetime string, job_status string, processed_count long,"
              " job_started_at string, job_completed_at string, error_message string")
    df = spark.createDataFrame([(tenant, *window, status, count, started, ended, error)], schema)
    for c in ("data_from_datetime", "data_to_datetime", "job_started_at", "job_completed_at"):
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def run_resolution(raw: DataFrame, masters: DataFrame | None, links: DataFrame | None, as_of: str,
                   from_ts: str | None = None, to_ts: str | None = None, cap: int | None = None,
                   mode: str = "sequential", **options) -> Resolution:
    """Resolve everything pending in a window as one set-based job; ``cap`` is the session limit of the caller."""
    todo = pending_raw(raw, links, from_ts, to_ts, cap)
    resolve = resolve_sequential if mode == "sequential" else resolve_transitive
    return resolve(todo, masters, as_of=as_of, **options)


def resolve_all_pending(raw: DataFrame, masters: DataFrame | None, links: DataFrame | None, as_of: str,
                        mode: str = "sequential", **options) -> Resolution:
    """Full sweep without bounds."""
    return run_resolution(raw, masters, links, as_of, mode=mode, **options)


def _in_backfill(rows: DataFrame, target: str, seconds: int, windows: int) -> DataFrame:
    """Rows with the contiguous window walking back from the target that they lie in; window i is [target-(i+1)s, target-i*s)."""
    age = F.timestamp_diff("MICROSECOND", F.col("received_at"), ts(target))
    index = F.ceil(age / F.lit(seconds * 1_000_000)) - 1
    inside = rows.where(F.col("received_at") < ts(target)).withColumn("window_index", index.cast("long"))
    return inside.where(F.col("window_index") < windows)


def backfill_windows(pending: DataFrame, target: str, seconds: int, windows: int) -> DataFrame:
    """Rows per window of a backfill."""
    return _in_backfill(pending, target, seconds, windows).groupBy("window_index").agg(F.count("*").alias("pending"))


def backfill(raw: DataFrame, masters: DataFrame | None, links: DataFrame | None, target: str, seconds: int, windows: int, as_of: str,
             mode: str = "sequential", **options) -> tuple[Resolution, DataFrame]:
    """Resolve what is pending in the windows walking back from the target, in one run over their union.

    Returns the resolution and (window_index, processed, new_masters, joined) per window that had pending rows.
    """
    todo = _in_backfill(pending_raw(raw, links), target, seconds, windows)
    resolve = resolve_sequential if mode == "sequential" else resolve_transitive
    res = resolve(todo.drop("window_index"), masters, as_of=as_of, **options)
    new = F.col("match_rule") == "NewMaster"
    counts = res.links.join(todo.select("raw_profile_id", "window_index"), "raw_profile_id").groupBy("window_index").agg(
        F.count("*").alias("processed"), F.count_if(new).alias("new_masters"), F.count_if(~new).alias("joined"))
    return res, counts


def diff_resolutions(a: DataFrame, b: DataFrame) -> DataFrame:
    """How two runs differ. Pair counts come from the sizes of (a, b) cells, never from pairs.

    together_*: row pairs sharing a master in the run; split: together in a only; merged: together in b only.
    """
    both = a.select("raw_profile_id", F.col("master_profile_id").alias("ma")).join(
        b.select("raw_profile_id", F.col("master_profile_id").alias("mb")), "raw_profile_id", "full_outer")
    cells = both.groupBy("ma", "mb").agg(F.count("*").alias("n"))
    pairs = lambda df, keep: df.where(keep).agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0)).alias("p"))
    in_a = pairs(cells.groupBy("ma").agg(F.sum("n").alias("n")), "ma is not null").withColumnRenamed("p", "together_a")
    in_b = pairs(cells.groupBy("mb").agg(F.sum("n").alias("n")), "mb is not null").withColumnRenamed("p", "together_b")
    same = pairs(cells, "ma is not null and mb is not null").withColumnRenamed("p", "together_both")
    only = cells.agg(F.coalesce(F.sum(F.when(F.col("mb").isNull(), F.col("n"))), F.lit(0)).alias("only_a"),
                     F.coalesce(F.sum(F.when(F.col("ma").isNull(), F.col("n"))), F.lit(0)).alias("only_b"))
    one = side_by_side([in_a, in_b, same, only])
    return one.withColumn("split", F.col("together_a") - F.col("together_both")).withColumn(
        "merged", F.col("together_b") - F.col("together_both"))


def side_by_side(parts: list[DataFrame]) -> DataFrame:
    """One row out of one-row tables: stacked, then folded column by column, so no join is needed."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def match_quality(links: DataFrame, truth: DataFrame) -> DataFrame:
    """Pairwise precision and recall against labelled identities (raw_profile_id, identity)."""
    cells = links.join(truth, "raw_profile_id").groupBy("master_profile_id", "identity").agg(F.count("*").alias("n"))
    total = lambda df, name: df.agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0)).alias(name))
    found = total(cells.groupBy("master_profile_id").agg(F.sum("n").alias("n")), "matched_pairs")
    real = total(cells.groupBy("identity").agg(F.sum("n").alias("n")), "true_pairs")
    out = side_by_side([found, real, total(cells, "correct_pairs")])
    return out.select(
        "matched_pairs", "true_pairs", "correct_pairs",
        (F.col("matched_pairs") - F.col("correct_pairs")).alias("false_merges"),
        (F.col("true_pairs") - F.col("correct_pairs")).alias("missed_merges"),
        F.round(F.try_divide("correct_pairs", "matched_pairs"), 6).alias("precision"),
        F.round(F.try_divide("correct_pairs", "true_pairs"), 6).alias("recall"))


def prune_job_log(log: DataFrame, as_of: str, hours: int = 12) -> tuple[DataFrame, DataFrame]:
    """Entries to keep, and the number that is removed (ended at or before the limit)."""
    bound = ts(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))
    old = F.coalesce(F.col("end_time") <= bound, F.lit(False))
    return log.where(~old), log.where(old).agg(F.count("*").alias("deleted"))


def drain_changed_profiles(masters: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Oldest masters to be notified, and the master table with these set active."""
    feed = masters.where(F.col("status_code") == MASTER_TO_NOTIFY).orderBy("updated_at", "master_profile_id").limit(
        limit).select("master_profile_id")
    flag = feed.withColumn("_sent", F.lit(True))
    updated = masters.join(flag, "master_profile_id", "left").withColumn(
        "status_code", F.when(F.col("_sent"), MASTER_ACTIVE).otherwise(F.col("status_code"))).drop("_sent")
    return feed, updated


def notification_feed(ids: DataFrame, masters: DataFrame) -> DataFrame:
    """One row per changed master and channel the person allows."""
    allowed = masters.join(ids.select("master_profile_id"), "master_profile_id", "left_semi").select(
        "master_profile_id", "email", "phone_number", F.explode("preferred_communication").alias("channel", "allowed"))
    return allowed.where(F.lower("allowed") == "true").drop("allowed")


def pending_count(raw: DataFrame, links: DataFrame, from_ts: str, to_ts: str) -> DataFrame:
    """Unlinked pending rows in the half-open window [from, to)."""
    todo = raw.where((F.col("status_code") == RAW_PENDING) & (F.col("received_at") >= ts(from_ts))
                     & (F.col("received_at") < ts(to_ts)))
    return todo.join(links.select("raw_profile_id"), "raw_profile_id", "left_anti").agg(F.count("*").alias("pending"))
