"""Time-ordered lookups per key without putting a key's whole history into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def micros(c):
    """Microseconds since 1970 of a timestamp without zone."""
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def last_before(points: DataFrame, marks: DataFrame, key: str, point_id: str, bucket_seconds: int = 60) -> DataFrame:
    """For each point the newest mark of its key at or before it.

    ``points``: key, ``point_id``, ``at`` (micros). ``marks``: key, ``at``, ``tie`` and ``value``; equal times are ordered
    by ``tie``. One row per key and time bucket carries the newest mark across buckets; inside a bucket a window compares
    rows of that bucket only.
    """
    width = bucket_seconds * 1_000_000
    mark = F.struct("at", "tie", "value")
    null_mark = F.lit(None).cast(marks.select(mark.alias("m")).schema["m"].dataType)
    rows = marks.select(key, "at", F.lit(0).alias("kind"), mark.alias("m"),
                        F.lit(None).cast(points.schema[point_id].dataType).alias(point_id)).unionByName(
        points.select(key, "at", F.lit(1).alias("kind"), null_mark.alias("m"), point_id))
    rows = rows.withColumn("bucket", F.floor(F.col("at") / width))
    newest = rows.groupBy(key, "bucket").agg(F.max("m").alias("bm"))
    earlier = W.partitionBy(key).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    newest = newest.select(key, "bucket", F.max("bm").over(earlier).alias("before"))
    inside = W.partitionBy(key, "bucket").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, 0)
    local = rows.withColumn("here", F.max("m").over(inside)).where("kind = 1")
    return local.join(newest, [key, "bucket"]).select(
        point_id, F.coalesce("here", "before")["value"].alias("value"))


def followed_within(rows: DataFrame, followers: DataFrame, key: str, window_seconds: int) -> DataFrame:
    """Rows plus ``followed``: is there a follower of the same key from ``at`` to ``at`` + window (both included)?

    With buckets as wide as the window only the newest follower of the own bucket and the oldest of the next one matter.
    """
    width = window_seconds * 1_000_000
    per = followers.groupBy(key, F.floor(F.col("at") / width).alias("bucket")).agg(
        F.min("at").alias("lo"), F.max("at").alias("hi"))
    marked = rows.withColumn("bucket", F.floor(F.col("at") / width))
    own = per.select(key, "bucket", "hi")
    following = per.select(key, (F.col("bucket") - 1).alias("bucket"), "lo")
    hit = F.coalesce(F.col("hi") >= F.col("at"), F.lit(False)) | F.coalesce(
        F.col("lo") <= F.col("at") + width, F.lit(False))
    return (
        marked.join(own, [key, "bucket"], "left").join(following, [key, "bucket"], "left")
        .withColumn("followed", hit).drop("bucket", "hi", "lo")
    )


def gap_sessions(events: DataFrame, key: str, gap_seconds: int) -> DataFrame:
    """Sessions split by idle gaps: (key, session_start, session_end, events), times in micros.

    Events of one gap-wide bucket always belong together, so they are combined before the shuffle; the window then sees at
    most one row per key and bucket.
    """
    gap = gap_seconds * 1_000_000
    per = events.groupBy(key, F.floor(F.col("at") / gap).alias("bucket")).agg(
        F.min("at").alias("lo"), F.max("at").alias("hi"), F.count("*").alias("n"))
    order = W.partitionBy(key).orderBy("bucket")
    fresh = F.when(F.col("lo") - F.lag("hi").over(order) >= gap, 1).when(F.lag("hi").over(order).isNull(), 1).otherwise(0)
    numbered = per.withColumn("fresh", fresh).withColumn("no", F.sum("fresh").over(order))
    return numbered.groupBy(key, "no").agg(
        F.min("lo").alias("session_start"), F.max("hi").alias("session_end"), F.sum("n").alias("events")).drop("no")
