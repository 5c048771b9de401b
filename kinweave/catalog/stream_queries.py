"""Streaming jobs run to completion over the given tables (file source, Parquet sinks)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kinweave.catalog.registry import register
from kinweave.catalog.sql import ORDERED, sql, uuid5
from kinweave.catalog.ingest_queries import wire_sql
from kinweave.operators import ingest
from kinweave.plans.asof import micros
from kinweave.plans.storage import documents_split, working_dir
from kinweave.streaming import ingest as stream_ingest
from kinweave.streaming import resolve, state, store, windows

SECOND = "yyyy-MM-dd HH:mm:ss"


def folder(c) -> str:
    return f"{working_dir(c.spark)}/stream-{uuid.uuid4().hex}"


def written(df, path: str):
    """Store a derived table as files and read it as a stream."""
    df.write.parquet(f"{path}/source")
    return df.sparkSession.readStream.schema(df.schema).parquet(f"{path}/source")


def in_batches(df, path: str, part, order: tuple[int, ...]):
    """Store a table in parts (the column ``part`` counts them from 0), one after the other in ``order``, and read it as a stream of that many
    micro-batches: files are taken by age."""
    for k in order:
        df.where(part == k).write.mode("append").parquet(f"{path}/source")
    files = len(df.sparkSession.read.schema(df.schema).parquet(f"{path}/source").inputFiles())
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", -(-files // len(order))).parquet(f"{path}/source")


def weeks(ts):
    """Part 0 to 3 by day of the month."""
    return F.least(F.floor((F.dayofmonth(ts) - 1) / 8), F.lit(3))


@register("stream_ingest", "O-T1 O-T2", wire_sql("""
SELECT outcome, count(*) AS events FROM wire GROUP BY 1
UNION ALL SELECT 'staged', count(*) FROM (SELECT DISTINCT w_tenant, CASE WHEN trim(w_visid) = '' THEN
  """ + uuid5("(w_tenant || 'obs' || 'shop.example.com' || w_version || w_phone || w_email)") + """ ELSE w_visid END
  FROM wire WHERE outcome = 'accepted' AND k NOT IN (21, 22))"""))
def _(c):
    path = folder(c)
    stream = ingest.route_ingest(stream_ingest.parse_documents(written(c.wire().select("value", "k"), path)))
    with documents_split(c.spark):
        stream_ingest.start_ingest(stream, f"{path}/ok", f"{path}/dead", f"{path}/staging", f"{path}/cp").awaitTermination()
    read = lambda name: c.spark.read.parquet(f"{path}/{name}")
    staged = read("staging").select("tenant_id", "web_visitor_id").distinct().agg(F.count("*").alias("events")).select(
        F.lit("staged").alias("outcome"), "events")
    outcomes = read("ok").select("outcome").union(read("dead").select("outcome")).groupBy("outcome").agg(F.count("*").alias("events"))
    return outcomes.union(staged)


@register("stream_staging", "O-T1 O-T2", wire_sql("""
SELECT w_tenant AS tenant_id, count(*) AS visitors FROM (SELECT DISTINCT w_tenant, CASE WHEN trim(w_visid) = '' THEN
  """ + uuid5("(w_tenant || 'obs' || 'shop.example.com' || w_version || w_phone || w_email)") + """ ELSE w_visid END AS id
  FROM wire WHERE outcome = 'accepted' AND k NOT IN (21, 22)) GROUP BY 1"""))
def _(c):
    """Staging rows after four micro-batches out of time order: a visitor's later batches overwrite its row."""
    path = folder(c)
    wire = in_batches(c.wire().select("value", "k", F.coalesce(weeks("ts"), F.lit(0)).alias("part")), path, F.col("part"), (1, 3, 0, 2))
    with documents_split(c.spark):
        stream_ingest.start_ingest(ingest.route_ingest(stream_ingest.parse_documents(wire.drop("part"))), f"{path}/ok", f"{path}/dead",
                                   f"{path}/staging", f"{path}/cp").awaitTermination()
    schema = c.spark.read.option("basePath", f"{path}/staging").parquet(f"{path}/staging").drop("batch").schema
    rows = store.current(c.spark, f"{path}/staging", ["tenant_id", "web_visitor_id"], schema)
    return rows.groupBy("tenant_id").agg(F.count("*").alias("visitors"))


@register("stream_resolution", "O-T3")
def _(c):
    path = folder(c)
    s = resolve.ResolutionStore(c.spark, f"{path}/store", c.raw().schema)
    resolve.start_resolution(in_batches(c.raw(), path, weeks("received_at"), (0, 1, 2, 3)), s, f"{path}/cp").awaitTermination()
    resolve.backfill(s, 1_000_000)
    return s.links().groupBy("match_rule").agg(F.count("*").alias("links"))


def _resolved_in_order(c):
    """Store after four micro-batches in order of arrival, each resolved as a whole on top of the ones before."""
    def build():
        path = folder(c)
        s = resolve.ResolutionStore(c.spark, f"{path}/store", c.raw().schema)
        stream = in_batches(c.raw(), path, weeks("received_at"), (0, 1, 2, 3))
        resolve.start_resolution(stream, s, f"{path}/cp", look_back_minutes=None).awaitTermination()
        return s
    return c.keep("stream_store", build)


@register("stream_golden_records", "O-T3 O-M1 O-M2 O-M6", sql(ORDERED + """
SELECT mid AS master_profile_id, tenant_id, email, phone_number, last_name, city, source_systems, first_rid AS first_seen_raw_profile_id FROM omast"""))
def _(c):
    return _resolved_in_order(c).masters().select(
        "master_profile_id", "tenant_id", "email", "phone_number", "last_name", "city", F.array_join("source_systems", ",").alias("source_systems"),
        "first_seen_raw_profile_id")


@register("stream_identifiers", "O-T3 O-M3", sql(ORDERED + "SELECT * FROM oval"))
def _(c):
    return _resolved_in_order(c).identifiers().select("master_profile_id", "kind", "value")


@register("stream_links", "O-T3", sql(ORDERED + """
SELECT rid AS raw_profile_id, mid AS master_profile_id, CASE WHEN seq = root THEN 'NewMaster' ELSE 'DynamicMatch' END AS match_rule FROM omem"""))
def _(c):
    return _resolved_in_order(c).links().select("raw_profile_id", "master_profile_id", "match_rule")


@register("stream_distinct_events", "O-T5", "SELECT event_type, count(*) AS events FROM events GROUP BY 1")
def _(c):
    path = folder(c)
    e = c.table("events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    # Every event comes twice, the second time with the part after; the parts are out of time order.
    twice = e.withColumn("part", weeks("ts")).unionByName(e.withColumn("part", (weeks("ts") + 1) % 4))
    stream = in_batches(twice, path, F.col("part"), (1, 3, 0, 2)).drop("part")
    windows.start_dedup(stream, "ts", path).awaitTermination()
    return windows.first_copies(c.spark, path).groupBy("event_type").agg(F.count("*").alias("events"))


def _counts(c, size: str, slide: str | None = None):
    path = folder(c)
    e = c.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    windows.start_windowed_counts(in_batches(e, path, weeks("ts"), (1, 3, 0, 2)), "ts", size, path, slide).awaitTermination()
    return windows.windowed_counts(c.spark, path).select(F.date_format("window_start", SECOND).alias("window_start"), "rows")


@register("stream_window_counts", "O-T6 O-R8", """
WITH b AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, count(*) AS rows FROM events GROUP BY 1)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, rows FROM b""")
def _(c):
    return _counts(c, "1 hour")


@register("stream_sliding_counts", "O-T6", """
WITH b AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR * unnest(range(4)) AS w FROM events)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS rows FROM b GROUP BY 1""")
def _(c):
    return _counts(c, "24 hours", "6 hours")


@register("stream_latest_profile", "O-T7", sql("""
SELECT tenant_id, visid, arg_max(metric, (ts, metric)) AS metric FROM acc GROUP BY 1, 2"""))
def _(c):
    path = folder(c)
    rows = c.accepted().select("tenant_id", "visid", micros("ts").alias("at"), "metric", weeks("ts").alias("part"))
    changes = state.latest_profile_state(in_batches(rows, path, F.col("part"), (1, 3, 0, 2)))
    state.start_upserts(changes, path).awaitTermination()
    return store.current(c.spark, f"{path}/out", ["tenant_id", "visid"], changes.schema).select("tenant_id", "visid", "metric")


@register("stream_conversation_memory", "O-T8", """
SELECT conv_id, string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) AS turns FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations) WHERE rn <= 10 GROUP BY 1""")
def _(c):
    path = folder(c)
    turns = in_batches(c.table("conversations"), path, F.pmod(F.col("turn"), F.lit(3)), (1, 0, 2))
    changes = state.conversation_memory_stream(turns)
    state.start_upserts(changes, path).awaitTermination()
    newest = store.current(c.spark, f"{path}/out", ["conv_id"], changes.schema)
    return newest.select("conv_id", F.array_join("turns", ",").alias("turns"))
