"""Queries over resolution runs, links, jobs and their comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinweave.catalog.context import RULES
from kinweave.catalog.registry import register
from kinweave.catalog.sql import ORDERED, ordered, sql, ts, uuid5
from kinweave.operators import jobs, reports, resolution
from kinweave.plans.tables import AS_OF
from kinweave.streaming.resolve import ResolutionStore

SECOND = "yyyy-MM-dd HH:mm:ss"


@register("summary_report", "O-R1", sql("""
SELECT (SELECT count(*) FROM mast) AS unique_master_profiles, (SELECT count(DISTINCT mid) FROM link) AS unique_master_links,
  (SELECT count(*) FROM raw) AS total_raw_profiles, (SELECT count(DISTINCT rid) FROM link) AS unique_raw_links,
  (SELECT count(*) FROM raw WHERE rid NOT IN (SELECT rid FROM link)) AS unlinked_raw_profiles"""))
def _(c):
    return reports.summary_report(c.raw(), c.golden(), c.links())


@register("identity_clusters", "O-I15 O-I16", sql(
    "SELECT rid AS raw_profile_id, mid AS master_profile_id, link_id, rule AS match_rule FROM link"))
def _(c):
    return c.links().select("raw_profile_id", "master_profile_id", "link_id", "match_rule")


@register("ordered_resolution", "O-I14", sql(ORDERED + """
SELECT rid AS raw_profile_id, mid AS master_profile_id, CASE WHEN seq = root THEN 'NewMaster' ELSE 'DynamicMatch' END AS match_rule,
  how AS matched_attribute FROM omem"""))
def _(c):
    return c.sequential().links.select("raw_profile_id", "master_profile_id", "match_rule", "matched_attribute")


@register("ordered_golden_records", "O-I14 O-M1 O-M2 O-M3")
def _(c):
    return resolution.golden_tables(c.sequential(), AS_OF)[0].drop(
        "ext_attributes", "preferred_communication", "crm_contact_ids", "social_user_ids")


@register("ordered_golden_values", "O-I14 O-M1 O-M2 O-M6", sql(ORDERED + """
SELECT mid AS master_profile_id, tenant_id, email, phone_number, last_name, city, source_systems, first_rid AS first_seen_raw_profile_id FROM omast"""))
def _(c):
    return c.keep("ordered_golden", lambda: resolution.golden_tables(c.sequential(), AS_OF)[0]).select(
        "master_profile_id", "tenant_id", "email", "phone_number", "last_name", "city", F.array_join("source_systems", ",").alias("source_systems"),
        "first_seen_raw_profile_id")


@register("ordered_identifiers", "O-I14 O-M3", sql(ORDERED + "SELECT * FROM oval"))
def _(c):
    return c.keep("ordered_values", lambda: resolution.golden_tables(c.sequential(), AS_OF)[1]).select("master_profile_id", "kind", "value")


@register("incremental_clusters", "O-I15 O-I19", sql("""
, two AS (
  SELECT 'r' || rid AS node, received_at AS at, tenant_id, rid FROM latr
  UNION ALL SELECT 'm' || mid, created_at, tenant_id, NULL FROM prior),
k2 AS (
  SELECT 'r' || i.rid AS node, i.tenant_id, rule_id, i.value FROM idkey i JOIN latr USING (rid)
  UNION SELECT 'm' || p.mid, i.tenant_id, rule_id, i.value FROM idkey i JOIN prior0 p USING (rid)),
e2 AS (SELECT DISTINCT x.node AS a, y.node AS b FROM k2 x JOIN k2 y USING (tenant_id, rule_id, value)),
reach2(a, b) AS (SELECT node, node FROM two UNION SELECT r.a, e.b FROM reach2 r JOIN e2 e ON e.a = r.b),
pick AS (SELECT r.a, r.b, row_number() OVER (PARTITION BY r.a ORDER BY substr(r.b, 1, 1), w.at, substr(r.b, 2)) AS rn
  FROM reach2 r JOIN two w ON w.node = r.b)
SELECT substr(a, 2) AS raw_profile_id, substr(b, 1, 1) = 'm' AS joined_prior FROM pick WHERE rn = 1 AND substr(a, 1, 1) = 'r'"""))
def _(c):
    _, late = c.early_late()
    res = c.keep("incremental", lambda: resolution.resolve_transitive(late, _prior_full(c), RULES, AS_OF))
    prior = c.prior_masters().select("master_profile_id", F.lit(True).alias("p"))
    return res.links.join(prior, "master_profile_id", "left").select(
        "raw_profile_id", F.coalesce("p", F.lit(False)).alias("joined_prior"))


def _prior_full(c):
    """Prior masters with all their identifiers as arrays."""
    from kinweave.catalog.matching_queries import _prior_identifiers
    from kinweave.operators import survivorship
    return c.keep("prior_arrays", lambda: survivorship.with_identifier_arrays(c.prior_masters(), _prior_identifiers(c)))


def _incremental(c):
    """Golden tables after a run over the late rows on top of the early masters."""
    _, late = c.early_late()
    res = c.keep("incremental", lambda: resolution.resolve_transitive(late, _prior_full(c), RULES, AS_OF))
    return c.keep("incremental_golden", lambda: resolution.golden_tables(res, AS_OF)[0]), c.keep(
        "incremental_values", lambda: resolution.golden_tables(res, AS_OF)[1])


@register("incremental_golden_records", "O-I19 O-M1 O-M2 O-M6", sql("""
SELECT g.mid AS master_profile_id, g.tenant_id, g.email, g.phone_number, g.last_name, g.city, s.source_systems FROM mast g JOIN (
  SELECT mid, array_to_string(list_sort(list(DISTINCT source_system)), ',') AS source_systems FROM mem GROUP BY 1) s USING (mid)"""))
def _(c):
    return _incremental(c)[0].select("master_profile_id", "tenant_id", "email", "phone_number", "last_name", "city",
                                     F.array_join("source_systems", ",").alias("source_systems"))


@register("incremental_identifiers", "O-I19 O-M3 O-M6", sql("""
SELECT DISTINCT mid AS master_profile_id, 'web_visitor' AS kind, visid AS value FROM mem
UNION SELECT m.mid, 'secondary_email', m.email FROM mem m JOIN mast g USING (mid) WHERE m.email <> '' AND lower(m.email) <> lower(g.email)
UNION SELECT m.mid, 'secondary_phone', m.phone_number FROM mem m JOIN mast g USING (mid) WHERE m.phone_number <> ''
  AND m.phone_number <> g.phone_number"""))
def _(c):
    return _incremental(c)[1].select("master_profile_id", "kind", "value")


@register("incremental_id_maps", "O-I19 O-M7", sql("""
SELECT mid AS master_profile_id, source_system, arg_max(crm_source_id, seq) AS crm_id FROM mem WHERE crm_source_id IS NOT NULL
GROUP BY 1, 2"""))
def _(c):
    return _incremental(c)[0].select("master_profile_id", F.explode("crm_contact_ids").alias("source_system", "crm_id"))


@register("ordered_incremental", "O-I14 O-I19 O-I22", sql(ordered("""
  SELECT row_number() OVER (ORDER BY NOT is_prior, arrived, id) AS seq, * EXCLUDE (arrived) FROM (
    SELECT true AS is_prior, mid AS id, tenant_id, nullif(lower(email), '') AS e, nullif(phone_number, '') AS p, created_at AS arrived FROM prior
    UNION ALL SELECT false, rid, tenant_id, nullif(lower(email), ''), nullif(phone_number, ''), received_at FROM latr)""") + f"""
SELECT o.id AS raw_profile_id, CASE WHEN f.is_prior THEN f.id ELSE {uuid5("f.tenant_id || ':' || f.id")} END AS master_profile_id,
  CASE WHEN o.seq = o.root THEN 'NewMaster' ELSE 'DynamicMatch' END AS match_rule, o.how AS matched_attribute
FROM olink o JOIN olink f ON f.seq = o.root WHERE NOT o.is_prior"""))
def _(c):
    _, late = c.early_late()
    res = c.keep("ordered_incremental", lambda: jobs.resolve_all_pending(late, c.prior_masters(), None, AS_OF))
    return res.links.select("raw_profile_id", "master_profile_id", "match_rule", "matched_attribute")


@register("pending_rows", "O-I2", sql("""
SELECT rid AS raw_profile_id FROM raw WHERE received_at >= TIMESTAMP '2024-01-20' AND received_at <= TIMESTAMP '2024-01-30 12:00:00'
  AND rid NOT IN (SELECT rid FROM early)"""))
def _(c):
    early, _ = c.early_late()
    return resolution.pending_raw(c.raw(), early.select("raw_profile_id"), "2024-01-20 00:00:00", "2024-01-30 12:00:00").select("raw_profile_id")


@register("processed_rows", "O-I13", sql("""
SELECT rid AS raw_profile_id, CASE WHEN received_at < TIMESTAMP '2024-01-29' THEN 3 ELSE 1 END AS status_code,
  CASE WHEN received_at < TIMESTAMP '2024-01-29' THEN '2024-01-31 00:00:00' END AS updated_at FROM raw"""))
def _(c):
    early, _ = c.early_late()
    return resolution.mark_processed(c.raw(), early.select("raw_profile_id"), AS_OF).select(
        "raw_profile_id", F.col("status_code").cast("long").alias("status_code"), F.date_format("updated_at", SECOND).alias("updated_at"))


@register("backlog_window", "O-I17", sql(f"""
SELECT {ts("max(received_at) + INTERVAL 1 MINUTE - INTERVAL 180 MINUTE")} AS from_ts, {ts("max(received_at) + INTERVAL 1 MINUTE")} AS to_ts
FROM latr"""))
def _(c):
    early, _ = c.early_late()
    return jobs.backlog_window(c.raw(), early.select("raw_profile_id")).select(
        F.date_format("from_ts", SECOND).alias("from_ts"), F.date_format("to_ts", SECOND).alias("to_ts"))


@register("planned_jobs", "O-I18", sql(f"""
, w AS (SELECT DISTINCT tenant_id, date_trunc('hour', received_at) AS f, date_trunc('hour', received_at) + INTERVAL 1 HOUR AS e FROM raw),
led AS (SELECT DISTINCT tenant_id, date_trunc('hour', received_at) AS f FROM early WHERE d <> 2)
SELECT w.tenant_id, {ts('w.f')} AS from_ts, {ts('w.e')} AS to_ts FROM w ANTI JOIN led ON led.tenant_id = w.tenant_id AND led.f = w.f"""))
def _(c):
    hour = F.date_trunc("hour", "received_at").cast("timestamp_ntz")
    end = hour + F.make_dt_interval(F.lit(0), F.lit(1))
    key = [F.col("tenant_id"), hour.alias("data_from_datetime"), end.alias("data_to_datetime")]
    state = F.when(F.col("web_visitor_id").endswith("-2"), "failed").when(
        F.col("web_visitor_id").endswith("-1"), "processing").otherwise("success")
    ledger = c.early_late()[0].select(*key, state.alias("job_status"))
    return jobs.plan_jobs(ledger, c.raw().select(*key).distinct()).select(
        "tenant_id", F.date_format("data_from_datetime", SECOND).alias("from_ts"), F.date_format("data_to_datetime", SECOND).alias("to_ts"))


@register("backfill_windows", "O-I20", sql("""
SELECT CAST(ceil(date_diff('microsecond', received_at, TIMESTAMP '2024-01-30 18:00:00') / 3600000000.0::DOUBLE) - 1 AS BIGINT) AS window_index,
  count(*) AS pending FROM raw WHERE received_at < TIMESTAMP '2024-01-30 18:00:00'
  AND received_at >= TIMESTAMP '2024-01-30 18:00:00' - INTERVAL 48 HOUR GROUP BY 1"""))
def _(c):
    return jobs.backfill_windows(resolution.pending_raw(c.raw()), "2024-01-30 18:00:00", 3600, 48)


@register("backfilled_links", "O-I20 O-I19", sql("""
, w AS (SELECT *, CAST(ceil(date_diff('microsecond', received_at, TIMESTAMP '2024-01-30 18:00:00') / 86400000000.0::DOUBLE) - 1 AS BIGINT) AS window_index
  FROM raw WHERE received_at < TIMESTAMP '2024-01-30 18:00:00' AND received_at >= TIMESTAMP '2024-01-30 18:00:00' - INTERVAL 4 DAY),
bkey AS (SELECT i.* FROM idkey i JOIN w USING (rid)),
bedge AS (SELECT DISTINCT x.rid AS a, y.rid AS b FROM bkey x JOIN bkey y USING (tenant_id, rule_id, value)),
breach(a, b) AS (SELECT rid, rid FROM w UNION SELECT r.a, e.b FROM breach r JOIN bedge e ON e.a = r.b),
broot AS (SELECT a AS rid, b AS root FROM (SELECT r.a, r.b, row_number() OVER (PARTITION BY r.a ORDER BY o.received_at, r.b) AS rn
  FROM breach r JOIN w o ON o.rid = r.b) WHERE rn = 1)
SELECT window_index, count(*) AS processed, count(*) FILTER (WHERE rid = root) AS new_masters, count(*) FILTER (WHERE rid <> root) AS joined
FROM w JOIN broot USING (rid) GROUP BY 1"""))
def _(c):
    return jobs.backfill(c.raw(), None, None, "2024-01-30 18:00:00", 86_400, 4, AS_OF, "transitive", rules=RULES)[1]


@register("ledger_after_run", "O-I18 O-I19", sql(f"""
, s AS (SELECT unnest([0, 1, 2]) AS w),
w AS (SELECT DISTINCT tenant_id, w, TIMESTAMP '2024-01-01' + to_days(10 * w) AS f, TIMESTAMP '2024-01-11' + to_days(10 * w) AS e FROM raw, s),
n AS (SELECT tenant_id, CAST(floor(date_diff('day', TIMESTAMP '2024-01-01', received_at) / 10) AS INTEGER) AS w, count(*) AS n FROM raw GROUP BY 1, 2)
SELECT w.tenant_id, {ts('f')} AS from_ts, {ts('e')} AS to_ts, CASE WHEN w.tenant_id = 't0' AND w.w = 0 THEN 7 ELSE coalesce(n, 0) END AS processed_count,
  'success' AS job_status FROM w LEFT JOIN n USING (tenant_id, w)"""))
def _(c):
    """A ledger that already has one successful window and one failed one, after a run over all windows."""
    from kinweave.operators import runs
    from kinweave.catalog.stream_queries import folder
    path = folder(c)
    day = lambda k: F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(k)
    k = F.explode(F.array(*[F.lit(10 * i) for i in range(3)]))
    windows = c.raw().select("tenant_id").distinct().select("tenant_id", k.alias("k")).select(
        "tenant_id", day(F.col("k")).alias("data_from_datetime"), day(F.col("k") + 10).alias("data_to_datetime"))
    ledger, store = runs.RunLedger(c.spark, f"{path}/ledger"), ResolutionStore(c.spark, f"{path}/store", c.raw().schema)
    first = windows.where("data_from_datetime = timestamp_ntz'2024-01-01 00:00:00'")
    for run, tenant, status, count in ((0, "t0", "success", 7), (1, "t1", "failed", 0)):
        own = first.where(F.col("tenant_id") == tenant)
        ledger.start(run, own, "2024-01-30 00:00:00")
        ledger.end(run, own.withColumn("processed_count", F.lit(count).cast("long")), status, "2024-01-30 00:00:00")
    runs.run_planned(ledger, store, c.raw(), windows, AS_OF)
    return ledger.rows().where("job_status = 'success'").select(
        "tenant_id", F.date_format("data_from_datetime", SECOND).alias("from_ts"), F.date_format("data_to_datetime", SECOND).alias("to_ts"),
        "processed_count", "job_status")


@register("run_differences", "O-I21", sql("""
, a AS (SELECT rid, mid AS ma FROM link), b AS (SELECT rid, sha256(lower(coalesce(email, visid)) || tenant_id) AS mb FROM raw WHERE d <> 3),
cells AS (SELECT ma, mb, count(*) AS n FROM a FULL OUTER JOIN b USING (rid) GROUP BY 1, 2),
s AS (SELECT
  (SELECT CAST(coalesce(sum(n * (n - 1) // 2), 0) AS BIGINT) FROM (SELECT sum(n) AS n FROM cells WHERE ma IS NOT NULL GROUP BY ma)) AS together_a,
  (SELECT CAST(coalesce(sum(n * (n - 1) // 2), 0) AS BIGINT) FROM (SELECT sum(n) AS n FROM cells WHERE mb IS NOT NULL GROUP BY mb)) AS together_b,
  (SELECT CAST(coalesce(sum(n * (n - 1) // 2), 0) AS BIGINT) FROM cells WHERE ma IS NOT NULL AND mb IS NOT NULL) AS together_both,
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM cells WHERE mb IS NULL) AS only_a,
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM cells WHERE ma IS NULL) AS only_b)
SELECT *, together_a - together_both AS split, together_b - together_both AS merged FROM s"""))
def _(c):
    by_email = c.raw().where("web_visitor_id not like '%-3'").select("raw_profile_id", F.sha2(F.concat(
        F.lower(F.coalesce("email", "web_visitor_id")), "tenant_id"), 256).alias("master_profile_id"))
    return jobs.diff_resolutions(c.links(), by_email)


@register("match_quality", "O-I26", sql("""
, cells AS (SELECT mid, u, count(*) AS n FROM mem GROUP BY 1, 2),
s AS (SELECT
  (SELECT CAST(sum(n * (n - 1) // 2) AS BIGINT) FROM (SELECT sum(n) AS n FROM cells GROUP BY mid)) AS matched_pairs,
  (SELECT CAST(sum(n * (n - 1) // 2) AS BIGINT) FROM (SELECT sum(n) AS n FROM cells GROUP BY u)) AS true_pairs,
  (SELECT CAST(sum(n * (n - 1) // 2) AS BIGINT) FROM cells) AS correct_pairs)
SELECT *, matched_pairs - correct_pairs AS false_merges, true_pairs - correct_pairs AS missed_merges,
  round(correct_pairs / matched_pairs::DOUBLE, 6) AS precision, round(correct_pairs / true_pairs::DOUBLE, 6) AS recall FROM s"""))
def _(c):
    truth = c.raw().select("raw_profile_id", F.split("web_visitor_id", "-")[1].alias("identity"))
    return jobs.match_quality(c.links(), truth)


def _job_log(c):
    orders = c.table("orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("start"))
    hours = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    return orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("start") + hours).alias("end_time"))


@register("kept_job_log", "O-S10", """
SELECT o_orderkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) END AS e
  FROM orders) WHERE e IS NULL OR e > TIMESTAMP '2000-01-01 06:00:00' - INTERVAL 12 HOUR""")
def _(c):
    return jobs.prune_job_log(_job_log(c), "2000-01-01 06:00:00")[0].select("o_orderkey")


@register("pruned_job_log", "O-S10", """
SELECT count(*) AS deleted FROM (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) END AS e
  FROM orders) WHERE e <= TIMESTAMP '2000-01-01 06:00:00' - INTERVAL 12 HOUR""")
def _(c):
    return jobs.prune_job_log(_job_log(c), "2000-01-01 06:00:00")[1]


@register("change_feed", "O-S12", sql("SELECT mid AS master_profile_id FROM mast ORDER BY mid LIMIT 100"))
def _(c):
    return jobs.drain_changed_profiles(c.golden(), 100)[0]


@register("drained_masters", "O-S12", sql("""
SELECT status_code, count(*) AS masters FROM (SELECT CASE WHEN row_number() OVER (ORDER BY mid) <= 100 THEN 1 ELSE 10 END AS status_code
  FROM mast) GROUP BY 1"""))
def _(c):
    updated = jobs.drain_changed_profiles(c.golden(), 100)[1]
    return updated.groupBy(F.col("status_code").cast("long").alias("status_code")).agg(F.count("*").alias("masters"))


@register("notifications", "O-S13", sql("""
SELECT mid AS master_profile_id, 'email' AS channel FROM mast WHERE last_comm_k % 2 = 0
UNION ALL SELECT mid, 'sms' FROM mast WHERE last_comm_k % 3 = 0"""))
def _(c):
    return jobs.notification_feed(c.golden(), c.golden()).select("master_profile_id", "channel")
