"""Queries over reports, quality checks and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinweave.catalog.registry import register
from kinweave.catalog.sql import sql, ts
from kinweave.functions import collections as C
from kinweave.operators import jobs, quality, reports

MASTER = "master_profile_id"
SECOND = "yyyy-MM-dd HH:mm:ss"


@register("raw_constraints", "O-Q1", sql("""
SELECT unnest(['gender','status_code','tenant_id_null','web_visitor_id_null','length_tenant_id','length_source_system','length_phone_number',
  'length_web_visitor_id','length_first_name','length_last_name','length_gender','length_zip_code','length_country']) AS rule, 0 AS violations"""))
def _(c):
    return quality.constraint_report(c.raw(), quality.raw_rules())


BROKEN = [("gender", "gender NOT IN ('male', 'female', 'unknown', 'other')"), ("status_code", "status_code NOT BETWEEN -1 AND 3"),
          ("tenant_id_null", "tenant_id IS NULL"), ("web_visitor_id_null", "web_visitor_id IS NULL")] + [
    (f"length_{column}", f"length({column}) > {most}") for column, most in quality.RAW_LENGTHS.items()]


@register("constraint_violations", "O-Q1", sql("""
, v AS (SELECT CASE WHEN k % 5 = 0 THEN '?' ELSE gender END AS gender, k - 2 AS status_code, CASE WHEN k <> 7 THEN tenant_id END AS tenant_id,
  CASE WHEN k % 6 <> 1 THEN repeat(visid, CAST(k AS INTEGER)) END AS web_visitor_id, source_system, repeat('9', CAST(3 * k AS INTEGER)) AS phone_number,
  repeat(last_name, CAST(k AS INTEGER)) AS first_name, last_name, repeat('9', CAST(k % 14 AS INTEGER)) AS zip_code, repeat(country, CAST(k AS INTEGER)) AS country FROM t)
""" + " UNION ALL ".join(f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {broken}) AS violations FROM v" for rule, broken in BROKEN)))
def _(c):
    """Tracking rows bent so that most rules have violations."""
    k = F.col("k")
    times = lambda column, n: F.expr(f"repeat({column}, cast({n} as int))")
    rows = c.tracking().select(
        F.when(k % 5 == 0, "?").otherwise(F.col("gender")).alias("gender"), (k - 2).alias("status_code"),
        F.when(k != 7, F.col("tenant_id")).alias("tenant_id"), F.when(k % 6 != 1, times("visid", "k")).alias("web_visitor_id"), "source_system",
        times("'9'", "3 * k").alias("phone_number"), times("last_name", "k").alias("first_name"), "last_name", times("'9'", "k % 14").alias("zip_code"),
        times("country", "k").alias("country"))
    return quality.constraint_report(rows, quality.raw_rules())


@register("event_constraints", "O-Q1", sql("""
, x AS (SELECT count(*) FILTER (WHERE rating + 1 > 10) AS r FROM acc)
SELECT 'feedback_rating' AS rule, r AS violations FROM x UNION ALL SELECT 'event_name_null', 0 UNION ALL SELECT 'session_id_null', 0
UNION ALL SELECT 'web_url_null', 0"""))
def _(c):
    shifted = c.events().withColumn("feedback_rating", F.col("feedback_rating") + 1)
    return quality.constraint_report(shifted, quality.event_rules())


@register("duplicate_visitors", "O-Q2", sql("""
SELECT tenant_id, visid AS web_visitor_id, count(*) AS copies FROM acc GROUP BY 1, 2 HAVING count(*) > 1"""))
def _(c):
    return quality.uniqueness_report(c.events(), ["tenant_id", "web_visitor_id"])


@register("orphan_orders", "O-Q3", """
SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def _(c):
    child = c.table("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return quality.referential_report(child, c.table("customer").where("c_acctbal > 0"), "c_custkey").select("o_orderkey")


@register("distinct_identifiers", "O-Q4", sql("""
SELECT count(DISTINCT email) AS distinct_email, count(DISTINCT visid) AS distinct_web_visitor_id, count(DISTINCT phone_number) AS distinct_phone_number
FROM raw"""))
def _(c):
    return quality.unique_identifier_monitor(c.raw(), ["email", "web_visitor_id", "phone_number"])


@register("synced_metadata", "O-Q5", """
WITH cur AS (SELECT p_partkey AS id, p_name || p_brand || p_size AS code, p_type AS data_type FROM part WHERE p_size <= 25),
c1 AS (SELECT min(id) AS id, code, min(data_type) AS data_type FROM cur GROUP BY code),
i1 AS (SELECT min(p_partkey) AS id, p_name || p_brand || p_size AS code, max(p_type) AS data_type FROM part GROUP BY 2)
SELECT coalesce(c1.id, i1.id) AS id, coalesce(c1.code, i1.code) AS code, coalesce(i1.data_type, c1.data_type) AS data_type
FROM c1 FULL OUTER JOIN i1 ON c1.code = i1.code""")
def _(c):
    code = F.concat("p_name", "p_brand", "p_size").alias("code")
    part = c.table("part")
    cur = part.where("p_size <= 25").groupBy(code).agg(F.min("p_partkey").alias("id"), F.min("p_type").alias("data_type"))
    new = part.groupBy(code).agg(F.min("p_partkey").alias("id"), F.max("p_type").alias("data_type"))
    return quality.sync_metadata(cur, new, "code").select("id", "code", "data_type")


@register("attribute_completeness", "O-Q6", sql("""
SELECT 'email' AS attribute, round(avg(CASE WHEN coalesce(email,'')<>'' THEN 1.0 ELSE 0.0 END), 6) AS completeness FROM mast
UNION ALL SELECT 'phone_number', round(avg(CASE WHEN coalesce(phone_number,'')<>'' THEN 1.0 ELSE 0.0 END), 6) FROM mast
UNION ALL SELECT 'city', round(avg(CASE WHEN coalesce(city,'')<>'' THEN 1.0 ELSE 0.0 END), 6) FROM mast"""))
def _(c):
    return quality.required_attribute_report(c.golden(), ["email", "phone_number", "city"])


@register("lineage", "O-Q7", sql(f"""
, f AS (SELECT mid, arg_min(rid, seq) AS first_rid FROM mem GROUP BY 1)
SELECT m.mid AS master_profile_id, m.rid AS raw_profile_id, m.source_system, m.visid AS web_visitor_id, {ts('m.received_at')} AS received_at,
  l.rule AS match_rule, m.rid = f.first_rid AS is_founder FROM mem m JOIN link l USING (rid) JOIN f ON f.mid = m.mid"""))
def _(c):
    return quality.lineage(c.links(), c.raw(), c.golden()).withColumn("received_at", F.date_format("received_at", SECOND))


def _purged(c):
    bad_raw = F.when(F.col("web_visitor_id").endswith("-1"), -1).otherwise(F.col("status_code"))
    bad_master = F.when(F.col("tenant_id") == "t1", -1).otherwise(F.col("status_code"))
    return quality.purge_deleted(c.raw().withColumn("status_code", bad_raw), c.golden().withColumn("status_code", bad_master),
                                 c.links(), c.events())


@register("purged_links", "O-Q8", sql("SELECT rid AS raw_profile_id, mid AS master_profile_id FROM mem WHERE d <> 1 AND tenant_id <> 't1'"))
def _(c):
    return _purged(c)[2].select("raw_profile_id", MASTER)


@register("purged_events", "O-Q8", sql(
    "SELECT event_id AS source_event_id, CASE WHEN tenant_id <> 't1' THEN mid END AS master_profile_id FROM ev"))
def _(c):
    return _purged(c)[3].select("source_event_id", MASTER)


@register("duplicate_masters", "O-R2", sql(
    "SELECT count(*) AS duplicate_masters FROM (SELECT mid FROM link GROUP BY mid HAVING count(*) > 1)"))
def _(c):
    return reports.masters_with_duplicates(c.links())


@register("duplicate_raws", "O-R3", sql("SELECT rid AS raw_profile_id, mid AS master_profile_id FROM link WHERE rule <> 'NewMaster'"))
def _(c):
    return reports.duplicate_raws(c.links(), c.golden())


@register("raw_status_counts", "O-R4", sql("SELECT 1 AS status_code, count(*) AS rows FROM raw"))
def _(c):
    return reports.status_counts(c.raw())


@register("total_web_visitors", "O-R5", sql("SELECT count(DISTINCT visid) AS total_web_visitors FROM mem"))
def _(c):
    return reports.total_web_visitors(c.identifiers())


@register("linked_masters", "O-R6", sql("SELECT count(DISTINCT mid) AS linked_masters FROM link"))
def _(c):
    return reports.linked_masters_same_tenant(c.golden(), c.links(), c.raw())


@register("pending_in_window", "O-R7", sql("""
SELECT count(*) AS pending FROM raw WHERE received_at >= TIMESTAMP '2024-01-29' AND received_at < TIMESTAMP '2024-01-30 06:00:00'"""))
def _(c):
    early, _ = c.early_late()
    return jobs.pending_count(c.raw(), early.select("raw_profile_id"), "2024-01-28 00:00:00", "2024-01-30 06:00:00")


@register("throughput", "O-R8", sql(f"""
SELECT {ts("time_bucket(INTERVAL 5 MINUTE, received_at)")} AS window_start, count(*) AS rows FROM raw GROUP BY 1"""))
def _(c):
    return reports.throughput(c.raw(), "received_at", "5 minutes").withColumn("window_start", F.date_format("window_start", SECOND))


@register("masters_created", "O-R9", sql("SELECT mid AS master_profile_id, count(*) AS raws FROM link GROUP BY 1"))
def _(c):
    return reports.masters_created_with_aliases(c.golden(), c.links(), "2024-01-01 00:00:00", "2024-02-01 00:00:00")


@register("contactable_masters", "O-R10", sql("SELECT mid AS master_profile_id FROM mast WHERE email <> '' AND phone_number <> ''"))
def _(c):
    return reports.contactable_masters(c.golden()).select(MASTER)


@register("order_value", "O-R11", sql("""
SELECT mid AS master_profile_id, count(*) AS orders, round(sum(amount), 2) AS order_value FROM buy WHERE mid IS NOT NULL GROUP BY 1"""))
def _(c):
    return reports.order_value_by_master(c.purchases())


@register("top_masters_by_value", "O-R12", sql("""
SELECT * FROM (SELECT tenant_id, mid AS master_profile_id, clv AS customer_lifetime_value, row_number() OVER (
  PARTITION BY tenant_id ORDER BY clv DESC NULLS LAST, mid) AS rank FROM score) WHERE rank <= 10"""))
def _(c):
    return reports.top_k_masters(c.scored(), "customer_lifetime_value", 10).select("tenant_id", MASTER, "customer_lifetime_value", "rank")


@register("top_masters_by_churn", "O-R12", sql("""
SELECT * FROM (SELECT tenant_id, mid AS master_profile_id, churn_probability, row_number() OVER (
  PARTITION BY tenant_id ORDER BY churn_probability ASC NULLS LAST, mid) AS rank FROM score) WHERE rank <= 10"""))
def _(c):
    return reports.top_k_masters(c.scored(), "churn_probability", 10).select("tenant_id", MASTER, "churn_probability", "rank")


@register("multi_source_masters", "O-R13", sql("""
SELECT mid AS master_profile_id FROM mem GROUP BY 1 HAVING count(*) FILTER (WHERE source_system = 'CRM') > 0
  AND count(*) FILTER (WHERE source_system = 'websdk') > 0"""))
def _(c):
    return c.golden().where(C.contains_all("source_systems", ["CRM", "websdk"])).select(MASTER)


@register("named_masters", "O-R14", sql(
    "SELECT mid AS master_profile_id FROM mast WHERE tenant_id = 't0' AND lower(last_name) = 'customer#000000012'"))
def _(c):
    return reports.name_search(c.golden(), "t0", " Customer#000000012 ").select(MASTER)


@register("profiles_in_radius", "O-R15", """
WITH p AS (SELECT c_custkey, (c_custkey % 180) - 90.0 AS latitude, (c_custkey * 7 % 360) - 180.0 AS longitude FROM customer),
q AS (SELECT c_custkey, 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(10.0 - latitude) / 2), 2)
  + cos(radians(latitude)) * cos(radians(10.0)) * pow(sin(radians(20.0 - longitude) / 2), 2)))) AS km FROM p)
SELECT c_custkey, round(km, 6) AS distance_km FROM q WHERE km <= 3000""")
def _(c):
    k = F.col("c_custkey")
    placed = c.table("customer").select("c_custkey", ((k % 180) - 90).cast("double").alias("latitude"),
                                        ((k * 7 % 360) - 180).cast("double").alias("longitude"))
    return reports.geo_radius(placed, 10.0, 20.0, 3000.0).select("c_custkey", F.round("distance_km", 6).alias("distance_km"))


@register("personas_by_region", "O-R16", sql("""
, tags AS (SELECT country, unnest([loyalty_tier, 'gender_' || gender, 'lead_' || lead_score]) AS persona FROM score)
SELECT * FROM (SELECT country, persona, count(*) AS profiles, row_number() OVER (PARTITION BY country ORDER BY count(*) DESC, persona) AS rank
  FROM tags GROUP BY 1, 2) WHERE rank <= 2"""))
def _(c):
    tagged = c.scored().withColumn("persona_tags", F.array(
        "loyalty_tier", F.concat(F.lit("gender_"), "gender"), F.concat(F.lit("lead_"), F.col("lead_score").cast("string"))))
    return reports.personas_by_region(tagged, 2)


@register("churn_heatmap", "O-R17", sql("""
SELECT CAST(floor(churn_probability * 10 + 1e-9) AS BIGINT) AS churn_bucket, count(*) FILTER (WHERE loyalty_tier = 'Bronze') AS "Bronze",
  count(*) FILTER (WHERE loyalty_tier = 'Silver') AS "Silver", count(*) FILTER (WHERE loyalty_tier = 'Gold') AS "Gold",
  count(*) FILTER (WHERE loyalty_tier = 'Platinum') AS "Platinum" FROM score GROUP BY 1"""))
def _(c):
    return reports.churn_heatmap(c.scored())


@register("link_coverage", "O-R18", sql("""
SELECT source_system, rule AS match_rule, count(*) AS rows, round(count(*) / sum(count(*)) OVER (PARTITION BY source_system)::DOUBLE, 6) AS share
FROM raw LEFT JOIN link USING (rid) GROUP BY 1, 2"""))
def _(c):
    return reports.coverage(c.raw(), c.links())


@register("customer_360", "O-R19", sql("""
SELECT mid AS master_profile_id, s.tenant_id, email, total_sessions, session_seconds, total_purchases, orders, order_value, loyalty_tier
FROM score s LEFT JOIN (SELECT mid, count(*) AS orders, round(sum(amount), 2) AS order_value FROM buy WHERE mid IS NOT NULL GROUP BY 1) o USING (mid)"""))
def _(c):
    return reports.customer_360_view(c.scored(), reports.order_value_by_master(c.purchases())).select(
        MASTER, "tenant_id", "email", "total_sessions", "session_seconds", "total_purchases", "orders", "order_value", "loyalty_tier")


@register("daily_trend", "O-R20", sql("""
, g AS (SELECT date_trunc('day', ts) AS p, metric, count(*) AS n FROM ev WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' GROUP BY 1, 2)
SELECT strftime(p, '%Y-%m-%d') AS period, metric AS event_name, n AS events, n - lag(n) OVER (PARTITION BY metric ORDER BY p) AS change FROM g"""))
def _(c):
    return reports.trend(c.events(), "day", "2024-01-05 00:00:00", "2024-01-25 00:00:00").withColumn(
        "period", F.date_format("period", "yyyy-MM-dd"))
