"""Queries over sources, decoding, validation, cleaning and staging."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinweave.catalog.registry import register
from kinweave.catalog.sql import sql, us, uuid5
from kinweave.functions import collections as C
from kinweave.functions import ids, text
from kinweave.operators import ingest, quality, vectors
from kinweave.plans import tables
from kinweave.sources import events as sources
from kinweave.sources import lake

MICRO = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SECOND = "yyyy-MM-dd HH:mm:ss"

# The wire documents with their planned defects, as SQL.
WIRE = """, wire AS (
  SELECT *, CASE WHEN k = 17 THEN 'missing_body' WHEN k = 13 THEN 'bad_json' WHEN metric IS NULL OR k = 26 THEN 'invalid'
      ELSE 'accepted' END AS outcome,
    CASE WHEN k = 26 THEN repeat('t', 40) ELSE tenant_id END AS w_tenant,
    CASE WHEN k = 23 THEN ' ' ELSE visid END AS w_visid,
    CASE WHEN k = 21 THEN '+84-bad' ELSE ' +849' || lpad(CAST(u AS VARCHAR), 8, '0') END AS w_phone,
    CASE WHEN k = 22 THEN 'user' || u || '@' ELSE 'user' || u || '@example.com' END AS w_email,
    CASE WHEN k % 4 = 1 THEN '+1' || lpad(CAST(u AS VARCHAR), 8, '0') END AS w_alias_phone,
    CASE WHEN k % 4 = 2 THEN ' <script>x</script><b>"u' || u || '"&''' END AS w_firstname,
    CASE WHEN k % 8 = 2 THEN 'Name ' || u END AS w_name,
    CASE WHEN k % 6 <> 0 THEN source_system END AS w_source, CASE WHEN k % 6 = 3 THEN 'loyalty' END AS w_usersource,
    CASE WHEN k = 27 THEN 'v1' ELSE '2025.05.01' END AS w_version
  FROM t
)
"""


def wire_sql(body: str) -> str:
    return sql(WIRE + body)


def parsed_wire(c):
    return ingest.route_ingest(sources.parse_documents(c.wire()))


@register("ingest_outcomes", "O-S1 O-V1 O-V3", wire_sql(
    "SELECT outcome, CAST(CASE outcome WHEN 'accepted' THEN 200 WHEN 'missing_body' THEN 500 ELSE 400 END AS BIGINT) AS status,"
    " count(*) AS events FROM wire GROUP BY 1, 2"))
def _(c):
    return parsed_wire(c).groupBy("outcome", F.col("status").cast("long").alias("status")).agg(F.count("*").alias("events"))


@register("decoded_envelopes", "O-S2", sql(
    f"SELECT eid, event_id, tenant_id, visid, metric, tpurl, session_id, {us('ts')} AS stamp, email, phone_number, source_system"
    " FROM t"))
def _(c):
    d = sources.decode_envelope(tables.tracking_documents(c.spark, c.sf_dir))
    return d.select("eid", "event_id", "tenant_id", "visid", "metric", "tpurl", F.col("sessionid").alias("session_id"),
                    F.col("datetime").alias("stamp"), ingest.trait("email").alias("email"),
                    ingest.trait("phone_number").alias("phone_number"), ingest.trait("source_system").alias("source_system"))


@register("dead_letters", "O-V3", wire_sql("SELECT eid, outcome FROM wire WHERE outcome <> 'accepted'"))
def _(c):
    return ingest.dead_letter(parsed_wire(c)).select("eid", "outcome")


@register("schema_errors", "O-V2", wire_sql("""
, e AS (SELECT eid, list_sort(list_filter([
    CASE WHEN k % 5 = 0 THEN 'missing:tpurl' END, CASE WHEN k = 27 THEN 'pattern:schema_version' END,
    CASE WHEN k % 3 <> 0 THEN 'uuid:event_id' END, 'uuid:visid',
    CASE WHEN k % 6 = 0 THEN 'missing:source_system' END], lambda x: x IS NOT NULL)) AS errs FROM wire WHERE outcome = 'accepted')
SELECT array_to_string(errs, ',') AS errors, count(*) AS events FROM e GROUP BY 1"""))
def _(c):
    checked = ingest.validate_event_schema(ingest.accepted(parsed_wire(c)))
    return checked.groupBy(F.array_join("errors", ",").alias("errors")).agg(F.count("*").alias("events"))


@register("record_states", "O-V4 O-V5 O-V6 O-V7", wire_sql("""
SELECT CASE WHEN k IN (21, 22) THEN 'Dropped' ELSE 'Ok' END AS record_state,
  CASE k WHEN 21 THEN 'phone_number' WHEN 22 THEN 'email' END AS reason, count(*) AS events
FROM wire WHERE outcome = 'accepted' GROUP BY 1, 2"""))
def _(c):
    return ingest.classify_records(ingest.accepted(parsed_wire(c))).groupBy("record_state", "reason").agg(
        F.count("*").alias("events"))


ESC = ("replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')")


@register("flattened_profiles", "O-V8 O-V9 O-V10 O-V12", wire_sql(f"""
SELECT eid, trim(CASE WHEN k = 23 THEN {uuid5("w_tenant || 'obs' || 'shop.example.com' || w_version || w_phone || w_email")}
    ELSE w_visid END) AS web_visitor_id, w_tenant AS tenant_id,
  CASE WHEN k = 23 THEN trim(w_phone) ELSE coalesce(w_alias_phone, trim(w_phone)) END AS phone_number, w_email AS email,
  CASE WHEN k = 23 THEN 'Ann' ELSE {ESC.format("coalesce(w_name, replace(trim(w_firstname), '<script>x</script>', ''), 'Ann')")}
    END AS first_name,
  CASE WHEN k = 23 THEN coalesce(w_source, 'websdk') ELSE coalesce(w_usersource, w_source) END AS source_system,
  'unknown' AS gender
FROM wire WHERE outcome = 'accepted' AND k NOT IN (21, 22)"""))
def _(c):
    ok = ingest.classify_records(ingest.accepted(parsed_wire(c))).where("record_state = 'Ok'")
    flat = ingest.events_to_raw_profiles(ok.withColumn("event_id", F.col("eid").cast("string")), F.col("ts"))
    return flat.select(F.col("event_id").cast("long").alias("eid"), "web_visitor_id", "tenant_id", "phone_number", "email",
                       "first_name", "source_system", "gender")


@register("staging_rows", "O-S8 O-V10", sql(f"""
SELECT rid AS raw_profile_id, tenant_id, visid AS web_visitor_id, {us('received_at')} AS received_at, email, phone_number,
  crm_source_id, source_system, last_name, country, gender, city, last_k, segment FROM raw"""))
def _(c):
    return c.raw().select(
        "raw_profile_id", "tenant_id", "web_visitor_id", F.date_format("received_at", MICRO).alias("received_at"), "email",
        "phone_number", "crm_source_id", "source_system", "last_name", "country", "gender", "city",
        C.ext_attr("ext_attributes", "last_k").alias("last_k"), C.ext_attr("ext_attributes", "segment").alias("segment"))


@register("bulk_customers", "O-S3", """
SELECT CAST(c_custkey AS VARCHAR) AS crm_source_id, lower(c_name) AS last_name, 'CRM' AS source_system,
  c_acctbal AS account_balance FROM customer""")
def _(c):
    mapping = {"crm_source_id": "cast(c_custkey as string)", "last_name": "lower(c_name)", "source_system": "'CRM'",
               "account_balance": "c_acctbal"}
    return sources.read_bulk_profiles(c.spark, f"{c.sf_dir}/customer.parquet", "parquet", mapping)


@register("crm_delta", "O-S4", """
WITH cur AS (SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal >= 0),
old AS (SELECT c_custkey, c_name, CASE WHEN c_nationkey = 3 THEN 'OLD' ELSE c_mktsegment END AS c_mktsegment, c_acctbal
        FROM customer WHERE c_acctbal < 9000)
SELECT coalesce(cur.c_custkey, old.c_custkey) AS c_custkey, CASE WHEN old.c_custkey IS NULL THEN 'insert'
  WHEN cur.c_custkey IS NULL THEN 'delete' ELSE 'update' END AS change
FROM cur FULL OUTER JOIN old ON cur.c_custkey = old.c_custkey
WHERE old.c_custkey IS NULL OR cur.c_custkey IS NULL OR cur.c_mktsegment <> old.c_mktsegment""")
def _(c):
    customer = c.table("customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey")
    cur = customer.where("c_acctbal >= 0").drop("c_nationkey")
    old = customer.where("c_acctbal < 9000").withColumn(
        "c_mktsegment", F.when(F.col("c_nationkey") == 3, "OLD").otherwise(F.col("c_mktsegment"))).drop("c_nationkey")
    return ingest.delta_extract(cur, old, ["c_custkey"])


@register("source_conflicts", "O-S5", sql("""
, p AS (SELECT u, city, source_system, ts, CASE source_system WHEN 'CRM' THEN 1 WHEN 'ecommerce' THEN 2 ELSE 3 END AS prio
  FROM acc WHERE city IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY prio, ts DESC, source_system DESC, city DESC) AS rn,
  min(city) OVER (PARTITION BY u) <> max(city) OVER (PARTITION BY u) AS needs_review FROM p)
SELECT u, city, source_system AS winning_source, needs_review FROM r WHERE rn = 1"""))
def _(c):
    events = c.tracking().where("metric is not null")
    return ingest.resolve_source_conflicts(events, ["u"], "city", "source_system", "ts", {"CRM": 1, "ecommerce": 2})


@register("event_lake", "O-S6 O-V24", sql(
    "SELECT strftime(ts, '%Y-%m-%d') AS event_date, metric AS event_type, count(*) AS events FROM acc GROUP BY 1, 2"))
def _(c):
    import uuid

    from kinweave.plans.storage import working_dir
    events = lake.enrich_ingest(c.accepted(), tables.AS_OF, "ts").withColumn("event_type", F.col("metric"))
    path = f"{working_dir(c.spark)}/lake-{uuid.uuid4().hex}"
    lake.write_event_lake(events.select("event_id", "ts", "tenant_id", "visid", "event_date", "event_type"), path)
    back = c.spark.read.parquet(path)
    return back.groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("event_date"), "event_type").agg(
        F.count("*").alias("events"))


@register("staging_upsert", "O-S7", sql("""
, ex AS (SELECT rid, tenant_id, visid, email, phone_number, city, received_at FROM early),
inc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, visid ORDER BY ts, eid) AS rn FROM acc
  WHERE d <> 0) WHERE rn = 1)
SELECT coalesce(ex.rid, sha256(inc.tenant_id || ':' || inc.visid)) AS raw_profile_id,
  coalesce(ex.visid, inc.visid) AS web_visitor_id, CASE WHEN inc.visid IS NULL THEN ex.email ELSE inc.email END AS email,
  CASE WHEN inc.visid IS NULL THEN ex.phone_number ELSE inc.phone_number END AS phone_number,
  CASE WHEN inc.visid IS NULL THEN ex.city ELSE inc.city END AS city,
  strftime(CASE WHEN inc.visid IS NULL THEN ex.received_at ELSE TIMESTAMP '2024-01-31' END, '%Y-%m-%d %H:%M:%S') AS received_at
FROM ex FULL OUTER JOIN inc ON ex.tenant_id = inc.tenant_id AND ex.visid = inc.visid"""))
def _(c):
    columns = ["raw_profile_id", "tenant_id", "web_visitor_id", "email", "phone_number", "city", "received_at", "status_code"]
    early, _ = c.early_late()
    oldest = ingest.events_to_raw_profiles(c.accepted(), F.col("datetime")).withColumn("eid", F.col("event_id").cast("long"))
    oldest = oldest.where("web_visitor_id not like '%-0'").groupBy("tenant_id", "web_visitor_id").agg(
        F.min_by(F.struct(*[x for x in columns if x not in ("tenant_id", "web_visitor_id")]),
                 F.struct("received_at", "eid")).alias("r")).select("tenant_id", "web_visitor_id", "r.*")
    merged = ingest.upsert_raw_profiles(early.select(*columns), oldest.select(*columns), tables.AS_OF)
    return merged.select("raw_profile_id", "web_visitor_id", "email", "phone_number", "city",
                         F.date_format("received_at", SECOND).alias("received_at"))


@register("retained_events", "O-S9", sql(
    "SELECT event_id FROM acc WHERE date_trunc('hour', ts) >= TIMESTAMP '2024-01-30 10:30:00' - INTERVAL 7 DAY"))
def _(c):
    return lake.retention_filter(c.accepted(), "ts", 7, "2024-01-30 10:30:00").select("event_id")


@register("hour_partitions", "O-S11", sql(
    "SELECT strftime(date_trunc('hour', ts), '%Y%m%d_%H') AS hour_partition, count(*) AS events FROM acc GROUP BY 1"))
def _(c):
    return lake.hour_partition(c.accepted(), "ts").groupBy("hour_partition").agg(F.count("*").alias("events"))


@register("segment_export", "O-S14", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000")
def _(c):
    import uuid

    from kinweave.plans.storage import working_dir
    path = f"{working_dir(c.spark)}/export-{uuid.uuid4().hex}"
    lake.export_segment(c.table("customer").where("c_mktsegment = 'BUILDING' and c_acctbal > 5000").select("c_custkey", "c_name"), path)
    return c.spark.read.option("header", "true").schema("c_custkey bigint, c_name string").csv(path)


@register("contact_checks", "O-V5 O-V6 O-V7 O-V13", wire_sql(r"""
SELECT eid, regexp_matches(w_email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$') AS email_ok,
  regexp_matches(trim(w_phone), '^\+?[0-9]+$') AS phone_ok, trim(w_phone) <> '' AS has_phone,
  CASE WHEN k = 21 THEN NULL ELSE trim(w_phone) END AS e164
FROM wire"""))
def _(c):
    t = c.tracking()
    k, u = F.col("k"), F.col("u").cast("string")
    t = t.withColumn("p", F.when(k == 21, "+84-bad").otherwise(F.concat(F.lit(" +849"), F.lpad(u, 8, "0"))))
    t = t.withColumn("e", F.when(k == 22, F.concat(F.lit("user"), u, F.lit("@"))).otherwise(
        F.concat(F.lit("user"), u, F.lit("@example.com"))))
    return t.select("eid", text.is_valid_email("e").alias("email_ok"), text.is_valid_basic_phone("p").alias("phone_ok"),
                    text.has_string_value("p").alias("has_phone"), text.normalize_phone_e164("p").alias("e164"))


@register("national_mobiles", "O-V13", """
SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN '+84' || substr('09' || (c_nationkey % 10) || lpad(CAST(c_custkey % 10000000 AS VARCHAR), 7, '0'), 2)
    ELSE '+84' || (c_nationkey % 10) || lpad(CAST(c_custkey % 10000000 AS VARCHAR), 8, '0') END AS e164,
  CASE WHEN c_nationkey % 2 = 0 THEN c_nationkey % 10 IN (6, 7, 8, 1, 4, 0, 3, 2, 9) ELSE
    ('0' || (c_nationkey % 10) || substr(lpad(CAST(c_custkey % 10000000 AS VARCHAR), 8, '0'), 1, 1)) IN
      ('096','097','098','032','033','034','035','036','037','038','039','091','094','081','082','083','084','085','088',
       '090','093','070','076','077','078','079','092','056','058','099','059') END AS is_mobile
FROM customer""")
def _(c):
    n, key = F.col("c_nationkey") % 10, F.col("c_custkey") % 10000000
    local = F.when(n % 2 == 0, F.concat(F.lit("09"), n, F.lit(" "), F.lpad(key.cast("string"), 7, "0"))).otherwise(
        F.concat(F.lit("84"), n, F.lit("-"), F.lpad(key.cast("string"), 8, "0")))
    return c.table("customer").select(
        "c_custkey", text.normalize_phone_e164(local).alias("e164"), text.is_vn_mobile(local).alias("is_mobile"))


@register("document_uuids", "O-V11", f"SELECT doc_id, {uuid5('text')} AS uuid FROM documents")
def _(c):
    return c.table("documents").select("doc_id", ids.uuid5_dns("text").alias("uuid"))


@register("sanitized_pages", "O-V8", "SELECT page_id, md5(" + ESC.format(
    r"regexp_replace(regexp_replace(html, '^\s+|\s+$', '', 'g'), '<script.*?>.*?</script>', '', 'gis')") + ") AS clean FROM pages")
def _(c):
    return c.table("pages").select("page_id", F.md5(text.sanitize_text("html").cast("binary")).alias("clean"))


@register("normalized_documents", "O-V14",
          r"SELECT doc_id, md5(trim(regexp_replace(lower(text), '\s+', ' ', 'g'))) AS norm FROM documents")
def _(c):
    return c.table("documents").select("doc_id", F.md5(text.normalize_text("text").cast("binary")).alias("norm"))


@register("page_campaigns", "O-V15", r"""
SELECT page_id, CASE WHEN regexp_matches(q, '(^|&)utm_source=') THEN url_decode(regexp_extract(q, '^(?:.*&)?utm_source=([^&]*)', 1)) END
  AS utmsource FROM (SELECT page_id, regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS q FROM pages)""")
def _(c):
    return c.table("pages").select("page_id", text.parse_utm("url")["utmsource"].alias("utmsource"))


@register("event_campaigns", "O-V15", sql(
    "SELECT 'src' || (k % 5) AS utmsource, 'camp ' || (k % 7) AS utmcampaign, count(*) AS events FROM acc GROUP BY 1, 2"))
def _(c):
    utm = c.accepted().select(text.parse_utm("tpurl").alias("x"))
    return utm.groupBy("x.utmsource", "x.utmcampaign").agg(F.count("*").alias("events"))


@register("event_classes", "O-V16", sql("""
SELECT CASE metric WHEN 'page-view' THEN 'view' WHEN 'click-details' THEN 'action' WHEN 'purchase' THEN 'conversion' END
    AS event_class, CASE WHEN metric = 'purchase' THEN 'USD' END AS currency, count(*) AS events,
  round(sum(CASE WHEN metric = 'purchase' THEN value END), 2) AS amount
FROM acc GROUP BY 1, 2"""))
def _(c):
    return ingest.event_taxonomy(c.accepted()).groupBy("event_class", "currency").agg(
        F.count("*").alias("events"), F.round(F.sum("transaction_value"), 2).alias("amount"))


@register("behavioral_ids", "O-V17 O-E1", sql(f"""
SELECT event_id AS source_event_id, sha256(metric || '|' || visid || '||' || {us('ts')} || '|' || tpurl || '|ua-' || d || '|' || session_id)
  AS id FROM acc"""))
def _(c):
    return c.events().select("source_event_id", "id")


@register("link_ids", "O-V18", sql("SELECT rid AS raw_profile_id, link_id FROM link"))
def _(c):
    return c.members().select("raw_profile_id", ids.link_id("raw_profile_id", "master_profile_id").alias("link_id"))


@register("masked_contacts", "O-V19", sql(r"""
SELECT rid AS raw_profile_id, regexp_replace(regexp_replace(regexp_replace(last_name, '[a-z]', 'x', 'g'), '[A-Z]', 'X', 'g'), '[0-9]', 'n', 'g')
  AS last_name, sha256(email) AS email FROM raw"""))
def _(c):
    return quality.mask_attributes(c.raw().select("raw_profile_id", "last_name", "email"), {"last_name": "mask", "email": "hash"})


@register("open_attributes", "O-V20 O-R13", sql(
    "SELECT rid AS raw_profile_id, segment, last_k = 'k1' AND segment = 'BUILDING' AS hit FROM raw"))
def _(c):
    return c.raw().select("raw_profile_id", C.ext_attr("ext_attributes", "segment").alias("segment"),
                          C.map_contains("ext_attributes", {"last_k": "k1", "segment": "BUILDING"}).alias("hit"))


@register("merged_attributes", "O-V21", sql(
    "SELECT rid AS raw_profile_id, 'k' || 'x' AS last_k, segment, city AS added, 2 + CASE WHEN city IS NULL THEN 0 ELSE 1 END AS n FROM raw"))
def _(c):
    right = F.when(F.col("city").isNotNull(), F.create_map(F.lit("last_k"), F.lit("kx"), F.lit("added"), F.col("city"))).otherwise(
        F.create_map(F.lit("last_k"), F.lit("kx")))
    m = c.raw().select("raw_profile_id", C.map_merge("ext_attributes", right).alias("m"))
    return m.select("raw_profile_id", C.ext_attr("m", "last_k").alias("last_k"), C.ext_attr("m", "segment").alias("segment"),
                    C.ext_attr("m", "added").alias("added"), F.size("m").alias("n"))


@register("appended_sets", "O-V22", sql("""
SELECT rid AS raw_profile_id, array_to_string(list_sort(list_distinct(list_filter([source_system, 'web', channel],
  lambda x: x IS NOT NULL AND x <> '' AND x <> 'CRM'))), ',') AS sources FROM raw"""))
def _(c):
    base = F.array("source_system", F.lit("web"))
    return c.raw().select("raw_profile_id", F.array_join(
        C.set_append(base, "last_known_channel", F.lit("CRM")), ",").alias("sources"))


@register("question_outcomes", "O-V23", """
SELECT conv_id, turn, CASE WHEN conv_id % 9 = 0 THEN 'empty_visitor' WHEN a.conv_id IS NULL THEN 'unknown_profile'
  WHEN length(q.text) > 1000 THEN 'too_long' ELSE 'accepted' END AS outcome
FROM conversations q LEFT JOIN (SELECT DISTINCT conv_id FROM conversations WHERE role = 'assistant') a USING (conv_id)
WHERE role = 'user'""")
def _(c):
    conv = c.table("conversations")
    visitor = F.when(F.col("conv_id") % 9 == 0, "").otherwise(F.concat(F.lit("v-"), "conv_id"))
    questions = conv.where("role = 'user'").select("conv_id", "turn", visitor.alias("visitor_id"),
                                                   F.col("text").alias("question"), F.lit("").alias("prompt"))
    known = conv.where("role = 'assistant'").select(F.concat(F.lit("v-"), "conv_id").alias("visitor_id"))
    return vectors.question_guard(questions, known).select("conv_id", "turn", "outcome")


@register("ingest_stamps", "O-V24", sql(
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS event_date, '2024-01-31 00:00:00' AS ingested_at FROM acc"))
def _(c):
    e = lake.enrich_ingest(c.accepted(), tables.AS_OF, "ts")
    return e.select("event_id", F.date_format("event_date", "yyyy-MM-dd").alias("event_date"),
                    F.date_format("ingested_at", SECOND).alias("ingested_at"))
