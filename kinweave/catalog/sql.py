"""SQL side of the queries: the same derived tables as common table expressions over the given tables."""

from __future__ import annotations


def uuid5(expr: str) -> str:
    h = f"sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode({expr}))"
    return (f"(substr({h},1,8)||'-'||substr({h},9,4)||'-5'||substr({h},14,3)||'-'||translate(substr({h},17,1),"
            f"'0123456789abcdef','89ab89ab89ab89ab')||substr({h},18,3)||'-'||substr({h},21,12))")


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def us(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def cents(expr: str) -> str:
    """Round the printed decimal value half up, as Spark does."""
    return f"CAST(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,2)) AS DOUBLE)"


BASE = f"""
WITH RECURSIVE src AS (
  SELECT e.event_id AS eid, e.ts, e.user_id AS u, e.event_type, e.value, e.event_id % 4 AS d,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k,
         e.user_id - CASE WHEN e.user_id % 10 = 1 THEN 1 ELSE 0 END AS g,
         c.c_name AS last_name, c.c_mktsegment AS segment, n.n_name AS country
  FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
), t AS (
  SELECT eid, ts, u, d, k, g, value, event_type, last_name, segment, country, CAST(eid AS VARCHAR) AS event_id,
    't' || (g % 3) AS tenant_id, 'v-' || u || '-' || d AS visid,
    CASE event_type WHEN 'view' THEN 'page-view' WHEN 'click' THEN 'click-details' WHEN 'signup' THEN 'identify'
      WHEN 'purchase' THEN 'purchase' END AS metric,
    CASE WHEN d IN (0,2) THEN CASE WHEN eid % 8 >= 4 THEN upper('user' || u || '@example.com')
      ELSE 'user' || u || '@example.com' END END AS email,
    CASE WHEN d IN (1,2) THEN '+849' || lpad(CAST(g AS VARCHAR), 8, '0') END AS phone_number,
    CASE WHEN d = 3 AND u % 2 = 0 THEN 'crm-' || u END AS crm_source_id,
    CASE d WHEN 0 THEN 'websdk' WHEN 1 THEN 'CRM' WHEN 2 THEN 'mobileapp' ELSE 'ecommerce' END AS source_system,
    CASE WHEN k % 2 = 0 THEN CASE WHEN u % 2 = 0 THEN 'female' ELSE 'male' END ELSE 'unknown' END AS gender,
    CASE WHEN k % 3 <> 0 THEN 'city-' || (k % 10) END AS city,
    's-' || u || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
    'https://shop.example.com/' || event_type || '?utm_source=src' || (k % 5) || '&utm_campaign=camp%20' || (k % 7) AS tpurl,
    'camp ' || (k % 7) AS campaign, 'item-' || (k % 20) AS item_id, 'term ' || (k % 15) AS term, 1 + k % 10 AS rating,
    'obs-' || d AS observer_id, CASE WHEN d % 2 = 0 THEN 'web' ELSE 'app' END AS channel, 'dev-' || d AS device,
    CASE k % 4 WHEN 0 THEN 'joy' WHEN 1 THEN 'anger' END AS emotion
  FROM src
), acc AS (SELECT * FROM t WHERE metric IS NOT NULL
), raw AS (
  SELECT * EXCLUDE (rn), sha256(tenant_id || ':' || visid) AS rid, 'k' || (k % 6) AS last_k, ts AS received_at
  FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, visid ORDER BY ts DESC, eid DESC) AS rn FROM acc)
  WHERE rn = 1
), idkey AS (
  SELECT rid, received_at, tenant_id, 1 AS rule_id, 'email' AS attribute, lower(email) AS value FROM raw WHERE email <> ''
  UNION ALL SELECT rid, received_at, tenant_id, 2, 'phone_number', phone_number FROM raw WHERE phone_number <> ''
  UNION ALL SELECT rid, received_at, tenant_id, 5, 'crm_source_id', source_system || '|' || crm_source_id FROM raw
    WHERE crm_source_id <> ''
), edge AS (
  SELECT DISTINCT x.rid AS a, y.rid AS b FROM idkey x JOIN idkey y USING (tenant_id, rule_id, value)
), reach(a, b) AS (
  SELECT rid, rid FROM raw UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b
), root AS (
  SELECT a AS rid, b AS root FROM (SELECT r.a, r.b, row_number() OVER (PARTITION BY r.a ORDER BY w.received_at, r.b) AS rn
    FROM reach r JOIN raw w ON w.rid = r.b) WHERE rn = 1
), mem AS (
  SELECT w.*, o.root, {uuid5("w.tenant_id || ':' || o.root")} AS mid, row_number() OVER (ORDER BY w.received_at, w.rid) AS seq
  FROM raw w JOIN root o USING (rid)
), link AS (
  SELECT rid, mid, sha256(rid || ':' || mid) AS link_id, CASE WHEN rid = root THEN 'NewMaster' ELSE 'DynamicMatch' END AS rule
  FROM mem
), mast AS (
  SELECT mid, tenant_id,
    coalesce(arg_min(email, seq) FILTER (WHERE email <> ''), arg_min(email, seq)) AS email,
    coalesce(arg_min(phone_number, seq) FILTER (WHERE phone_number <> ''), arg_min(phone_number, seq)) AS phone_number,
    arg_max(last_name, seq) FILTER (WHERE last_name IS NOT NULL) AS last_name,
    arg_max(gender, seq) FILTER (WHERE gender IS NOT NULL) AS gender,
    arg_max(city, seq) FILTER (WHERE city IS NOT NULL) AS city,
    arg_max(country, seq) FILTER (WHERE country IS NOT NULL) AS country,
    arg_max(k, seq) AS last_comm_k, max(ts) AS last_seen_at, arg_max(observer_id, seq) AS last_seen_observer_id,
    arg_max(channel, seq) AS last_known_channel, arg_max(replace(tpurl, '&', '&amp;'), seq) AS last_url,
    min(root) AS first_rid, count(*) AS member_rows, max(seq) AS last_seq
  FROM mem GROUP BY mid, tenant_id
), owner AS (SELECT DISTINCT tenant_id, visid, mid FROM mem
), ev AS (
  SELECT a.*, o.mid FROM acc a LEFT JOIN owner o USING (tenant_id, visid)
), buy AS (
  SELECT p.*, o.mid FROM (
    SELECT o_orderkey, o_custkey, o_totalprice AS amount, CAST(o_orderdate AS DATE) AS day,
      't' || ((o_custkey - CASE WHEN o_custkey % 10 = 1 THEN 1 ELSE 0 END) % 3) AS tenant_id,
      'v-' || o_custkey || '-' || (o_orderkey % 4) AS visid FROM orders) p
  LEFT JOIN owner o USING (tenant_id, visid)
), sess AS (
  SELECT mid, count(*) AS total_sessions, CAST(sum(secs) AS BIGINT) AS session_seconds FROM (
    SELECT mid, session_id, date_sub('second', min(ts), max(ts)) AS secs FROM ev WHERE mid IS NOT NULL GROUP BY 1, 2)
  GROUP BY mid
), summ AS (
  SELECT mid, count(*) FILTER (WHERE metric = 'page-view') AS pv, count(*) FILTER (WHERE metric = 'click-details') AS cl
  FROM ev WHERE mid IS NOT NULL GROUP BY mid
), stats AS (
  SELECT mid, count(*) AS total_purchases, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_order_value, min(day) AS first_day, max(day) AS last_day
  FROM buy WHERE mid IS NOT NULL GROUP BY mid
), trend AS (
  SELECT mid,
    count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-16' AND ts < TIMESTAMP '2024-01-31')
      - count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-16') AS trend,
    count(*) FILTER (WHERE rating <= 2) AS complaints FROM ev WHERE mid IS NOT NULL GROUP BY mid
), late AS (
  SELECT mid, date_diff('day', max(day), DATE '2001-08-02') AS days_since_purchase,
    count(*) FILTER (WHERE day >= DATE '2001-05-04') AS purchases_90d FROM buy WHERE mid IS NOT NULL GROUP BY mid
), churn AS (
  SELECT mid, trend, complaints, days_since_purchase, purchases_90d, round(least(0.1::DOUBLE
      + CASE WHEN coalesce(days_since_purchase, 0) > 90 THEN 0.2 ELSE 0 END
      + CASE WHEN greatest(-coalesce(trend, 0), 0) > 10 THEN 0.2 ELSE 0 END
      + CASE WHEN coalesce(purchases_90d, 0) = 0 AND coalesce(days_since_purchase, 0) > 60 THEN 0.3 ELSE 0 END
      + CASE WHEN coalesce(complaints, 0) > 1 THEN 0.2 ELSE 0 END, 0.95), 4) AS churn_probability
  FROM trend FULL OUTER JOIN late USING (mid)
), score0 AS (
  SELECT m.*, s.total_sessions, s.session_seconds, st.total_purchases, st.avg_order_value, c.churn_probability,
    c.trend, c.complaints,
    CAST(floor(coalesce(su.pv, 0) * 1.0 + coalesce(su.cl, 0) * 2.0 + coalesce(s.session_seconds, 0) * 0.1::DOUBLE) AS INTEGER)
      AS engagement_score,
    CASE WHEN last_seen_at >= TIMESTAMP '2024-01-24' THEN 100 WHEN last_seen_at >= TIMESTAMP '2024-01-01' THEN 75
      WHEN last_seen_at >= TIMESTAMP '2023-11-02' THEN 50 WHEN last_seen_at >= TIMESTAMP '2023-08-04' THEN 25 ELSE 0 END
      AS recency_score,
    CASE WHEN st.total_purchases > 0 THEN {cents("""st.avg_order_value * CASE WHEN date_diff('day', first_day, last_day) <= 0
      THEN st.total_purchases::DOUBLE ELSE st.total_purchases / (date_diff('day', first_day, last_day) / 365.25::DOUBLE) END * 5""")}
      ELSE 0.0 END AS clv,
    CAST(round(((CASE WHEN coalesce(email,'')<>'' THEN 1 ELSE 0 END) + (CASE WHEN coalesce(phone_number,'')<>'' THEN 1 ELSE 0 END)
      + (CASE WHEN coalesce(last_name,'')<>'' THEN 1 ELSE 0 END) + (CASE WHEN coalesce(city,'')<>'' THEN 1 ELSE 0 END)
      + (CASE WHEN coalesce(country,'')<>'' THEN 1 ELSE 0 END) + (CASE WHEN coalesce(gender,'')<>'' THEN 1 ELSE 0 END))
      * 100.0 / 8, 0) AS INTEGER) AS data_quality_score
  FROM mast m LEFT JOIN sess s USING (mid) LEFT JOIN summ su USING (mid) LEFT JOIN stats st USING (mid)
    LEFT JOIN churn c USING (mid)
), score AS (
  SELECT *, CASE WHEN coalesce(total_purchases,0) >= 20 AND clv >= 10000000 THEN 'Platinum'
      WHEN coalesce(total_purchases,0) >= 10 AND clv >= 5000000 THEN 'Gold'
      WHEN coalesce(total_purchases,0) >= 5 AND clv >= 1000000 THEN 'Silver' ELSE 'Bronze' END AS loyalty_tier,
    CASE WHEN recency_score > 70 AND coalesce(total_sessions,0) > 20 THEN 85
      WHEN recency_score > 50 OR coalesce(total_sessions,0) > 10 THEN 50 ELSE 15 END AS lead_score
  FROM score0
), early AS (SELECT * FROM raw WHERE received_at < TIMESTAMP '2024-01-29'
), latr AS (SELECT * FROM raw WHERE received_at >= TIMESTAMP '2024-01-29'
), ekey AS (SELECT i.* FROM idkey i JOIN early USING (rid)
), eedge AS (SELECT DISTINCT x.rid AS a, y.rid AS b FROM ekey x JOIN ekey y USING (tenant_id, rule_id, value)
), ereach(a, b) AS (SELECT rid, rid FROM early UNION SELECT r.a, e.b FROM ereach r JOIN eedge e ON e.a = r.b
), eroot AS (
  SELECT a AS rid, b AS root, received_at AS created_at FROM (SELECT r.a, r.b, w.received_at, row_number() OVER (
    PARTITION BY r.a ORDER BY w.received_at, r.b) AS rn FROM ereach r JOIN raw w ON w.rid = r.b) WHERE rn = 1
), prior0 AS (
  SELECT w.*, o.root, o.created_at, {uuid5("w.tenant_id || ':' || o.root")} AS mid,
    row_number() OVER (ORDER BY w.received_at, w.rid) AS seq FROM early w JOIN eroot o USING (rid)
), prior AS (
  SELECT mid, tenant_id, min(created_at) AS created_at,
    arg_min(email, seq) FILTER (WHERE email <> '') AS email,
    arg_min(phone_number, seq) FILTER (WHERE phone_number <> '') AS phone_number,
    arg_max(last_name, seq) AS last_name, arg_max(city, seq) FILTER (WHERE city IS NOT NULL) AS city,
    arg_max(country, seq) AS country, arg_max(gender, seq) AS gender
  FROM prior0 GROUP BY mid, tenant_id
)
"""


def ordered(rows: str) -> str:
    """Views of the row-by-row process over ``rows`` (seq from 1, is_prior, id, tenant_id, e, p): one step of the recursion per row.

    ``olink``: seq, id, tenant_id, is_prior, root (seq of the founder), how.
    """
    same = "lambda m: m.t = r.tenant_id AND m.{0} = r.{0}"
    return f""", orow AS ({rows}), orun(seq, root, how, masters) AS (
  SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST([] AS STRUCT(root BIGINT, t VARCHAR, e VARCHAR, p VARCHAR)[])
  UNION ALL SELECT seq, coalesce(by_e, by_p, seq), CASE WHEN by_e IS NOT NULL THEN 'email' WHEN by_p IS NOT NULL THEN 'phone_number' ELSE 'new' END,
    CASE WHEN by_e IS NULL AND by_p IS NULL THEN list_append(masters, {{'root': seq, 't': tenant_id, 'e': e, 'p': p}})
      ELSE list_transform(masters, lambda m: CASE WHEN m.root = coalesce(by_e, by_p)
        THEN {{'root': m.root, 't': m.t, 'e': coalesce(m.e, e), 'p': coalesce(m.p, p)}} ELSE m END) END
  FROM (SELECT r.*, n.masters, CASE WHEN NOT r.is_prior THEN list_filter(n.masters, {same.format("e")})[1].root END AS by_e,
          CASE WHEN NOT r.is_prior THEN list_filter(n.masters, {same.format("p")})[1].root END AS by_p
        FROM orun n JOIN orow r ON r.seq = n.seq + 1)
), olink AS (SELECT r.*, o.root, o.how FROM orow r JOIN orun o USING (seq))"""


#: The staging rows in order, and their masters and golden values in ordered mode.
ORDERED = ordered("""SELECT row_number() OVER (ORDER BY received_at, rid) AS seq, false AS is_prior, rid AS id, tenant_id,
    nullif(lower(email), '') AS e, nullif(phone_number, '') AS p FROM raw""") + f""", omem AS (
  SELECT w.*, o.seq, o.how, o.root, {uuid5("w.tenant_id || ':' || f.id")} AS mid FROM olink o JOIN raw w ON w.rid = o.id JOIN olink f ON f.seq = o.root
), omast AS (
  SELECT mid, tenant_id,
    coalesce(arg_min(email, seq) FILTER (WHERE email <> ''), arg_min(email, seq)) AS email,
    coalesce(arg_min(phone_number, seq) FILTER (WHERE phone_number <> ''), arg_min(phone_number, seq)) AS phone_number,
    arg_max(last_name, seq) FILTER (WHERE last_name IS NOT NULL) AS last_name, arg_max(city, seq) FILTER (WHERE city IS NOT NULL) AS city,
    array_to_string(list_sort(list(DISTINCT source_system)), ',') AS source_systems, arg_max(rid, seq) AS last_rid, arg_min(rid, seq) AS first_rid
  FROM omem GROUP BY mid, tenant_id
), oval AS (
  SELECT DISTINCT mid AS master_profile_id, 'web_visitor' AS kind, visid AS value FROM omem
  UNION SELECT m.mid, 'secondary_email', m.email FROM omem m JOIN omast g USING (mid) WHERE m.email <> '' AND lower(m.email) <> lower(g.email)
  UNION SELECT m.mid, 'secondary_phone', m.phone_number FROM omem m JOIN omast g USING (mid) WHERE m.phone_number <> ''
    AND m.phone_number <> g.phone_number)
"""


def sql(body: str) -> str:
    return BASE + body
