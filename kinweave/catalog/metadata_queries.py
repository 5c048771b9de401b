"""Queries of runs whose rules and survivorship come from an attribute metadata table."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinweave.catalog.registry import register
from kinweave.catalog.sql import sql, uuid5
from kinweave.operators import metadata
from kinweave.plans.tables import AS_OF

SCHEMA = ("id int, attribute_internal_code string, is_identity_resolution boolean, status string, matching_rule string, "
          "matching_threshold double, consolidation_rule string")

#: Matching by email, id map and last name; what else the rows carry is consolidated only. Some rows are inactive or unusable.
ATTRIBUTES = [
    (1, "email", True, "ACTIVE", "exact", None, "prefer_master"), (2, "phone_number", True, "INACTIVE", "exact", None, "non_null"),
    (3, "crm_source_id", True, "ACTIVE", "exact", None, "prefer_master"), (4, "last_name", True, "ACTIVE", "exact", None, "most_recent"),
    (5, "segment", False, "ACTIVE", "exact", None, "non_null"), (6, "city", False, "ACTIVE", "none", None, "concatenate"),
    (7, "country", False, "ACTIVE", None, None, "prefer_raw"), (8, "gender", False, "ACTIVE", None, None, "most_recent"),
    (9, "first_name", True, "ACTIVE", "fuzzy_trgm", None, "shortest"), (10, "web_visitor_id", True, "ACTIVE", "none", None, None),
]

#: Priorities differ from the built-in ones: id map, email, phone, then similar last names.
ORDERED_ATTRIBUTES = [
    (1, "crm_source_id", True, "ACTIVE", "exact", None, "prefer_master"), (2, "email", True, "ACTIVE", "exact", None, "non_null"),
    (3, "phone_number", True, "ACTIVE", "exact", None, "non_null"), (4, "last_name", True, "ACTIVE", "fuzzy_trgm", 0.8, "prefer_raw"),
]

CLUSTERS = f"""
, mkey AS (
  SELECT rid, tenant_id, 1 AS rule_id, lower(email) AS value FROM raw WHERE email <> ''
  UNION ALL SELECT rid, tenant_id, 3, source_system || '|' || crm_source_id FROM raw WHERE crm_source_id <> ''
  UNION ALL SELECT rid, tenant_id, 4, last_name FROM raw WHERE last_name <> ''),
medge AS (SELECT DISTINCT x.rid AS a, y.rid AS b FROM mkey x JOIN mkey y USING (tenant_id, rule_id, value)),
mreach(a, b) AS (SELECT rid, rid FROM raw UNION SELECT r.a, e.b FROM mreach r JOIN medge e ON e.a = r.b),
mroot AS (SELECT a AS rid, b AS root FROM (SELECT r.a, r.b, row_number() OVER (PARTITION BY r.a ORDER BY w.received_at, r.b) AS rn
  FROM mreach r JOIN raw w ON w.rid = r.b) WHERE rn = 1),
mmem AS (SELECT w.*, o.root, {uuid5("w.tenant_id || ':' || o.root")} AS mid, row_number() OVER (ORDER BY w.received_at, w.rid) AS seq
  FROM raw w JOIN mroot o USING (rid))"""


def _metadata(c, rows):
    return c.spark.createDataFrame(rows, SCHEMA)


def _resolved(c):
    return c.keep("by_metadata", lambda: metadata.resolve_by_metadata(c.raw(), _metadata(c, ATTRIBUTES), as_of=AS_OF))


@register("metadata_resolution", "O-I1 O-I15", sql(CLUSTERS + """
SELECT rid AS raw_profile_id, mid AS master_profile_id, CASE WHEN rid = root THEN 'NewMaster' ELSE 'DynamicMatch' END AS match_rule FROM mmem"""))
def _(c):
    return _resolved(c).links.select("raw_profile_id", "master_profile_id", "match_rule")


@register("metadata_golden_records", "O-I1 O-M9", sql(CLUSTERS + """
SELECT mid AS master_profile_id, tenant_id, count(*) AS member_rows,
  coalesce(arg_min(email, seq) FILTER (WHERE email <> ''), arg_min(email, seq)) AS email,
  arg_max(last_name, (ts, seq)) FILTER (WHERE last_name IS NOT NULL) AS last_name,
  arg_max(segment, seq) FILTER (WHERE segment IS NOT NULL) AS segment,
  coalesce(array_to_string(list_sort(list(DISTINCT city) FILTER (WHERE city <> '')), ','), '') AS city,
  arg_max(country, seq) FILTER (WHERE country IS NOT NULL) AS country,
  arg_max(gender, (ts, seq)) FILTER (WHERE gender IS NOT NULL) AS gender,
  CASE WHEN count(crm_source_id) > 0 THEN 'ecommerce=' || arg_min(crm_source_id, seq) FILTER (WHERE crm_source_id IS NOT NULL) END AS crm_ids
FROM mmem GROUP BY mid, tenant_id"""))
def _(c):
    golden = metadata.golden_by_metadata(_resolved(c), _metadata(c, ATTRIBUTES))
    entries = F.transform(F.map_entries("crm_source_id"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return golden.select("master_profile_id", "tenant_id", "member_rows", "email", "last_name", "segment", F.array_join("city", ",").alias("city"),
                         "country", "gender", F.array_join(entries, ",").alias("crm_ids"))


ORDERED_RUN = """
, word AS (SELECT n, unnest(string_split_regex(lower(n), '[^a-z0-9]+')) AS w FROM (SELECT DISTINCT last_name AS n FROM raw WHERE last_name <> '')),
gram AS (SELECT DISTINCT n, substr('  ' || w || ' ', i, 3) AS g FROM (SELECT n, w, unnest(range(1, length(w) + 2)) AS i FROM word WHERE w <> '')),
size AS (SELECT n, count(*) AS c FROM gram GROUP BY 1),
pair AS (SELECT x.n AS a, y.n AS b, count(*) AS c FROM gram x JOIN gram y USING (g) GROUP BY 1, 2),
near AS (SELECT a, list(b) AS names FROM pair JOIN size p ON p.n = a JOIN size q ON q.n = b WHERE pair.c / (p.c + q.c - pair.c) >= 0.8 - 1e-9 GROUP BY 1),
prow AS (SELECT row_number() OVER (ORDER BY received_at, rid) AS seq, rid, tenant_id, nullif(lower(email), '') AS e, nullif(phone_number, '') AS p,
    CASE WHEN crm_source_id <> '' THEN source_system || '|' || crm_source_id END AS c, nullif(last_name, '') AS n, coalesce(names, []) AS names
  FROM raw LEFT JOIN near ON a = last_name),
prun(seq, root, how, masters) AS (
  SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR),
    CAST([] AS STRUCT(root BIGINT, t VARCHAR, e VARCHAR, p VARCHAR, n VARCHAR, c VARCHAR[])[])
  UNION ALL SELECT seq, coalesce(by_c, by_e, by_p, by_n, seq), CASE WHEN by_c IS NOT NULL THEN 'crm_source_id' WHEN by_e IS NOT NULL THEN 'email'
      WHEN by_p IS NOT NULL THEN 'phone_number' WHEN by_n IS NOT NULL THEN 'last_name' ELSE 'new' END,
    CASE WHEN coalesce(by_c, by_e, by_p, by_n) IS NULL
      THEN list_append(masters, {'root': seq, 't': tenant_id, 'e': e, 'p': p, 'n': n, 'c': CASE WHEN c IS NULL THEN [] ELSE [c] END})
      ELSE list_transform(masters, lambda m: CASE WHEN m.root = coalesce(by_c, by_e, by_p, by_n) THEN {'root': m.root, 't': m.t, 'e': coalesce(m.e, e),
        'p': coalesce(m.p, p), 'n': coalesce(m.n, n), 'c': CASE WHEN c IS NULL THEN m.c ELSE list_append(m.c, c) END} ELSE m END) END
  FROM (SELECT r.*, u.masters, list_filter(u.masters, lambda m: m.t = r.tenant_id AND list_contains(m.c, r.c))[1].root AS by_c,
          list_filter(u.masters, lambda m: m.t = r.tenant_id AND m.e = r.e)[1].root AS by_e,
          list_filter(u.masters, lambda m: m.t = r.tenant_id AND m.p = r.p)[1].root AS by_p,
          list_filter(u.masters, lambda m: m.t = r.tenant_id AND list_contains(r.names, m.n))[1].root AS by_n
        FROM prun u JOIN prow r ON r.seq = u.seq + 1))
"""


@register("ordered_metadata_resolution", "O-I14 O-I1", sql(ORDERED_RUN + f"""
SELECT r.rid AS raw_profile_id, {uuid5("f.tenant_id || ':' || f.rid")} AS master_profile_id, how AS matched_attribute
FROM prow r JOIN prun u USING (seq) JOIN prow f ON f.seq = u.root"""))
def _(c):
    res = c.keep("ordered_by_metadata", lambda: metadata.resolve_by_metadata(
        c.raw(), _metadata(c, ORDERED_ATTRIBUTES), as_of=AS_OF, mode="ordered"))
    return res.links.select("raw_profile_id", "master_profile_id", "matched_attribute")
