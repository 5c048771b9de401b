"""Queries over match rules, candidates and survivorship policies."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinweave.catalog.context import CRM, EMAIL, PHONE, RULES
from kinweave.catalog.registry import register
from kinweave.catalog.sql import sql, ts
from kinweave.config import Rule
from kinweave.operators import matching, similarity, survivorship

PAIR = ("SELECT rid AS raw_profile_id, mid AS master_profile_id, attribute AS matched_attribute FROM ("
        "SELECT *, row_number() OVER (PARTITION BY rid ORDER BY rule_id, created_at, mid) AS rn FROM cand) WHERE rn = 1")


def late_values(c, rules):
    return matching.raw_rule_values(c.early_late()[1], rules)


def prior_values(c, rules):
    return matching.master_rule_values(c.prior_masters(), rules)


def links_of(df):
    return df.select("raw_profile_id", "master_profile_id", "matched_attribute")


@register("rule_values", "O-I3", sql("SELECT rid AS raw_profile_id, attribute, value FROM idkey"))
def _(c):
    return matching.raw_rule_values(c.raw(), RULES).select("raw_profile_id", "attribute", "value")


@register("active_rule_rows", "O-I1 O-Q5", """
SELECT c_custkey AS id, c_name AS attribute_internal_code FROM customer
WHERE c_nationkey % 2 = 0 AND c_mktsegment = 'BUILDING' AND CASE WHEN c_nationkey % 3 = 0 THEN 'none' WHEN c_nationkey % 5 = 0 THEN NULL
  ELSE 'exact' END <> 'none'""")
def _(c):
    n = F.col("c_nationkey")
    metadata = c.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("attribute_internal_code"),
        (n % 2 == 0).alias("is_identity_resolution"),
        F.when(F.col("c_mktsegment") == "BUILDING", "ACTIVE").otherwise("INACTIVE").alias("status"),
        F.when(n % 3 == 0, "none").when(n % 5 != 0, "exact").alias("matching_rule"))
    return matching.active_rule_rows(metadata).select("id", "attribute_internal_code")


@register("email_match", "O-I4", sql("""
, cand AS (SELECT l.rid, 1 AS rule_id, 'email' AS attribute, p.created_at, p.mid FROM latr l JOIN prior p
  ON p.tenant_id = l.tenant_id AND lower(p.email) = lower(l.email)) """ + PAIR))
def _(c):
    found = matching.exact_match(late_values(c, [EMAIL]), matching.master_rule_values(c.prior_masters(), [EMAIL], secondary=False))
    return links_of(matching.pick_candidate(found))


@register("visitor_member_match", "O-I5", sql("""
, m AS (SELECT mid, tenant_id, list(DISTINCT visid) AS ids, min(created_at) AS created_at FROM prior0 GROUP BY 1, 2),
cand AS (SELECT a.rid, 4 AS rule_id, 'web_visitor_id' AS attribute, m.created_at, m.mid FROM raw a JOIN m
  ON m.tenant_id = a.tenant_id AND list_contains(m.ids, a.visid)) """ + PAIR))
def _(c):
    rule = Rule(4, "web_visitor_id", kind="array")
    arrays = c.keep("prior_arrays", lambda: survivorship.with_identifier_arrays(
        c.prior_masters(), _prior_identifiers(c)))
    return links_of(matching.pick_candidate(matching.exact_match(
        matching.raw_rule_values(c.raw(), [rule]), matching.master_rule_values(arrays, [rule]))))


def _prior_identifiers(c):
    from kinweave.operators import resolution
    early, _ = c.early_late()
    res = resolution.resolve_transitive(early, rules=RULES, as_of="2024-01-29 00:00:00")
    return survivorship.identifier_values(res.members, survivorship.golden_records(res.members, "2024-01-29 00:00:00"))


@register("crm_map_match", "O-I6", sql("""
, cand AS (SELECT a.rid, 5 AS rule_id, 'crm_source_id' AS attribute, p.created_at, p.mid FROM raw a
  JOIN prior0 b ON b.tenant_id = a.tenant_id AND b.source_system = a.source_system AND b.crm_source_id = a.crm_source_id
  JOIN prior p ON p.mid = b.mid) """ + PAIR))
def _(c):
    found = matching.exact_match(matching.raw_rule_values(c.raw(), [CRM]), prior_values(c, [CRM]))
    return links_of(matching.pick_candidate(found))


TRIGRAMS = """
, names AS (SELECT DISTINCT p_name AS n FROM part), brands AS (SELECT p_partkey, p_name AS n FROM part),
word AS (SELECT n, unnest(string_split_regex(lower(n), '[^a-z0-9]+')) AS w FROM names),
gram AS (SELECT DISTINCT n, substr('  ' || w || ' ', i, 3) AS g FROM word, LATERAL (SELECT unnest(generate_series(1, length(w) + 1)) AS i)
  WHERE w <> ''),
size AS (SELECT n, count(*) AS c FROM gram GROUP BY n),
pair AS (SELECT x.n AS a, y.n AS b, count(*) AS common FROM gram x JOIN gram y USING (g) GROUP BY 1, 2),
sim AS (SELECT a, b, common / (sa.c + sb.c - common)::DOUBLE AS s FROM pair JOIN size sa ON sa.n = a JOIN size sb ON sb.n = b)
"""


def part_names(c):
    """Parts as named raw rows and, from the other brand groups, as named masters."""
    part = c.table("part")
    rows = part.select(F.col("p_partkey").cast("string").alias("raw_profile_id"), F.lit("t").alias("tenant_id"),
                       F.col("p_name").alias("name"), "p_size")
    raw = matching.raw_rule_values(rows.where("p_size <= 25"), [Rule(1, "name", "fuzzy_trgm", 0.5)])
    masters = rows.where("p_size > 25").select(
        F.col("raw_profile_id").alias("master_profile_id"), "tenant_id", "name",
        F.col("raw_profile_id").cast("long").alias("created_at"))
    return raw, matching.master_rule_values(masters, [Rule(1, "name", "fuzzy_trgm", 0.5)])


@register("trigram_name_match", "O-I7", "WITH one AS (SELECT 1)" + TRIGRAMS + """
, m AS (SELECT p_name AS b, min(p_partkey) AS k FROM part WHERE p_size > 25 GROUP BY 1),
best AS (SELECT a, min(k) AS k FROM sim JOIN m USING (b) WHERE s >= 0.5 - 1e-9 GROUP BY a)
SELECT CAST(part.p_partkey AS VARCHAR) AS raw_profile_id, CAST(k AS VARCHAR) AS master_profile_id, round(s, 6) AS measure
FROM part JOIN best ON best.a = part.p_name JOIN part q ON q.p_partkey = k JOIN sim ON sim.a = part.p_name AND sim.b = q.p_name
WHERE part.p_size <= 25""")
def _(c):
    raw, masters = part_names(c)
    return similarity.trigram_match(raw, masters, 0.5).select("raw_profile_id", "master_profile_id", F.round("measure", 6).alias("measure"))


def soundex_sql(text: str) -> str:
    """American Soundex spelled out: H and W are skipped, other characters without a code part equal codes."""
    codes = f"translate(regexp_replace(upper({text}), '[^A-Z]', 'A', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230127022455012623017202')"
    runs = f"(CASE WHEN left({codes}, 1) = '7' THEN '0' ELSE left({codes}, 1) END || replace(substr({codes}, 2), '7', ''))"
    for d in range(7):
        runs = f"regexp_replace({runs}, '{d}+', '{d}', 'g')"
    return f"CASE WHEN regexp_matches({text}, '^[A-Za-z]') THEN upper(left({text}, 1)) || rpad(left(replace(substr({runs}, 2), '0', ''), 3), 3, '0') ELSE {text} END"


@register("phonetic_name_match", "O-I8", f"""
WITH r AS (SELECT p_partkey, {soundex_sql("p_name")} AS code, p_size FROM part WHERE p_name <> ''),
m AS (SELECT code, min(p_partkey) AS k FROM r WHERE p_size > 25 GROUP BY 1)
SELECT CAST(p_partkey AS VARCHAR) AS raw_profile_id, CAST(k AS VARCHAR) AS master_profile_id, 'phonetic_soundex' AS attribute
FROM r JOIN m USING (code) WHERE p_size <= 25""")
def _(c):
    raw, masters = part_names(c)
    return matching.phonetic_match(raw, masters).select("raw_profile_id", "master_profile_id", "attribute")


@register("edit_distance_match", "O-I9", """
WITH m AS (SELECT p_name AS b, min(p_partkey) AS k FROM part WHERE p_size > 25 GROUP BY 1),
r AS (SELECT DISTINCT p_name AS a FROM part WHERE p_size <= 25),
best AS (SELECT a, k, d FROM (SELECT a, k, levenshtein(a, b) AS d, row_number() OVER (PARTITION BY a ORDER BY levenshtein(a, b), k) AS rn
  FROM r, m WHERE levenshtein(a, b) <= 2) WHERE rn = 1)
SELECT CAST(p_partkey AS VARCHAR) AS raw_profile_id, CAST(k AS VARCHAR) AS master_profile_id, d AS measure
FROM part JOIN best ON a = p_name WHERE p_size <= 25""")
def _(c):
    raw, masters = part_names(c)
    return similarity.levenshtein_match(raw, masters, 2).select(
        "raw_profile_id", "master_profile_id", F.col("measure").cast("long").alias("measure"))


@register("composite_match", "O-I11", sql("""
, cand AS (SELECT l.rid, 1 AS rule_id, 'email' AS attribute, p.created_at, p.mid FROM latr l JOIN prior p
    ON p.tenant_id = l.tenant_id AND lower(p.email) = lower(l.email)
  UNION ALL SELECT l.rid, 2, 'phone_number+last_name', p.created_at, p.mid FROM latr l JOIN prior p
    ON p.tenant_id = l.tenant_id AND p.phone_number = l.phone_number AND p.last_name = l.last_name) """ + PAIR))
def _(c):
    return links_of(matching.composite_rule_match(
        c.early_late()[1], c.prior_masters(), [["email"], ["phone_number", "last_name"]]))


@register("candidate_pick", "O-I12", sql("""
, cand AS (SELECT l.rid, 1 AS rule_id, 'email' AS attribute, p.created_at, p.mid FROM latr l JOIN prior p
    ON p.tenant_id = l.tenant_id AND lower(p.email) = lower(l.email)
  UNION ALL SELECT l.rid, 2, 'phone_number', p.created_at, p.mid FROM latr l JOIN prior p
    ON p.tenant_id = l.tenant_id AND p.phone_number = l.phone_number) """ + PAIR))
def _(c):
    rules = [EMAIL, PHONE]
    found = matching.exact_match(late_values(c, rules), matching.master_rule_values(c.prior_masters(), rules, secondary=False))
    return links_of(matching.pick_candidate(found))


@register("cascade_match", "O-I24", sql("""
, a1 AS (SELECT l.rid, 1 AS rule_id, 'phone_number' AS attribute, p.created_at, p.mid FROM latr l JOIN prior p
    ON p.tenant_id = l.tenant_id AND p.phone_number = l.phone_number),
a2 AS (SELECT l.rid, 2 AS rule_id, 'email' AS attribute, p.created_at, p.mid FROM latr l JOIN prior p
    ON p.tenant_id = l.tenant_id AND lower(p.email) = lower(l.email) WHERE l.rid NOT IN (SELECT rid FROM a1)),
cand AS (SELECT * FROM a1 UNION ALL SELECT * FROM a2) """ + PAIR))
def _(c):
    rules = [PHONE, EMAIL]
    return links_of(matching.cascade_match(
        late_values(c, rules), matching.master_rule_values(c.prior_masters(), rules, secondary=False), rules))


WEIGHTS = {"email": 4.0, "phone_number": 3.0, "last_name": 2.5, "city": 1.0, "country": 0.5}


@register("weighted_match", "O-I25", sql("""
, pairs AS (SELECT l.rid, p.mid, p.created_at,
    CASE WHEN lower(l.email) = lower(p.email) THEN 4.0 ELSE 0 END + CASE WHEN l.phone_number = p.phone_number THEN 3.0 ELSE 0 END
    + CASE WHEN l.last_name = p.last_name THEN 2.5 ELSE 0 END + CASE WHEN l.city = p.city THEN 1.0 ELSE 0 END
    + CASE WHEN l.country = p.country THEN 0.5 ELSE 0 END AS score
  FROM latr l JOIN prior p ON p.tenant_id = l.tenant_id)
SELECT rid AS raw_profile_id, mid AS master_profile_id, CAST(score AS DOUBLE) AS score FROM (SELECT *, row_number() OVER (
  PARTITION BY rid ORDER BY score DESC, created_at, mid) AS rn FROM pairs WHERE score >= 3.5) WHERE rn = 1"""))
def _(c):
    return matching.probabilistic_match(c.early_late()[1], c.prior_masters(), WEIGHTS, 3.5).select(
        "raw_profile_id", "master_profile_id", "score")


@register("guarded_match", "O-I23", sql("""
, pairs AS (SELECT l.rid, p.mid, p.created_at,
    CASE WHEN lower(l.email) <> lower(p.email) THEN 1 ELSE 0 END + CASE WHEN l.last_name <> p.last_name THEN 1 ELSE 0 END
    + CASE WHEN l.city <> p.city THEN 1 ELSE 0 END AS conflicts
  FROM latr l JOIN prior p ON p.tenant_id = l.tenant_id AND p.country = l.country)
SELECT rid AS raw_profile_id, mid AS master_profile_id FROM (SELECT *, row_number() OVER (
  PARTITION BY rid ORDER BY created_at, mid) AS rn FROM pairs WHERE conflicts <= 1) WHERE rn = 1"""))
def _(c):
    return matching.merge_guard(c.early_late()[1], c.prior_masters(), "country", ["email", "last_name", "city"], 1).select(
        "raw_profile_id", "master_profile_id")


# Survivorship policies, one query each.

def _policy(name, ops, column, policy, body):
    @register(name, ops, sql(body))
    def _(c):
        return survivorship.consolidate(c.members(), {column: policy}).select(
            "master_profile_id", F.col(column).alias("value"))


_policy("newest_city", "O-M1", "city", "prefer_raw",
        "SELECT mid AS master_profile_id, arg_max(city, seq) FILTER (WHERE city IS NOT NULL) AS value FROM mem GROUP BY 1")
_policy("primary_email", "O-M2", "email", "prefer_master",
        "SELECT mid AS master_profile_id, arg_min(email, seq) FILTER (WHERE email <> '') AS value FROM mem GROUP BY 1")
_policy("recent_channel", "O-M9", "last_known_channel", "most_recent",
        "SELECT mid AS master_profile_id, arg_max(channel, seq) AS value FROM mem GROUP BY 1")


@register("secondary_values", "O-M3", sql("""
SELECT DISTINCT mid AS master_profile_id, kind, value FROM (
  SELECT m.mid, 'secondary_email' AS kind, m.email AS value FROM mem m JOIN mast g USING (mid) WHERE m.email <> ''
    AND lower(m.email) <> lower(g.email)
  UNION ALL SELECT m.mid, 'secondary_phone', m.phone_number FROM mem m JOIN mast g USING (mid) WHERE m.phone_number <> ''
    AND m.phone_number <> g.phone_number)"""))
def _(c):
    return c.identifiers().where("kind <> 'web_visitor'")


@register("latest_touch", "O-M4 O-M5", sql(f"""
SELECT mid AS master_profile_id, last_seen_observer_id, last_known_channel, last_url AS last_seen_touchpoint_url,
  {ts('last_seen_at')} AS last_seen_at FROM mast"""))
def _(c):
    return c.golden().select("master_profile_id", "last_seen_observer_id", "last_known_channel", "last_seen_touchpoint_url",
                             F.date_format("last_seen_at", "yyyy-MM-dd HH:mm:ss").alias("last_seen_at"))


@register("source_sets", "O-M6", sql("""
SELECT mid AS master_profile_id, array_to_string(list_sort(list(DISTINCT source_system)), ',') AS source_systems FROM mem GROUP BY 1"""))
def _(c):
    return c.golden().select("master_profile_id", F.array_join("source_systems", ",").alias("source_systems"))


@register("visitor_sets", "O-M6", sql("SELECT DISTINCT mid AS master_profile_id, visid AS value FROM mem"))
def _(c):
    return c.identifiers().where("kind = 'web_visitor'").select("master_profile_id", "value")


@register("crm_id_maps", "O-M7", sql("""
SELECT mid AS master_profile_id, source_system, arg_max(crm_source_id, seq) AS crm_id FROM mem WHERE crm_source_id IS NOT NULL
GROUP BY 1, 2"""))
def _(c):
    return c.golden().select("master_profile_id", F.explode("crm_contact_ids").alias("source_system", "crm_id"))


@register("merged_open_attributes", "O-M8", sql("""
SELECT mid AS master_profile_id, arg_max(segment, seq) AS segment, arg_max(last_k, seq) AS last_k FROM mem GROUP BY 1"""))
def _(c):
    return c.golden().select("master_profile_id", F.col("ext_attributes")["segment"].alias("segment"),
                             F.col("ext_attributes")["last_k"].alias("last_k"))


@register("new_masters", "O-M10 O-M11", sql("""
SELECT mid AS master_profile_id, tenant_id, first_rid AS first_seen_raw_profile_id, 10 AS status_code,
  '2024-01-31 00:00:00' AS updated_at FROM (SELECT mid, tenant_id, arg_min(rid, seq) AS first_rid FROM mem GROUP BY 1, 2)"""))
def _(c):
    return c.golden().select("master_profile_id", "tenant_id", "first_seen_raw_profile_id",
                             F.col("status_code").cast("long").alias("status_code"),
                             F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))


@register("golden_records", "O-M1 O-M2 O-M4 O-M5", sql("""
SELECT mid AS master_profile_id, tenant_id, email, phone_number, last_name, gender, city, country, member_rows FROM mast"""))
def _(c):
    return c.golden().select("master_profile_id", "tenant_id", "email", "phone_number", "last_name", "gender", "city",
                             "country", "member_rows")
