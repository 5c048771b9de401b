"""Queries over behavioural events, scores and segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinweave.catalog.registry import register
from kinweave.catalog.sql import cents, sql
from kinweave.operators import behavior, scoring
from kinweave.plans.tables import AS_OF, PURCHASE_AS_OF

MASTER = "master_profile_id"


@register("stitched_events", "O-E1 O-E2", sql(
    "SELECT event_id AS source_event_id, metric AS event_name, mid AS master_profile_id, rating AS feedback_rating, item_id FROM ev"))
def _(c):
    return c.events().select("source_event_id", "event_name", MASTER, F.col("feedback_rating").cast("long").alias("feedback_rating"), "item_id")


@register("anonymous_purchases", "O-E2", sql(
    "SELECT mid IS NULL AS anonymous, count(*) AS orders FROM buy GROUP BY 1"))
def _(c):
    return c.purchases().groupBy(F.col(MASTER).isNull().alias("anonymous")).agg(F.count("*").alias("orders"))


@register("event_summary", "O-E3", sql(
    "SELECT mid AS master_profile_id, metric AS event_name, count(*) AS events FROM ev WHERE mid IS NOT NULL GROUP BY 1, 2"))
def _(c):
    return behavior.event_summary(c.events()).select(MASTER, F.explode("event_summary").alias("event_name", "events"))


@register("session_stats", "O-E4", sql("SELECT mid AS master_profile_id, total_sessions, session_seconds FROM sess"))
def _(c):
    return behavior.session_stats(c.events())


@register("idle_sessions", "O-E4", sql("""
, g AS (SELECT mid, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY mid ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh
  FROM ev WHERE mid IS NOT NULL),
n AS (SELECT mid, ts, sum(fresh) OVER (PARTITION BY mid ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM g),
s AS (SELECT mid, no, count(*) AS events, date_diff('microsecond', min(ts), max(ts)) // 1000000 AS secs FROM n GROUP BY 1, 2)
SELECT mid AS master_profile_id, count(*) AS total_sessions, max(events) AS longest_session_events, CAST(sum(secs) AS BIGINT) AS session_seconds
FROM s GROUP BY 1"""))
def _(c):
    return behavior.idle_sessions(c.events())


@register("purchase_stats", "O-E5", sql("""
SELECT mid AS master_profile_id, total_purchases, avg_order_value,
  strftime(first_day, '%Y-%m-%d') AS first_purchase_date, strftime(last_day, '%Y-%m-%d') AS last_purchase_date FROM stats"""))
def _(c):
    day = lambda x: F.date_format(x, "yyyy-MM-dd").alias(x)
    return behavior.purchase_stats(c.purchases()).select(
        MASTER, "total_purchases", "avg_order_value", day("first_purchase_date"), day("last_purchase_date"))


@register("funnel", "O-E6", sql("""
, f0 AS (SELECT mid, min(ts) AS t0 FROM ev WHERE mid IS NOT NULL AND metric = 'page-view' GROUP BY 1),
f1 AS (SELECT f0.mid, min(ts) AS t1 FROM f0 JOIN ev ON ev.mid = f0.mid AND metric = 'click-details' AND ts >= t0 GROUP BY 1),
f2 AS (SELECT f1.mid, min(ts) AS t2 FROM f1 JOIN ev ON ev.mid = f1.mid AND metric = 'identify' AND ts >= t1 GROUP BY 1),
f3 AS (SELECT f2.mid, min(ts) AS t3 FROM f2 JOIN ev ON ev.mid = f2.mid AND metric = 'purchase' AND ts >= t2 GROUP BY 1),
n AS (SELECT 1 AS step, 'page-view' AS event_name, count(*) AS masters FROM f0 UNION ALL SELECT 2, 'click-details', count(*) FROM f1
  UNION ALL SELECT 3, 'identify', count(*) FROM f2 UNION ALL SELECT 4, 'purchase', count(*) FROM f3)
SELECT step, event_name, masters, round(masters / (SELECT count(*) FROM f0)::DOUBLE, 6) AS conversion FROM n"""))
def _(c):
    return behavior.funnel(c.events(), ["page-view", "click-details", "identify", "purchase"])


@register("abandoned_carts", "O-E7", sql("""
SELECT a.event_id AS source_event_id, a.mid AS master_profile_id FROM ev a WHERE a.mid IS NOT NULL AND a.metric = 'click-details'
AND NOT EXISTS (SELECT 1 FROM ev b WHERE b.mid = a.mid AND b.metric = 'purchase' AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 24 HOUR)"""))
def _(c):
    return behavior.abandoned_carts(c.events(), "click-details", "purchase", 86400).select("source_event_id", MASTER)


@register("campaign_touches", "O-E8", sql("""
, b AS (SELECT event_id, mid, ts, value FROM ev WHERE mid IS NOT NULL AND metric = 'purchase'),
tch AS (SELECT event_id, mid, ts, campaign FROM ev WHERE mid IS NOT NULL AND metric <> 'purchase'),
j AS (SELECT b.event_id, b.mid, arg_min(tch.campaign, (tch.ts, tch.event_id)) AS first_campaign,
  arg_max(tch.campaign, (tch.ts, tch.event_id)) AS last_campaign FROM b JOIN tch ON tch.mid = b.mid AND tch.ts <= b.ts GROUP BY 1, 2)
SELECT b.event_id AS source_event_id, b.mid AS master_profile_id, b.value AS amount, first_campaign, last_campaign
FROM b LEFT JOIN j USING (event_id)"""))
def _(c):
    return behavior.campaign_touches(c.events())


@register("campaign_attribution", "O-E8", sql("""
, b AS (SELECT event_id, mid, ts, value FROM ev WHERE mid IS NOT NULL AND metric = 'purchase'),
tch AS (SELECT event_id, mid, ts, campaign FROM ev WHERE mid IS NOT NULL AND metric <> 'purchase'),
j AS (SELECT b.event_id, arg_min(tch.campaign, (tch.ts, tch.event_id)) AS first_campaign,
  arg_max(tch.campaign, (tch.ts, tch.event_id)) AS last_campaign FROM b JOIN tch ON tch.mid = b.mid AND tch.ts <= b.ts GROUP BY 1)
SELECT first_campaign, last_campaign, count(*) AS purchases, round(sum(value), 2) AS amount FROM b LEFT JOIN j USING (event_id) GROUP BY 1, 2"""))
def _(c):
    return behavior.campaign_attribution(c.events())


@register("segment_performance", "O-E9", sql("""
SELECT campaign, source_system AS source, device, grouping(campaign, source_system, device) AS level, count(*) AS events,
  count(DISTINCT mid) AS masters, count(*) FILTER (WHERE metric = 'purchase') AS purchases
FROM ev GROUP BY ROLLUP (campaign, source_system, device)"""))
def _(c):
    return behavior.segment_performance(c.events())


@register("product_affinity", "O-E10", sql("""
SELECT * FROM (SELECT mid AS master_profile_id, item_id, count(*) AS views, row_number() OVER (PARTITION BY mid ORDER BY count(*) DESC, item_id) AS rank
  FROM ev WHERE mid IS NOT NULL GROUP BY 1, 2) WHERE rank <= 3"""))
def _(c):
    return behavior.product_affinity(c.events(), 3)


@register("rating_summary", "O-E11", sql("""
SELECT item_id, count(*) AS ratings, round(avg(rating), 6) AS avg_rating,
  round((count(*) FILTER (WHERE rating >= 9) - count(*) FILTER (WHERE rating <= 6)) * 100.0::DOUBLE / count(*), 6) AS nps
FROM ev GROUP BY 1"""))
def _(c):
    return behavior.rating_summary(c.events())


@register("emotion_counts", "O-E11", sql(
    "SELECT emotion AS tag, count(*) AS events FROM ev WHERE emotion IS NOT NULL GROUP BY 1"))
def _(c):
    return behavior.tag_counts(c.events(), "emotion")


@register("search_terms", "O-E12", sql("""
SELECT * FROM (SELECT tenant_id, term, count(*) AS searches, row_number() OVER (PARTITION BY tenant_id ORDER BY count(*) DESC, term) AS rank
  FROM ev GROUP BY 1, 2) WHERE rank <= 5"""))
def _(c):
    return behavior.search_intent(c.events(), 5, ["tenant_id"])


@register("master_search_terms", "O-E12", sql("""
SELECT * FROM (SELECT mid AS master_profile_id, term, count(*) AS searches, row_number() OVER (PARTITION BY mid ORDER BY count(*) DESC, term) AS rank
  FROM ev WHERE mid IS NOT NULL GROUP BY 1, 2) WHERE rank <= 2"""))
def _(c):
    return behavior.search_intent(behavior.known(c.events()), 2, [MASTER])


@register("cart_sizes", "O-E13", """
SELECT CASE WHEN n <= 2 THEN 'small' WHEN n <= 5 THEN 'medium' ELSE 'large' END AS band, count(*) AS orders, round(avg(amount), 2) AS avg_amount
FROM (SELECT l_orderkey, count(*) AS n, sum(l_extendedprice * (1 - l_discount)) AS amount FROM lineitem GROUP BY 1) GROUP BY 1""")
def _(c):
    return behavior.cart_size_segments(c.table("lineitem"), "l_orderkey", F.col("l_extendedprice") * (1 - F.col("l_discount")))


@register("enriched_profiles", "O-E14", sql("""
SELECT mid AS master_profile_id, m.country, r.r_name AS region, c.c_acctbal AS account_balance FROM mast m
LEFT JOIN nation n ON n.n_name = m.country LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN customer c ON c.c_name = m.last_name"""))
def _(c):
    nation = c.table("nation").select(F.col("n_name").alias("country"), "n_regionkey")
    region = c.table("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    customer = c.table("customer").select(F.col("c_name").alias("last_name"), F.col("c_acctbal").alias("account_balance"))
    return behavior.enrich_profiles(c.golden(), [(nation, "country"), (region, "n_regionkey"), (customer, "last_name")]).select(
        MASTER, "country", "region", "account_balance")


@register("scored_profiles", "O-K1 O-K2 O-K3 O-K4 O-K5 O-K6 O-K8", sql("""
SELECT mid AS master_profile_id, engagement_score, recency_score, clv AS customer_lifetime_value, loyalty_tier, lead_score,
  churn_probability, data_quality_score FROM score"""))
def _(c):
    long = lambda x: F.col(x).cast("long").alias(x)
    return c.scored().select(MASTER, long("engagement_score"), long("recency_score"), "customer_lifetime_value", "loyalty_tier",
                             long("lead_score"), "churn_probability", long("data_quality_score"))


@register("customer_values", "O-K3 O-K4", """
WITH p AS (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS a, min(CAST(o_orderdate AS DATE)) AS f, max(CAST(o_orderdate AS DATE)) AS l
  FROM orders GROUP BY 1),
v AS (SELECT *, """ + cents("a * CASE WHEN date_diff('day', f, l) <= 0 THEN n::DOUBLE ELSE n / (date_diff('day', f, l) / 365.25::DOUBLE) END * 5") + """ AS clv FROM p)
SELECT o_custkey, clv, CASE WHEN n >= 20 AND clv >= 10000000 THEN 'Platinum' WHEN n >= 10 AND clv >= 5000000 THEN 'Gold'
  WHEN n >= 5 AND clv >= 1000000 THEN 'Silver' ELSE 'Bronze' END AS tier FROM v""")
def _(c):
    from kinweave.functions import scores
    p = behavior.purchase_stats(c.purchases(), "o_custkey")
    p = p.withColumn("clv", scores.clv("avg_order_value", "total_purchases", "first_purchase_date", "last_purchase_date", 5))
    return p.select("o_custkey", "clv", scores.loyalty_tier("total_purchases", "clv").alias("tier"))


@register("lead_model", "O-K5")
def _(c):
    scored = c.scored().withColumn("label", (F.coalesce("total_purchases", F.lit(0)) > 10).cast("int"))
    return scoring.lead_score_model(scored, ["recency_score", "total_sessions", "engagement_score", "data_quality_score"],
                                    "label", "lr-1", AS_OF).select(MASTER, "lead_score", "lead_score_model_version")


@register("next_best_actions", "O-K7", sql("""
, top AS (SELECT mid, item_id, row_number() OVER (PARTITION BY mid ORDER BY count(*) DESC, item_id) AS rn FROM ev WHERE mid IS NOT NULL GROUP BY 1, 2),
p AS (SELECT s.mid, s.loyalty_tier, a.item_id AS i1, b.item_id AS i2, s.total_sessions % 5 = 0 AS cart, s.country AS interest FROM score s
  LEFT JOIN top a ON a.mid = s.mid AND a.rn = 1 LEFT JOIN top b ON b.mid = s.mid AND b.rn = 2),
q AS (SELECT *, CASE i1 WHEN 'item-1' THEN 'item-2' WHEN 'item-3' THEN 'item-4' WHEN 'item-5' THEN 'item-6' END AS r1,
  CASE i2 WHEN 'item-1' THEN 'item-2' WHEN 'item-3' THEN 'item-4' WHEN 'item-5' THEN 'item-6' END AS r2,
  loyalty_tier IN ('Gold', 'Silver') AND interest IN ('NATION_1', 'NATION_2', 'NATION_3') AS rich FROM p),
w AS (SELECT *, list_filter([r1, r2, CASE WHEN cart THEN i1 WHEN rich THEN 'item-19' END], lambda x: x IS NOT NULL) AS got FROM q),
z AS (SELECT *, CASE WHEN len(got) > 1 AND got[1] = got[2] THEN [got[1]] || got[3:] ELSE got END AS g1 FROM w),
z2 AS (SELECT *, CASE WHEN len(g1) = 3 AND g1[3] IN (g1[1], g1[2]) THEN g1[1:2] ELSE g1 END AS g2 FROM z)
SELECT mid AS master_profile_id, CASE WHEN cart THEN 'cart_recovery_' || i1 WHEN rich THEN 'luxury' WHEN len(g2) = 0 THEN 'general_awareness' END AS campaign,
  CASE WHEN cart THEN 'complete_purchase' WHEN rich THEN 'explore_deals' WHEN len(g2) = 0 THEN 'learn_more' END AS cta,
  CASE WHEN NOT coalesce(cart, false) AND NOT coalesce(rich, false) AND len(g2) = 0 THEN 'item-0' ELSE array_to_string(g2[1:2], ',') END AS items
FROM z2"""))
def _(c):
    top = behavior.product_affinity(c.events(), 2)
    viewed = top.groupBy(MASTER).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "item_id"))),
                                                 lambda x: x["item_id"]).alias("last_viewed"))
    p = c.scored().join(viewed, MASTER, "left").select(
        MASTER, "loyalty_tier", "last_viewed", F.array("country").alias("interests"),
        (F.col("total_sessions") % 5 == 0).alias("cart_abandoned"), F.slice("last_viewed", 1, 1).alias("cart_items"))
    luxury = {"campaign": "luxury", "tiers": ("Gold", "Silver"), "interests": ("NATION_1", "NATION_2", "NATION_3"), "items": ("item-19",)}
    return scoring.next_best_action(
        p, [f"item-{i}" for i in range(20)], ["luxury"], {"item-1": "item-2", "item-3": "item-4", "item-5": "item-6"}, luxury,
        {"campaign": "general_awareness", "cta": "learn_more", "item": "item-0"}).withColumn(
        "items", F.array_join("product_recommendation", ",")).drop("product_recommendation")


@register("rfm_tiles", "O-K9", """
WITH b AS (SELECT o_custkey, date_diff('day', max(CAST(o_orderdate AS DATE)), DATE '2001-08-02') AS days, count(*) AS orders,
  round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY 1)
SELECT o_custkey, days, orders, amount, ntile(5) OVER (ORDER BY days DESC, o_custkey) AS r, ntile(5) OVER (ORDER BY orders, o_custkey) AS f,
  ntile(5) OVER (ORDER BY amount, o_custkey) AS m FROM b""")
def _(c):
    return scoring.rfm(c.purchases(), "o_custkey", PURCHASE_AS_OF).select(
        "o_custkey", F.col("days").cast("long").alias("days"), "orders", "amount", *[F.col(x).cast("long").alias(x) for x in "rfm"])


@register("engagement_frequency", "O-K10", sql("""
SELECT mid AS master_profile_id, count(*) AS events, count(DISTINCT CAST(ts AS DATE)) AS active_days,
  round(count(*) / count(DISTINCT CAST(ts AS DATE))::DOUBLE, 6) AS events_per_day FROM ev WHERE mid IS NOT NULL GROUP BY 1"""))
def _(c):
    return scoring.engagement_frequency(c.events())


@register("loyal_segment", "O-K11", sql(
    "SELECT mid AS master_profile_id FROM score WHERE churn_probability < 0.5 AND lead_score > 40 AND loyalty_tier <> 'Bronze'"))
def _(c):
    return scoring.segment(c.scored(), "churn_probability < 0.5 AND lead_score > 40 AND loyalty_tier <> 'Bronze'").select(MASTER)


@register("churn_features", "O-K12 O-K6", sql("""
SELECT mid AS master_profile_id, trend, complaints, days_since_purchase, purchases_90d, churn_probability FROM churn"""))
def _(c):
    f = scoring.churn_trend_features(c.events(), c.purchases(), AS_OF, purchase_as_of=PURCHASE_AS_OF)
    return scoring.add_churn(f).withColumn("days_since_purchase", F.col("days_since_purchase").cast("long"))


@register("trigger_audiences", "O-K13", sql("""
, cart AS (SELECT DISTINCT a.mid FROM ev a WHERE a.mid IS NOT NULL AND a.metric = 'click-details' AND NOT EXISTS (
    SELECT 1 FROM ev b WHERE b.mid = a.mid AND b.metric = 'purchase' AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 24 HOUR)),
rec AS (SELECT DISTINCT mid FROM ev WHERE mid IS NOT NULL AND metric = 'purchase' AND ts >= TIMESTAMP '2024-01-29'),
vw AS (SELECT DISTINCT mid FROM ev WHERE mid IS NOT NULL AND metric = 'page-view' AND ts >= TIMESTAMP '2024-01-29'),
aud AS (SELECT mid, 'abandoned_cart' AS audience FROM cart UNION ALL SELECT mid, 'post_purchase' FROM rec
  UNION ALL SELECT mid, 'retargeting' FROM vw WHERE mid NOT IN (SELECT mid FROM rec))
SELECT mid AS master_profile_id, audience, email, phone_number FROM aud JOIN mast USING (mid)
WHERE coalesce(email, '') <> '' OR coalesce(phone_number, '') <> ''"""))
def _(c):
    recent = behavior.known(c.events()).where("created_at >= timestamp_ntz'2024-01-29 00:00:00'")
    carts = behavior.abandoned_carts(c.events(), "click-details", "purchase", 86400)
    return scoring.trigger_audiences(c.golden(), carts, recent.where("event_name = 'purchase'"),
                                     recent.where("event_name = 'page-view'"), AS_OF)
