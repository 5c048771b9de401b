"""Hand rows of cleaning, identifiers, collections, trigrams and scores."""

import datetime as dt
import html
import random
import uuid

import pytest
from pyspark.sql import functions as F

from kinweave.functions import collections as C
from kinweave.functions import ids, scores, text, trigram


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r.x for r in df.select("i", expr(F.col("c")).alias("x")).orderBy("i").collect()]


def test_uuid5(spark):
    values = ["kinweave:tenant-7:row-42", "", "ü-漢字", "a" * 500]
    assert column(spark, values, ids.uuid5_dns) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, v)) for v in values]


def test_sanitize(spark):
    values = [" <script>x</script><b>\"a\"&'", "a<SCRIPT src=1>\nx\n</Script>b", "  plain \t", None, "<script>open"]
    want = ["&lt;b&gt;&quot;a&quot;&amp;&#x27;", "ab", "plain", None, html.escape("<script>open")]
    assert column(spark, values, text.sanitize_text) == want


def test_contact_checks(spark):
    emails = ["a@b.co", "a.b+c%d@x-y.org", "a@b", "@b.co", "a b@c.de", "", None]
    assert column(spark, emails, text.is_valid_email) == [True, True, False, False, False, False, False]
    phones = ["0975550148", "+84975550148", " 0985550163 ", "841275550199", "09755501486", "09a5550148", "+", "", None]
    assert column(spark, phones, text.is_valid_basic_phone) == [True] * 5 + [False] * 4
    assert column(spark, ["0975550148", "84975550148", "+84 97 555 0148", "12", None], text.normalize_phone_e164) == [
        "+84975550148", "+84975550148", "+84975550148", None, None]
    mobiles = ["+84975550148", "0385550148", "0955550148", "+84095550148", "08495550148", "095550148", "09555501489"]
    assert column(spark, mobiles, text.is_vn_mobile) == [True, True, False, False, False, False, False]


def test_blank_and_normal(spark):
    assert column(spark, [" \t\n", "　", " x ", "", None], text.has_string_value) == [False, False, True, False, False]
    assert column(spark, ["  Xin   CHÀO\n bạn "], text.normalize_text) == ["xin chào bạn"]


def test_query_parameters(spark):
    urls = ["https://x.y/?utm_source=a%20b&utm_medium=c", "https://x.y/?utm_source=a&utm_source=z", "https://x.y/#utm_source=q",
            "https://x.y/?xutm_source=q", "no url?utm_source=%zz", None]
    assert column(spark, urls, lambda c: text.query_value(c, "utm_source")) == ["a b", "z", None, None, "%zz", None]


def test_collections(spark):
    row = spark.sql("select map('a','1','b','2') as m, map('b','3') as n, array('x','y','') as v").select(
        C.map_merge("m", "n").alias("merged"), C.map_merge("m", F.lit(None).cast("map<string,string>")).alias("same"),
        C.set_append("v", F.lit("a"), F.lit("y")).alias("s"), C.contains_all("v", ["x", "y"]).alias("all"),
        C.contains_all("v", ["q"]).alias("none"), C.ext_attr("m", "zz").alias("gone")).first()
    assert row.merged == {"a": "1", "b": "3"} and row.same == {"a": "1", "b": "2"}
    assert row.s == ["a", "x"] and row["all"] and not row["none"] and row.gone is None


def test_trigram_formula(spark):
    df = spark.createDataFrame([("word", "two words"), ("Smith", "Smyth"), ("", ""), ("abc", "abc")], "a string, b string")
    got = [round(r[0], 4) for r in df.select(trigram.similarity(trigram.trigrams("a"), trigram.trigrams("b"))).collect()]
    assert got == [0.3636, 0.3333, 0.0, 1.0]


def test_engagement(spark):
    maps = [{"page_view": 15, "click": 5, "session_time": 300}, {"page_view": 10}, {}, None]
    assert column(spark, maps, scores.engagement_score, "map<string,long>") == [55, 10, 0, 0]


def test_recency(spark):
    now = dt.datetime(2025, 5, 15, 10)
    seen = [now - dt.timedelta(days=d) for d in (5, 25, 80, 150, 200)] + [None]
    assert column(spark, seen, lambda c: scores.recency_score(c, str(now)), "timestamp_ntz") == [100, 75, 50, 25, 0, 0]


def test_lifetime_value_and_tier(spark):
    rows = [(1.5e6, 10, dt.date(2022, 1, 15), dt.date(2024, 12, 15), 5), (5e5, 1, dt.date(2024, 1, 15), dt.date(2024, 1, 15), 3),
            (2e5, 3, dt.date(2024, 1, 1), dt.date(2024, 3, 1), 2), (None, 3, dt.date(2024, 1, 1), dt.date(2024, 3, 1), 2), (1.0, 0, None, None, 2)]
    df = spark.createDataFrame(rows, "a double, n int, f date, l date, y int")
    assert [r[0] for r in df.select(scores.clv("a", "n", "f", "l", "y")).collect()] == [25721830.99, 1500000.0, 7305000.0, 0.0, 0.0]
    tiers = spark.createDataFrame([(25, 12e6), (22, 6e6), (12, 3e6), (6, 5e5), (None, None)], "n int, v double")
    assert [r[0] for r in tiers.select(scores.loyalty_tier("n", "v")).collect()] == ["Platinum", "Gold", "Silver", "Bronze", "Bronze"]


def test_lead_and_churn(spark):
    df = spark.createDataFrame([(80, 25), (60, 15), (30, 5)], "r int, s int")
    assert [r[0] for r in df.select(scores.lead_score("r", "s")).collect()] == [85, 50, 15]
    df = spark.createDataFrame([(120, -15, 0, 2), (70, -5, 1, 1), (10, 5, 3, 0)], "d int, t int, f int, c int")
    assert [r[0] for r in df.select(scores.churn_probability("d", "t", "f", "c")).collect()] == [0.95, 0.1, 0.1]


def test_next_best_action(spark):
    from kinweave.operators.scoring import next_best_action
    rows = [("a", ["P789", "P123"], ["P789"], True, "Silver", ["du lịch biển"]), ("b", ["P001"], None, None, "Gold", ["du lịch biển"]),
            ("c", None, None, None, "Bronze", ["đọc sách"])]
    df = spark.createDataFrame(rows, "master_profile_id string, last_viewed array<string>, cart_items array<string>, "
                                     "cart_abandoned boolean, loyalty_tier string, interests array<string>")
    catalog = ["P123", "P456", "P789", "P790_bundle", "P_LUX01", "P_LUX02", "P_BESTSELLER1"]
    got = {r.master_profile_id: (r.campaign, r.cta, r.product_recommendation)
           for r in next_best_action(df, catalog, ["luxury_summer_deals"]).collect()}
    assert got == {"a": ("cart_recovery_P789", "complete_purchase", ["P790_bundle", "P456"]),
                   "b": ("luxury_summer_deals", "explore_deals", ["P_LUX01", "P_LUX02"]),
                   "c": ("general_awareness", "learn_more", ["P_BESTSELLER1"])}


@pytest.mark.parametrize("total", [0, 3, 17, 100])
def test_ntile_without_global_window(spark, total):
    from pyspark.sql import Window as W

    from kinweave.plans.ordering import add_ntile
    df = spark.createDataFrame([(i, random.Random(i).randrange(9)) for i in range(total)], "id long, v int")
    got = {r.id: r.t for r in add_ntile(df, [F.asc("v"), F.asc("id")], 5, "t", total).collect()}
    want = {r.id: r.t for r in df.withColumn("t", F.ntile(5).over(W.orderBy("v", "id"))).collect()}
    assert got == want


def test_time_lookups(spark):
    from kinweave.plans.asof import followed_within, gap_sessions, last_before
    rng = random.Random(3)
    marks = [(f"k{rng.randrange(3)}", rng.randrange(10**10), i, f"v{i}") for i in range(150)]
    points = [(f"k{rng.randrange(4)}", rng.randrange(10**10), i) for i in range(150)]
    m = spark.createDataFrame(marks, "k string, at long, tie long, value string")
    p = spark.createDataFrame(points, "k string, at long, pid long")
    got = {r.pid: r.value for r in last_before(p, m, "k", "pid", 60).collect()}
    want = {pid: max(((a, t, v) for kk, a, t, v in marks if kk == k and a <= at), default=(0, 0, None))[2] for k, at, pid in points}
    assert got == want
    got = {r.pid: r.followed for r in followed_within(p, m.select("k", "at"), "k", 120).collect()}
    want = {pid: any(kk == k and at <= a <= at + 120_000_000 for kk, a, _, _ in marks) for k, at, pid in points}
    assert got == want
    got = sorted((r.k, r.session_start, r.session_end, r.events) for r in gap_sessions(m, "k", 90).collect())
    want = []
    for k in sorted({x[0] for x in marks}):
        run = []
        for at in sorted(a for kk, a, _, _ in marks if kk == k):
            if run and at - run[-1] >= 90_000_000:
                want.append((k, run[0], run[-1], len(run)))
                run = []
            run.append(at)
        want.append((k, run[0], run[-1], len(run)))
    assert got == sorted(want)
