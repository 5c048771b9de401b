"""Behavioural events: stitching to masters, summaries, funnels, carts, attribution, affinity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kinweave.config import EVENT_CLASSES
from kinweave.functions.ids import event_id_hash
from kinweave.plans.asof import followed_within, gap_sessions, last_before, micros
from kinweave.plans.skew import lookup_join

MASTER = "master_profile_id"


def events_to_behavioral(df: DataFrame) -> DataFrame:
    """Tracking documents as behavioural events; duplicates by content hash are removed."""
    payload = lambda key: F.try_element_at(F.col("event_payload"), F.lit(key))
    classes = F.create_map(*[F.lit(x) for pair in EVENT_CLASSES.items() for x in pair])
    used = ("item_id", "rating", "emotion")
    out = df.select(
        F.col("metric").alias("event_name"),
        F.coalesce(F.try_element_at(classes, F.col("metric")), F.lit("behavioral")).alias("event_type"),
        F.col("datetime").cast("timestamp_ntz").alias("created_at"),
        F.try_element_at(F.col("profile_traits"), F.lit("source_system")).alias("source_system"),
        "tenant_id", F.col("visid").alias("web_visitor_id"), F.lit(None).cast("string").alias(MASTER),
        F.col("sessionid").alias("session_id"), "mediahost", F.col("tpurl").alias("web_url"),
        payload("rating").try_cast("int").alias("feedback_rating"), payload("emotion").alias("emotion"),
        payload("item_id").alias("item_id"), "user_agent", "device", "utmdata",
        F.map_filter(F.coalesce("event_payload", F.expr("cast(map() as map<string,string>)")),
                     lambda k, _: ~k.isin(*used)).alias("metadata"), F.col("event_id").alias("source_event_id"),
    )
    stamp = F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return out.withColumn("id", event_id_hash(
        "event_name", "web_visitor_id", MASTER, stamp, "web_url", "user_agent", "session_id")).dropDuplicates(["id"])


def visitor_owner(links_raw: DataFrame) -> DataFrame:
    """(tenant_id, web_visitor_id) -> master, one row per visitor."""
    return links_raw.groupBy("tenant_id", "web_visitor_id").agg(F.min(MASTER).alias(MASTER))


def stitch_events(events: DataFrame, owners: DataFrame, rows: int | None = None) -> DataFrame:
    """Set the master of each event; unknown visitors and deleted masters give NULL."""
    rows = events.count() if rows is None else rows
    return lookup_join(events.drop(MASTER), owners, ["tenant_id", "web_visitor_id"], rows)


def known(events: DataFrame) -> DataFrame:
    return events.where(F.col(MASTER).isNotNull())


def event_summary(events: DataFrame) -> DataFrame:
    """{event name: count} per master; the map holds one entry per event name."""
    counts = known(events).groupBy(MASTER, "event_name").count()
    return counts.groupBy(MASTER).agg(F.map_from_entries(
        F.array_sort(F.collect_list(F.struct("event_name", "count")))).alias("event_summary"))


def session_stats(events: DataFrame) -> DataFrame:
    """Sessions and their summed length in seconds per master."""
    per = known(events).groupBy(MASTER, "session_id").agg(
        F.min("created_at").alias("lo"), F.max("created_at").alias("hi"))
    return per.groupBy(MASTER).agg(
        F.count("*").alias("total_sessions"), F.sum(F.timestamp_diff("SECOND", "lo", "hi")).alias("session_seconds"))


def idle_sessions(events: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Sessions of masters whose events carry no session id, split by idle gaps."""
    per = gap_sessions(known(events).select(MASTER, micros("created_at").alias("at")), MASTER, gap_seconds)
    return per.groupBy(MASTER).agg(
        F.count("*").alias("total_sessions"), F.max("events").alias("longest_session_events"),
        F.sum(F.expr("(session_end - session_start) div 1000000")).alias("session_seconds"))


def purchase_stats(purchases: DataFrame, key: str = MASTER) -> DataFrame:
    """Purchases, average value and first and last day. Cents are summed exactly, so row order does not matter."""
    total = F.sum(F.col("amount").cast("decimal(18,2)")).cast("double")
    return purchases.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("*").alias("total_purchases"), (total / F.count("*")).alias("avg_order_value"),
        F.min("day").alias("first_purchase_date"), F.max("day").alias("last_purchase_date"))


def funnel(events: DataFrame, steps: list[str]) -> DataFrame:
    """Masters reaching each step after the one before it, and the conversion from the first step."""
    base = known(events).where(F.col("event_name").isin(*steps)).select(MASTER, "event_name", "created_at")
    rows = events.count()
    reached = base.where(F.col("event_name") == steps[0]).groupBy(MASTER).agg(F.min("created_at").alias("t0"))
    table = reached
    for i, step in enumerate(steps[1:], 1):
        before = table.select(MASTER, F.col(f"t{i-1}").alias("_prev"))
        nxt = lookup_join(base.where(F.col("event_name") == step), before, MASTER, rows).where(
            F.col("created_at") >= F.col("_prev")).groupBy(MASTER).agg(F.min("created_at").alias(f"t{i}"))
        table = table.join(nxt, MASTER, "left")
    counts = table.agg(*[F.count(f"t{i}").alias(f"c{i}") for i in range(len(steps))])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(s).alias("event_name"), F.col(f"c{i}").alias("masters"),
                              F.round(F.try_divide(F.col(f"c{i}"), F.col("c0")), 6).alias("conversion"))
                     for i, s in enumerate(steps)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def abandoned_carts(events: DataFrame, cart: str, bought: str, window_seconds: int) -> DataFrame:
    """Cart events without a purchase of the same master within the window."""
    timed = known(events).withColumn("at", micros("created_at"))
    carts = timed.where(F.col("event_name") == cart)
    buys = timed.where(F.col("event_name") == bought).select(MASTER, "at")
    return followed_within(carts, buys, MASTER, window_seconds).where(~F.col("followed")).drop("followed", "at")


def campaign_touches(events: DataFrame, bought: str = "purchase") -> DataFrame:
    """Every purchase with the first and the last campaign its master touched before."""
    timed = known(events).select(MASTER, "source_event_id", "event_name", micros("created_at").alias("at"),
                                 F.col("utmdata.utmcampaign").alias("campaign"), "metadata")
    buys = timed.where(F.col("event_name") == bought)
    touches = timed.where((F.col("event_name") != bought) & F.col("campaign").isNotNull())
    first = touches.groupBy(MASTER).agg(F.min(F.struct("at", "source_event_id", "campaign")).alias("f"))
    last = last_before(buys.select(MASTER, "source_event_id", "at"),
                       touches.select(MASTER, "at", F.col("source_event_id").alias("tie"), F.col("campaign").alias("value")),
                       MASTER, "source_event_id")
    value = F.try_element_at(F.col("metadata"), F.lit("transaction_value")).try_cast("double")
    return (
        lookup_join(buys, first, MASTER, events.count()).join(last.withColumnRenamed("value", "last_campaign"), "source_event_id", "left")
        .select("source_event_id", MASTER, F.coalesce(value, F.lit(0.0)).alias("amount"),
                F.when(F.col("f.at") <= F.col("at"), F.col("f.campaign")).alias("first_campaign"), "last_campaign")
    )


def campaign_attribution(events: DataFrame, bought: str = "purchase") -> DataFrame:
    """Purchases and value per first and last campaign."""
    return campaign_touches(events, bought).groupBy("first_campaign", "last_campaign").agg(
        F.count("*").alias("purchases"), F.round(F.sum("amount"), 2).alias("amount"))


def segment_performance(events: DataFrame) -> DataFrame:
    """Events, masters and purchases by campaign, source and device with all subtotals."""
    return events.select(F.col("utmdata.utmcampaign").alias("campaign"), F.col("source_system").alias("source"), "device",
                         "event_name", MASTER).rollup("campaign", "source", "device").agg(
        F.grouping_id().cast("long").alias("level"), F.count("*").alias("events"),
        F.count_distinct(MASTER).alias("masters"), F.count_if(F.col("event_name") == "purchase").alias("purchases"))


def top_per_group(counts: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """k best rows per group; Spark keeps only k rows per group and task before the shuffle."""
    w = W.partitionBy(*group).orderBy(*order)
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def product_affinity(events: DataFrame, k: int) -> DataFrame:
    """Items a master looked at most."""
    counts = known(events).where(F.col("item_id").isNotNull()).groupBy(MASTER, "item_id").agg(F.count("*").alias("views"))
    return top_per_group(counts, [MASTER], [F.desc("views"), F.asc("item_id")], k)


def search_intent(events: DataFrame, k: int, by: list[str]) -> DataFrame:
    """Most frequent search terms per group of columns."""
    term = F.try_element_at(F.col("metadata"), F.lit("term"))
    counts = events.withColumn("term", term).where("term is not null").groupBy(*by, "term").agg(
        F.count("*").alias("searches"))
    return top_per_group(counts, by, [F.desc("searches"), F.asc("term")], k)


def rating_summary(events: DataFrame) -> DataFrame:
    """Average rating and net promoter score per item."""
    r = F.col("feedback_rating")
    return events.where(r.isNotNull() & F.col("item_id").isNotNull()).groupBy("item_id").agg(
        F.count("*").alias("ratings"), F.round(F.avg(r), 6).alias("avg_rating"),
        F.round((F.count_if(r >= 9) - F.count_if(r <= 6)) * 100.0 / F.count("*"), 6).alias("nps"))


def tag_counts(events: DataFrame, column: str) -> DataFrame:
    """How often each tag (a text or an array of texts) occurs."""
    tags = F.explode(column) if events.schema[column].dataType.typeName() == "array" else F.col(column)
    return events.select(tags.alias("tag")).where("tag is not null").groupBy("tag").agg(F.count("*").alias("events"))


# Upper bounds of the cart bands.
CART_BANDS = ((2, "small"), (5, "medium"))


def cart_size_segments(lines: DataFrame, order: str, amount: Column) -> DataFrame:
    """Orders by number of lines, with their value."""
    per = lines.groupBy(order).agg(F.count("*").alias("lines"), F.sum(amount).alias("amount"))
    band = None
    for upper, label in CART_BANDS:
        cond = F.col("lines") <= upper
        band = F.when(cond, label) if band is None else band.when(cond, label)
    return per.groupBy(band.otherwise("large").alias("band")).agg(
        F.count("*").alias("orders"), F.round(F.avg("amount"), 2).alias("avg_amount"))


def enrich_profiles(masters: DataFrame, lookups: list[tuple[DataFrame, str]]) -> DataFrame:
    """Left-join lookup tables one after the other; Spark broadcasts those it knows to be small."""
    for table, key in lookups:
        masters = masters.join(table, key, "left")
    return masters
