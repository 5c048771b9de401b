"""Reports and lookups over resolved tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kinweave.functions.scores import haversine_km
from kinweave.functions.text import has_string_value, normalize_text
from kinweave.operators.behavior import top_per_group
from kinweave.operators.jobs import side_by_side
from kinweave.plans.skew import lookup_join

MASTER = "master_profile_id"


def summary_report(raw: DataFrame, masters: DataFrame, links: DataFrame) -> DataFrame:
    """Masters, linked masters, raw rows, linked raw rows and unlinked raw rows in one row.

    Links are distinct per raw row, so both link figures and the anti join come from one read of each table.
    """
    unlinked = raw.join(links.select("raw_profile_id"), "raw_profile_id", "left_anti").agg(
        F.count("*").alias("unlinked_raw_profiles"))
    return side_by_side([
        masters.agg(F.count("*").alias("unique_master_profiles")),
        links.agg(F.count_distinct(MASTER).alias("unique_master_links"),
                  F.count_distinct("raw_profile_id").alias("unique_raw_links")),
        raw.agg(F.count("*").alias("total_raw_profiles")), unlinked,
    ])


def masters_with_duplicates(links: DataFrame) -> DataFrame:
    return links.groupBy(MASTER).count().where("count > 1").agg(F.count("*").alias("duplicate_masters"))


def duplicate_raws(links: DataFrame, masters: DataFrame) -> DataFrame:
    """Links whose raw row did not found the master."""
    return lookup_join(links, masters.select(MASTER, "first_seen_raw_profile_id"), MASTER).where(
        F.col("raw_profile_id") != F.col("first_seen_raw_profile_id")).select("raw_profile_id", MASTER)


def status_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("status_code").cast("long").alias("status_code")).agg(F.count("*").alias("rows"))


def total_web_visitors(identifiers: DataFrame) -> DataFrame:
    return identifiers.where("kind = 'web_visitor'").agg(F.count_distinct("value").alias("total_web_visitors"))


def linked_masters_same_tenant(masters: DataFrame, links: DataFrame, raw: DataFrame) -> DataFrame:
    return (
        lookup_join(links.select(MASTER, "raw_profile_id"), masters.select(MASTER, "tenant_id"), MASTER)
        .join(raw.select("raw_profile_id", F.col("tenant_id").alias("_t")), "raw_profile_id")
        .where(F.col("tenant_id") == F.col("_t")).agg(F.count_distinct(MASTER).alias("linked_masters"))
    )


def throughput(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Rows per time window."""
    return df.groupBy(F.window(ts, size).alias("w")).agg(F.count("*").alias("rows")).select(
        F.col("w.start").alias("window_start"), "rows")


def masters_created_with_aliases(masters: DataFrame, links: DataFrame, from_ts: str, to_ts: str) -> DataFrame:
    """Masters created in [from, to) and how many raw rows each holds."""
    new = masters.where((F.col("created_at") >= F.lit(from_ts).cast("timestamp_ntz"))
                        & (F.col("created_at") < F.lit(to_ts).cast("timestamp_ntz"))).select(MASTER)
    return links.groupBy(MASTER).agg(F.count("*").alias("raws")).join(new, MASTER)


def contactable_masters(masters: DataFrame) -> DataFrame:
    return masters.where(has_string_value("email") & has_string_value("phone_number"))


def order_value_by_master(purchases: DataFrame) -> DataFrame:
    return purchases.where(F.col(MASTER).isNotNull()).groupBy(MASTER).agg(
        F.count("*").alias("orders"), F.round(F.sum("amount"), 2).alias("order_value"))


# Direction of each ranking metric.
RANKINGS = {"lead_score": "desc", "customer_lifetime_value": "desc", "churn_probability": "asc",
            "data_quality_score": "desc", "updated_at": "desc", "created_at": "desc", "last_seen_at": "desc"}


def top_k_masters(masters: DataFrame, metric: str, k: int) -> DataFrame:
    """Best k masters per tenant, NULLs last."""
    c = F.col(metric)
    order = c.desc_nulls_last() if RANKINGS[metric] == "desc" else c.asc_nulls_last()
    return top_per_group(masters, ["tenant_id"], [order, F.asc(MASTER)], k)


def name_search(masters: DataFrame, tenant: str, last_name: str, first_name: str | None = None) -> DataFrame:
    hit = (F.col("tenant_id") == tenant) & (normalize_text("last_name") == " ".join(last_name.lower().split()))
    if first_name is not None:
        hit = hit & (normalize_text("first_name") == " ".join(first_name.lower().split()))
    return masters.where(hit)


def geo_radius(df: DataFrame, lat: float, lon: float, km: float) -> DataFrame:
    """Rows within a distance; a bounding box on latitude is pushed to the scan, longitude wraps in the exact test."""
    band = km / 111.0
    return df.where(F.col("latitude").between(lat - band, lat + band)).withColumn(
        "distance_km", haversine_km("latitude", "longitude", F.lit(lat), F.lit(lon))).where(F.col("distance_km") <= km)


def personas_by_region(masters: DataFrame, k: int, tags: str = "persona_tags", region: str = "country") -> DataFrame:
    counts = masters.select(region, F.explode(tags).alias("persona")).groupBy(region, "persona").agg(
        F.count("*").alias("profiles"))
    return top_per_group(counts, [region], [F.desc("profiles"), F.asc("persona")], k)


def churn_heatmap(masters: DataFrame, by: str = "loyalty_tier",
                  labels=("Bronze", "Silver", "Gold", "Platinum")) -> DataFrame:
    """Profiles per churn decile (rows) and tier (columns)."""
    bucket = F.floor(F.col("churn_probability") * 10 + F.lit(1e-9)).alias("churn_bucket")
    return masters.groupBy(bucket).pivot(by, list(labels)).agg(F.count(F.lit(1))).fillna(0)


def coverage(raw: DataFrame, links: DataFrame) -> DataFrame:
    """Linked rows per source and rule, and their share of the source's rows."""
    per = raw.select("raw_profile_id", "source_system").join(
        links.select("raw_profile_id", "match_rule"), "raw_profile_id", "left").groupBy("source_system", "match_rule").agg(
        F.count("*").alias("rows"))
    # One row per source and rule by now, so the window runs over a handful of rows.
    total = F.sum("rows").over(W.partitionBy("source_system"))
    return per.select("source_system", "match_rule", "rows", F.round(F.col("rows") / total, 6).alias("share"))


def customer_360_view(masters: DataFrame, *parts: DataFrame) -> DataFrame:
    """One wide row per master: golden record plus event, purchase and score aggregates."""
    for p in parts:
        masters = masters.join(p, MASTER, "left")
    return masters


def trend(events: DataFrame, grain: str, from_ts: str, to_ts: str, name: str = "event_name", ts: str = "created_at") -> DataFrame:
    """Counts per period and event, and the change against the period before."""
    kept = events.where((F.col(ts) >= F.lit(from_ts).cast("timestamp_ntz")) & (F.col(ts) < F.lit(to_ts).cast("timestamp_ntz")))
    per = kept.groupBy(F.date_trunc(grain, ts).cast("timestamp_ntz").alias("period"), name).agg(F.count("*").alias("events"))
    return per.withColumn("change", F.col("events") - F.lag("events").over(W.partitionBy(name).orderBy("period")))
