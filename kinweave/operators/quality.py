"""Data-quality and governance jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.config import DELETE
from kinweave.functions.text import mask_value
from kinweave.plans.skew import lookup_join
from kinweave.schema import RAW_LENGTHS

# Allowed values of constrained columns.
GENDERS = ("male", "female", "unknown", "other")


def raw_rules() -> dict[str, Column]:
    """Violation conditions of the staging table."""
    rules = {
        "gender": ~F.col("gender").isin(*GENDERS),
        "status_code": ~F.col("status_code").between(-1, 3),
        "tenant_id_null": F.col("tenant_id").isNull(),
        "web_visitor_id_null": F.col("web_visitor_id").isNull(),
    }
    rules |= {f"length_{c}": F.length(c) > n for c, n in RAW_LENGTHS.items()}
    return rules


def event_rules() -> dict[str, Column]:
    return {"feedback_rating": ~F.col("feedback_rating").between(1, 10), "event_name_null": F.col("event_name").isNull(),
            "session_id_null": F.col("session_id").isNull(), "web_url_null": F.col("web_url").isNull()}


def master_rules() -> dict[str, Column]:
    return {"status_code": ~F.col("status_code").between(-1, 10)}


def constraint_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violations per rule in one pass over the table."""
    names = list(rules)
    counts = df.agg(*[F.count_if(rules[n]).alias(f"_{i}") for i, n in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"_{i}").alias("violations")) for i, n in enumerate(names)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def uniqueness_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def referential_report(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose (non-NULL) key has no parent."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key).distinct(), key, "left_anti")


def unique_identifier_monitor(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct identifiers; approximate counts also work on streams."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(c).alias(f"distinct_{c}") for c in columns])


def sync_metadata(current: DataFrame, incoming: DataFrame, key: str = "attribute_internal_code") -> DataFrame:
    """Upsert attribute definitions; ids of known attributes stay."""
    from kinweave.operators.ingest import upsert
    return upsert(current, incoming, [key], ["id"])


def required_attribute_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of rows with a value, per required attribute."""
    filled = df.agg(*[F.round(F.avg(F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", 1.0).otherwise(0.0)), 6)
                      .alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).alias("completeness")) for c in columns])
    return filled.select(F.explode(rows).alias("r")).select("r.*")


def lineage(links: DataFrame, raw: DataFrame, masters: DataFrame) -> DataFrame:
    """Every raw row behind a master with source and rule: rows, so a large master needs no large array."""
    raws = links.join(raw.select("raw_profile_id", "source_system", "web_visitor_id", "received_at"), "raw_profile_id")
    return (
        lookup_join(raws, masters.select("master_profile_id", "first_seen_raw_profile_id"), "master_profile_id", links.count())
        .where("first_seen_raw_profile_id is not null").select("master_profile_id", "raw_profile_id", "source_system", "web_visitor_id", "received_at", "match_rule",
                (F.col("raw_profile_id") == F.col("first_seen_raw_profile_id")).alias("is_founder"))
    )


def purge_deleted(raw: DataFrame, masters: DataFrame, links: DataFrame, events: DataFrame):
    """Drop rows marked for deletion; their links go too, events lose a deleted master but stay."""
    kept_raw = raw.where(F.col("status_code") != DELETE)
    kept_masters = masters.where(F.col("status_code") != DELETE)
    gone_raw = raw.where(F.col("status_code") == DELETE).select("raw_profile_id")
    gone_masters = masters.where(F.col("status_code") == DELETE).select("master_profile_id")
    flag = gone_masters.withColumn("_gone", F.lit(True))
    kept_links = lookup_join(links.join(gone_raw, "raw_profile_id", "left_anti"), flag, "master_profile_id", links.count()).where(
        F.col("_gone").isNull()).drop("_gone")
    kept_events = lookup_join(events, flag, "master_profile_id").withColumn(
        "master_profile_id", F.when(F.col("_gone").isNull(), F.col("master_profile_id"))).drop("_gone")
    return kept_raw, kept_masters, kept_links, kept_events


def mask_attributes(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Hide attributes: ``mask`` keeps the shape, ``hash`` gives a digest that still joins."""
    for c, how in columns.items():
        df = df.withColumn(c, mask_value(c, how))
    return df
