"""Golden-record values: one aggregate per master over its member rows in processing order ``seq``.

All scalar policies are partial aggregates (``max_by``/``min_by``), so a master with very many rows is combined before the
shuffle. Values that can grow without limit (visitor ids, further emails and phones) are kept as rows of
``identifier_values`` instead of arrays; ``with_identifier_arrays`` adds the array form for exports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.config import LATEST_TOGETHER, MASTER_TO_NOTIFY, PREFER_MASTER, PREFER_RAW
from kinweave.plans.skew import lookup_join

MASTER = "master_profile_id"


def last_non_null(c: str, order: str = "seq") -> Column:
    """Newest non-NULL value; an empty text counts as a value."""
    return F.expr(f"max_by({c}, {order}) filter (where {c} is not null)")


def first_non_blank(c: str, order: str = "seq") -> Column:
    """Oldest non-blank value, else the first value as it is."""
    return F.coalesce(F.expr(f"min_by({c}, {order}) filter (where {c} <> '')"), F.min_by(c, order))


def most_recent(c: str, ts: str = "last_seen_at", order: str = "seq") -> Column:
    """Non-NULL value of the newest event; ties go to the row processed later."""
    return F.expr(f"max_by({c}, struct({ts}, {order})) filter (where {c} is not null)")


def latest_struct(columns=LATEST_TOGETHER, ts: str = "last_seen_at", order: str = "seq") -> Column:
    """Columns of one and the same newest event; without any time the founding row's values stay."""
    s = "struct(" + ", ".join(columns) + ")"
    return F.coalesce(F.expr(f"max_by({s}, struct({ts}, {order})) filter (where {ts} is not null)"),
                      F.expr(f"min_by({s}, {order})"))


def set_union(c: str) -> Column:
    """Distinct non-blank values, sorted; for columns with a small vocabulary such as source systems."""
    return F.array_sort(F.expr(f"collect_set({c}) filter (where {c} <> '')"))


# Names of the selectable policies.
POLICIES = {
    "most_recent": most_recent, "non_null": last_non_null, "prefer_raw": last_non_null,
    "prefer_master": first_non_blank, "concatenate": set_union,
}


def consolidate(members: DataFrame, policies: dict[str, str], key: str = MASTER) -> DataFrame:
    """One row per master with each column merged by its named policy."""
    return members.groupBy(key).agg(*[POLICIES[rule](c).alias(c) for c, rule in policies.items()])


def map_by_source(members: DataFrame, value: str, name: str, key: str = MASTER) -> DataFrame:
    """{source system: id} per master, the last id of each source; size bounded by the number of sources."""
    rows = members.where(F.col(value).isNotNull() & F.col("source_system").isNotNull()).select(
        key, "seq", "source_system", F.col(value).alias("v"))
    if f"prior_{name}" in members.columns:  # a prior master's entries count at its place in the order
        rows = rows.unionByName(members.select(key, "seq", F.explode(f"prior_{name}").alias("source_system", "v")))
    last = rows.groupBy(key, "source_system").agg(F.max_by("v", "seq").alias("v"))
    return last.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source_system", "v")))).alias(name))


def json_shallow_merge(members: DataFrame, c: str = "ext_attributes", key: str = MASTER) -> DataFrame:
    """Open attributes merged key by key, later rows win; size bounded by the number of attribute keys."""
    last = members.select(key, "seq", F.explode(c).alias("k", "v")).groupBy(key, "k").agg(F.max_by("v", "seq").alias("v"))
    return last.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(c))


def identifier_values(members: DataFrame, golden: DataFrame, key: str = MASTER) -> DataFrame:
    """(master, kind, value): visitor ids, and the emails and phones that differ from the primary one."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in (
        ("web_visitor", "web_visitor_id"), ("email", "email"), ("phone", "phone_number"))])
    if "prior_values" in members.columns:
        kinds = F.concat(kinds, F.coalesce("prior_values", F.array().cast("array<struct<kind:string,value:string>>")))
    values = members.select(key, F.explode(kinds).alias("i")).select(key, "i.*").where("value <> ''").distinct()
    most = values.count()
    primary = golden.select(key, F.lower("email").alias("_e"), F.col("phone_number").alias("_p"))
    joined = lookup_join(values, primary, key, most)
    same = ((F.col("kind") == "email") & F.lower("value").eqNullSafe(F.col("_e"))) | (
        (F.col("kind") == "phone") & F.col("value").eqNullSafe(F.col("_p")))
    return joined.where(~same).select(
        key, F.when(F.col("kind") == "web_visitor", "web_visitor").otherwise(
            F.concat(F.lit("secondary_"), "kind")).alias("kind"), "value")


def golden_records(members: DataFrame, as_of: str, key: str = MASTER) -> DataFrame:
    """Scalar golden record per master. Prior masters take part as the earliest rows of their group."""
    extra = [F.min_by("prior_created_at", "seq").alias("_created")] if "prior_created_at" in members.columns else []
    systems = set_union("source_system")
    if "prior_source_systems" in members.columns:
        systems = F.array_sort(F.array_distinct(F.concat(systems, F.flatten(F.collect_set("prior_source_systems")))))
    merged = members.groupBy("tenant_id", key).agg(
        *[first_non_blank(c).alias(c) for c in PREFER_MASTER],
        *[last_non_null(c).alias(c) for c in PREFER_RAW],
        last_non_null("preferred_communication").alias("preferred_communication"),
        F.max("last_seen_at").alias("last_seen_at"), latest_struct().alias("_latest"),
        systems.alias("source_systems"),
        F.min_by("raw_profile_id", "seq").alias("first_seen_raw_profile_id"),
        F.count("*").alias("member_rows"), *extra,
    )
    now = F.lit(as_of).cast("timestamp_ntz")
    created = F.coalesce(F.col("_created"), now) if extra else now
    return merged.select(
        *[c for c in merged.columns if not c.startswith("_")], "_latest.*",
        created.alias("created_at"), now.alias("updated_at"), F.lit(MASTER_TO_NOTIFY).alias("status_code"))


def touch(masters: DataFrame, as_of: str) -> DataFrame:
    """Stamp a merge: updated now, to be notified."""
    return masters.withColumn("updated_at", F.lit(as_of).cast("timestamp_ntz")).withColumn(
        "status_code", F.lit(MASTER_TO_NOTIFY))


def with_identifier_arrays(masters: DataFrame, identifiers: DataFrame, key: str = MASTER) -> DataFrame:
    """Array columns for exports; each holds all values of one master, so use it where masters are of human size."""
    arrays = identifiers.groupBy(key).agg(*[
        F.array_sort(F.expr(f"collect_set(value) filter (where kind = '{kind}')")).alias(name)
        for kind, name in (("web_visitor", "web_visitor_ids"), ("secondary_email", "secondary_emails"),
                           ("secondary_phone", "secondary_phone_numbers"))])
    return masters.join(arrays, key, "left")
