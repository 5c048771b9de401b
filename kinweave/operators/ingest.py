"""From tracking documents to staging rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.config import EVENT_CLASSES, RAW_PENDING
from kinweave.functions.ids import fallback_visitor_id
from kinweave.functions.text import (
    has_string_value, is_valid_basic_phone, is_valid_email, sanitize_text, strip,
)
from kinweave.schema import RAW_TEXT_COLUMNS, RAW_TYPES

# Document rules.
SCHEMA_VERSION_PATTERN = r"^\d{4}\.\d{2}\.\d{2}$"
UUID_PATTERN = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
REQUIRED_FIELDS = ("tenant_id", "mediahost", "schema_version", "metric", "tpurl")


def trait(key: str) -> Column:
    return F.try_element_at(F.col("profile_traits"), F.lit(key))


def has_trait(key: str) -> Column:
    return F.coalesce(F.map_contains_key("profile_traits", key), F.lit(False))


def is_valid_track_event() -> Column:
    """String ids of 1 to 36 characters and a string metric below 50."""
    ok = (F.length("visid").between(1, 36) & F.length("tenant_id").between(1, 36) & (F.length("metric") < 50))
    return F.coalesce(ok & F.col("_typed"), F.lit(False))


def schema_errors() -> Column:
    """Codes of all violated document rules, sorted."""
    def fails(cond: Column, code: str) -> Column:
        return F.when(F.coalesce(cond, F.lit(False)), F.lit(code))

    checks = [fails(F.col(f).isNull(), f"missing:{f}") for f in REQUIRED_FIELDS]
    checks += [
        fails(~F.col("schema_version").rlike(SCHEMA_VERSION_PATTERN), "pattern:schema_version"),
        fails(~F.col("event_id").rlike(UUID_PATTERN), "uuid:event_id"),
        fails(~F.col("visid").rlike(UUID_PATTERN), "uuid:visid"),
        fails(F.col("datetime").isNotNull() & F.expr("try_cast(datetime as timestamp)").isNull(), "datetime"),
        fails(F.col("tpurl").isNotNull() & F.try_parse_url("tpurl", F.lit("PROTOCOL")).isNull(), "uri:tpurl"),
        fails(F.col("profile_traits").isNotNull() & ~has_trait("source_system"), "missing:source_system"),
    ]
    return F.array_sort(F.array_compact(F.array(*checks)))


def validate_event_schema(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", schema_errors())


def route_ingest(df: DataFrame, body: str = "value") -> DataFrame:
    """Outcome and HTTP-style status of every record; nothing is dropped."""
    missing = F.coalesce(F.octet_length(body), F.lit(0)) == 0  # bytes are known, characters would be counted through every body
    outcome = (
        F.when(missing, "missing_body").when(F.col("_corrupt").isNotNull(), "bad_json")
        .when(is_valid_track_event(), "accepted").otherwise("invalid")
    )
    status = F.when(F.col("outcome") == "accepted", 200).when(F.col("outcome") == "missing_body", 500).otherwise(400)
    return df.withColumn("outcome", outcome).withColumn("status", status)


def accepted(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("outcome") == "accepted")


def dead_letter(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("outcome") != "accepted")


def classify_records(df: DataFrame, validate_after_alias: bool = False) -> DataFrame:
    """``Ok`` or ``Dropped`` per queue record, with the reason of a drop.

    Contact checks look at the raw trait keys; with ``validate_after_alias`` at the mapped ones.
    """
    if validate_after_alias:
        df = map_trait_aliases(df)
    phone, email = trait("phone_number"), trait("email")
    reason = (
        F.when(F.col("_corrupt").isNotNull(), "bad_json")
        .when(has_string_value(phone) & ~is_valid_basic_phone(phone), "phone_number")
        .when(has_string_value(email) & ~is_valid_email(email), "email")
    )
    return df.withColumn("reason", reason).withColumn(
        "record_state", F.when(F.col("reason").isNull(), "Ok").otherwise("Dropped"))


def _first_present(*keys: str) -> Column:
    """Value of the first key that exists, even when that value is NULL."""
    out = F.lit(None).cast("string")
    for key in reversed(keys):
        out = F.when(has_trait(key), trait(key)).otherwise(out)
    return out


# Trait names in order of precedence for each staging attribute.
TRAIT_ALIASES = {
    "phone_number": ("phone", "phone_number"),
    "first_name": ("name", "firstname", "first_name"),
    "last_name": ("lastname", "last_name"),
    "date_of_birth": ("birthday", "date_of_birth"),
    "crm_contact_id": ("userid", "crm_contact_id"),
    "source_system": ("usersource", "source_system"),
}


def map_trait_aliases(df: DataFrame) -> DataFrame:
    """Rename SDK trait keys for web visitors; presence of a key decides, not its value."""
    traits = F.coalesce(F.col("profile_traits"), F.expr("cast(map() as map<string,string>)"))
    rest = F.map_filter(traits, lambda k, _: ~k.isin(*TRAIT_ALIASES))
    renamed = F.create_map(*[x for target, keys in TRAIT_ALIASES.items()
                             for x in (F.lit(target), _first_present(*keys))])
    mapped = F.when(has_string_value("visid"), F.map_concat(rest, renamed)).otherwise(traits)
    return df.withColumn("profile_traits", mapped)


def add_visitor_id(df: DataFrame) -> DataFrame:
    """Visitor id of the document, or one made from its other identifying fields."""
    parts = ["tenant_id", "observer_id", "mediahost", "schema_version", trait("phone_number"), trait("email")]
    return df.withColumn("web_visitor_id", fallback_visitor_id("visid", *parts))


def events_to_raw_profiles(df: DataFrame, received_at: Column) -> DataFrame:
    """Flatten documents to staging rows."""
    df = map_trait_aliases(add_visitor_id(df))

    def value(name: str) -> Column:
        if name == "tenant_id":
            source = F.coalesce(F.col("tenant_id"), F.lit(""))
        elif name == "web_visitor_id":
            source = F.col("web_visitor_id")
        elif name == "source_system":
            source = F.when(has_trait(name), trait(name)).otherwise("websdk")
        elif name == "gender":
            source = F.when(has_trait(name), trait(name)).otherwise("unknown")
        else:
            source = trait(name)
        clean = sanitize_text(source)
        return (clean.try_cast(RAW_TYPES[name]) if name in RAW_TYPES else clean).alias(name)

    def open_map(name: str) -> Column:
        empty = F.expr("cast(map() as map<string,string>)")
        return F.coalesce(F.from_json(trait(name), "map<string,string>"), empty).alias(name)

    flat = df.select(
        "event_id", received_at.cast("timestamp_ntz").alias("received_at"), F.lit(RAW_PENDING).alias("status_code"),
        *[value(c) for c in RAW_TEXT_COLUMNS], open_map("preferred_communication"), open_map("ext_attributes"),
    )
    return flat.withColumn("raw_profile_id", F.sha2(F.concat_ws(":", "tenant_id", "web_visitor_id"), 256))


def dedupe_last(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Last row per stripped key; rows with an empty key are skipped.

    A partial aggregate keeps one row per key and task, so a hot key never gathers its rows anywhere.
    """
    stripped = [strip(k) for k in keys]
    usable = df
    for k in keys:
        usable = usable.where(F.length(k) > 0)
    best = usable.groupBy(*[s.alias(f"_k{i}") for i, s in enumerate(stripped)]).agg(
        F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def staging_rows(events: DataFrame, received_at: Column, order: list) -> DataFrame:
    """Newest staging row per tenant and visitor. Older documents are dropped before the costly cleaning."""
    columns = ["tenant_id", "visid", "observer_id", "mediahost", "schema_version", "profile_traits", "event_id"]
    slim = add_visitor_id(events).select("web_visitor_id", *columns, received_at.alias("_received"),
                                         F.struct(*order).alias("_order"))
    newest = dedupe_last(slim, ["tenant_id", "web_visitor_id"], ["_order"])
    return events_to_raw_profiles(newest, F.col("_received"))


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """Insert or overwrite by key: incoming values win, NULL included; ``keep`` columns stay as first stored."""
    new = incoming.select(*keys, F.struct(*[c for c in existing.columns if c not in keys]).alias("_new"))
    joined = existing.join(new, keys, "full_outer")
    columns = []
    for c in existing.columns:
        if c in keys:
            columns.append(F.col(c))
        elif c in keep:
            columns.append(F.coalesce(F.col(c), F.col(f"_new.{c}")).alias(c))
        else:
            columns.append(F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c))
    return joined.select(*columns)


def upsert_raw_profiles(existing: DataFrame, incoming: DataFrame, as_of: str) -> DataFrame:
    """Staging upsert by tenant and visitor: the row becomes pending again, received now, and keeps its id."""
    stamped = incoming.withColumn("received_at", F.lit(as_of).cast("timestamp_ntz")).withColumn(
        "status_code", F.lit(RAW_PENDING))
    return upsert(existing, stamped, ["tenant_id", "web_visitor_id"], ["raw_profile_id"])


def delta_extract(current: DataFrame, snapshot: DataFrame, keys: list[str]) -> DataFrame:
    """Keys inserted, updated or deleted since a snapshot, compared by the values themselves (no hash collisions)."""
    values = [c for c in current.columns if c not in keys]
    a = current.select(*keys, F.struct(*values).alias("_cur"))
    b = snapshot.select(*keys, F.struct(*values).alias("_old"))
    change = (
        F.when(F.col("_old").isNull(), "insert").when(F.col("_cur").isNull(), "delete")
        .when(~F.col("_cur").eqNullSafe(F.col("_old")), "update")
    )
    return a.join(b, keys, "full_outer").select(*keys, change.alias("change")).where("change is not null")


def resolve_source_conflicts(df: DataFrame, keys: list[str], value: str, source: str, ts: str,
                             priority: dict[str, int]) -> DataFrame:
    """Winning value per key (best source, then newest) and whether sources disagree; one partial aggregate."""
    rank = F.lit(len(priority) + 1)
    for name, r in priority.items():
        rank = F.when(F.col(source) == name, r).otherwise(rank)
    order = F.struct((-rank).alias("p"), F.col(ts).alias("t"), F.col(source).alias("s"), F.col(value).alias("v"))
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.max_by(value, order).alias(value),
        F.max_by(source, order).alias("winning_source"),
        (F.min(value) != F.max(value)).alias("needs_review"),
    )


def event_taxonomy(df: DataFrame, name: str = "metric") -> DataFrame:
    """Class of an event and the purchase fields with their defaults; unknown names get no class."""
    # Eighteen fixed entries, so a literal map replaces a join.
    classes = F.create_map(*[F.lit(x) for pair in EVENT_CLASSES.items() for x in pair])
    cls = F.try_element_at(classes, F.col(name))
    payload = lambda key: F.try_element_at(F.col("event_payload"), F.lit(key))
    buying = cls == "conversion"
    return (
        df.withColumn("event_class", cls)
        .withColumn("transaction_id", F.when(buying, F.coalesce(payload("transaction_id"), F.lit(""))))
        .withColumn("transaction_value", F.when(
            buying, F.coalesce(payload("transaction_value").try_cast("double"), F.lit(0.0))))
        .withColumn("currency", F.when(buying, F.coalesce(payload("currency"), F.lit("USD"))))
    )
