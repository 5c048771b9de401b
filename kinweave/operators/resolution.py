"""Whole resolution runs: number the rows, group them, link them, build golden records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.config import DEFAULT_RULES, LATEST_TOGETHER, PREFER_RAW, RAW_PENDING, RAW_PROCESSED, Rule
from kinweave.functions.ids import link_id, uuid5_dns
from kinweave.operators import survivorship
from kinweave.operators.components import connected_components, hub_edges
from kinweave.operators.matching import by_kind, master_rule_values, raw_rule_values
from kinweave.operators.ordered import keyed, settle
from kinweave.operators.sequential import resolve_in_order
from kinweave.operators.similarity import fuzzy_edges, similar_pairs
from kinweave.plans.ordering import add_sequence
from kinweave.plans.skew import MIN_HOT_ROWS, lookup_join
from kinweave.plans.storage import materialize


@dataclass
class Resolution:
    """``members``: numbered input rows with their master; ``links``: new links; ``aliases``: masters merged away."""

    members: DataFrame
    links: DataFrame
    aliases: DataFrame | None = None


_CARRIED = ("email", "phone_number", "source_system", "web_visitor_id", "crm_source_id", "social_user_id",
            *PREFER_RAW, "preferred_communication", "last_seen_at", *LATEST_TOGETHER, "ext_attributes")


# What a prior master has gathered beyond its scalar columns: column here, type.
_GATHERED = {"prior_source_systems": "array<string>", "prior_crm_contact_ids": "map<string,string>",
             "prior_social_user_ids": "map<string,string>", "prior_values": "array<struct<kind:string,value:string>>"}
_GATHERED_VALUES = (("web_visitor", "web_visitor_ids"), ("email", "secondary_emails"), ("phone", "secondary_phone_numbers"))


def _tagged(kind: str):
    return lambda value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))


def _gathered(masters: DataFrame) -> list:
    """The sets and maps of prior masters, NULL where the table lacks them."""
    out = []
    for name, kind in _GATHERED.items():
        own = name.removeprefix("prior_")
        out.append((F.col(own) if own in masters.columns else F.lit(None)).cast(kind).alias(name))
    arrays = [F.transform(F.coalesce(c, F.array().cast("array<string>")), _tagged(kind))
              for kind, c in _GATHERED_VALUES if c in masters.columns]
    out[-1] = (F.concat(*arrays) if arrays else F.lit(None)).cast(_GATHERED["prior_values"]).alias("prior_values")
    return out


def pending_raw(raw: DataFrame, links: DataFrame | None = None, from_ts: str | None = None, to_ts: str | None = None,
                limit: int | None = None) -> DataFrame:
    """Pending rows without a link, received within the inclusive bounds; a limit keeps the oldest."""
    out = raw.where(F.col("status_code") == RAW_PENDING)
    if from_ts is not None:
        out = out.where(F.col("received_at") >= F.lit(from_ts).cast("timestamp_ntz"))
    if to_ts is not None:
        out = out.where(F.col("received_at") <= F.lit(to_ts).cast("timestamp_ntz"))
    if links is not None:
        out = out.join(links.select("raw_profile_id"), "raw_profile_id", "left_anti")
    return out if limit is None else out.orderBy("received_at", "raw_profile_id").limit(limit)


def mark_processed(raw: DataFrame, links: DataFrame, as_of: str) -> DataFrame:
    """Status of linked pending rows becomes processed."""
    done = links.select("raw_profile_id", F.lit(True).alias("_linked")).distinct()
    hit = F.coalesce(F.col("_linked"), F.lit(False)) & (F.col("status_code") == RAW_PENDING)
    out = raw.join(done, "raw_profile_id", "left").withColumn("_hit", hit)
    if "updated_at" in raw.columns:
        out = out.withColumn("updated_at", F.when(F.col("_hit"), F.lit(as_of).cast("timestamp_ntz")).otherwise(
            F.col("updated_at")))
    else:
        out = out.withColumn("updated_at", F.when(F.col("_hit"), F.lit(as_of).cast("timestamp_ntz")))
    return out.withColumn("status_code", F.when(F.col("_hit"), RAW_PROCESSED).otherwise(F.col("status_code"))).drop(
        "_hit", "_linked")


def number_rows(raw: DataFrame, masters: DataFrame | None = None) -> DataFrame:
    """Prior masters (oldest first), then raw rows by (received_at, raw_profile_id), numbered in one order."""
    null = lambda t: F.lit(None).cast(t)
    rows = raw.select("raw_profile_id", null("string").alias("prior_id"), null("timestamp_ntz").alias("prior_created_at"),
                      F.lit(False).alias("is_prior"), F.col("received_at").alias("_t"),
                      F.col("raw_profile_id").alias("_id"), "tenant_id", *_CARRIED,
                      *[null(kind).alias(name) for name, kind in _GATHERED.items()])
    if masters is not None:
        types = dict(raw.dtypes)
        carried = [F.col(c).cast(types[c]) if c in masters.columns else null(types[c]) for c in _CARRIED]
        first = F.col("first_seen_raw_profile_id") if "first_seen_raw_profile_id" in masters.columns else null("string")
        rows = masters.select(
            first.alias("raw_profile_id"), F.col("master_profile_id").alias("prior_id"),
            F.col("created_at").alias("prior_created_at"), F.lit(True).alias("is_prior"), F.col("created_at").alias("_t"),
            F.col("master_profile_id").alias("_id"), "tenant_id",
            *[c.alias(n) for c, n in zip(carried, _CARRIED)], *_gathered(masters)).unionByName(rows)
    ordered = rows.withColumn("_late", F.when(F.col("is_prior"), 0).otherwise(1))
    return add_sequence(ordered, ["_late", "_t", "_id"]).drop("_late", "_id").withColumnRenamed("_t", "arrived_at")


def _finish(numbered: DataFrame, groups: DataFrame, as_of: str, rows: int, min_hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Name the masters and derive the links. ``groups``: seq, root and how."""
    founders = numbered.join(groups.where("seq = root").select("seq"), "seq", "left_semi")
    names = founders.select(F.col("seq").alias("root"), F.coalesce(
        "prior_id", uuid5_dns(F.concat_ws(":", "tenant_id", "raw_profile_id"))).alias("master_profile_id"))
    members = materialize(lookup_join(numbered.join(groups, "seq"), names, "root", rows, min_hot_rows))
    links = members.where("not is_prior").select(
        "raw_profile_id", "master_profile_id", link_id("raw_profile_id", "master_profile_id").alias("link_id"),
        F.lit(as_of).cast("timestamp_ntz").alias("linked_at"),
        F.when(F.col("seq") == F.col("root"), "NewMaster").otherwise("DynamicMatch").alias("match_rule"),
        F.col("how").alias("matched_attribute"))
    return members, links


def resolve_transitive(raw: DataFrame, masters: DataFrame | None = None, rules=DEFAULT_RULES, as_of: str = "1970-01-01",
                       min_hot_rows: int = MIN_HOT_ROWS) -> Resolution:
    """Batch mode: rows and prior masters connected through shared identifiers form one master, the oldest one.

    Each rule is followed by its kind: equal identifiers, equal phonetic codes, or texts whose trigrams are similar enough, be they
    on a prior master or on another row of the batch. Further prior masters of a component are reported as aliases of the
    surviving master.
    """
    equal, fuzzy = by_kind(rules)
    rules = [*equal, *fuzzy]
    numbered = number_rows(raw, masters)
    rows = numbered.count()
    values = raw_rule_values(numbered.where("not is_prior"), rules, ("seq",))
    most = rows * len(rules)
    if masters is not None:
        prior = master_rule_values(masters, rules, id_cols=("master_profile_id",))
        seqs = numbered.where("is_prior").select("seq", F.col("prior_id").alias("master_profile_id"))
        values = values.unionByName(prior.join(seqs, "master_profile_id").drop("master_profile_id"))
        values = materialize(values)
        most = values.count()
    edges = hub_edges(values, ["tenant_id", "rule_id", "value"], "seq", min_hot_rows, most)
    if fuzzy:
        names = ["u", "v", "rule_id", "attribute"]
        edges = edges.select(*names).unionByName(fuzzy_edges(values.where(F.col("rule_id").isin([r.id for r in fuzzy])), fuzzy).select(*names))
    edges = materialize(edges)
    roots = connected_components(edges, min_hot_rows=min_hot_rows)
    how = edges.groupBy("u").agg(F.min(F.struct("rule_id", "attribute")).alias("h"))
    groups = (
        numbered.select("seq", "is_prior").join(roots.withColumnRenamed("node", "seq"), "seq", "left")
        .join(how.select(F.col("u").alias("seq"), F.col("h.attribute").alias("how")), "seq", "left")
        .select("seq", F.coalesce("root", "seq").alias("root"),
                F.when(F.coalesce("root", "seq") == F.col("seq"), F.when(F.col("is_prior"), "prior").otherwise("new"))
                .otherwise(F.coalesce("how", F.lit("transitive"))).alias("how"))
    )
    members, links = _finish(numbered, materialize(groups), as_of, rows, min_hot_rows)
    aliases = members.where("is_prior and seq <> root").select(
        F.col("prior_id").alias("old_id"), F.col("master_profile_id").alias("new_id"))
    return Resolution(members, links, aliases)


def resolve_sequential(raw: DataFrame, masters: DataFrame | None = None, as_of: str = "1970-01-01",
                       rules=("email", "phone_number"), min_hot_rows: int = MIN_HOT_ROWS, **options) -> Resolution:
    """Order-faithful mode on the two primary contact columns: same result as one row after the other.

    ``rules``: the two columns in order of priority, as names or as exact rules. Other rules go to ``resolve_ordered``; the two columns by other
    than exact rules are refused here, ``resolve_ordered`` takes them.
    """
    names = [r.attribute if isinstance(r, Rule) else r for r in rules]
    contact = sorted(names) == ["email", "phone_number"]
    if contact and any(isinstance(r, Rule) and r.matching_rule != "exact" for r in rules):
        raise ValueError("email and phone_number are followed exactly here; resolve_ordered follows other rules on them")
    if not contact:
        return resolve_ordered(raw, masters, as_of, rules, min_hot_rows, **options)
    rules = names
    numbered = number_rows(raw, masters)
    key = lambda c: F.lower(c) if c == "email" else F.col(c)
    nodes = numbered.select("seq", "tenant_id", "is_prior", key(rules[0]).alias(rules[0] + "_key"),
                            key(rules[1]).alias(rules[1] + "_key"))
    decided = resolve_in_order(nodes, rules[0] + "_key", rules[1] + "_key", min_hot_rows=min_hot_rows, **options)
    groups = decided.select("seq", F.col("master").alias("root"), F.regexp_replace("how", "_key$", "").alias("how"))
    members, links = _finish(numbered, materialize(groups), as_of, numbered.count(), min_hot_rows)
    return Resolution(members, links)


def resolve_ordered(raw: DataFrame, masters: DataFrame | None = None, as_of: str = "1970-01-01", rules=DEFAULT_RULES,
                    min_hot_rows: int = MIN_HOT_ROWS, **options) -> Resolution:
    """Order-faithful mode for rules of every kind, the smallest rule id first: same result as one row after the other.

    A master answers for the first value of a scalar column (its primary one), for all values of sets and for all entries of id maps that it
    has had. Phonetic rules compare codes, trigram rules take every value that is similar enough. Rules of other kinds take no part.
    """
    equal, fuzzy = by_kind(rules)
    rules = [*equal, *fuzzy]
    numbered = number_rows(raw, masters)
    rows = numbered.count()
    brought = raw_rule_values(numbered.where("not is_prior"), rules, ("seq",))
    held = brought
    if masters is not None:
        seqs = numbered.where("is_prior").select("seq", F.col("prior_id").alias("master_profile_id"))
        prior = master_rule_values(masters, rules, secondary=False, id_cols=("master_profile_id",))
        held = brought.unionByName(prior.join(seqs, "master_profile_id").drop("master_profile_id"))
    held = materialize(held)
    scalar = [r.id for r in rules if r.kind == "column"]
    asked = held.where(F.col("rule_id").isin([r.id for r in equal])).join(numbered.where("not is_prior").select("seq"), "seq", "left_semi")
    asked = asked.select("seq", "tenant_id", "rule_id", "value")
    for r in fuzzy:
        texts = held.where(F.col("rule_id") == r.id).select("tenant_id", "rule_id", F.col("value").alias("text")).distinct()
        near = similar_pairs(texts, r.threshold).select("tenant_id", "rule_id", F.col("a").alias("value"), F.col("b").alias("near"))
        own = brought.where(F.col("rule_id") == r.id).select("seq", "tenant_id", "rule_id", "value")
        asked = asked.unionByName(own.join(near, ["tenant_id", "rule_id", "value"]).select("seq", "tenant_id", "rule_id", F.col("near").alias("value")))
    held_keys, asked_keys = keyed(held.select("seq", "tenant_id", "rule_id", "value", F.col("rule_id").isin(scalar).alias("slot")), asked,
                                  rows * max(1, len(rules)), min_hot_rows)
    decided = settle(numbered.select("seq", "is_prior"), held_keys, asked_keys, **options)
    how = F.when(F.col("master") == F.col("seq"), F.lit("new"))
    for r in rules:
        how = how.when(F.col("rule_id") == r.id, r.attribute)
    groups = decided.select("seq", F.col("master").alias("root"), how.alias("how"))
    members, links = _finish(numbered, materialize(groups), as_of, rows, min_hot_rows)
    return Resolution(members, links)


def merge_updated(raw: DataFrame, links: DataFrame, masters: DataFrame, as_of: str) -> DataFrame:
    """Golden records of masters whose linked staging rows became pending again: new traits are merged in.

    An ordinary run leaves such rows alone, as it only takes rows without a link.
    """
    again = raw.where(F.col("status_code") == RAW_PENDING).join(
        links.select("raw_profile_id", "master_profile_id"), "raw_profile_id")
    touched = masters.join(again.select("master_profile_id").distinct(), "master_profile_id", "left_semi")
    numbered = number_rows(again, touched)
    owners = again.select("raw_profile_id", "master_profile_id")
    rows = numbered.where("not is_prior").join(owners, "raw_profile_id").unionByName(
        numbered.where("is_prior").withColumn("master_profile_id", F.col("prior_id")))
    return golden_tables(Resolution(rows, links), as_of)[0]


def golden_tables(res: Resolution, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Masters with their maps, and their identifier rows; what prior masters had gathered stays with them."""
    golden = survivorship.golden_records(res.members, as_of)
    ids = survivorship.identifier_values(res.members, golden)
    for part in (survivorship.map_by_source(res.members, "crm_source_id", "crm_contact_ids"),
                 survivorship.map_by_source(res.members, "social_user_id", "social_user_ids"),
                 survivorship.json_shallow_merge(res.members)):
        name = part.columns[-1]
        empty = F.expr("cast(map() as map<string,string>)")
        golden = golden.join(part, "master_profile_id", "left").withColumn(name, F.coalesce(name, empty))
    return golden, ids
