"""Resolution and golden records as the attribute metadata says: its rows are compiled into a match plan and survivorship aggregates.

The metadata is a small configuration table with one row per attribute: ``id`` (also the priority), ``attribute_internal_code``, ``status``,
``is_identity_resolution``, ``matching_rule``, ``matching_threshold`` and ``consolidation_rule``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.config import Rule
from kinweave.operators.matching import MAP_COLUMNS, active_rules
from kinweave.operators.resolution import Resolution, resolve_ordered, resolve_transitive
from kinweave.operators.survivorship import MASTER, POLICIES

#: Attributes whose values become a map by source system, or rows of their own besides the golden record.
MAP_ATTRIBUTES = tuple(MAP_COLUMNS)


@dataclass(frozen=True)
class Plan:
    """``rules``: how rows are matched, strongest first; ``policies``: how each attribute is consolidated; ``ignored``: rows that say nothing
    usable, with the reason."""

    rules: tuple[Rule, ...]
    policies: dict[str, str]
    ignored: dict[str, str] = field(default_factory=dict)


def compile_plan(metadata: DataFrame) -> Plan:
    """Rules of the active identity attributes by id; policies of all active attributes with a consolidation rule.

    An unknown consolidation rule, and a trigram rule without a threshold, is reported in ``ignored`` and takes no part, as a repeated
    attribute does after its first row.
    """
    rules, policies, ignored = [], {}, {}
    for r in active_rules(metadata):
        if r.matching_rule == "fuzzy_trgm" and r.threshold is None:
            ignored[r.attribute] = "no threshold"
        elif r.matching_rule not in ("exact", "fuzzy_trgm", "fuzzy_dmetaphone"):
            ignored[r.attribute] = f"unknown matching rule {r.matching_rule}"
        elif r.attribute not in {x.attribute for x in rules}:
            rules.append(r)
    named = metadata.where("status = 'ACTIVE' and consolidation_rule is not null").orderBy("id").select(
        "attribute_internal_code", "consolidation_rule").collect()  # one row per configured attribute
    for r in named:
        if r.consolidation_rule not in POLICIES:
            ignored[r.attribute_internal_code] = f"unknown consolidation rule {r.consolidation_rule}"
        else:
            policies.setdefault(r.attribute_internal_code, r.consolidation_rule)
    return Plan(tuple(rules), policies, ignored)


def resolve_by_metadata(raw: DataFrame, metadata: DataFrame, masters: DataFrame | None = None, as_of: str = "1970-01-01",
                        mode: str = "transitive", **options) -> Resolution:
    """Resolution with the rules of the metadata, in either mode. Without a usable rule every row is a master of its own."""
    resolve = {"transitive": resolve_transitive, "ordered": resolve_ordered}[mode]
    return resolve(raw, masters, rules=compile_plan(metadata).rules, as_of=as_of, **options)


def _value(members: DataFrame, attribute: str) -> Column:
    """A member column of that name, else the open attribute."""
    return F.col(f"`{attribute}`") if attribute in members.columns else F.try_element_at(F.col("ext_attributes"), F.lit(attribute))


def golden_by_policy(members: DataFrame, policies: dict[str, str], key: str = MASTER) -> DataFrame:
    """(tenant_id, master, attributes...): one row per master with each attribute merged by its policy.

    ``most_recent`` goes by ``last_seen_at``, the others by the order of processing; ``concatenate`` gives a sorted set. Attributes that live
    in maps (one id per source system) come as a map: ``prefer_master`` keeps a source's first id, ``most_recent`` its most recently
    seen one, the others its last one; ``concatenate`` gives all ids of a source. All are partial aggregates.
    """
    scalar = {a: p for a, p in policies.items() if a not in MAP_ATTRIBUTES}
    names = {a: f"v{k}" for k, a in enumerate(scalar)}
    rows = members.select("tenant_id", key, "seq", "last_seen_at", *[_value(members, a).alias(n) for a, n in names.items()])
    types = dict(rows.dtypes)
    aggregates = [_merged(names[a], p, types[names[a]] == "string").alias(names[a]) for a, p in scalar.items()]
    out = rows.groupBy("tenant_id", key).agg(F.count("*").alias("member_rows"), *aggregates).select(
        "tenant_id", key, "member_rows", *[F.col(n).alias(a) for a, n in names.items()])
    for attribute, policy in policies.items():
        if attribute in MAP_ATTRIBUTES:
            out = out.join(_source_map(members, attribute, policy, key), key, "left")
    return out


def _merged(column: str, policy: str, text: bool) -> Column:
    """Values that are no texts have no blank form, only NULL."""
    if not text and policy == "prefer_master":
        return F.expr(f"min_by({column}, seq) filter (where {column} is not null)")
    if not text and policy == "concatenate":
        return F.array_sort(F.collect_set(column))
    return POLICIES[policy](column)


def _source_map(members: DataFrame, attribute: str, policy: str, key: str) -> DataFrame:
    rows = members.where((F.col(attribute) != "") & F.col("source_system").isNotNull()).select(
        key, "seq", "last_seen_at", "source_system", F.col(attribute).alias("v"))
    merged = rows.groupBy(key, "source_system").agg(POLICIES[policy]("v").alias("v"))
    return merged.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source_system", "v")))).alias(attribute))


def golden_by_metadata(res: Resolution, metadata: DataFrame) -> DataFrame:
    """Golden records of a resolution with the consolidation rules of the metadata; survivorship.golden_records has the built-in ones."""
    return golden_by_policy(res.members, compile_plan(metadata).policies)
