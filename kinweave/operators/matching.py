"""Equality-based identity rules: each rule is an equi join on a derived key.

A raw row is linked to one master, so masters are reduced to the preferred one per key before they are joined. No rule
ever produces all pairs of a key.
"""

from __future__ import annotations

from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.config import Rule
from kinweave.functions.text import has_string_value
from kinweave.plans.skew import lookup_join

# Kinds of matching rules in the metadata.
PHONETIC_KIND, TRIGRAM_KIND = "fuzzy_dmetaphone", "fuzzy_trgm"
EQUALITY_KINDS = ("exact", PHONETIC_KIND)

KEY = ["tenant_id", "rule_id", "value"]


def active_rules(metadata: DataFrame) -> list[Rule]:
    """Rules of the attribute metadata that take part in matching, by priority; the registry is a small config table."""
    usable = metadata.where(
        "is_identity_resolution and status = 'ACTIVE' and matching_rule is not null and matching_rule <> 'none'")
    kinds = {"social_user_id": "map", "crm_source_id": "map", "web_visitor_id": "array", "national_id": "array"}
    rows = usable.orderBy("id").select(
        "id", "attribute_internal_code", "matching_rule", "matching_threshold", "consolidation_rule").collect()
    return [
        Rule(r.id, r.attribute_internal_code, r.matching_rule,
             None if r.matching_threshold is None else float(r.matching_threshold), r.consolidation_rule,
             kinds.get(r.attribute_internal_code, "column"), r.attribute_internal_code == "email")
        for r in rows
    ]


def active_rule_rows(metadata: DataFrame) -> DataFrame:
    return metadata.where(
        "is_identity_resolution and status = 'ACTIVE' and matching_rule is not null and matching_rule <> 'none'")


def by_kind(rules) -> tuple[list[Rule], list[Rule]]:
    """(rules decided by equality, trigram rules); phonetic rules compare codes, so they are decided by equality.

    A fuzzy rule without a threshold and a rule of an unknown kind take no part.
    """
    equal = [r for r in rules if r.matching_rule in EQUALITY_KINDS]
    fuzzy = [r for r in rules if r.matching_rule == TRIGRAM_KIND and r.threshold is not None]
    return equal, fuzzy


def _normal(value: Column, rule: Rule) -> Column:
    if rule.matching_rule == PHONETIC_KIND:
        return F.soundex(value)
    return F.lower(value) if rule.ignore_case else value


def _raw_value(raw: DataFrame, rule: Rule) -> Column:
    """A staging column if there is one, else the open attribute of that name."""
    if rule.attribute in raw.columns:
        value = F.col(rule.attribute).cast("string")
    else:
        value = F.try_element_at(F.col("ext_attributes"), F.lit(rule.attribute))
    if rule.kind == "map":
        return F.when(value != "", F.concat_ws("|", F.when(F.col("source_system").isNotNull(), F.col("source_system")),
                                               value))
    return _normal(value, rule)


def raw_rule_values(raw: DataFrame, rules, id_cols=("raw_profile_id",)) -> DataFrame:
    """Unpivot: one row per raw row and rule with a non-blank value, in one pass over the input."""
    items = F.array(*[
        F.struct(F.lit(r.id).alias("rule_id"), F.lit(r.attribute).alias("attribute"), _raw_value(raw, r).alias("value"))
        for r in rules]).cast("array<struct<rule_id:int,attribute:string,value:string>>")
    return (
        raw.select(*id_cols, "tenant_id", F.explode(items).alias("i"))
        .select(*id_cols, "tenant_id", "i.*").where("value <> ''")
    )


# Golden-record columns holding the further values of a scalar identifier.
ARRAY_COLUMNS = {"web_visitor_id": ("web_visitor_ids",), "national_id": ("national_ids",),
                 "email": ("secondary_emails",), "phone_number": ("secondary_phone_numbers",)}
MAP_COLUMNS = {"crm_source_id": "crm_contact_ids", "social_user_id": "social_user_ids"}


def master_rule_values(masters: DataFrame, rules, secondary: bool = True,
                       id_cols=("master_profile_id", "created_at")) -> DataFrame:
    """Identifiers of the masters as rows: scalar columns, array members and map entries."""
    parts = []
    for r in rules:
        arrays = [F.transform(c, F.lower) if r.ignore_case else F.col(c) for c in ARRAY_COLUMNS.get(r.attribute, ())
                  if c in masters.columns and (secondary or r.kind == "array")]
        if r.kind == "column" and r.attribute in masters.columns:
            arrays.append(F.array(_normal(F.col(r.attribute), r)))
        elif r.kind == "column" and not arrays:
            arrays.append(F.array(_normal(F.try_element_at(F.col("ext_attributes"), F.lit(r.attribute)), r)))
        if r.kind == "map" and MAP_COLUMNS.get(r.attribute) in masters.columns:
            arrays.append(F.transform(F.map_entries(MAP_COLUMNS[r.attribute]),
                                      lambda e: F.concat_ws("|", e["key"], e["value"])))
        if arrays:
            parts.append(F.struct(F.lit(r.id).alias("rule_id"), F.lit(r.attribute).alias("attribute"),
                                  F.flatten(F.array_compact(F.array(*arrays))).alias("values")))
    parts = F.array(*parts).cast("array<struct<rule_id:int,attribute:string,values:array<string>>>")
    return (
        masters.select(*id_cols, "tenant_id", F.explode(parts).alias("i"))
        .select(*id_cols, "tenant_id", "i.rule_id", "i.attribute", F.explode("i.values").alias("value"))
        .where("value <> ''").distinct()
    )


def preferred_master(values: DataFrame, key: list[str] | None = None) -> DataFrame:
    """One master per key: the oldest, then the smallest id."""
    return values.groupBy(*(key or KEY)).agg(
        F.min(F.struct("created_at", "master_profile_id")).alias("_m")
    ).select(*(key or KEY), "_m.created_at", "_m.master_profile_id")


def exact_match(raw_values: DataFrame, master_values: DataFrame) -> DataFrame:
    """Candidates by equality of an identifier inside the tenant (also array members and map entries, as rows)."""
    found = lookup_join(raw_values, preferred_master(master_values), KEY).where("master_profile_id is not null")
    return found.select(
        "raw_profile_id", "tenant_id", "rule_id", "attribute", "created_at", "master_profile_id")


def phonetic_match(raw_values: DataFrame, master_values: DataFrame) -> DataFrame:
    """Candidates whose values sound alike (Soundex code as the join key)."""
    code = lambda df: df.withColumn("value", F.soundex("value"))
    return exact_match(code(raw_values), code(master_values)).withColumn("attribute", F.lit("phonetic_soundex"))


def pick_candidate(candidates: DataFrame) -> DataFrame:
    """One candidate per raw row: strongest rule, oldest master, smallest id."""
    return candidates.groupBy("raw_profile_id").agg(
        F.min(F.struct("rule_id", "created_at", "master_profile_id", "attribute")).alias("_c")
    ).select("raw_profile_id", "_c.master_profile_id", "_c.rule_id", F.col("_c.attribute").alias("matched_attribute"))


def composite_key(fields: list[str], ignore_case=("email",)) -> Column:
    """All fields as one key, NULL when one of them is blank."""
    parts = [F.lower(f) if f in ignore_case else F.col(f) for f in fields]
    filled = None
    for f in fields:
        filled = has_string_value(f) if filled is None else filled & has_string_value(f)
    return F.when(filled, F.array(*parts))


def composite_rule_match(raw: DataFrame, masters: DataFrame, alternatives: list[list[str]],
                         ranks: list[int] | None = None) -> DataFrame:
    """A disjunction of conjunctions such as ``email OR (phone AND name)``: one equi join over all alternatives.

    Alternatives come in order of priority; ``ranks`` gives several of them the same priority.
    """
    ranks = ranks or list(range(1, len(alternatives) + 1))

    def keyed(df, cols):
        items = F.array(*[F.struct(F.lit(n).alias("rule_id"), F.lit("+".join(a)).alias("attribute"),
                                   F.concat(F.array(F.lit("+".join(a))), composite_key(a)).alias("value"))
                          for n, a in zip(ranks, alternatives)])
        return df.select(*cols, "tenant_id", F.explode(items).alias("i")).select(
            *cols, "tenant_id", "i.*").where("value is not null")
    return pick_candidate(exact_match(keyed(raw, ["raw_profile_id"]),
                                      keyed(masters, ["master_profile_id", "created_at"])))


def cascade_match(raw_values: DataFrame, master_values: DataFrame, rules) -> DataFrame:
    """Strongest rule first, weaker rules only for the rest.

    The rules do not depend on each other, so the smallest matching rule per raw row gives the same links in one pass.
    """
    ranked = {r.id: i + 1 for i, r in enumerate(rules)}
    order = F.create_map(*[F.lit(x) for pair in ranked.items() for x in pair])
    return pick_candidate(exact_match(raw_values, master_values).withColumn("rule_id", order[F.col("rule_id")]))


def probabilistic_match(raw: DataFrame, masters: DataFrame, weights: dict[str, float], threshold: float) -> DataFrame:
    """Best master whose summed weights of agreeing fields reach the threshold.

    The score depends only on which fields agree. So every field set heavy enough becomes one composite key, both sides
    meet by equality on it, and the heaviest set of a raw row wins: exact, without comparing pairs.
    """
    fields = list(weights)
    sets = [list(s) for n in range(1, len(fields) + 1) for s in combinations(fields, n)
            if sum(weights[f] for f in s) >= threshold - 1e-9]
    sets.sort(key=lambda s: (-sum(weights[f] for f in s), s))
    if not sets:
        raise ValueError("no field combination reaches the threshold")
    totals = [round(sum(weights[f] for f in s), 6) for s in sets]
    levels = sorted(set(totals), reverse=True)
    best = composite_rule_match(raw, masters, sets, [levels.index(t) + 1 for t in totals])
    score = F.create_map(*[F.lit(x) for i, t in enumerate(levels) for x in (i + 1, float(t))])
    return best.select("raw_profile_id", "master_profile_id", score[F.col("rule_id")].alias("score"),
                       F.col("matched_attribute").alias("agreeing"))


def merge_guard(raw: DataFrame, masters: DataFrame, weak_key: str, fields: list[str], max_conflicts: int) -> DataFrame:
    """Match on a weak key unless more than ``max_conflicts`` other fields differ (both filled, unequal).

    At most c conflicts means some set of F-c fields is free of conflict. A field is free of conflict when equal or blank
    on one side, which wildcards turn into equality: a master offers each field as its value (or "blank") and as "any"; a
    raw value asks for itself and for "blank", a blank raw asks for "any".
    """
    sets = list(combinations(fields, max(len(fields) - max_conflicts, 0)))
    any_, blank = F.lit("any"), F.lit("blank")

    def norm(f):
        v = F.lower(f) if f == "email" else F.col(f)
        return F.when(has_string_value(f), F.concat(F.lit("="), v))

    def keyed(df, cols, offers):
        out = []
        for i, s in enumerate(sets):
            for choice in product(range(2), repeat=len(s)):
                parts = [offers(norm(f), c) for f, c in zip(s, choice)]
                valid = F.lit(True)
                for p in parts:
                    valid = valid & p.isNotNull()
                out.append(F.when(valid, F.struct(F.lit(1).alias("rule_id"), F.lit(weak_key).alias("attribute"),
                                                  F.array(F.lit(str(i)), F.col(weak_key), *parts).alias("value"))))
        return (
            df.where(has_string_value(weak_key)).select(*cols, "tenant_id", F.explode(F.array_compact(F.array(*out))).alias("i"))
            .select(*cols, "tenant_id", "i.*")
        )

    master_offer = lambda v, c: F.coalesce(v, blank) if c == 0 else any_
    raw_offer = lambda v, c: F.coalesce(v, any_) if c == 0 else F.when(v.isNotNull(), blank)
    return pick_candidate(exact_match(
        keyed(raw, ["raw_profile_id"], raw_offer), keyed(masters, ["master_profile_id", "created_at"], master_offer)))
