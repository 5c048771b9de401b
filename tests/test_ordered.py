"""Ordered mode for any rules equals one row after the other; plans compiled from metadata; the run ledger."""

import random

import pytest
from pyspark.sql import functions as F
from test_resolution import AS_OF, SMALL, groups, raws

from kinweave.config import Rule
from kinweave.operators import jobs, metadata, ordered, resolution, runs, survivorship
from kinweave.plans import tables
from kinweave.streaming.resolve import ResolutionStore

SLOTS = {1: False, 2: True, 3: True, 4: False}


def one_by_one(rows):
    """rows: (seq, is_prior, {rule: values}, {rule: asked values}) -> {seq: (master, rule)}"""
    masters, out = [], {}
    for seq, prior, held, asked in rows:
        hit, rule = None, None
        if not prior:
            for r in sorted(asked):
                hit = next((m for m in masters if any(v in m["owns"].get(r, ()) for v in asked[r])), None)
                if hit:
                    rule = r
                    break
        if hit is None:
            hit = {"id": seq, "owns": {}}
            masters.append(hit)
        for r, values in held.items():
            if SLOTS[r]:
                if values and not hit["owns"].get(r):
                    hit["owns"][r] = {values[0]}
            else:
                hit["owns"].setdefault(r, set()).update(values)
        out[seq] = (hit["id"], rule)
    return out


def random_rows(seed, n, keys, hot, priors):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        held = {}
        for r in SLOTS:
            if rng.random() < 0.55:
                value = "hot" if rng.random() < hot else f"{rng.randrange(keys)}"
                held[r] = [value, *([f"{rng.randrange(keys)}"] if not SLOTS[r] and i < priors else [])]
        asked = {r: [v[0], *([f"{rng.randrange(keys)}"] if r == 4 and rng.random() < 0.3 else [])] for r, v in held.items()}
        rows.append((i, i < priors, held, {} if i < priors else asked))
    return rows


@pytest.mark.parametrize("seed,n,keys,hot,priors", [(1, 120, 40, 0.0, 0), (2, 150, 12, 0.0, 20), (3, 200, 60, 0.4, 10), (4, 150, 400, 0.1, 0)])
def test_rounds_equal_one_row_after_the_other(spark, seed, n, keys, hot, priors):
    rows = random_rows(seed, n, keys, hot, priors)
    number = lambda s: s * 7 + 3
    nodes = spark.createDataFrame([(number(s), p) for s, p, _, _ in rows], "seq long, is_prior boolean")
    held = spark.createDataFrame([(number(s), "t", r, v, SLOTS[r]) for s, _, h, _ in rows for r, vs in h.items() for v in vs],
                                 "seq long, tenant_id string, rule_id int, value string, slot boolean")
    asked = spark.createDataFrame([(number(s), "t", r, v) for s, _, _, a in rows for r, vs in a.items() for v in vs],
                                  "seq long, tenant_id string, rule_id int, value string")
    got = ordered.settle(nodes, *ordered.keyed(held, asked, 4 * n, min_hot_rows=50), block_bits=5)
    want = {number(s): (number(m), r) for s, (m, r) in one_by_one(rows).items()}
    assert {r.seq: (r.master, r.rule_id) for r in got.collect()} == want


def test_hot_value_settles_in_few_rounds(spark):
    nodes = spark.range(3000).select(F.col("id").alias("seq"), F.lit(False).alias("is_prior"))
    values = nodes.select("seq", F.lit("t").alias("tenant_id"), F.explode(F.array(
        F.struct(F.lit(2).alias("r"), F.when(F.col("seq") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("seq") % 900)).alias("v")),
        F.struct(F.lit(3).alias("r"), F.concat(F.lit("e"), F.col("seq") % 700).alias("v")))).alias("x"))
    values = values.select("seq", "tenant_id", F.col("x.r").alias("rule_id"), F.col("x.v").alias("value"))
    got = ordered.settle(nodes, *ordered.keyed(values.withColumn("slot", F.lit(True)), values, 6000, min_hot_rows=100), max_rounds=14)
    rows = {}
    for r in values.collect():
        rows.setdefault(r.seq, {})[r.rule_id] = [r.value]
    want = one_by_one([(s, False, h, h) for s, h in sorted(rows.items())])
    assert {r.seq: r.master for r in got.collect()} == {s: m for s, (m, _) in want.items()}


def test_long_chain_settles_in_few_blocks(spark):
    """Every row asks for the value of the row before, which owns it only if that row founded a master: each decision hangs on the last one."""
    nodes = spark.range(700).select(F.col("id").alias("seq"), (F.col("id") < 2).alias("is_prior"))
    held = nodes.select("seq", F.lit("t").alias("tenant_id"), F.lit(3).alias("rule_id"), F.col("seq").cast("string").alias("value"), F.lit(True).alias("slot"))
    asked = nodes.select("seq", F.lit("t").alias("tenant_id"), F.lit(3).alias("rule_id"), F.explode(F.array(
        F.col("seq").cast("string"), (F.col("seq") - 1).cast("string"))).alias("value"))
    got = ordered.settle(nodes, *ordered.keyed(held, asked, 1400), max_rounds=9, block_bits=8)
    want = one_by_one([(s, s < 2, {3: [str(s)]}, {} if s < 2 else {3: [str(s), str(s - 1)]}) for s in range(700)])
    assert {r.seq: (r.master, r.rule_id) for r in got.collect()} == want
    with pytest.raises(RuntimeError):
        ordered.settle(nodes, *ordered.keyed(held, asked, 1400), max_rounds=2, block_bits=8)


def test_rows_without_identifiers_found_masters(spark):
    nodes = spark.range(5).select(F.col("id").alias("seq"), F.lit(False).alias("is_prior"))
    held = spark.createDataFrame([(1, None, 3, "x", True), (2, None, 3, "x", True)], "seq long, tenant_id string, rule_id int, value string, slot boolean")
    for some in (held, held.limit(0)):
        got = ordered.settle(nodes, *ordered.keyed(some, some.drop("slot"), 5))
        assert {r.seq: (r.master, r.rule_id) for r in got.collect()} == {s: (s, None) for s in range(5)}


RULES = (Rule(1, "crm_source_id", kind="map"), Rule(2, "email", ignore_case=True), Rule(3, "web_visitor_id", kind="array"),
         Rule(4, "last_name", "fuzzy_trgm", 0.6), Rule(5, "first_name", "fuzzy_dmetaphone"))


def test_rules_of_every_kind_in_order(spark):
    rows = [
        {"email": "A@x", "last_name": "Henderson", "web_visitor_id": "w1"}, {"email": "a@X", "web_visitor_id": "w2"},
        {"web_visitor_id": "w2", "crm_source_id": "c1", "source_system": "crm"}, {"crm_source_id": "c1", "source_system": "web", "web_visitor_id": "w9"},
        {"crm_source_id": "c1", "source_system": "crm", "web_visitor_id": "w8", "email": "other@x"}, {"email": "other@x", "web_visitor_id": "w7"},
        {"last_name": "Hendersson", "web_visitor_id": "w6"}, {"first_name": "Robert", "web_visitor_id": "w5"}, {"first_name": "Rupert", "web_visitor_id": "w4"},
        {"tenant_id": "t9", "email": "a@x", "web_visitor_id": "w1"}]
    raw = raws(spark, *rows)
    res = resolution.resolve_sequential(raw, rules=RULES, as_of=AS_OF)
    assert groups(res) == [["r0", "r1", "r2", "r4", "r6"], ["r3"], ["r5"], ["r7", "r8"], ["r9"]]
    how = {r.raw_profile_id: r.matched_attribute for r in res.links.collect()}
    assert (how["r0"], how["r1"], how["r2"], how["r4"], how["r6"], how["r8"]) == ("new", "email", "web_visitor_id", "crm_source_id", "last_name", "first_name")
    # On top of prior masters their sets and maps answer as well.
    early, late = raw.where("raw_profile_id in ('r0', 'r1', 'r2', 'r3')"), raw.where("raw_profile_id not in ('r0', 'r1', 'r2', 'r3')")
    first = resolution.resolve_ordered(early, rules=RULES, as_of="2025-05-02 00:00:00")
    golden, ids = resolution.golden_tables(first, "2025-05-02 00:00:00")
    second = resolution.resolve_ordered(late, survivorship.with_identifier_arrays(golden, ids), as_of=AS_OF, rules=RULES)
    both = {r.raw_profile_id: r.master_profile_id for r in first.links.collect()} | {r.raw_profile_id: r.master_profile_id for r in second.links.collect()}
    assert both == {r.raw_profile_id: r.master_profile_id for r in res.links.collect()}


SCHEMA = ("id int, attribute_internal_code string, is_identity_resolution boolean, status string, matching_rule string, "
          "matching_threshold double, consolidation_rule string")


def test_plan_of_metadata(spark):
    meta = spark.createDataFrame([
        (3, "email", True, "ACTIVE", "exact", None, "non_null"), (1, "crm_source_id", True, "ACTIVE", "exact", None, "prefer_master"),
        (2, "last_name", True, "ACTIVE", "fuzzy_trgm", None, "most_recent"), (4, "city", False, "ACTIVE", "none", None, "concatenate"),
        (5, "gender", True, "DELETED", "exact", None, "non_null"), (6, "x", True, "ACTIVE", "sounds_like", None, "shortest"),
        (7, "email", True, "ACTIVE", "exact", None, "prefer_raw")], SCHEMA)
    plan = metadata.compile_plan(meta)
    assert [(r.id, r.attribute, r.kind, r.ignore_case) for r in plan.rules] == [(1, "crm_source_id", "map", False), (3, "email", "column", True)]
    assert plan.policies == {"crm_source_id": "prefer_master", "last_name": "most_recent", "email": "non_null", "city": "concatenate"}
    assert set(plan.ignored) == {"last_name", "x"}


@pytest.mark.parametrize("mode", ["transitive", "ordered"])
def test_policies_of_metadata(spark, mode):
    day = lambda d: f"2025-04-{d:02d} 00:00:00"
    import datetime as dt
    at = lambda d: dt.datetime(2025, 4, d)
    rows = [{"email": "a@x", "city": "Hue", "first_name": "Old", "last_seen_at": at(9), "latitude": 1.0, "crm_source_id": "c1", "ext_attributes": {"tier": "1"}},
            {"email": "A@X", "city": "Hanoi", "first_name": "New", "last_seen_at": at(3), "latitude": 2.0, "crm_source_id": "c2"},
            {"email": "a@x", "city": "", "last_seen_at": at(5), "ext_attributes": {"tier": "2"}}, {"email": "b@x"}]
    meta = spark.createDataFrame([
        (1, "email", True, "ACTIVE", "exact", None, "prefer_master"), (2, "city", False, "ACTIVE", None, None, "concatenate"),
        (3, "first_name", False, "ACTIVE", None, None, "most_recent"), (4, "tier", False, "ACTIVE", None, None, "non_null"),
        (5, "latitude", False, "ACTIVE", None, None, "prefer_master"), (6, "crm_source_id", False, "ACTIVE", None, None, "prefer_master")], SCHEMA)
    res = metadata.resolve_by_metadata(raws(spark, *rows), meta, as_of=AS_OF, mode=mode)
    got = {r.member_rows: r for r in metadata.golden_by_metadata(res, meta).collect()}
    assert set(got) == {3, 1} and got[3].email == "a@x" and got[3].city == ["Hanoi", "Hue"] and got[3].first_name == "Old"
    assert got[3].tier == "2" and got[3].latitude == 1.0 and got[3].crm_source_id == {"web": "c1"} and got[1].crm_source_id is None
    assert day(1) and metadata.resolve_by_metadata(raws(spark, *rows), meta.where("id > 1"), as_of=AS_OF, mode=mode).links.select(
        "master_profile_id").distinct().count() == 4


def windows_of(spark, *spans):
    return spark.createDataFrame([("t0", f"2025-05-01 {a}:00", f"2025-05-01 {b}:00") for a, b in spans], "tenant_id string, f string, t string").select(
        "tenant_id", F.col("f").cast("timestamp_ntz").alias("data_from_datetime"), F.col("t").cast("timestamp_ntz").alias("data_to_datetime"))


def test_ledger_of_runs(spark, tmp_path, monkeypatch):
    """A run over two windows, a failed one, a lost one that is repeated without double links."""
    raw = raws(spark, *[{"email": f"e{i % 4}@x"} for i in range(20)])
    ledger, store = runs.RunLedger(spark, str(tmp_path / "ledger")), ResolutionStore(spark, str(tmp_path / "store"), raw.schema, buckets=8)
    windows = windows_of(spark, ("00:00", "00:05"), ("00:05", "00:10"))
    assert runs.run_planned(ledger, store, raw, windows, AS_OF) == 0 and ledger.committed() == 1
    assert sorted((r.job_status, r.processed_count) for r in ledger.rows().collect()) == [("success", 5), ("success", 5)]
    assert runs.run_planned(ledger, store, raw, windows, AS_OF) is None and store.links().count() == 10

    later = windows_of(spark, ("00:10", "00:15"))
    whole = runs.resolve_batch
    monkeypatch.setattr(runs, "resolve_batch", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("no space")))
    with pytest.raises(RuntimeError):
        runs.run_planned(ledger, store, raw, later, AS_OF)
    failed = ledger.rows().where("job_status = 'failed'").collect()
    assert [(r.processed_count, r.error_message) for r in failed] == [(0, "RuntimeError: no space")] and ledger.lost() == []

    def dies(*a, **k):
        whole(*a, **k)
        raise KeyboardInterrupt

    monkeypatch.setattr(runs, "resolve_batch", dies)
    with pytest.raises(KeyboardInterrupt):
        runs.run_planned(ledger, store, raw, later, AS_OF)
    assert ledger.lost() == [2] and ledger.committed() == 1 and store.links(ledger.committed()).count() == 10
    monkeypatch.setattr(runs, "resolve_batch", whole)
    assert runs.run_planned(ledger, store, raw, windows_of(spark, ("00:10", "00:15"), ("00:15", "00:30")), AS_OF) == 3
    assert ledger.lost() == [] and ledger.committed() == 4
    links = store.links(ledger.committed()).collect()
    assert len(links) == len({r.raw_profile_id for r in links}) == 20 and len({r.master_profile_id for r in links}) == 4
    sweep = resolution.resolve_sequential(raw, as_of=AS_OF)
    assert {(r.raw_profile_id, r.master_profile_id) for r in links} == {(r.raw_profile_id, r.master_profile_id) for r in sweep.links.collect()}


def test_backfill_counts_by_window(spark):
    raw = raws(spark, *[{"email": f"e{i % 3}@x"} for i in range(10)])
    res, counts = jobs.backfill(raw, None, None, "2025-05-01 00:09:00", 120, 3, AS_OF)
    assert sorted(r.raw_profile_id for r in res.links.collect()) == [f"r{i}" for i in range(3, 9)]
    assert sorted(map(tuple, counts.collect())) == [(0, 2, 0, 2), (1, 2, 1, 1), (2, 2, 2, 0)]


def test_ordered_metadata_equals_a_plain_loop(spark):
    """The registered query's plan on the smallest data, row after row."""
    from kinweave.catalog.metadata_queries import ORDERED_ATTRIBUTES
    raw = tables.raw_profiles(spark, SMALL)
    rules = metadata.compile_plan(spark.createDataFrame(ORDERED_ATTRIBUTES, SCHEMA)).rules
    rows = sorted(raw.collect(), key=lambda r: (r.received_at, r.raw_profile_id))

    def grams(text):
        return {f"  {w} "[i:i + 3] for w in "".join(c if c.isalnum() else " " for c in text.lower()).split() for i in range(len(w) + 1)}

    def same(rule, mine, theirs):
        if rule.matching_rule == "exact":
            return mine == theirs
        a, b = grams(mine), grams(theirs)
        return bool(a | b) and len(a & b) / len(a | b) >= rule.threshold - 1e-9

    def value(r, rule):
        v = r[rule.attribute]
        return None if not v else f"{r.source_system}|{v}" if rule.kind == "map" else v.lower() if rule.ignore_case else v

    masters, want = [], {}
    for r in rows:
        hit = next((m for rule in rules if value(r, rule) for m in masters if m["t"] == r.tenant_id
                    and any(same(rule, value(r, rule), v) for v in m["owns"][rule.id])), None)
        if hit is None:
            hit = {"t": r.tenant_id, "id": r.raw_profile_id, "owns": {rule.id: [] for rule in rules}}
            masters.append(hit)
        for rule in rules:
            v = value(r, rule)
            if v and (rule.kind != "column" or not hit["owns"][rule.id]):
                hit["owns"][rule.id].append(v)
        want.setdefault(hit["id"], []).append(r.raw_profile_id)
    res = resolution.resolve_ordered(raw, rules=rules, as_of=AS_OF)
    assert groups(res) == sorted(map(sorted, want.values()))
