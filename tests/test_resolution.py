"""Hand rows of both resolution modes, and invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kinweave.config import DEFAULT_RULES, Rule
from kinweave.operators import jobs, resolution, survivorship
from kinweave.plans import tables
from kinweave.schema import RAW_TEXT_COLUMNS, RAW_TYPES

AS_OF = "2025-05-15 00:00:00"
SMALL = "/root/testdata/sf0.001"


def raws(spark, *rows):
    """Each row: dict of staging values; order of arguments is order of arrival."""
    names = ["raw_profile_id", "received_at", "status_code", *RAW_TEXT_COLUMNS, "preferred_communication", "ext_attributes"]
    types = {"received_at": "timestamp_ntz", "status_code": "int", "preferred_communication": "map<string,string>",
             "ext_attributes": "map<string,string>", **RAW_TYPES}
    data = []
    for i, r in enumerate(rows):
        base = {"raw_profile_id": f"r{i}", "received_at": dt.datetime(2025, 5, 1) + dt.timedelta(minutes=i), "status_code": 1,
                "tenant_id": "t0", "web_visitor_id": f"v{i}", "source_system": "web", "preferred_communication": {},
                "ext_attributes": {}}
        data.append(tuple({**base, **r}.get(n) for n in names))
    return spark.createDataFrame(data, ", ".join(f"{n} {types.get(n, 'string')}" for n in names))


def groups(res):
    out = {}
    for r in res.links.collect():
        out.setdefault(r.master_profile_id, set()).add(r.raw_profile_id)
    return sorted(map(sorted, out.values()))


MODES = {"transitive": resolution.resolve_transitive, "sequential": resolution.resolve_sequential}


@pytest.mark.parametrize("mode", MODES)
def test_hand_rows(spark, mode):
    """One tenant per case, all cases in one run."""
    cases = {
        "sample": [("john@", "1234567890"), ("john@", None), ("jane.d@", "5551234567"), ("jane.d@", "5551234567"), (None, "8889990000")],
        "case": [("X@A.com", None), ("x@a.COM", None)],
        "blank": [("", None), ("", None)],
        "order": [("e1", None), (None, "p1"), ("e1", "p1")],
        "reversed": [("e1", "p1"), ("e1", None), (None, "p1")],
    }
    rows, place = [], {}
    for tenant, values in cases.items():
        for n, (email, phone) in enumerate(values):
            place[f"r{len(rows)}"] = (tenant, n)
            rows.append({"tenant_id": tenant, "email": email, "phone_number": phone})
    rows += [{"tenant_id": "t1", "email": "same@x"}, {"tenant_id": "t2", "email": "same@x"}]
    res = MODES[mode](raws(spark, *rows), as_of=AS_OF)
    got = {}
    for g in groups(res):
        tenant = place.get(g[0], ("other", 0))[0]
        got.setdefault(tenant, []).append(sorted(place.get(r, ("", 0))[1] for r in g))
    assert sorted(got["sample"]) == [[0, 1], [2, 3], [4]]
    assert got["case"] == [[0, 1]]
    assert sorted(got["blank"]) == [[0], [1]]
    assert sorted(got["order"]) == ([[0, 2], [1]] if mode == "sequential" else [[0, 1, 2]])
    assert got["reversed"] == [[0, 1, 2]]
    assert len(got["other"]) == 2
    rules = {r.raw_profile_id: r.match_rule for r in res.links.collect()}
    assert rules["r0"] == "NewMaster" and rules["r1"] == "DynamicMatch"


@pytest.mark.parametrize("mode", MODES)
def test_merge_into_existing_master(spark, mode):
    first = MODES[mode](raws(spark, {"email": "david@x", "phone_number": "p1", "first_name": "David", "source_system": "CRM"}), as_of="2025-05-01 00:00:00")
    golden, ids = resolution.golden_tables(first, "2025-05-01 00:00:00")
    later = raws(spark, {"raw_profile_id": "new", "email": "dave@x", "phone_number": "p1", "first_name": "Dave", "source_system": "Web"})
    res = MODES[mode](later, survivorship.with_identifier_arrays(golden, ids), as_of=AS_OF)
    link = res.links.collect()
    assert [(r.match_rule, r.matched_attribute, r.master_profile_id) for r in link] == [
        ("DynamicMatch", "phone_number", golden.first().master_profile_id)]
    merged, values = resolution.golden_tables(res, AS_OF)
    row = merged.first()
    assert merged.count() == 1 and row.first_name == "Dave" and row.email == "david@x" and row.status_code == 10
    assert str(row.created_at) == "2025-05-01 00:00:00" and row.first_seen_raw_profile_id == "r0"
    assert {(r.kind, r.value) for r in values.collect() if r.kind != "web_visitor"} == {("secondary_email", "dave@x")}
    assert set(row.source_systems) >= {"Web"}


def test_returning_visitor_updates_the_linked_master(spark):
    rows = raws(spark, {"email": "a@x", "city": "Hue"}, {"email": "b@x", "city": "Vinh"})
    res = resolution.resolve_transitive(rows, as_of="2025-05-01 00:00:00")
    golden, _ = resolution.golden_tables(res, "2025-05-01 00:00:00")
    changed = raws(spark, {"email": "a@x", "city": "Da Nang"}, {"email": "b@x", "status_code": 3})
    assert resolution.pending_raw(changed, res.links).count() == 0
    out = resolution.merge_updated(changed, res.links, golden, AS_OF).collect()
    assert [(r.email, r.city, str(r.created_at), str(r.updated_at)) for r in out] == [
        ("a@x", "Da Nang", "2025-05-01 00:00:00", AS_OF)]


def test_crm_map_joins_rows(spark):
    res = resolution.resolve_transitive(raws(
        spark, {"source_system": "CRM", "crm_source_id": "7"}, {"source_system": "CRM", "crm_source_id": "7"},
        {"source_system": "ERP", "crm_source_id": "7"}), rules=DEFAULT_RULES, as_of=AS_OF)
    assert groups(res) == [["r0", "r1"], ["r2"]]
    golden, _ = resolution.golden_tables(res, AS_OF)
    assert sorted(str(r.crm_contact_ids) for r in golden.collect()) == ["{'CRM': '7'}", "{'ERP': '7'}"]


def test_joined_masters_become_aliases(spark):
    a = resolution.resolve_transitive(raws(spark, {"email": "a@x"}, {"email": "b@x"}), as_of="2025-05-01 00:00:00")
    golden, _ = resolution.golden_tables(a, "2025-05-01 00:00:00")
    founded = {"r0": "2025-05-01 00:00:00", "r1": "2025-05-02 00:00:00"}
    golden = golden.withColumn("created_at", F.when(F.col("first_seen_raw_profile_id") == "r0", founded["r0"]).otherwise(founded["r1"]).cast("timestamp_ntz"))
    old = {r.first_seen_raw_profile_id: r.master_profile_id for r in golden.collect()}
    bridge = raws(spark, {"raw_profile_id": "n1", "email": "A@x", "phone_number": "p"}, {"raw_profile_id": "n2", "email": "b@x", "phone_number": "p"})
    res = resolution.resolve_transitive(bridge, golden, as_of=AS_OF)
    assert [(r.old_id, r.new_id) for r in res.aliases.collect()] == [(old["r1"], old["r0"])]
    assert {r.master_profile_id for r in res.links.collect()} == {old["r0"]}


def test_survivorship_policies(spark):
    rows = [(1, "m", "a", "s1", dt.datetime(2025, 1, 3)), (2, "m", "", "s2", dt.datetime(2025, 1, 1)), (3, "m", None, "s1", None)]
    df = spark.createDataFrame(rows, "seq long, master_profile_id string, c string, s string, last_seen_at timestamp_ntz")
    got = survivorship.consolidate(df.withColumn("c2", F.col("c")).withColumn("c3", F.col("c")), {
        "c": "prefer_raw", "c2": "prefer_master", "c3": "most_recent", "s": "concatenate"}).first()
    assert (got.c, got.c2, got.c3, got.s) == ("", "a", "a", ["s1", "s2"])


def test_pipeline_counts_and_invariants(spark):
    raw = tables.raw_profiles(spark, SMALL)
    rules = [r for r in DEFAULT_RULES if r.attribute in ("email", "phone_number", "crm_source_id")]
    a = resolution.resolve_transitive(raw, rules=rules, as_of=AS_OF)
    b = resolution.resolve_transitive(raw.orderBy(F.desc("email")).repartition(3), rules=rules, as_of=AS_OF)
    s = resolution.resolve_sequential(raw, as_of=AS_OF)
    assert (raw.count(), len(groups(a)), len(groups(s))) == (60, 28, 32)
    assert groups(a) == groups(b)
    for res in (a, s):
        assert res.links.count() == res.links.select("raw_profile_id").distinct().count() == 60
        assert res.links.where("match_rule = 'NewMaster'").count() == len(groups(res))
    assert resolution.pending_raw(raw, a.links).count() == 0
    done = resolution.mark_processed(raw, a.links, AS_OF)
    assert {r.status_code for r in done.collect()} == {3}


def test_windows_and_ledger(spark):
    df = raws(spark, {}, {}, {})
    window = jobs.backlog_window(df, spark.createDataFrame([("r2",)], "raw_profile_id string")).first()
    assert (str(window.from_ts), str(window.to_ts)) == ("2025-04-30 21:02:00", "2025-05-01 00:02:00")
    everything = df.select("raw_profile_id")
    assert jobs.backlog_window(df, everything).count() == 0
    entry = jobs.ledger_row(spark, "t0", (str(window.from_ts), str(window.to_ts)), "success", 2, AS_OF, AS_OF)
    wanted = spark.createDataFrame([("t0", window.from_ts, window.to_ts), ("t1", window.from_ts, window.to_ts)],
                                   "tenant_id string, data_from_datetime timestamp_ntz, data_to_datetime timestamp_ntz")
    assert [r.tenant_id for r in jobs.plan_jobs(entry, wanted).collect()] == ["t1"]
    counts = {r.window_index: r.pending for r in jobs.backfill_windows(df, "2025-05-01 00:02:00", 60, 5).collect()}
    assert counts == {0: 1, 1: 1}


def test_two_windows_give_the_sets_and_maps_of_one_sweep(spark):
    rows = [
        {"email": "a@x", "source_system": "web", "web_visitor_id": "v1"},
        {"email": "A@x", "source_system": "CRM", "crm_source_id": "c1", "phone_number": "1"},
        {"phone_number": "1", "email": "other@x", "source_system": "ERP", "crm_source_id": "e1", "ext_attributes": {"k": "1"}},
        {"email": "b@x", "source_system": "shop"},
        {"email": "other@x", "source_system": "web", "web_visitor_id": "v9", "phone_number": "2", "ext_attributes": {"l": "2"}},
        {"email": "b@x", "phone_number": "2", "source_system": "app", "web_visitor_id": "v3"},
        {"email": "new@x", "source_system": "app"},
    ]
    everything = raws(spark, *rows)
    early, late = everything.where("raw_profile_id < 'r4'"), everything.where("raw_profile_id >= 'r4'")

    def state(golden, values):
        return ({(r.master_profile_id, r.email, r.phone_number, tuple(r.source_systems), tuple(sorted(r.crm_contact_ids.items())),
                  tuple(sorted(r.ext_attributes.items()))) for r in golden.collect()},
                {(r.master_profile_id, r.kind, r.value) for r in values.collect()})

    once = state(*resolution.golden_tables(resolution.resolve_transitive(everything, as_of=AS_OF), AS_OF))
    first = resolution.resolve_transitive(early, as_of="2025-05-01 00:10:00")
    golden, values = resolution.golden_tables(first, "2025-05-01 00:00:00")
    founded = first.members.where("seq = root").select("master_profile_id", "arrived_at")
    prior = survivorship.with_identifier_arrays(golden, values).join(founded, "master_profile_id").withColumn(
        "created_at", F.col("arrived_at")).drop("arrived_at")
    second = resolution.resolve_transitive(late, prior, as_of=AS_OF)
    assert state(*resolution.golden_tables(second, AS_OF)) == once


def test_rules_are_followed_by_their_kind(spark):
    rows = raws(spark, {"last_name": "Jonathan Smith"}, {"last_name": "Jonathan Smyth"}, {"last_name": "Mary Poe"})
    named = lambda kind, least=None: [Rule(1, "last_name", kind, least)]
    run = lambda rules, masters=None: groups(resolution.resolve_transitive(rows, masters, rules=rules, as_of=AS_OF))
    assert run(named("fuzzy_trgm", 0.5)) == [["r0", "r1"], ["r2"]]
    assert run(named("fuzzy_trgm")) == run(named("no_such_kind")) == run(named("exact")) == [["r0"], ["r1"], ["r2"]]
    assert run(named("fuzzy_dmetaphone")) == [["r0", "r1"], ["r2"]]
    with pytest.raises(ValueError):
        resolution.resolve_sequential(rows, rules=(Rule(1, "email", "fuzzy_trgm", 0.5), Rule(2, "phone_number")))
