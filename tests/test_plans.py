"""Skew-safe joins, stored tables and pushed-down scans."""

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from kinweave.catalog.context import Context
from kinweave.operators import behavior, ingest
from kinweave.plans import tables
from kinweave.plans.ordering import add_sequence
from kinweave.plans.skew import hot_keys, lookup_join, with_minimum
from kinweave.plans.storage import COMPILED_BYTES, LONGEST_METHOD, materialize, working_dir
from kinweave.sources import lake
from kinweave.sources.events import parse_documents


@pytest.fixture(scope="module")
def big(spark):
    rows = [(i, "hot" if i % 3 == 0 else ("lost" if i % 3 == 1 and i % 2 else f"k{i % 40}"), i % 2) for i in range(600)]
    rows += [(600 + i, None, 0) for i in range(10)]
    return spark.createDataFrame(rows, "i long, k string, p int")


@pytest.mark.parametrize("least", [20, 10**6])
def test_lookup_join_equals_left_join(spark, big, least):
    small = spark.createDataFrame([("hot", 1, "h"), ("k2", 2, None), ("k4", None, "x")], "k string, v int, w string")
    got = lookup_join(big, small, "k", 610, least)
    want = big.join(small, "k", "left").select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("least", [20, 10**6])
def test_lookup_join_on_two_columns(spark, big, least):
    small = spark.createDataFrame([("hot", 1, 7), ("lost", 0, 8), ("k3", 1, 9)], "k string, p int, v int")
    got = lookup_join(big, small, ["k", "p"], 610, least)
    want = big.join(small, ["k", "p"], "left").select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_keys_are_found_and_spread(spark, big):
    assert {r.k for r in hot_keys(big, ["k"], 610, 50).collect()} == {"hot", "lost"}
    assert hot_keys(big, ["k"], 610) is None
    plan = lookup_join(big, big.groupBy("k").agg(F.count("*").alias("n")), "k", 610, 50)._jdf.queryExecution().toString()
    assert "_salt" in plan


@pytest.mark.parametrize("least", [20, 10**6])
def test_with_minimum(spark, big, least):
    got = {r.i: (r.m, r.n) for r in with_minimum(big, "k", {"m": F.col("i"), "n": F.when(F.col("i") > 30, F.col("i"))}, 610, least).collect()}
    rows = [(r.i, r.k) for r in big.collect()]
    low, above = {}, {}
    for i, k in rows:
        low[k] = min(low.get(k, i), i)
        if i > 30:
            above[k] = min(above.get(k, i), i)
    assert got == {i: (None, None) if k is None else (low[k], above.get(k)) for i, k in rows}


def test_sequence_is_a_total_order(spark, big):
    rows = add_sequence(big.repartition(5), [F.desc("i")]).orderBy("seq").collect()
    assert [r.i for r in rows] == sorted((r.i for r in rows), reverse=True)


def _session(configured, checkpoint, master):
    context = SimpleNamespace(applicationId="app", master=master, getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: configured))


def test_storage_uses_the_shared_folder():
    assert working_dir(_session("hdfs://x/cp/", None, "yarn")) == "hdfs://x/cp/kinweave-app"
    assert working_dir(_session(None, "hdfs://y/1", "yarn")) == "hdfs://y/1/kinweave-app"
    with pytest.raises(RuntimeError):
        working_dir(_session(None, None, "spark://host:7077"))


def test_stored_tables_are_files(big):
    assert materialize(big).inputFiles() and sorted(map(str, materialize(big).collect())) == sorted(map(str, big.collect()))


def test_scans_are_pruned_and_filtered(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = lake.retention_filter(events, "ts", 7, "2024-01-30 10:30:00").select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-23T11:00" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_null_and_hot_keys_are_spread(spark):
    """Half of the rows without a key, half of the rest on one key; no partition of the join takes more than its share."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, None).when(
            F.col("id") % 4 == 1, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("k"))
        lookup = rows.where("k is not null").groupBy("k").agg(F.min("id").alias("v")).hint("merge")
        for least in (500, 10**6):
            joined = lookup_join(rows, lookup, "k", 40_000, least)
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            hot = 10_000 if least == 10**6 else 0  # a key below the limit may stay together
            assert max(sizes) - hot <= 3 * 40_000 / len(sizes), (least, sizes)
            assert joined.where("k is null and v is not null").count() == 0 and joined.count() == 40_000
        least = with_minimum(rows, "k", {"m": F.col("id")}, 40_000)
        sizes = [r["count"] for r in least.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) - 10_000 <= 3 * 40_000 / len(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_a_filter_on_fields_does_not_repeat_the_parsing(spark):
    docs = spark.createDataFrame([('{"tenant_id": "t", "visid": "v", "metric": "m"}',), ('{"tenant_id": 1, "visid": "v", "metric": "m"}',),
                                  ("{",), ("",), (None,)], "value string")
    ok = ingest.classify_records(ingest.accepted(ingest.route_ingest(parse_documents(docs)))).where("record_state = 'Ok'")
    assert ok._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert [(r.tenant_id, r.visid, r.metric) for r in ok.collect()] == [("t", "v", "m")]


def test_a_filter_on_fields_does_not_repeat_the_reading_of_variants(spark):
    docs = spark.createDataFrame([('{"tenant_id": "t", "visid": "v", "metric": "m"}',)], "value string")
    ok = ingest.classify_records(ingest.accepted(ingest.route_ingest(parse_documents(docs)))).where("record_state = 'Ok'")
    plan = ok.select("tenant_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get(_doc") == 3 and plan.count("schemaOfVariant(") == 3, plan


def test_an_empty_body_is_found_without_counting_characters(spark):
    df = parse_documents(spark.createDataFrame([(1, None), (2, ""), (3, "{"), (4, "\u00e9")], "id int, value string"))
    routed = ingest.route_ingest(df)
    assert {r.id: r.outcome for r in routed.collect()} == {1: "missing_body", 2: "missing_body", 3: "bad_json", 4: "bad_json"}
    plan = ingest.accepted(routed)._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length(value" in plan and not re.search(r"(?<!octet_)length\(value", plan)


def test_documents_are_not_written_to_be_read_once(spark, monkeypatch, tmp_path):
    one = spark.createDataFrame([(1, "e30=")], "eid long, data string")
    monkeypatch.setattr(tables, "_tracking_documents", lambda *_: one)
    monkeypatch.setattr(tables, "_stored", {})
    assert [r.eid for r in tables.routed_events(spark, str(tmp_path)).collect()] == [1]
    assert tables._stored == {}
    kept = tables.tracking_documents(spark, str(tmp_path))
    assert tables.routed_events(spark, str(tmp_path)).inputFiles() == kept.inputFiles() != []


@pytest.mark.parametrize("build", [tables.accepted_events, tables.raw_profiles])
def test_wide_tables_are_written_by_compiled_methods(spark, monkeypatch, build):
    before = spark.conf.get(LONGEST_METHOD)
    monkeypatch.setattr(tables, "stored", lambda *_: spark.conf.get(LONGEST_METHOD))
    assert build(spark, "unused") == COMPILED_BYTES
    assert spark.conf.get(LONGEST_METHOD) == before


def test_events_are_stitched_without_being_counted(spark, monkeypatch):
    bounds = []
    monkeypatch.setattr(Context, "keep", lambda self, name, build: build())
    monkeypatch.setattr(Context, "accepted", lambda self: spark.range(3))
    monkeypatch.setattr(Context, "owners", lambda self: None)
    monkeypatch.setattr(behavior, "events_to_behavioral", lambda df: None)
    monkeypatch.setattr(behavior, "stitch_events", lambda events, owners, rows=None: bounds.append(rows))
    Context(spark, "unused").events()
    assert bounds == [3]
