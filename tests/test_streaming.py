"""Streams give the batch result; replays change nothing; late rows wait for the backfill."""

import pytest

from kinweave.operators import ingest, resolution
from kinweave.plans import tables
from kinweave.streaming import resolve
from kinweave.streaming.store import append_upserts, compact, current

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def raw(spark):
    return tables.raw_profiles(spark, SMALL)


def links(store):
    return sorted((r.raw_profile_id, r.master_profile_id) for r in store.links().collect())


def test_batches_replay_and_backfill(spark, raw, tmp_path):
    store = resolve.ResolutionStore(spark, str(tmp_path / "s"), raw.schema)
    early = raw.where("received_at < timestamp_ntz'2024-01-29 00:00:00'")
    late = raw.where("received_at >= timestamp_ntz'2024-01-29 00:00:00'")
    resolve.resolve_batch(store, early, 0, None)
    first = links(store)
    resolve.resolve_batch(store, early, 0, None)
    assert links(store) == first and len(first) == early.count()
    in_window = resolve.resolve_batch(store, late, 1)
    assert 0 < in_window < late.count()
    assert resolve.backfill(store, 2) == late.count() - in_window
    assert len(links(store)) == raw.count()
    assert len({m for _, m in links(store)}) == store.masters().count()


def test_one_batch_equals_the_sweep(spark, raw, tmp_path):
    store = resolve.ResolutionStore(spark, str(tmp_path / "s"), raw.schema)
    resolve.resolve_batch(store, raw, 0, None)
    sweep = resolution.resolve_sequential(raw, as_of=tables.AS_OF)
    assert links(store) == sorted((r.raw_profile_id, r.master_profile_id) for r in sweep.links.collect())


def test_log_keeps_newest_and_compacts(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "k string, v int"
    df = lambda *rows: spark.createDataFrame(list(rows), schema)
    assert current(spark, path, ["k"], df(("a", 1)).schema).count() == 0
    append_upserts(df(("a", 1), ("b", 1)), path, 0)
    append_upserts(df(("a", 2)), path, 1)
    read = lambda p, **o: {r.k: r.v for r in current(spark, p, ["k"], df(("a", 1)).schema, **o).collect()}
    assert read(path) == {"a": 2, "b": 1} and read(path, before=1) == {"a": 1, "b": 1}
    compact(spark, path, ["k"], df(("a", 1)).schema, str(tmp_path / "log2"))
    assert read(str(tmp_path / "log2")) == {"a": 2, "b": 1}


def test_bucket_table_reads_the_buckets_of_its_keys_only(spark, tmp_path):
    """Runs fold by levels, the newest row wins, a replay sees earlier batches only, and other buckets are not scanned."""
    from kinweave.streaming.buckets import BucketTable
    t = BucketTable(spark, str(tmp_path / "t"), ["k"], ["k"], buckets=16, fan=3)
    rows = lambda b: spark.createDataFrame([(f"k{(b * 5 + i) % 17}", b) for i in range(8)], "k string, v int")
    want = {}
    assert t.read() is None
    for b in range(11):
        t.write(rows(b), b)
        want.update({f"k{(b * 5 + i) % 17}": b for i in range(8)})
        assert {r.k: r.v for r in t.read().collect()} == want
    assert [r.level for r in t.live()] == [2, 0, 0] and [(r.first, r.last) for r in t.live()] == [(0, 8), (9, 9), (10, 10)]
    before = {r.k: r.v for r in t.read(10).collect()}
    t.write(rows(10), 10)
    assert {r.k: r.v for r in t.read(10).collect()} == before and {r.k: r.v for r in t.read().collect()} == want
    keys = spark.createDataFrame([("k3",), ("k9",)], "k string")
    some = t.read(None, keys)
    assert {r.k: r.v for r in some.collect()} == {k: want[k] for k in ("k3", "k9")}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket", "[bucket") or "PartitionFilters: [(bucket" in plan or "bucket#" in plan.split("PartitionFilters")[1][:80]
    t.write(spark.createDataFrame([], "k string, v int"), 11)
    assert {r.k: r.v for r in t.read().collect()} == want


def test_batches_on_top_of_each_other_keep_what_masters_gathered(spark, raw, tmp_path):
    """Four micro-batches in order give the golden records and identifiers of one sweep."""
    store = resolve.ResolutionStore(spark, str(tmp_path / "s"), raw.schema, buckets=8)
    days = [r.d for r in raw.selectExpr("date(received_at) d").distinct().orderBy("d").collect()]
    cuts = [days[0], days[len(days) // 3], days[2 * len(days) // 3], days[-1]]
    for b, (low, high) in enumerate(zip(cuts, [*cuts[1:], None])):
        part = raw.where(raw.received_at.cast("date") >= low)
        resolve.resolve_batch(store, part if high is None else part.where(raw.received_at.cast("date") < high), b, None)
    sweep = resolution.resolve_sequential(raw, as_of=tables.AS_OF)
    golden, values = resolution.golden_tables(sweep, tables.AS_OF)
    assert links(store) == sorted((r.raw_profile_id, r.master_profile_id) for r in sweep.links.collect())
    names = ["master_profile_id", "email", "phone_number", "last_name", "city", "source_systems", "crm_contact_ids", "first_seen_raw_profile_id"]
    assert sorted(map(str, store.masters().select(names).collect())) == sorted(map(str, golden.select(names).collect()))
    three = ["master_profile_id", "kind", "value"]
    assert sorted(map(tuple, store.identifiers().select(three).collect())) == sorted(map(tuple, values.select(three).collect()))


def test_traits_and_types(spark):
    from kinweave.sources.events import parse_documents
    docs = [
        '{"visid":"v1","tenant_id":"t","metric":"m","profile_traits":{"phone":"1","phone_number":"2","name":"N","firstname":"F","first_name":"G"}}',
        '{"visid":"v2","tenant_id":"t","metric":"m","profile_traits":{"phone":null,"phone_number":"2","firstname":"F","first_name":"G"}}',
        '{"visid":7,"tenant_id":"t","metric":"m"}', '{"visid":"v3","tenant_id":"t","metric":""}', '{"visid":', "", '[1]',
        '{"visid":"' + "x" * 37 + '","tenant_id":"t","metric":"m"}', '{"visid":"v4","tenant_id":"t","metric":"' + "m" * 50 + '"}',
    ]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, value string")
    routed = ingest.route_ingest(parse_documents(df))
    outcome = [r.outcome for r in routed.orderBy("i").collect()]
    assert outcome == ["accepted", "accepted", "invalid", "accepted", "bad_json", "missing_body", "invalid", "invalid", "invalid"] or outcome[6] == "bad_json"
    mapped = {r.visid: r.profile_traits for r in ingest.map_trait_aliases(routed.where("i < 2")).collect()}
    assert mapped["v1"]["phone_number"] == "1" and mapped["v1"]["first_name"] == "N"
    assert mapped["v2"]["phone_number"] is None and mapped["v2"]["first_name"] == "F"


def test_upsert_overwrites_with_null(spark):
    schema = "tenant_id string, web_visitor_id string, raw_profile_id string, email string, received_at timestamp_ntz, status_code int"
    old = spark.sql("select 't' tenant_id, 'v' web_visitor_id, 'r1' raw_profile_id, 'e' email, timestamp_ntz'2024-01-01 00:00:00' received_at, 3 status_code")
    new = spark.sql("select 't' tenant_id, 'v' web_visitor_id, 'r2' raw_profile_id, cast(null as string) email, timestamp_ntz'2024-01-02 00:00:00' received_at, 1 status_code")
    row = ingest.upsert_raw_profiles(old, new, "2024-01-03 00:00:00").first()
    assert (row.raw_profile_id, row.email, row.status_code, str(row.received_at)) == ("r1", None, 1, "2024-01-03 00:00:00")


def test_window_counts_hold_the_newest_rows(spark):
    """Every row of the input is in a count, those of the last 180 minutes too."""
    from collections import Counter

    from kinweave.catalog import QUERIES
    want = Counter(r.ts.strftime("%Y-%m-%d %H:00:00") for r in spark.read.parquet(f"{SMALL}/events.parquet").select("ts").collect())
    got = {r.window_start: r.rows for r in QUERIES["stream_window_counts"].run(spark, SMALL).collect()}
    assert got == dict(want)


def one_file_per_batch(spark, folder, parts, schema):
    """Files in the order of ``parts``, one per micro-batch."""
    import os
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        for name in os.listdir(folder):
            if name.endswith(".parquet") and not name.startswith("f"):
                at = f"{folder}/f{len(os.listdir(folder))}_{k}.parquet"
                os.rename(f"{folder}/{name}", at)
                os.utime(at, (1_700_000_000 + 60 * len(os.listdir(folder)),) * 2)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


EVENTS = "event_id long, event_type string, ts timestamp"


def out_of_order():
    """Five parts out of time order; the fourth brings copies of the newest rows, the second an event without a time."""
    from datetime import datetime, timedelta
    start, parts = datetime(2024, 1, 1), []
    for k, day in enumerate((9, 3, 12, 1, 3)):
        own = [(1000 * day + i, f"e{i % 3}", start + timedelta(days=day, minutes=7 * i)) for i in range(40)]
        own += [(12_000 + i, f"e{i % 3}", start + timedelta(days=12, minutes=7 * i)) for i in range(5)] if k == 3 else []
        own += [(12_035 + i, f"e{(35 + i) % 3}", start + timedelta(days=12, minutes=7 * (35 + i))) for i in range(5)] if k == 4 else []
        own += [(77, "e9", None)] if k == 1 else []
        parts.append(own)
    return parts


def test_late_rows_are_stored_apart_and_merged(spark, tmp_path):
    from collections import Counter

    from kinweave.streaming import windows
    parts = out_of_order()
    rows = [r for p in parts for r in p]
    stream = one_file_per_batch(spark, str(tmp_path / "in"), parts, EVENTS)
    counts, events = str(tmp_path / "counts"), str(tmp_path / "events")
    windows.start_windowed_counts(stream, "ts", "1 hour", counts).awaitTermination()
    windows.start_dedup(stream, "ts", events).awaitTermination()
    want = Counter(t.strftime("%Y-%m-%d %H") for _, _, t in rows if t)
    assert {r.window_start.strftime("%Y-%m-%d %H"): r.rows for r in windows.windowed_counts(spark, counts).collect()} == dict(want)
    got = windows.first_copies(spark, events).collect()
    assert sorted(r.event_id for r in got) == sorted({e for e, _, _ in rows})
    assert {(r.event_id, r.event_type) for r in got} == {(e, k) for e, k, _ in rows}
    late = {r.event_id // 1000 for r in spark.read.parquet(f"{events}/late").collect()}
    assert late == {0, 1, 3, 12} and spark.read.parquet(f"{counts}/late").agg({"rows": "sum"}).first()[0] >= 80
    # Copies in time met their key in the state.
    assert spark.read.parquet(f"{events}/on_time").groupBy("event_id").count().where("count > 1").isEmpty()


def test_sliding_counts_by_type(spark, tmp_path):
    from collections import Counter
    from datetime import datetime, timedelta

    from kinweave.streaming import windows
    parts = out_of_order()
    stream = one_file_per_batch(spark, str(tmp_path / "in"), parts, EVENTS)
    windows.start_windowed_counts(stream, "ts", "3 hours", str(tmp_path / "c"), "1 hour", by=["event_type"]).awaitTermination()
    want = Counter()
    for _, kind, t in (r for p in parts for r in p):
        if t:
            hour = datetime(t.year, t.month, t.day, t.hour)
            want.update((hour - timedelta(hours=k), kind) for k in range(3))
    got = {(r.window_start, r.event_type): r.rows for r in windows.windowed_counts(spark, str(tmp_path / "c"), ["event_type"]).collect()}
    assert got == dict(want)


def test_state_is_bounded_by_the_watermark(spark, tmp_path):
    """Days in time order: the state holds what the last three hours may still change, whatever came before."""
    from datetime import datetime, timedelta

    from kinweave.streaming import windows
    start = datetime(2024, 1, 1)
    parts = [[(100 * day + i, "e", start + timedelta(days=day, minutes=10 * i)) for i in range(50)] for day in range(5)]
    stream = one_file_per_batch(spark, str(tmp_path / "in"), parts, EVENTS)
    held = {}
    for name, query in (("counts", windows.start_windowed_counts(stream, "ts", "1 hour", str(tmp_path / "c"))),
                        ("dedup", windows.start_dedup(stream, "ts", str(tmp_path / "d")))):
        query.awaitTermination()
        held[name] = [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]]
    assert held["counts"][-1] <= 9 + 4 and held["dedup"][-1] <= 50 + 19
    assert max(held["dedup"]) < 2.5 * 50 and "RocksDB" in windows.ROCKSDB
    assert windows.windowed_counts(spark, str(tmp_path / "c")).agg({"rows": "sum"}).first()[0] == 250
    assert windows.first_copies(spark, str(tmp_path / "d")).count() == 250


def test_streams_go_on_after_a_restart(spark, tmp_path):
    """The first three parts, a stop, then the others from the same checkpoints."""
    from collections import Counter

    from kinweave.streaming import state, store, windows
    parts, folder, path = out_of_order(), str(tmp_path / "in"), str(tmp_path)
    turns = [(r[0] % 7, r[0], f"text {r[0]}") for p in parts for r in p]
    talk, talk_schema = str(tmp_path / "talk"), "conv_id long, turn long, text string"
    for half in (parts[:3], parts[3:]):
        stream = one_file_per_batch(spark, folder, half, EVENTS)
        windows.start_windowed_counts(stream, "ts", "1 hour", f"{path}/c").awaitTermination()
        windows.start_dedup(stream, "ts", f"{path}/d").awaitTermination()
        spoken = one_file_per_batch(spark, talk, [[(r[0] % 7, r[0], f"text {r[0]}") for r in p] for p in half], talk_schema)
        memory = state.conversation_memory_stream(spoken, keep=4)
        state.start_upserts(memory, f"{path}/m").awaitTermination()
    rows = [r for p in parts for r in p]
    want = Counter(t.strftime("%Y-%m-%d %H") for _, _, t in rows if t)
    assert {r.window_start.strftime("%Y-%m-%d %H"): r.rows for r in windows.windowed_counts(spark, f"{path}/c").collect()} == dict(want)
    assert sorted(r.event_id for r in windows.first_copies(spark, f"{path}/d").collect()) == sorted({e for e, _, _ in rows})
    got = {r.conv_id: list(zip(r.turns, r.texts)) for r in store.current(spark, f"{path}/m/out", ["conv_id"], memory.schema).collect()}
    assert got == {c: sorted({(t, x) for k, t, x in turns if k == c})[-4:] for c in {k for k, _, _ in turns}}


def test_latest_profile_over_batches(spark, tmp_path):
    from kinweave.streaming import state, store
    parts = [[("t", f"v{i % 3}", at, f"m{at % 5}") for i, at in enumerate(range(s, s + 20))] for s in (100, 10, 60)]
    parts[1].append(("t", "v0", 10**6, None))
    stream = one_file_per_batch(spark, str(tmp_path / "in"), parts, "tenant_id string, visid string, at long, metric string")
    changes = state.latest_profile_state(stream)
    state.start_upserts(changes, str(tmp_path)).awaitTermination()
    got = {r.visid: (r.at, r.metric) for r in store.current(spark, f"{tmp_path}/out", ["tenant_id", "visid"], changes.schema).collect()}
    want = {}
    for _, v, at, m in (r for p in parts for r in p):
        want[v] = max(want.get(v, (-1, "")), (at, m or ""))
    assert got == {v: (at, m or None) for v, (at, m) in want.items()}


def test_idle_conversations_end_by_timer(spark, tmp_path):
    """A conversation that nothing was added to for a while is put out as ended and starts anew afterwards."""
    import time

    from kinweave.streaming import state
    path = str(tmp_path)
    schema = "conv_id long, turn long, text string"
    one_file_per_batch(spark, f"{path}/in", [[(1, 1, "a"), (1, 2, "b"), (1, None, "x")], [(1, 4, "d"), (1, 3, "c")]], schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    query = state.start_upserts(state.conversation_memory_stream(stream, keep=3, idle_ms=20_000), path, {"processingTime": "1 second"})

    def wait_for(rows):
        for _ in range(90):
            time.sleep(1)
            log = [(r.batch, r.turns, r.ended) for r in spark.read.schema(
                "conv_id long, turns array<long>, texts array<string>, ended boolean, batch long").option("basePath", f"{path}/out").parquet(
                f"{path}/out").collect()] if (tmp_path / "out").exists() else []
            if len(log) >= rows:
                return [(t, e) for _, t, e in sorted(log)]
        raise AssertionError(log)

    try:
        assert wait_for(3)[-1] == ([2, 3, 4], True)
        one_file_per_batch(spark, f"{path}/in", [[(1, 9, "new")]], schema)
        assert wait_for(4)[:4][-1] == ([9], False)
    finally:
        query.stop()


def test_ingest_counts_every_staging_row(spark):
    """Staging rows with a visitor id made from the other identifying fields are counted as well."""
    import duckdb

    from check import TABLES
    from kinweave.catalog import QUERIES
    from kinweave.catalog.ingest_queries import wire_sql
    from kinweave.catalog.sql import uuid5
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    made_up = uuid5("(w_tenant || 'obs' || 'shop.example.com' || w_version || w_phone || w_email)")
    rows = wire_sql(f"""
SELECT DISTINCT w_tenant, CASE WHEN trim(w_visid) = '' THEN {made_up} ELSE w_visid END AS id, k = 23 AS blank FROM wire
WHERE outcome = 'accepted' AND k NOT IN (21, 22)""")
    want = con.execute(f"SELECT count(*), count(*) FILTER (WHERE blank) FROM ({rows})").fetchone()
    got = {r.outcome: r.events for r in QUERIES["stream_ingest"].run(spark, SMALL).collect()}
    assert want[1] > 0 and got["staged"] == want[0]


def test_a_parsed_batch_is_held_in_small_parts(spark, tmp_path, monkeypatch):
    from kinweave.plans import storage
    from kinweave.streaming import ingest as stream_ingest

    docs = spark.range(400).selectExpr("""concat('{"tenant_id": "t", "metric": "m", "visid": "v', id, '", "mediahost": "', sha2(cast(id as string), 512), '"}') value""")
    docs.repartition(8).write.parquet(f"{tmp_path}/in")
    size = max(f.stat().st_size for f in (tmp_path / "in").glob("part-*"))
    monkeypatch.setattr(storage, "DOCUMENT_BYTES", size)
    parts, rows = [], stream_ingest.staging_rows
    monkeypatch.setattr(stream_ingest, "staging_rows", lambda batch: (parts.append(batch.rdd.getNumPartitions()), rows(batch))[1])
    given = {"spark.sql.files.minPartitionNum": "1", "spark.sql.files.openCostInBytes": "0"}
    for name, value in given.items():
        spark.conf.set(name, value)
    before = spark.conf.get(storage.TASK_BYTES)
    try:
        stream = stream_ingest.routed(spark.readStream.schema("value string").parquet(f"{tmp_path}/in"))
        with storage.documents_split(spark):
            stream_ingest.start_ingest(stream, *[f"{tmp_path}/{n}" for n in ("ok", "dead", "staging", "cp")]).awaitTermination()
    finally:
        for name in given:
            spark.conf.unset(name)
    assert parts == [8] and spark.conf.get(storage.TASK_BYTES) == before
    assert spark.read.parquet(f"{tmp_path}/staging").count() == 400
