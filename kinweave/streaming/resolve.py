"""Resolution in micro-batches over the trailing window; rows that come too late wait for the backfill.

The store holds golden records with their sets and maps, identifier rows, links and an index from contact values to masters, each in hash
buckets, so a batch opens the buckets of its own rows, contacts and masters only. What waits is one small table per batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.operators.jobs import LOOK_BACK_MINUTES
from kinweave.operators.resolution import golden_tables, pending_raw, resolve_sequential
from kinweave.operators.survivorship import with_identifier_arrays
from kinweave.plans.storage import materialize
from kinweave.streaming.buckets import BucketTable
from kinweave.streaming.store import append_upserts, table_exists

MASTER = "master_profile_id"
CONTACT = ["tenant_id", "kind", "value"]


@dataclass
class ResolutionStore:
    """Tables below a folder. ``before`` gives them as they were before a batch, for replays."""

    spark: SparkSession
    path: str
    raw_schema: T.StructType
    buckets: int = 64

    def _table(self, name: str, keys: list[str], by: list[str]) -> BucketTable:
        return BucketTable(self.spark, f"{self.path}/{name}", keys, by, self.buckets)

    @property
    def link_table(self) -> BucketTable:
        return self._table("links", ["raw_profile_id"], ["raw_profile_id"])

    @property
    def master_table(self) -> BucketTable:
        return self._table("masters", [MASTER], [MASTER])

    @property
    def identifier_table(self) -> BucketTable:
        return self._table("identifiers", [MASTER, "kind", "value"], [MASTER])

    @property
    def contact_table(self) -> BucketTable:
        return self._table("contacts", [*CONTACT, MASTER], CONTACT)

    def links(self, before: int | None = None) -> DataFrame | None:
        return self.link_table.read(before)

    def masters(self, before: int | None = None) -> DataFrame | None:
        return self.master_table.read(before)

    def identifiers(self, before: int | None = None) -> DataFrame | None:
        return self.identifier_table.read(before)

    def waiting(self, before: int) -> DataFrame:
        """Rows that an earlier batch left for the backfill: the newest folder of all, since each batch writes the whole of it."""
        root = f"{self.path}/waiting"
        if table_exists(self.spark, root):
            at = self.spark._jvm.org.apache.hadoop.fs.Path(root)
            names = [s.getPath().getName() for s in at.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(at)]
            last = max((int(n.removeprefix("batch=")) for n in names if n.startswith("batch=") and int(n.removeprefix("batch=")) < before), default=None)
            if last is not None:
                return self.spark.read.schema(self.raw_schema).parquet(f"{root}/batch={last}")
        return self.spark.createDataFrame([], self.raw_schema)


def contacts_of(rows: DataFrame, *more: str) -> DataFrame:
    """(tenant_id, kind, value, ...) of the primary contacts, as they are compared."""
    items = F.array(F.struct(F.lit("email").alias("kind"), F.lower("email").alias("value")),
                    F.struct(F.lit("phone").alias("kind"), F.col("phone_number").alias("value")))
    return rows.select("tenant_id", *more, F.explode(items).alias("i")).select("tenant_id", "i.*", *more).where("value <> ''").distinct()


def relevant_masters(store: ResolutionStore, todo: DataFrame, before: int) -> DataFrame | None:
    """Masters owning an email or phone of the pending rows, with all they have gathered; no other master can be matched."""
    owners = store.contact_table.read(before, contacts_of(todo))
    if owners is None:
        return None
    ids = materialize(owners.select(MASTER).distinct())
    masters, values = store.master_table.read(before, ids), store.identifier_table.read(before, ids)
    if masters is None:
        return None
    return masters if values is None else with_identifier_arrays(masters, values)


def _in_window(rows: DataFrame, look_back_minutes: int | None) -> DataFrame:
    """The rows received in the trailing window."""
    newest = rows.agg(F.max("received_at").alias("m")).select(
        (F.col("m") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(look_back_minutes))).cast("string").alias("f")).first()
    return pending_raw(rows, from_ts=newest.f)


def resolve_batch(store: ResolutionStore, batch: DataFrame, batch_id: int, look_back_minutes: int | None = LOOK_BACK_MINUTES) -> int:
    """Resolve a micro-batch and what waits in the window; returns the rows resolved. Older rows wait on.

    All tables are read as of the batches before, so a replayed batch produces the same folders again.
    """
    columns = store.raw_schema.fieldNames()
    rows = store.waiting(batch_id).withColumn("_new", F.lit(0)).unionByName(batch.select(*columns).withColumn("_new", F.lit(1)))
    newest = rows.groupBy("raw_profile_id").agg(F.max_by(F.struct(*columns), F.struct("_new", "received_at")).alias("r")).select("r.*")
    newest = materialize(newest)
    todo = pending_raw(newest, store.link_table.read(batch_id, newest))
    todo = materialize(todo if look_back_minutes is None else _in_window(todo, look_back_minutes))
    count = todo.count()
    open_rows = pending_raw(newest, store.link_table.read(batch_id, newest)).join(todo.select("raw_profile_id"), "raw_profile_id", "left_anti")
    append_upserts(open_rows.select(*columns), f"{store.path}/waiting", batch_id)
    if count == 0:
        return 0
    as_of = todo.agg(F.max("received_at").cast("string").alias("m")).first().m
    priors = relevant_masters(store, todo, batch_id)
    result = resolve_sequential(todo, None if priors is None else materialize(priors), as_of=as_of)
    # Prior masters that took no row stay as they are.
    joined = materialize(result.links.select(MASTER).distinct())
    golden, values = golden_tables(result, as_of)
    golden = materialize(golden.join(joined, MASTER, "left_semi"))
    store.master_table.write(golden, batch_id)
    store.identifier_table.write(values.join(joined, MASTER, "left_semi").withColumn("seen_at", F.lit(as_of)), batch_id)
    store.contact_table.write(contacts_of(golden, MASTER), batch_id)
    store.link_table.write(result.links, batch_id)
    return count


def start_resolution(stream: DataFrame, store: ResolutionStore, checkpoint: str, trigger: dict | None = None,
                     look_back_minutes: int | None = LOOK_BACK_MINUTES):
    """One resolution per micro-batch of staging rows, e.g. ``trigger={"processingTime": "1 minute"}``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        resolve_batch(store, batch, batch_id, look_back_minutes)
    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True})).start()


def backfill(store: ResolutionStore, batch_id: int) -> int:
    """Resolve whatever is still waiting, however old."""
    return resolve_batch(store, store.spark.createDataFrame([], store.raw_schema), batch_id, look_back_minutes=None)
