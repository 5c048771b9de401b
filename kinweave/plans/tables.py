"""The given warehouse tables seen as customer data: tracking documents, staging rows, purchases, vectors, memory.

Every value is integer or text arithmetic over columns of the given tables, so the same rows can be stated in any SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators import ingest
from kinweave.plans.storage import materialize, methods_compiled
from kinweave.sources.events import decode_envelope

AS_OF = "2024-01-31 00:00:00"
PURCHASE_AS_OF = "2001-08-02"

_stored: dict[tuple, object] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a table of few files; a table of many files keeps its scan partitions."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]) -> object:
    """Build a shared intermediate table once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        built = build()
        _stored[key] = materialize(built) if isinstance(built, DataFrame) else built
    return _stored[key]


def tracking_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat tracking event per row of ``events``, with the traits of its customer."""
    ev = spread(read(spark, sf_dir, "events")).select(
        F.col("event_id").alias("eid"), F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("user_id").alias("u"),
        "event_type", "value", F.get_json_object("props", "$.k").cast("long").alias("k"))
    customer = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("u"), F.col("c_name").alias("last_name"), "c_nationkey",
        F.col("c_mktsegment").alias("segment"))
    nation = read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    d, u, eid, k = F.col("eid") % 4, F.col("u"), F.col("eid"), F.col("k")
    g = u - F.when(u % 10 == 1, 1).otherwise(0)
    email = F.concat(F.lit("user"), u, F.lit("@example.com"))
    upper_email = F.concat(F.lit("USER"), u, F.lit("@EXAMPLE.COM"))
    metric = (F.when(F.col("event_type") == "view", "page-view").when(F.col("event_type") == "click", "click-details")
              .when(F.col("event_type") == "signup", "identify").when(F.col("event_type") == "purchase", "purchase"))
    source = F.element_at(F.array(*[F.lit(s) for s in ("websdk", "CRM", "mobileapp", "ecommerce")]),
                          (d + 1).cast("int"))
    return (
        ev.join(customer, "u", "left").join(nation, "c_nationkey", "left")
        .select(
            "eid", "ts", "u", "value", "k", "last_name", "segment", "country", d.alias("d"),
            eid.cast("string").alias("event_id"),
            F.concat(F.lit("t"), g % 3).alias("tenant_id"),
            F.concat(F.lit("v-"), u, F.lit("-"), d).alias("visid"),
            metric.alias("metric"),
            F.when(d.isin(0, 2), F.when(eid % 8 >= 4, upper_email).otherwise(email)).alias("email"),
            F.when(d.isin(1, 2), F.concat(F.lit("+849"), F.lpad(g.cast("string"), 8, "0"))).alias("phone_number"),
            F.when((d == 3) & (u % 2 == 0), F.concat(F.lit("crm-"), u)).alias("crm_source_id"),
            source.alias("source_system"),
            F.when(k % 2 == 0, F.when(u % 2 == 0, "female").otherwise("male")).alias("gender"),
            F.when(k % 3 != 0, F.concat(F.lit("city-"), k % 10)).alias("city"),
            F.concat(F.lit("s-"), u, F.lit("-"), F.date_format("ts", "yyyy-MM-dd")).alias("sessionid"),
            F.concat(F.lit("https://shop.example.com/"), F.col("event_type"), F.lit("?utm_source=src"), k % 5,
                     F.lit("&utm_campaign=camp%20"), k % 7).alias("tpurl"),
            F.concat(F.lit("item-"), k % 20).alias("item_id"),
            F.concat(F.lit("term "), k % 15).alias("term"),
            (1 + k % 10).alias("rating"),
            F.concat(F.lit("obs-"), d).alias("observer_id"),
            F.when(d % 2 == 0, "web").otherwise("app").alias("channel"),
            F.when(k % 4 == 0, "joy").when(k % 4 == 1, "anger").alias("emotion"),
        )
    )


def tracking_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tracking events as stored base64 queue records holding JSON."""
    return stored(spark, sf_dir, "tracking_documents", lambda: _tracking_documents(spark, sf_dir))


def wire_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored documents with the defects an ingest meets: cut JSON, no body, bad contacts, odd keys."""
    return stored(spark, sf_dir, "wire_documents", lambda: _wire_documents(spark, sf_dir))


def _tracking_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tracking_events(spark, sf_dir)
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    doc = F.to_json(F.struct(
        "event_id", "tenant_id", "visid", "metric", "tpurl", "sessionid", "observer_id",
        F.lit("2025.05.01").alias("schema_version"), F.lit("shop.example.com").alias("mediahost"),
        stamp.alias("datetime"), F.concat(F.lit("ua-"), "d").alias("user_agent"),
        F.concat(F.lit("dev-"), "d").alias("device"),
        F.struct(F.concat(F.lit("src"), F.col("k") % 5).alias("utmsource"),
                 F.concat(F.lit("camp "), F.col("k") % 7).alias("utmcampaign")).alias("utmdata"),
        F.struct(
            "item_id", "term", F.col("rating").cast("string").alias("rating"), "emotion",
            F.when(F.col("metric") == "purchase", F.col("value").cast("string")).alias("transaction_value"),
            F.when(F.col("metric") == "purchase", F.concat(F.lit("tx-"), "event_id")).alias("transaction_id"),
        ).alias("event_payload"),
        F.struct(
            "email", "phone_number", "crm_source_id", "source_system", "last_name", "country", "gender", "city",
            stamp.alias("last_seen_at"), F.col("observer_id").alias("last_seen_observer_id"),
            F.col("tpurl").alias("last_seen_touchpoint_url"), F.col("channel").alias("last_known_channel"),
            F.struct("segment", F.concat(F.lit("k"), F.col("k") % 6).alias("last_k")).alias("ext_attributes"),
            F.struct((F.col("k") % 2 == 0).alias("email"), (F.col("k") % 3 == 0).alias("sms"))
            .alias("preferred_communication"),
        ).alias("profile_traits"),
    ))
    return t.select("eid", F.base64(doc.cast("binary")).alias("data"))  # texts are UTF-8 already


def _wire_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The value of ``k`` chooses the defect.
    t = tracking_events(spark, sf_dir)
    k = F.col("k")
    phone = F.when(k == 21, "+84-bad").otherwise(F.concat(F.lit(" +849"), F.lpad(F.col("u").cast("string"), 8, "0")))
    email = F.when(k == 22, F.concat(F.lit("user"), "u", F.lit("@"))).otherwise(
        F.concat(F.lit("user"), "u", F.lit("@example.com")))
    doc = F.to_json(F.struct(
        F.when(k % 3 == 0, F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad("event_id", 12, "0")))
        .otherwise(F.col("event_id")).alias("event_id"),
        F.when(k == 26, F.repeat(F.lit("t"), 40)).otherwise(F.col("tenant_id")).alias("tenant_id"),
        F.when(k == 23, F.lit(" ")).otherwise(F.col("visid")).alias("visid"),
        "metric",
        F.when(k % 5 != 0, F.col("tpurl")).alias("tpurl"),
        F.lit("obs").alias("observer_id"), F.lit("shop.example.com").alias("mediahost"),
        F.when(k == 27, "v1").otherwise("2025.05.01").alias("schema_version"),
        F.struct(
            email.alias("email"), phone.alias("phone_number"),
            F.when(k % 4 == 1, F.concat(F.lit("+1"), F.lpad(F.col("u").cast("string"), 8, "0"))).alias("phone"),
            F.when(k % 4 == 2, F.concat(F.lit(" <script>x</script><b>\"u"), "u", F.lit("\"&'"))).alias("firstname"),
            F.when(k % 8 == 2, F.concat(F.lit("Name "), "u")).alias("name"),
            F.lit("Ann").alias("first_name"),
            F.when(k % 6 != 0, F.col("source_system")).alias("source_system"),
            F.when(k % 6 == 3, "loyalty").alias("usersource"),
        ).alias("profile_traits"),
    ))
    body = F.when(k == 17, "").when(k == 13, F.expr("left(doc, length(doc) - 5)")).otherwise(F.col("doc"))
    return t.select("eid", "ts", "u", "k", doc.alias("doc")).withColumn("value", body).drop("doc")


def routed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their outcome; they are read here once, so they are not written for it, only read if they have been."""
    documents = _stored.get((spark.sparkContext.applicationId, sf_dir, "tracking_documents"))
    return ingest.route_ingest(decode_envelope(_tracking_documents(spark, sf_dir) if documents is None else documents))


def accepted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        ok = ingest.classify_records(ingest.accepted(routed_events(spark, sf_dir)))
        return ok.where("record_state = 'Ok'").drop("data", "value", "_corrupt", "_typed").withColumn(
            "ts", F.col("datetime").cast("timestamp_ntz"))
    with methods_compiled(spark):
        return stored(spark, sf_dir, "accepted_events", build)


def raw_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging table: last accepted event per tenant and visitor."""
    def build():
        events = accepted_events(spark, sf_dir)
        order = [F.col("ts"), F.col("event_id").cast("long")]
        return ingest.staging_rows(events, F.col("datetime"), order)
    with methods_compiled(spark):
        return stored(spark, sf_dir, "raw_profiles", build)


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as purchases of one of the customer's visitors."""
    o = read(spark, sf_dir, "orders")
    g = F.col("o_custkey") - F.when(F.col("o_custkey") % 10 == 1, 1).otherwise(0)
    return o.select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").alias("amount"), F.to_date("o_orderdate").alias("day"),
        F.concat(F.lit("t"), g % 3).alias("tenant_id"),
        F.concat(F.lit("v-"), "o_custkey", F.lit("-"), F.col("o_orderkey") % 4).alias("web_visitor_id"))
