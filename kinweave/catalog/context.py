"""Shared tables of the registered queries, each derived once per data folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.config import DEFAULT_RULES
from kinweave.functions import scores
from kinweave.operators import behavior, resolution, scoring
from kinweave.plans import tables
from kinweave.plans.tables import AS_OF, PURCHASE_AS_OF, stored

# The identifiers the given tables provide.
RULES = tuple(r for r in DEFAULT_RULES if r.attribute in ("email", "phone_number", "crm_source_id"))
EMAIL, PHONE, CRM = RULES


@dataclass
class Context:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return tables.read(self.spark, self.sf_dir, name)

    def keep(self, name: str, build):
        return stored(self.spark, self.sf_dir, name, build)

    def tracking(self) -> DataFrame:
        return self.keep("tracking", lambda: tables.tracking_events(self.spark, self.sf_dir))

    def wire(self) -> DataFrame:
        return tables.wire_documents(self.spark, self.sf_dir)

    def accepted(self) -> DataFrame:
        return tables.accepted_events(self.spark, self.sf_dir)

    def raw(self) -> DataFrame:
        return tables.raw_profiles(self.spark, self.sf_dir)

    def transitive(self) -> resolution.Resolution:
        return self.keep("transitive", lambda: resolution.resolve_transitive(self.raw(), rules=RULES, as_of=AS_OF))

    def sequential(self) -> resolution.Resolution:
        return self.keep("sequential", lambda: resolution.resolve_sequential(self.raw(), as_of=AS_OF))

    def members(self) -> DataFrame:
        return self.transitive().members

    def links(self) -> DataFrame:
        return self.transitive().links

    def golden(self) -> DataFrame:
        return self.keep("golden", lambda: resolution.golden_tables(self.transitive(), AS_OF)[0])

    def identifiers(self) -> DataFrame:
        return self.keep("identifiers", lambda: resolution.golden_tables(self.transitive(), AS_OF)[1])

    def early_late(self) -> tuple[DataFrame, DataFrame]:
        """Staging rows received before and from the middle of the month."""
        cut = F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")
        return self.raw().where(F.col("received_at") < cut), self.raw().where(F.col("received_at") >= cut)

    def prior_masters(self) -> DataFrame:
        """Masters of the early rows: the golden table a later run starts from."""
        def build():
            early, _ = self.early_late()
            res = resolution.resolve_transitive(early, rules=RULES, as_of="2024-01-29 00:00:00")
            golden, _ = resolution.golden_tables(res, "2024-01-29 00:00:00")
            founded = res.members.where("seq = root").select("master_profile_id", F.col("arrived_at").alias("_t"))
            return golden.join(founded, "master_profile_id").withColumn("created_at", F.col("_t")).drop("_t")
        return self.keep("prior_masters", build)

    def owners(self) -> DataFrame:
        return behavior.visitor_owner(self.members())

    def events(self) -> DataFrame:
        # The accepted documents bound the events from above; counting the events themselves would remove the copies twice.
        return self.keep("events", lambda: behavior.stitch_events(
            behavior.events_to_behavioral(self.accepted()), self.owners(), self.accepted().count()))

    def purchases(self) -> DataFrame:
        return self.keep("purchases", lambda: behavior.stitch_events(
            tables.purchases(self.spark, self.sf_dir), self.owners()))

    def summary(self) -> DataFrame:
        """Event counts under score names, with the session seconds as one more entry."""
        renamed = F.transform_keys("event_summary", lambda k, _: F.when(k == "page-view", "page_view").when(
            k == "click-details", "click").otherwise(k))
        sessions = behavior.session_stats(self.events())
        return self.keep("summary", lambda: behavior.event_summary(self.events()).select(
            "master_profile_id", renamed.alias("event_summary")).join(sessions, "master_profile_id").withColumn(
            "event_summary", F.map_concat("event_summary", F.create_map(F.lit("session_time"), "session_seconds"))))

    def scored(self) -> DataFrame:
        """Golden records with sessions, purchases and all rule scores."""
        def build():
            g = self.golden().join(self.summary(), "master_profile_id", "left").join(
                behavior.purchase_stats(self.purchases()), "master_profile_id", "left")
            features = scoring.churn_trend_features(self.events(), self.purchases(), AS_OF, purchase_as_of=PURCHASE_AS_OF)
            g = g.join(scoring.add_churn(features), "master_profile_id", "left")
            value = scores.clv("avg_order_value", "total_purchases", "first_purchase_date", "last_purchase_date", 5)
            return (
                g.withColumn("engagement_score", scores.engagement_score("event_summary"))
                .withColumn("recency_score", scores.recency_score("last_seen_at", AS_OF))
                .withColumn("customer_lifetime_value", value)
                .withColumn("loyalty_tier", scores.loyalty_tier("total_purchases", "customer_lifetime_value"))
                .withColumn("lead_score", scores.lead_score("recency_score", "total_sessions"))
                .withColumn("data_quality_score", scores.profile_completeness(
                    ["email", "phone_number", "first_name", "last_name", "city", "country", "gender", "date_of_birth"]))
            )
        return self.keep("scored", build)
