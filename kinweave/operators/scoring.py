"""Score and segment jobs over masters, events and purchases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions import scores
from kinweave.functions.text import has_string_value
from kinweave.plans.ordering import add_ntile
from kinweave.plans.storage import materialize

MASTER = "master_profile_id"


def rfm(purchases: DataFrame, key: str, as_of: str, tiles: int = 5) -> DataFrame:
    """Recency, frequency and monetary tiles (the highest tile is best); ties are ordered by key."""
    base = materialize(purchases.groupBy(key).agg(
        F.datediff(F.lit(as_of).cast("date"), F.max("day")).alias("days"), F.count("*").alias("orders"),
        F.round(F.sum("amount"), 2).alias("amount")))
    total = base.count()
    out = add_ntile(base, [F.desc("days"), F.asc(key)], tiles, "r", total)
    out = add_ntile(out, [F.asc("orders"), F.asc(key)], tiles, "f", total)
    return add_ntile(out, [F.asc("amount"), F.asc(key)], tiles, "m", total)


def engagement_frequency(events: DataFrame) -> DataFrame:
    """Events per active day of a master; days are reduced first, so no large distinct set is kept."""
    per_day = events.where(F.col(MASTER).isNotNull()).groupBy(MASTER, F.to_date("created_at").alias("day")).count()
    return per_day.groupBy(MASTER).agg(
        F.sum("count").alias("events"), F.count("*").alias("active_days"),
        F.round(F.sum("count") / F.count("*"), 6).alias("events_per_day"))


def churn_trend_features(events: DataFrame, purchases: DataFrame, as_of: str, days: int = 15,
                         purchase_as_of: str | None = None, complaint: Column | None = None) -> DataFrame:
    """Event change against the previous period, purchases of 90 days, days since the last one, complaints."""
    now = F.lit(as_of).cast("timestamp_ntz")
    start, before = now - F.make_dt_interval(F.lit(days)), now - F.make_dt_interval(F.lit(2 * days))
    at = F.col("created_at")
    complaint = F.col("feedback_rating") <= 2 if complaint is None else complaint
    trend = events.where(F.col(MASTER).isNotNull()).groupBy(MASTER).agg(
        (F.count_if((at >= start) & (at < now)) - F.count_if((at >= before) & (at < start))).alias("trend"),
        F.count_if(complaint).alias("complaints"))
    today = F.lit(purchase_as_of or as_of).cast("date")
    bought = purchases.where(F.col(MASTER).isNotNull()).groupBy(MASTER).agg(
        F.datediff(today, F.max("day")).alias("days_since_purchase"),
        F.count_if(F.col("day") >= F.date_sub(today, 90)).alias("purchases_90d"))
    return trend.join(bought, MASTER, "full_outer")


def add_churn(features: DataFrame) -> DataFrame:
    return features.withColumn("churn_probability", scores.churn_probability(
        "days_since_purchase", "trend", "purchases_90d", "complaints"))


def segment(masters: DataFrame, predicate: str) -> DataFrame:
    """Masters that satisfy a SQL condition."""
    return masters.where(F.expr(predicate))


def lead_score_model(features: DataFrame, columns: list[str], label: str, version: str, as_of: str) -> DataFrame:
    """``int(100 * P(convert))`` of a logistic regression trained on the labelled rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    steps = [VectorAssembler(inputCols=columns, outputCol="_x", handleInvalid="keep"),
             StandardScaler(inputCol="_x", outputCol="_s"),
             LogisticRegression(featuresCol="_s", labelCol=label, probabilityCol="_p", maxIter=20)]
    ready = features.fillna(0, subset=columns).withColumn(label, F.col(label).cast("double"))
    scored = Pipeline(stages=steps).fit(ready.where(F.col(label).isNotNull())).transform(ready)
    return scored.select(
        MASTER, (vector_to_array("_p")[1] * 100).cast("int").alias("lead_score"),
        F.lit(version).alias("lead_score_model_version"),
        F.lit(as_of).cast("timestamp_ntz").alias("lead_score_last_updated"))


# The built-in offers of the next-best-action rules.
RELATED_ITEMS = {"P123": "P456", "P789": "P790_bundle"}
LUXURY = {"campaign": "luxury_summer_deals", "tiers": ("Gold", "Platinum"),
          "interests": ("du lịch biển", "nghỉ dưỡng cao cấp"), "items": ("P_LUX01", "P_LUX02")}
DEFAULT_OFFER = {"campaign": "general_awareness", "cta": "learn_more", "item": "P_BESTSELLER1"}


def next_best_action(profiles: DataFrame, catalog: list[str], campaigns: list[str], related: dict[str, str] = RELATED_ITEMS,
                     luxury: dict = LUXURY, default: dict = DEFAULT_OFFER, most: int = 2) -> DataFrame:
    """Campaign, call to action and recommended items per profile.

    Input columns: last_viewed, cart_items and interests (arrays), cart_abandoned, loyalty_tier. Companions of viewed items
    come first, then a deserted cart item or the luxury offer; the default offer applies when nothing else does.
    """
    none = F.expr("cast(array() as array<string>)")
    sellable = {a: b for a, b in related.items() if b in catalog}
    pairs = [F.lit(x) for pair in sellable.items() for x in pair]
    companion = F.create_map(*pairs) if pairs else F.expr("cast(map() as map<string,string>)")
    viewed = F.array_compact(F.transform(F.coalesce("last_viewed", none), lambda i: F.try_element_at(companion, i)))
    cart = F.coalesce("cart_abandoned", F.lit(False)) & (F.size(F.coalesce("cart_items", none)) > 0)
    rich = (
        F.lit(luxury["campaign"] in campaigns) & F.coalesce(F.col("loyalty_tier").isin(*luxury["tiers"]), F.lit(False))
        & F.coalesce(F.arrays_overlap(F.coalesce("interests", none), F.array(*[F.lit(i) for i in luxury["interests"]])),
                     F.lit(False))
    )
    offers = [F.lit(i) for i in luxury["items"] if i in catalog]
    extra = F.when(cart, F.array(F.get("cart_items", 0))).when(rich, F.array(*offers) if offers else none).otherwise(none)
    picked = F.slice(F.array_distinct(F.concat(viewed, extra)), 1, most)
    nothing = ~cart & ~rich & (F.size(picked) == 0)
    fallback = F.array(F.lit(default["item"])) if default["item"] in catalog else none
    return profiles.select(
        MASTER,
        F.when(cart, F.concat(F.lit("cart_recovery_"), F.get("cart_items", 0))).when(rich, luxury["campaign"])
        .when(nothing, default["campaign"]).alias("campaign"),
        F.when(cart, "complete_purchase").when(rich, "explore_deals").when(nothing, default["cta"]).alias("cta"),
        F.when(nothing, fallback).otherwise(picked).alias("product_recommendation"))


def trigger_audiences(masters: DataFrame, carts: DataFrame, recent_buyers: DataFrame, viewers: DataFrame,
                      as_of: str) -> DataFrame:
    """Contact lists by trigger: deserted cart, after purchase, birthday, retargeting (viewed, did not buy)."""
    contact = masters.where(has_string_value("email") | has_string_value("phone_number")).select(
        MASTER, "email", "phone_number", "date_of_birth")
    today = F.lit(as_of).cast("date")
    member = lambda ids, label: ids.select(MASTER).distinct().withColumn("audience", F.lit(label))
    born = contact.where((F.month("date_of_birth") == F.month(today)) & (F.dayofmonth("date_of_birth") == F.dayofmonth(today)))
    lists = member(carts, "abandoned_cart").unionByName(member(recent_buyers, "post_purchase")).unionByName(
        member(viewers.join(recent_buyers.select(MASTER).distinct(), MASTER, "left_anti"), "retargeting")).unionByName(
        member(born, "birthday"))
    return lists.join(contact.drop("date_of_birth"), MASTER)
