"""Profile scores as Column expressions; ``as_of`` is always a parameter, never the wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinweave.functions.text import col

# Weights, limits and labels of the scores.
ENGAGEMENT_WEIGHTS = (("page_view", 1.0), ("click", 2.0), ("session_time", 0.1))
RECENCY_STEPS = ((7, 100), (30, 75), (90, 50), (180, 25))
TIER_STEPS = ((20, 10_000_000, "Platinum"), (10, 5_000_000, "Gold"), (5, 1_000_000, "Silver"))
DAYS_PER_YEAR = 365.25


def engagement_score(summary) -> Column:
    """Weighted event counts, cut to an integer; missing keys count as 0."""
    total = F.lit(0.0)
    for key, weight in ENGAGEMENT_WEIGHTS:
        total = total + F.coalesce(F.try_element_at(col(summary), F.lit(key)).cast("long"), F.lit(0)) * weight
    return F.coalesce(total, F.lit(0.0)).cast("int")


def recency_score(last_seen, as_of) -> Column:
    seen, now = col(last_seen), F.lit(as_of).cast("timestamp_ntz")
    out = None
    for days, score in RECENCY_STEPS:
        cond = seen >= now - F.make_dt_interval(F.lit(days))
        out = F.when(cond, score) if out is None else out.when(cond, score)
    return out.otherwise(0)


def clv(avg_order_value, purchases, first_date, last_date, years) -> Column:
    """Average order value x purchases per year x expected years, rounded to cents."""
    n, years_c = col(purchases), col(years) if not isinstance(years, (int, float)) else F.lit(years)
    days = F.datediff(col(last_date), col(first_date))
    per_year = F.when(days <= 0, n.cast("double")).otherwise(n / (days / F.lit(DAYS_PER_YEAR)))
    value = F.round(col(avg_order_value) * per_year * years_c.cast("double"), 2)
    usable = (n > 0) & col(avg_order_value).isNotNull() & days.isNotNull() & (years_c != 0)
    return F.when(usable, value).otherwise(F.lit(0.0))


def loyalty_tier(purchases, lifetime_value) -> Column:
    n, v = F.coalesce(col(purchases), F.lit(0)), F.coalesce(col(lifetime_value), F.lit(0.0))
    out = None
    for least_n, least_v, label in TIER_STEPS:
        cond = (n >= least_n) & (v >= least_v)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise("Bronze")


def lead_score(recency, sessions) -> Column:
    r, s = F.coalesce(col(recency), F.lit(0)), F.coalesce(col(sessions), F.lit(0))
    return F.when((r > 70) & (s > 20), 85).when((r > 50) | (s > 10), 50).otherwise(15)


def churn_probability(days_since_purchase, trend, purchases_90d, complaints) -> Column:
    """Additive risk over a base of 0.1, at most 0.95."""
    days, freq = F.coalesce(col(days_since_purchase), F.lit(0)), F.coalesce(col(purchases_90d), F.lit(0))
    drop = F.greatest(-F.coalesce(col(trend), F.lit(0)), F.lit(0))
    risk = (
        F.lit(0.1)
        + F.when(days > 90, 0.2).otherwise(0.0)
        + F.when(drop > 10, 0.2).otherwise(0.0)
        + F.when((freq == 0) & (days > 60), 0.3).otherwise(0.0)
        + F.when(F.coalesce(col(complaints), F.lit(0)) > 1, 0.2).otherwise(0.0)
    )
    return F.round(F.least(risk, F.lit(0.95)), 4)


def profile_completeness(columns: list[str]) -> Column:
    """Share of filled attributes, 0 to 100."""
    filled = sum((F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", 1).otherwise(0) for c in columns),
                 F.lit(0))
    return F.round(filled * 100.0 / len(columns), 0).cast("int")


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    a, b = F.radians(col(lat1)), F.radians(col(lat2))
    dlat, dlon = b - a, F.radians(col(lon2)) - F.radians(col(lon1))
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * 6371.0) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))
