"""Joins that stay balanced when one key, or NULL, holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Rows of one key that a single task may take; a key with more is spread over a task per so many rows.
MIN_HOT_ROWS = 1_000_000
#: Shares of the rows without a key: they meet nothing, so any share will do.
NULL_SALTS = 64
#: Hot keys whose lookup rows are broadcast at most; beyond, they take a shuffle join of their own with AQE's skew handling.
MAX_HOT_KEYS = 100_000


def hot_keys(df: DataFrame, key: list[str], rows: int, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame | None:
    """(key..., _rows) of the keys with more than ``min_hot_rows`` rows, an absolute limit; NULL keys are not among them."""
    if rows <= min_hot_rows:
        return None
    return df.dropna(subset=key).groupBy(*key).agg(F.count("*").alias("_rows")).where(F.col("_rows") > min_hot_rows)


def _no_key(key: list[str]) -> Column:
    out = F.col(key[0]).isNull()
    for k in key[1:]:
        out = out | F.col(k).isNull()
    return out


def _row_hash(df: DataFrame) -> Column:
    """A hash of the row; maps cannot be hashed and are left out."""
    return F.xxhash64(*[F.col(c) for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])


def lookup_join(big: DataFrame, lookup: DataFrame, key: str | list[str], rows: int | None = None,
                min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Left join to a table with at most one row per key.

    Rows of hot keys get their value from a broadcast of their few lookup rows and are spread in proportion to the key's size;
    rows with a NULL in the key are spread as well; all others meet their lookup row in a plain shuffle join. ``rows`` is the
    size of the big side, counted when unknown.
    """
    rows = big.count() if rows is None else rows
    key = [key] if isinstance(key, str) else key
    hashed = _row_hash(big)
    nulls = F.when(_no_key(key), 1 + F.pmod(hashed, F.lit(max(NULL_SALTS, rows // min_hot_rows))))
    target = lookup.withColumn("_salt", F.lit(0).cast("long"))
    hot = hot_keys(big, key, rows, min_hot_rows)
    if hot is None:
        return big.withColumn("_salt", nulls.otherwise(F.lit(0)).cast("long")).join(target, [*key, "_salt"], "left").drop("_salt").select(
            *big.columns, *[c for c in lookup.columns if c not in key])
    few_enough = F.broadcast if rows // min_hot_rows <= MAX_HOT_KEYS else (lambda df: df)
    values = [c for c in lookup.columns if c not in key]
    found = lookup.join(few_enough(hot.drop("_rows")), key, "left_semi")
    few = hot.join(found, key, "left").select(*key, "_rows", *[F.col(c).alias(f"_hot_{c}") for c in values])
    share = F.ceil(F.col("_rows") / min_hot_rows) + 1
    spread = nulls.when(F.col("_rows").isNotNull(), 1 + F.pmod(hashed, share)).otherwise(F.lit(0)).cast("long")
    flagged = big.join(few_enough(few), key, "left").withColumn("_salt", spread)
    joined = flagged.join(target, [*key, "_salt"], "left")
    picked = [F.when(F.col("_rows").isNotNull(), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in values]
    return joined.select(*big.columns, *picked)


def with_minimum(df: DataFrame, key: str | list[str], minima: dict[str, Column], rows: int,
                 min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Add the minimum of each expression over the row's key; rows with a NULL in the key get NULL.

    When the whole table is smaller than a hot key, a window does it in one shuffle. Otherwise minima are combined map-side
    and looked up without gathering a key's rows.
    """
    key = [key] if isinstance(key, str) else key
    filled = ~_no_key(key)
    if rows <= min_hot_rows:
        # NULL keys get no minimum, so they are dealt by the rest of the row instead of all together.
        rest = F.when(_no_key(key), F.pmod(_row_hash(df), F.lit(NULL_SALTS)))
        w = W.partitionBy(*key, rest)
        return df.withColumns({n: F.when(filled, F.min(e).over(w)) for n, e in minima.items()})
    per_key = df.where(filled).groupBy(*key).agg(*[F.min(e).alias(n) for n, e in minima.items()])
    return lookup_join(df, per_key, key, rows, min_hot_rows)
