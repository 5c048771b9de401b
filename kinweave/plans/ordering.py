"""Global order without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kinweave.plans.storage import materialize


def add_sequence(df: DataFrame, order: list, name: str = "seq") -> DataFrame:
    """Number the rows in a total order (unique sort keys), range-partitioned; numbers grow but have gaps.

    The result is stored: range bounds are sampled, so a recomputation could number rows differently.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ranged.withColumn(name, F.monotonically_increasing_id()))


def add_dense_rank_number(df: DataFrame, order: list, name: str = "position") -> DataFrame:
    """1-based gap-free position in a total order: place in the partition plus the rows of earlier partitions."""
    seq = add_sequence(df, order, "_seq")
    part, place = F.shiftright("_seq", 33), F.col("_seq").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = seq.withColumn("_part", part).withColumn("_place", place)
    # One row per range partition, so this window and the broadcast below are bounded by the partition count.
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place") + 1)
        .drop("_seq", "_part", "_place", "_offset")
    )


def add_ntile(df: DataFrame, order: list, n: int, name: str, total: int) -> DataFrame:
    """``ntile(n)`` over the whole table: the first ``total % n`` tiles hold one row more."""
    base, extra = divmod(total, n)
    numbered = add_dense_rank_number(df, order, "_pos")
    cut = extra * (base + 1)
    tile = F.when(F.col("_pos") <= cut, F.floor((F.col("_pos") - 1) / F.lit(base + 1)) + 1).otherwise(
        F.lit(extra) + F.floor((F.col("_pos") - 1 - cut) / F.lit(max(base, 1))) + 1)
    return numbered.withColumn(name, tile.cast("int")).drop("_pos")
