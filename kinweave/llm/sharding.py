"""Contiguous shards of nearly equal bytes from global prefix sums.

Rows are put in order by range partitioning. One total of bytes and rows per partition, summed over the partitions before it, and a
running sum inside the partition give every row its place in the whole; shards are cut at equal shares of all bytes. Only the
partition totals (one row per range partition) and the first rows of the shards are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kinweave.plans.storage import materialize

#: Rows of a range partition lie in numbers of this many low bits (see ``monotonically_increasing_id``).
PLACE_BITS = 33


def prefix_sums(rows: DataFrame, order: list, size: str = "size") -> DataFrame:
    """``rows`` with ``_place`` (0-based position) and ``_before`` (``size`` summed over all earlier rows) in the given order.

    ``order`` must be total up to rows that are interchangeable. The order is stored before it is used, because range bounds are
    sampled: a recomputed partition then has the rows it had.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialize(ranged.withColumn("_seq", F.monotonically_increasing_id()))
    part = stored.withColumn("_part", F.shiftright("_seq", PLACE_BITS))
    totals = part.groupBy("_part").agg(F.count("*").alias("_rows"), F.sum(size).alias("_bytes"))
    # One row per range partition, so this window and the broadcast are bounded by the number of partitions.
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows"),
                            F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_bytes"))
    inside = W.partitionBy("_part").orderBy("_seq").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = part.withColumn("_upto", F.sum(size).over(inside))
    return running.join(F.broadcast(offsets), "_part").select(
        *rows.columns, (F.col("_rows") + F.col("_seq").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))).alias("_place"),
        (F.col("_bytes") + F.col("_upto") - F.col(size)).alias("_before"))


def cut_shards(rows: DataFrame, shards: int, order: list, size: str = "size") -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1, ascending in the order) and ``slot`` (gapless from 0 in each shard).

    A row belongs to the shard that its middle byte falls into, so every cut lies within half a row of its target. Sizes are
    positive; their sum times twice the number of shards must be a long.
    """
    placed = materialize(prefix_sums(rows, order, size))
    total = placed.agg(F.sum(size)).first()[0] or 1
    cut = placed.withColumn("shard", F.expr(f"least({shards - 1}, (2 * _before + `{size}`) * {shards}L div {2 * total}L)").cast("int"))
    firsts = cut.groupBy("shard").agg(F.min("_place").alias("_first"))
    return cut.join(F.broadcast(firsts), "shard").select(*rows.columns, "shard", (F.col("_place") - F.col("_first")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per input row, NULL ids, empty and repeated rows included.

    ``size`` is the text's UTF-8 bytes (NULL: none) plus 1. The law is ``bytes``: shards are contiguous in ascending doc_id (NULL last;
    rows of one id by checksum and size, equal rows are interchangeable) and their sizes near equal. A text larger than a shard takes
    one whole shard or several, which leaves the ones it covers empty. Equal texts (groups) are not moved together, since a group may be
    larger than a shard; they lie where their ids are. ``grown_shard`` is NULL under this law. Other columns are ignored, an empty table
    gives an empty result.
    """
    filled = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(filled) + 1).cast("long").alias("size"),
                       F.crc32(filled.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("row"))
    # Stored first: the texts are read once, and the row number that splits one id over partitions stays what it is.
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_crc32").asc(), F.col("size").asc(), F.col("row").asc()]
    cut = cut_shards(materialize(rows), shards, order)
    return cut.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
