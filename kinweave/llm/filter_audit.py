"""How filters interact in every order they could be applied in.

A document is reduced to the mask of the filters it fails, and documents to counts per part and mask. Orders are numbered by their
Lehmer rank, that is lexicographically, so all orders that begin alike are one interval of ranks. A mask goes at step s in exactly
the orders whose first s filters are s - 1 that it passes and then one that it fails: a few intervals per mask. Its counts are added where
an interval begins and taken away where it ends; a prefix sum over the ranks gives every order's totals. The work behind the counts
does not depend on the number of documents.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kinweave.plans.storage import materialize

#: The filters of ``text_failures`` and ``document_masks`` in the order of their mask bits.
LETTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
SYMBOLS = "[#$%&*|]"
#: Shares that rows without an id are dealt to when labels are looked up: they have none.
NULL_SHARES = 4096


def lehmer_rank(prefix: tuple[int, ...], n: int) -> int:
    """Rank of the first order of ``n`` filters that begins with ``prefix``."""
    return sum(sum(g < f and g not in prefix[:k] for g in range(n)) * factorial(n - 1 - k) for k, f in enumerate(prefix))


def removal_intervals(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, start, stop): the ranks [start, stop) of the orders that remove the mask at the step, neighbours joined."""
    found = []
    for mask in range(1, 1 << n):
        for step in range(1, n + 1):
            width = factorial(n - step)
            for prefix in permutations(range(n), step):
                if mask >> prefix[-1] & 1 and not any(mask >> f & 1 for f in prefix[:-1]):
                    start = lehmer_rank(prefix, n)
                    if found and found[-1][:2] == (mask, step) and found[-1][3] == start:
                        found[-1] = (mask, step, found[-1][2], start + width)
                    else:
                        found.append((mask, step, start, start + width))
    return found


def audit_orders(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """The audit from counted masks: one row per part, order and step.

    ``masks`` has (part, mask, n, good, toxic): documents of a part that fail exactly the filters of the mask (bit k: k-th letter), and how
    many of them are good and toxic; a part may have a mask several times. Returns (part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley), zeros included, for each part; no parts give no rows.
    """
    spark, n = masks.sparkSession, len(letters)
    orders = ["".join(p) for p in permutations(letters)]
    # At most n * n! ends per mask and 2^n masks: a table of fixed size.
    ends = [(mask, step, rank, sign) for mask, step, start, stop in removal_intervals(n)
            for rank, sign in ((start, 1), (stop, -1)) if rank < len(orders)]
    ends = F.broadcast(spark.createDataFrame(ends, "mask int, step int, rank int, sign int"))
    counted = ("n", "good", "toxic")
    masks = materialize(masks.groupBy("part", F.col("mask").cast("int").alias("mask")).agg(*[F.sum(c).cast("long").alias(c) for c in counted]))

    bits = [F.col("mask").bitwiseAND(F.lit(1 << k)) != 0 for k in range(n)]
    some = lambda found: F.coalesce(F.sum(F.when(found, F.col("n"))), F.lit(0))
    totals = masks.groupBy("part").agg(
        F.sum("n").alias("total"), F.array(*[some(b) for b in bits]).alias("fails"),
        F.array(*[some(F.col("mask") == 1 << k) for k in range(n)]).alias("alone"))
    grid = totals.select("part", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")).select(
        "part", "step", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))).alias("rank"), *[F.lit(0).cast("long").alias(c) for c in counted])
    differences = masks.join(ends, "mask").select("part", "step", "rank", *[(F.col(c) * F.col("sign")).alias(c) for c in counted])
    summed = differences.unionByName(grid).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in counted])
    prefix = W.partitionBy("part", "step").orderBy("rank").rowsBetween(W.unboundedPreceding, W.currentRow)
    removed = summed.select("part", "step", "rank", *[F.sum(c).over(prefix).alias(c) for c in counted])

    order = F.element_at(F.array(*[F.lit(o) for o in orders]), F.col("rank") + 1)
    steps = removed.withColumn("filter_order", order).withColumn("place", F.instr(F.lit(letters), F.expr("substring(filter_order, step, 1)")))
    so_far = W.partitionBy("part", "rank").orderBy("step").rowsBetween(W.unboundedPreceding, W.currentRow)
    gone = steps.withColumn("gone", F.sum("n").over(so_far)).withColumn("shapley", F.sum("n").over(W.partitionBy("part", "place")))
    return gone.join(totals, "part").select(
        "part", "filter_order", "step", (F.col("total") - F.col("gone")).alias("kept"), F.col("n").alias("removed"),
        (F.element_at("fails", F.col("place")) - F.col("n")).alias("redundant"), F.element_at("alone", F.col("place")).alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley")


def text_failures(text: Column) -> list[Column]:
    """Conditions A to D on a text without NULL."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    return [F.size(words) < MIN_WORDS, 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
            100 * F.regexp_count(text, F.lit("[A-Z]")) > CAPITAL_PERCENT * F.length(text), text.rlike(SYMBOLS)]


def document_masks(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic) of whole texts and their labels.

    Filter E fails a row whose text also belongs to a smaller id; a row without an id fails nothing by E and counts as nobody's smaller id.
    Rows that share an id count each; none of them is smaller than the other. NULL texts are empty texts, the NULL part is the empty
    string. An id is good or toxic when any of its label rows says so.
    """
    filled = F.coalesce(F.col(text), F.lit(""))
    flags = F.lit(0)
    for k, fails in enumerate(text_failures(F.col("text"))):
        flags = flags + F.when(fails, 1 << k).otherwise(0)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), filled.alias("text"))
    narrow = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), flags.alias("mask"))
    # Repeated rows meet in the map-side aggregate, so no later key holds more rows than there are parts.
    counted = materialize(narrow.groupBy("digest", "doc_id", "part", "mask").agg(F.count("*").alias("n")))
    first = counted.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    share = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(NULL_SHARES))).otherwise(0).cast("int")
    marked = counted.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", share.alias("share"), "part", "n",
        (F.col("mask") + F.when(F.col("first").isNull() & F.col("doc_id").isNotNull(), 1 << 4).otherwise(0)).alias("mask"))
    known = labels.select(F.col("doc_id"), F.col("quality"), F.col("toxic")).where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(
        "doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
                      F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic")).withColumn("share", F.lit(0))
    labelled = marked.join(known, ["doc_id", "share"], "left")
    return labelled.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *[F.coalesce(F.sum(F.when(F.col(f"is_{c}"), F.col("n"))), F.lit(0)).alias(c) for c in ("good", "toxic")])


def audit_filters(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``audit_orders`` of the five document filters over whole texts; see ``document_masks`` for odd rows. Empty input gives no rows."""
    return audit_orders(document_masks(docs, labels, doc_id, text, part))
