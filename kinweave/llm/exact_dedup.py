"""Exact duplicates with a heavy-hitter split.

A Misra-Gries summary (``approx_top_k``, at most ``TRACKED`` counters whatever the input) names the digests that may be
frequent. Their exact counts and winners are computed with partial aggregates; those with more than 1/``HEAVY`` of the rows,
so fewer than ``HEAVY`` of them, are broadcast and settle their rows where they lie. All other digests have bounded groups
and take an ordinary aggregate and join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kinweave.llm.text import free_name, quoted, without_blanks
from kinweave.plans.storage import materialize

HEAVY = 1000
TRACKED = 10_000


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row.

    Texts are equal when they are identical without the characters ``[\\x20\\x09-\\x0D]``; NULL counts as empty. Of equal texts
    the one with the most code points stays, then the smallest id (NULL ids last); of rows that are equal in both exactly
    one is kept. Other columns of the input are ignored; an empty table gives an empty result.
    """
    digests = materialize(docs.select(
        F.col(doc_id).alias("doc_id"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("n"),
        F.sha2(without_blanks(F.col(text)), 256).alias("sha"), F.monotonically_increasing_id().alias("row")))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    per_text = [F.count("*").alias("group_size"), best.alias("best")]

    found = digests.agg(F.count("*").alias("rows"), F.expr(f"approx_top_k(sha, {HEAVY}, {TRACKED})").alias("top"))
    frequent = found.select("rows", F.explode("top").alias("t")).select("rows", F.col("t.item").alias("sha"))
    verified = digests.join(F.broadcast(frequent), "sha").groupBy("sha", "rows").agg(*per_text)
    heavy = materialize(verified.where(F.col("group_size") * HEAVY > F.col("rows")).drop("rows"))

    hot = digests.join(F.broadcast(heavy), "sha")
    rest = digests.join(F.broadcast(heavy.select("sha")), "sha", "left_anti")
    settled = hot.unionByName(rest.join(rest.groupBy("sha").agg(*per_text), "sha"))
    return settled.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input without the rows that ``exact_dedup`` drops, all columns kept as they are, whatever their names.

    NULL texts count as empty, so one row without text stays; rows equal in id and text stay once; an empty table stays empty.
    """
    own, best = free_name(docs.columns, "own"), free_name(docs.columns, "best")
    won = exact_dedup(docs, doc_id, text).where("kept").select(F.struct("doc_id", F.col("text_sha256").alias("sha")).alias(best))
    about = F.struct(F.col(doc_id).alias("doc_id"), F.sha2(without_blanks(F.col(text)), 256).alias("sha"),
                     (-F.length(F.coalesce(F.col(text), F.lit("")))).alias("n"))
    marked = docs.withColumn(own, about).join(
        won, F.col(f"{own}.doc_id").eqNullSafe(F.col(f"{best}.doc_id")) & (F.col(f"{own}.sha") == F.col(f"{best}.sha")))
    # An id that has one text several times won with its longest original; equal rows are interchangeable.
    place = F.row_number().over(W.partitionBy(best).orderBy(f"{own}.n"))
    return marked.withColumn(own, place).where(F.col(own) == 1).select(*quoted(docs.columns))
