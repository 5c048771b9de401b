"""Order-faithful resolution as set-based rounds.

The row-by-row process: rows come in order; a row joins the master that already owns its first identifier (say the email),
else the oldest master owning its second (say the phone), else it founds a master. A master has one slot per identifier and
an empty slot is filled by the first row that brings a value; a filled slot never changes.

Here a row is decided as soon as no earlier undecided row can still change its outcome, so all such rows are decided
together:

* An owned first identifier is final. Every later row carrying it belongs to its owner, whatever else happens.
* Ownership of the second identifier only changes through a row that may acquire it: one that finds it unowned, or one whose
  first identifier may still be taken by a master with an empty second slot (an earlier undecided row without a second
  identifier). Rows before the first such row see a final owner.
* A first identifier stays unowned up to the first row that may acquire it: rows that join a master whose first slot is
  filled leave it unowned.

So a value shared by a third of all rows is settled in a few rounds, not one row at a time, and only minima per key are
exchanged: no group is ever gathered in a task. The earliest undecided row is always decidable, hence the loop ends.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kinweave.plans.skew import MIN_HOT_ROWS, lookup_join, with_minimum
from kinweave.plans.storage import materialize

# Rows of one key are scanned in blocks of this many sequence numbers.
BLOCK_BITS = 17
# The state is a union of what each round added; it is folded into one table after so many rounds.
COMPACT_EVERY = 5


def _encode(nodes: DataFrame, column: str, key: str, rows: int, min_hot_rows: int) -> DataFrame:
    """Replace an identifier text by a long: the smallest sequence number carrying it in its tenant."""
    filled = nodes.withColumn(column, F.when(F.col(column) != "", F.col(column)))
    return with_minimum(filled, [column, "tenant_id"], {key: F.col("seq")}, rows, min_hot_rows).drop(column)


def _owner_so_far(waiting: DataFrame, taken: DataFrame, small: bool, block_bits: int) -> DataFrame:
    """Each waiting row with the oldest master that had acquired its second key before it (NULL if none).

    A running minimum per key. On large tables it has two levels: the minimum of all earlier blocks comes from one row per
    key and block, the rest from a window inside a block, so a hot key is spread over its blocks.
    """
    none = F.lit(None).cast("long")
    rows = waiting.select("seq", "a", "b", none.alias("m"), F.lit(True).alias("asks")).unionByName(
        taken.select(F.col("at").alias("seq"), none.alias("a"), "b", "m", F.lit(False).alias("asks")))
    before = lambda w: F.min("m").over(w.orderBy("seq").rowsBetween(W.unboundedPreceding, -1))
    if small:
        return rows.withColumn("owner", before(W.partitionBy("b"))).where("asks").select("seq", "a", "b", "owner")
    rows = rows.withColumn("block", F.shiftright("seq", block_bits))
    per_block = rows.where("b is not null").groupBy("b", "block").agg(F.min("m").alias("bm"))
    earlier = W.partitionBy("b").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    marks = per_block.select("b", "block", F.min("bm").over(earlier).alias("before"))
    local = rows.withColumn("local", before(W.partitionBy("b", "block"))).where("asks")
    return local.join(marks, ["b", "block"], "left").select("seq", "a", "b", F.least("before", "local").alias("owner"))


def _settle_owned(left: DataFrame, own_a: DataFrame, slots: DataFrame, waiting: int, min_hot_rows: int):
    """Split off the rows whose first key is owned, and find the first second-key value each open owner gets from them."""
    owners = own_a.select("a", F.col("m").alias("am"), F.col("at").alias("a_since"))
    seen = lookup_join(left, owners, "a", waiting, min_hot_rows)
    seen = materialize(seen.withColumn("by_a", F.coalesce(F.col("a_since") < F.col("seq"), F.lit(False))))
    by_a = seen.where("by_a").select("seq", "am", "b")
    fills_b = by_a.where("b is not null").groupBy(F.col("am").alias("m")).agg(F.min(F.struct("seq", "b")).alias("f"))
    fills_b = materialize(fills_b.join(slots, "m").where("b_at is null").select(
        "m", F.col("f.b").alias("b"), F.col("f.seq").alias("at")))
    return seen.where("not by_a").select("seq", "a", "b"), by_a, fills_b


def resolve_in_order(nodes: DataFrame, first: str = "email_key", second: str = "phone_key", max_rounds: int = 10_000,
                     min_hot_rows: int = MIN_HOT_ROWS, block_bits: int = BLOCK_BITS) -> DataFrame:
    """(seq, master, how) for every row: ``master`` is the seq of the founding row, ``how`` the identifier that matched.

    ``nodes``: seq, tenant_id, is_prior and the two normalised identifiers; prior masters come before all rows.
    """
    rows = nodes.count()
    keyed = _encode(nodes, first, "a", rows, min_hot_rows)
    keyed = materialize(_encode(keyed, second, "b", rows, min_hot_rows).select("seq", "is_prior", "a", "b"))
    prior = keyed.where("is_prior")
    done = [prior.select("seq", F.col("seq").alias("master"), F.lit("prior").alias("how"))]
    # Who owns a first key since when; which master acquired a second key when; when a master's slots were filled.
    own_a = prior.where("a is not null").groupBy("a").agg(F.min("seq").alias("m")).withColumn("at", F.col("m"))
    own_b = prior.where("b is not null").select("b", F.col("seq").alias("m"), F.col("seq").alias("at"))
    filled = prior.select(F.col("seq").alias("m"), F.when(F.col("a").isNotNull(), F.col("seq")).alias("a_at"),
                          F.when(F.col("b").isNotNull(), F.col("seq")).alias("b_at"))
    left = keyed.where("not is_prior").select("seq", "a", "b")
    waiting = left.count()
    none = F.lit(None).cast("long")
    small = rows <= min_hot_rows
    # On small tables the steps of a round form one chain, so nothing in between needs to be stored.
    keep = (lambda df: df) if small else materialize

    for turn in range(max_rounds):
        if waiting == 0:
            return reduce(DataFrame.unionByName, done)
        slots = filled.groupBy("m").agg(F.min("a_at").alias("a_at"), F.min("b_at").alias("b_at"))
        # Rows whose first key is owned: final at once. Their first second-key value fills an empty slot of the owner.
        if turn == 0 and rows == waiting:
            rest = left
        else:
            rest, by_a, fills_b = _settle_owned(left, own_a, slots, waiting, min_hot_rows)
            done.append(by_a.select("seq", F.col("am").alias("master"), F.lit(first).alias("how")))
            own_b = own_b.unionByName(fills_b)
            filled = filled.unionByName(fills_b.select("m", none.alias("a_at"), F.col("at").alias("b_at")))
            slots = filled.groupBy("m").agg(F.min("a_at").alias("a_at"), F.min("b_at").alias("b_at"))

        # The other rows: who owns the second key at their turn, and is that master's first slot filled by then?
        rest = _owner_so_far(rest, own_b, small, block_bits)
        rest = lookup_join(rest, slots.select(F.col("m").alias("owner"), "a_at"), "owner", waiting, min_hot_rows)
        owned = F.col("owner").isNotNull()
        full = owned & F.coalesce(F.col("a_at") < F.col("seq"), F.lit(False))
        rest = keep(rest.select("seq", "a", "b", "owner", owned.alias("owned"), full.alias("full")))
        # First row per first key that may acquire it, and first row on it that founds a master with no second key.
        with_a = with_minimum(rest, "a", {"stop_a": F.when(~F.col("full"), F.col("seq")),
                                          "bare_a": F.when(F.col("b").isNull(), F.col("seq"))}, waiting, min_hot_rows)
        risky = ~F.col("owned") | F.coalesce(F.col("bare_a") < F.col("seq"), F.lit(False))
        filling = F.col("owned") & ~F.col("full") & F.col("a").isNotNull()
        with_b = with_minimum(with_a, "b", {"stop_b": F.when(risky, F.col("seq")), "fill_b": F.when(filling, F.col("seq"))},
                              waiting, min_hot_rows)
        no_later = lambda stop: F.col(stop).isNull() | (F.col("seq") <= F.col(stop))
        ready = no_later("stop_a") & no_later("stop_b") & (~filling | no_later("fill_b"))
        judged = materialize(with_b.select("seq", "a", "b", "owner", "owned", filling.alias("filling"), ready.alias("ready")))

        settled = judged.where("ready")
        done.append(settled.select("seq", F.coalesce("owner", "seq").alias("master"),
                                   F.when(F.col("owned"), second).otherwise("new").alias("how")))
        founders, takers = settled.where("not owned"), settled.where("filling")
        own_a = own_a.unionByName(
            founders.where("a is not null").select("a", F.col("seq").alias("m"), F.col("seq").alias("at"))).unionByName(
            takers.select("a", F.col("owner").alias("m"), F.col("seq").alias("at")))
        own_b = own_b.unionByName(founders.where("b is not null").select(
            "b", F.col("seq").alias("m"), F.col("seq").alias("at")))
        filled = filled.unionByName(takers.select(F.col("owner").alias("m"), F.col("seq").alias("a_at"), none.alias("b_at")))
        filled = filled.unionByName(founders.select(
            F.col("seq").alias("m"), F.when(F.col("a").isNotNull(), F.col("seq")).alias("a_at"),
            F.when(F.col("b").isNotNull(), F.col("seq")).alias("b_at")))
        if turn % COMPACT_EVERY == COMPACT_EVERY - 1:
            own_a, own_b, filled = materialize(own_a), materialize(own_b), materialize(filled)
            done = [materialize(reduce(DataFrame.unionByName, done))]
        left = judged.where("not ready").select("seq", "a", "b")
        waiting = left.count()
    raise RuntimeError(f"rows still undecided after {max_rounds} rounds: {waiting}")
