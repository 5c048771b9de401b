"""Order-faithful resolution by any number of rules, in blocks of the order.

The row-by-row process: rows come in order; a row joins the oldest master of its tenant that owns an identifier it brings under the strongest
rule with such a master, else it founds a master. A master owns, per rule, the first value that a member brings (scalar columns), or every
value its members bring (sets and maps). A trigram rule asks for all values similar to the row's own.

A row's decision depends on earlier rows only, through chains that may be as long as the table, so no number of rounds over all rows is
safe. The order is cut into blocks of a bounded number of identifiers instead. A block fetches what earlier rows left behind for it: the oldest
owner of every key that its rows ask for, and which slots of these owners are taken. Whoever a row of the block can join is among these owners or
founded in the block, so its rows are then decided one after the other where they lie, tenants beside each other, and what they add to owners
and slots is stored for the blocks behind. Every identifier is exchanged a fixed number of times, whatever the rows share.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.plans.skew import MIN_HOT_ROWS, lookup_join
from kinweave.plans.storage import appended, materialize, new_path

#: A block of the order has at most 2 to this power identifiers, unless so few rows (2 to this power over FINEST) bring more.
BLOCK_BITS = 20
FINEST = 256
#: Tenants are decided beside each other in so many groups at most.
GROUPS = 64
#: What a stored row of the log says.
JOINED, OWNED, FILLED = 0, 1, 2
LOG = "what int, at long, master long, rule_id int"
_NOBODY = np.iinfo(np.int64).max


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy()


def _decide(rows: pa.Table, known: pa.Table) -> pa.Table:
    """One row after the other. ``rows``: (seq, asks, rule_id, key, slot); ``known``: (key, master, rules), the owner of a key with its taken slots."""
    key, codes = np.unique(_numbers(rows["key"]), return_inverse=True)
    owner = np.full(len(key), _NOBODY)
    owner[np.searchsorted(key, _numbers(known["key"]))] = _numbers(known["master"])
    before, owner = owner, owner.tolist()
    taken = {(m, r) for m, rules in zip(known["master"].to_pylist(), known["rules"].to_pylist()) for r in rules or ()}
    seq, asks, rule = _numbers(rows["seq"]), _numbers(rows["asks"]), _numbers(rows["rule_id"])
    # A row asks before it brings, under its strongest rule first; a slot takes the smallest key of several.
    order = np.lexsort((codes, rule, ~asks, seq))
    joined, filled, now, master, by = [], [], None, None, None
    for s, a, r, k, slot in zip(*(v[order].tolist() for v in (seq, asks, rule, codes, _numbers(rows["slot"])))):
        if s != now:
            if by is not None:
                joined.append((now, master, by))
            now, master, by = s, s, None
        if a:
            found = owner[k]
            if found < _NOBODY and (by is None or r == by and found < master):
                master, by = found, r
            continue
        if slot:
            if (master, r) in taken:
                continue
            taken.add((master, r))
            filled.append((master, r))
        if master < owner[k]:
            owner[k] = master
    if by is not None:
        joined.append((now, master, by))
    owner = np.array(owner, np.int64)
    new = np.flatnonzero(owner < before)
    none = [None] * max(len(new), len(filled))
    what = np.repeat(np.array([JOINED, OWNED, FILLED], np.int32), [len(joined), len(new), len(filled)])
    return pa.table({
        "what": pa.array(what),
        "at": pa.array([*(j[0] for j in joined), *key[new].tolist(), *none[:len(filled)]], pa.int64()),
        "master": pa.array([*(j[1] for j in joined), *owner[new].tolist(), *(f[0] for f in filled)], pa.int64()),
        "rule_id": pa.array([*(j[2] for j in joined), *none[:len(new)], *(f[1] for f in filled)], pa.int32())})


def _blocks(rows: DataFrame, block_bits: int) -> list[tuple[int, int]]:
    """(bucket, block) of every bucket of sequence numbers, in order; a block ends before it gets too many identifiers."""
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n")).orderBy("bucket").collect()  # one row per 2 ** block_bits / FINEST rows
    out, block, size = [], 0, 0
    for r in counts:
        if size and size + r.n > 1 << block_bits:
            block, size = block + 1, 0
        out.append((r.bucket, block))
        size += r.n
    return out


def settle(nodes: DataFrame, held: DataFrame, asked: DataFrame, max_rounds: int = 10_000, block_bits: int = BLOCK_BITS) -> DataFrame:
    """(seq, master, rule_id) for every row of ``nodes`` (seq, is_prior); prior masters keep to themselves.

    ``held``: (seq, rule_id, key, slot, part), the identifiers that a row brings to its master, where ``slot`` rules own the first one only.
    ``asked``: (seq, rule_id, key, part), the identifiers under which a row looks for a master; the smallest rule wins. All rows that share a
    key have one ``part``. Blocks beyond ``max_rounds`` are an error.
    """
    rows = held.select("seq", F.lit(False).alias("asks"), "rule_id", "key", "slot", "part").unionByName(
        asked.select("seq", F.lit(True).alias("asks"), "rule_id", "key", F.lit(False).alias("slot"), "part")).where("key is not null")
    rows = rows.join(nodes.select("seq", "is_prior"), "seq").where("not (asks and is_prior)").drop("is_prior")
    rows = materialize(rows.withColumn("bucket", F.shiftright("seq", max(0, block_bits - FINEST.bit_length() + 1))))
    spark = nodes.sparkSession
    buckets = _blocks(rows, block_bits)
    blocks = buckets[-1][1] + 1 if buckets else 0
    if blocks > max_rounds:
        raise RuntimeError(f"{blocks} blocks are more than {max_rounds} rounds")
    if blocks > 1:
        of = F.broadcast(spark.createDataFrame(buckets, "bucket long, block int"))
        rows = appended(rows.join(of, "bucket").drop("bucket").repartition("block", "part"), new_path(spark), "block")
    log = new_path(spark)
    nothing = spark.createDataFrame([], "of int, key long, master long, rules array<int>")
    for block in range(blocks):
        here = rows if blocks == 1 else rows.where(F.col("block") == block)
        here = here.select("part", "seq", "asks", "rule_id", "key", "slot")
        known = nothing
        if block:
            so_far = spark.read.schema(LOG).parquet(log)
            owned = so_far.where(F.col("what") == OWNED).select(F.col("at").alias("key"), "master")
            wanted = here.where("asks").select("part", "key").distinct()
            owners = owned.join(wanted, "key").groupBy("part", "key").agg(F.min("master").alias("master"))
            slots = so_far.where(F.col("what") == FILLED).select("master", "rule_id")
            slots = slots.join(owners.select("master").distinct(), "master", "left_semi").groupBy("master").agg(F.collect_set("rule_id").alias("rules"))
            known = owners.join(slots, "master", "left").select(F.col("part").alias("of"), "key", "master", "rules")
        found = here.groupBy("part").cogroup(known.groupBy("of")).applyInArrow(_decide, LOG)
        appended(found, log, "what")
    if not blocks:
        return nodes.select("seq", F.col("seq").alias("master"), F.lit(None).cast("int").alias("rule_id"))
    joined = spark.read.schema(LOG).parquet(log).where(F.col("what") == JOINED).select(F.col("at").alias("seq"), "master", "rule_id")
    return nodes.select("seq").join(joined, "seq", "left").select("seq", F.coalesce("master", "seq").alias("master"), "rule_id")


def keyed(held: DataFrame, asked: DataFrame, rows: int, min_hot_rows: int = MIN_HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Both tables with a number ``key`` in place of (tenant_id, rule_id, value), and the tenant's ``part``. Values that no row holds are not asked for."""
    name = ["tenant_id", "rule_id", "value"]
    numbers = materialize(held.select(*name).distinct().withColumn("key", F.monotonically_increasing_id()))
    part = F.pmod(F.xxhash64("tenant_id"), F.lit(GROUPS)).cast("int")
    code = lambda df: lookup_join(df, numbers, name, rows, min_hot_rows).withColumn("part", part).drop("tenant_id", "value")
    return materialize(code(held)), materialize(code(asked).where("key is not null").distinct())
