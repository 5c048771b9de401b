"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed hash. A source's whole repetitions need no choice; the rest of its target is a budget that is
filled with the documents below a hash threshold. Sizes are summed by source and hash bucket, the budget falls into one bucket,
and only that bucket is summed again on finer hash bits, until it holds one hash: the boundary document. It is taken too when that lands
nearer to the target, and the source is done. Otherwise less than half its size is open, a smaller budget for a nested threshold among the
documents that still fit, until none does. Nothing is sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kinweave.llm.text import free_name, quoted, word_count
from kinweave.plans.ordering import add_dense_rank_number
from kinweave.plans.storage import materialize

BITS, LEVELS = 12, 5
CAP = 3
WEIGHTS = (1, 2, 3)
#: A cut: documents of at most ``limit`` words whose hash is below ``below`` are taken once more.
CUTS = "array<struct<limit:double,below:bigint>>"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from rows (source, size): weights repeat over the sources in code point order, NULL last.

    Targets sum up to all sizes. One that would pass ``cap`` times its source stops there and the excess is shared again by
    weight, which ends when the share of one weight unit no longer changes.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = add_dense_rank_number(totals, [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("position") - 1) % len(weights) + 1).cast("int"))
    sources = materialize(placed.select("source", "source_size", weight.alias("weight")))
    limit = F.col("source_size") * float(cap)
    first = sources.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    unit = first.t / first.w if first.w else 0.0
    while True:
        capped = limit < F.lit(unit) * F.col("weight")
        r = sources.agg(F.sum(F.when(capped, limit)).alias("fixed"), F.sum(F.when(~capped, F.col("weight"))).alias("w")).first()
        following = (first.t - (r.fixed or 0.0)) / r.w if r.w else unit
        if following <= unit * (1 + 1e-15):
            break
        unit = following
    return sources.select("source", "source_size", F.least(limit, F.lit(unit) * F.col("weight")).alias("target"))


def _taken(size: str = "size", hashed: str = "h", cuts: str = "cuts") -> F.Column:
    return F.exists(cuts, lambda c: (F.col(size) <= c["limit"]) & (F.col(hashed) < c["below"]))


def _same(a: str, b: str) -> F.Column:
    return F.col(a).eqNullSafe(F.col(b))


def _next_cut(rows: DataFrame, state: DataFrame) -> DataFrame:
    """One more cut for every open source: the largest hash threshold whose documents fit in ``left``, and the boundary document if nearer.

    A source stays open only if less than half of the boundary document's size is left, so ``left`` halves from cut to cut.
    """
    fits = rows.join(state.where("open").select(F.col("source").alias("s"), "left", "cuts"), _same("source", "s")).where(
        (F.col("size") <= F.col("left")) & ~_taken()).select("source", "size", "h")
    at = state.withColumns({"prefix": F.lit(None).cast("long"), "room": F.col("left"), "edge": F.lit(None).cast("long"), "deeper": F.col("open")})
    keep = state.columns
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        here = at.where("deeper").select(F.col("source").alias("s"), F.col("prefix").alias("p"), "room")
        inside = fits.withColumn("bucket", F.shiftright("h", shift)).withColumn("p0", F.shiftright("h", shift + BITS))
        if level:
            inside = inside.join(here.select("s", "p"), _same("source", "s") & (F.col("p0") == F.col("p"))).drop("s", "p")
        sums = inside.groupBy("source", "bucket").agg(
            F.sum("size").alias("size"), F.min("h").alias("low"), F.max("h").alias("high"))
        running = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
        joined = sums.withColumn("upto", F.sum("size").over(running)).join(here.select("s", "room"), _same("source", "s"))
        # The first bucket that does not fit; without one the whole range is taken.
        first = F.min(F.when(F.col("upto") > F.col("room"), F.struct("bucket", (F.col("upto") - F.col("size")).alias("before"), "size", "low", "high")))
        over = joined.groupBy("source").agg(first.alias("b"), F.max("upto").alias("all")).select(F.col("source").alias("s"), "b", "all")
        settled, none, whole = ~F.col("deeper"), F.col("all").isNull(), F.col("b").isNull()
        one = F.col("b.low") == F.col("b.high")
        moved = at.join(over, _same("source", "s"), "left")
        at = materialize(moved.select(
            *[c for c in keep if c != "open"], "open",
            F.when(settled | none, F.col("prefix")).when(whole, F.lit(1 << BITS * LEVELS)).when(one, F.col("b.low")).otherwise(F.col("b.bucket")).alias("prefix"),
            F.when(settled | none, F.col("room")).when(whole, F.col("room") - F.col("all")).otherwise(F.col("room") - F.col("b.before")).alias("room"),
            F.when(~settled & one, F.col("b.size")).otherwise(F.col("edge")).alias("edge"),
            F.coalesce(~settled & ~one, F.lit(False)).alias("deeper")))
        if at.where("deeper").isEmpty():
            break
    nearer = F.coalesce(F.col("edge") < 2 * F.col("room"), F.lit(False))
    cut = F.array(F.struct(F.col("left").cast("double").alias("limit"), (F.col("prefix") + nearer.cast("long")).alias("below")).cast(
        "struct<limit:double,below:bigint>"))
    return materialize(at.select(
        *[c for c in keep if c not in ("left", "cuts", "open")],
        F.when(F.col("open") & F.col("prefix").isNotNull(), F.concat("cuts", cut)).otherwise(F.col("cuts")).alias("cuts"),
        (F.col("room") - F.when(nearer, F.col("edge")).otherwise(0)).alias("left"),
        (F.col("open") & F.col("edge").isNotNull() & ~nearer).alias("open")))


def _last_cut(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Where nothing fits any more: the smallest document left, if taking it lands nearer to the target than leaving it."""
    under = state.where("left > 0").select(F.col("source").alias("s"), "left", "cuts")
    least = rows.join(under, _same("source", "s")).where((F.col("size") < 2 * F.col("left")) & ~_taken()).groupBy("source").agg(
        F.min(F.struct("size", "h")).alias("next")).select(F.col("source").alias("s"), "next")
    cut = F.array(F.struct(F.col("next.size").cast("double").alias("limit"), (F.col("next.h") + 1).alias("below")).cast(
        "struct<limit:double,below:bigint>"))
    return state.join(least, _same("source", "s"), "left").withColumn(
        "cuts", F.when(F.col("next").isNotNull(), F.concat("cuts", cut)).otherwise(F.col("cuts"))).drop("s", "next", "left", "open")


def _hash(*identity: F.Column) -> F.Column:
    return F.shiftrightunsigned(F.xxhash64(*identity), 64 - BITS * LEVELS)


def _identity(doc_id: F.Column, source: F.Column, text: F.Column) -> F.Column:
    """A hash of what tells rows apart; NULLs count as values."""
    return _hash(*[x for c in (doc_id, source, text) for x in (c.isNull(), c)])


def _hashed(docs: DataFrame, doc_id: str, source: str, text: str, field: str) -> DataFrame:
    """``docs`` with a struct column ``field`` (source, size, h); equal rows have one hash."""
    return docs.withColumn(field, F.struct(F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                                           _identity(F.col(doc_id), F.col(source), F.col(text)).alias("h")))


def _split_equal(rows: DataFrame, field: str, shared: DataFrame | None) -> DataFrame:
    """``rows`` with a hash of its own for every row whose ``field.h`` is in ``shared`` (h).

    Rows with one hash are interchangeable, so any numbering of them gives the same choice. Numbers come from the place in a stored
    partition and the rows of earlier ones, so that no group is gathered in a task.
    """
    if shared is None:
        return rows
    key = shared.select(F.col("h").alias("shared_h"))
    met = F.col(f"{field}.h") == F.col("shared_h")
    stored = materialize(rows.join(key, met, "left_semi").select(
        F.struct(*quoted(rows.columns)).alias("row"), F.col(f"{field}.h").alias("h"), F.monotonically_increasing_id().alias("at")))
    part = stored.withColumn("part", F.shiftright("at", 33))
    sizes = part.groupBy("h", "part").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("h").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("h", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    place = F.row_number().over(W.partitionBy("h", "part").orderBy("at")) + F.col("offset")
    own = F.when(place == 1, F.col("h")).otherwise(_hash(F.col("h"), place.cast("long")))
    numbered = part.join(offsets, ["h", "part"]).select("row", own.alias("own"))
    back = numbered.select(F.col("row").withField(f"{field}.h", F.col("own")).alias("row")).select("row.*")
    return rows.join(key, met, "left_anti").unionByName(back)


def mix_state(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
              weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> tuple[DataFrame, DataFrame | None]:
    """The choice: one row (s, source_size, target, copies, cuts) per source with its whole repetitions and the cuts that fill the rest;
    and the hashes that several rows share, if any."""
    own = free_name(docs.columns, "own")
    rows = materialize(_hashed(docs, doc_id, source, text, own).select(F.col(own).alias("own")))
    shared = materialize(rows.where("own.size > 0").groupBy(F.col("own.h").alias("h")).agg(F.count("*").alias("n")).where("n > 1").select("h"))
    shared = None if shared.isEmpty() else shared
    if shared is not None:
        rows = materialize(_split_equal(rows, "own", shared))
    rows = rows.select("own.*")
    targets = source_targets(rows, weights, cap)
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = materialize(targets.withColumn("copies", copies).withColumn(
        "left", F.col("target") - F.col("copies") * F.col("source_size")).withColumn("cuts", F.array().cast(CUTS)).withColumn(
        "open", F.col("left") > 0))
    filled = rows.where("size > 0")
    while not state.where("open").isEmpty():
        state = _next_cut(filled, state)
    return materialize(_last_cut(filled, state).withColumnRenamed("source", "s")), shared


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
                weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies), one row per document.

    ``size`` counts words (NULL text: 0), ``taken`` is ``size * copies`` and ``copies`` is at most ``cap``. The choice is a
    function of ids, sources and texts alone, so reruns agree; of equal rows any may be the ones taken. A source's taken words are at most
    half the size of one of its documents away from the target. NULL is a source and an id like any other. Documents without words have
    ``copies`` of their source's whole repetitions. An empty table gives an empty result.
    """
    state, shared = mix_state(docs, doc_id, source, text, weights, cap)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    rows = _split_equal(_hashed(narrow, "doc_id", "source", "text", "own").select("doc_id", "own"), "own", shared)
    joined = rows.join(state, F.col("own.source").eqNullSafe(F.col("s")))
    total = F.col("copies") + (_taken("own.size", "own.h") & (F.col("own.size") > 0)).cast("long")
    return joined.select("doc_id", F.col("own.size").alias("size"), "source_size", "target", (F.col("own.size") * total).alias("taken"),
                         total.alias("copies"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
          weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The input's rows, each as often as the mix takes it; documents without words are left out.

    Columns are unchanged, whatever their names. An empty table stays empty.
    """
    state, shared = mix_state(docs, doc_id, source, text, weights, cap)
    own, mix = free_name(docs.columns, "own"), free_name(docs.columns, "mix")
    rows = _split_equal(_hashed(docs, doc_id, source, text, own), own, shared).where(F.col(f"{own}.size") > 0)
    joined = rows.join(state.select(F.struct("*").alias(mix)), F.col(f"{own}.source").eqNullSafe(F.col(f"{mix}.s")))
    total = F.col(f"{mix}.copies") + _taken(f"{own}.size", f"{own}.h", f"{mix}.cuts").cast("long")
    counted = joined.withColumn(mix, total).where(F.col(mix) > 0)
    return counted.withColumn(own, F.explode(F.sequence(F.lit(1), F.col(mix).cast("int")))).select(*quoted(docs.columns))
