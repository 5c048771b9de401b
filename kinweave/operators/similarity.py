"""Fuzzy rules over distinct values, with exact candidate generation.

Names repeat a lot, so the comparison runs on distinct values only and the result is joined back by equality.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.functions.trigram import similarity, trigrams
from kinweave.operators.components import connected_components
from kinweave.operators.matching import preferred_master
from kinweave.plans.ordering import add_dense_rank_number
from kinweave.plans.skew import lookup_join
from kinweave.plans.storage import materialize

#: Master values of the first level of a search from the oldest on, and how much larger each following level is.
FIRST_LEVEL, GROWTH = 1024, 16
#: Rows under one trigram that a share takes.
HEAVY_GRAM = 20_000
#: Trigrams that two texts must have in common to be compared, at most, and subsets of so many trigrams that a text is put under for one length.
LARGEST, SUBSETS = 4, 16
#: Sets of up to so many trigrams are told apart by their exact size, larger ones by sizes that grow by a share.
EXACT_SIZES, GROWING = 20, 1.05


def _distinct_values(raw_values: DataFrame, master_values: DataFrame):
    left = raw_values.select("tenant_id", "rule_id", F.col("value").alias("a")).distinct()
    right = preferred_master(master_values).withColumnRenamed("value", "b")
    return left, right


def _back_to_raws(raw_values: DataFrame, best: DataFrame) -> DataFrame:
    """Attach the best master of each distinct value to all raw rows with that value."""
    found = lookup_join(raw_values, best.withColumnRenamed("a", "value"), ["tenant_id", "rule_id", "value"])
    return found.where("master_profile_id is not null").select(
        "raw_profile_id", "tenant_id", "rule_id", "attribute", "created_at", "master_profile_id", "measure")


def trigram_match(raw_values: DataFrame, master_values: DataFrame, threshold: float, first: int = FIRST_LEVEL) -> DataFrame:
    """Oldest master whose value has trigram similarity of at least ``threshold``.

    Masters' values are looked at from the oldest on, in levels of ``first``, then ``GROWTH`` times as many, and so on; a raw value that has found
    its master leaves. However many names are near-equal, a raw value meets no more of them than one level has.
    """
    left, right = _distinct_values(raw_values, master_values)
    total = right.count()
    placed = right if total <= first else materialize(add_dense_rank_number(right, ["created_at", "master_profile_id", "tenant_id", "rule_id", "b"], "place"))
    found, start, size = None, 0, first
    while start < max(total, 1):
        level = placed if total <= first else placed.where((F.col("place") > start) & (F.col("place") <= start + size)).drop("place")
        near = similar_texts(left.withColumnRenamed("a", "text"), level.select("tenant_id", "rule_id", F.col("b").alias("text")), threshold)
        best = near.join(level, ["tenant_id", "rule_id", "b"]).groupBy("tenant_id", "rule_id", "a").agg(
            F.min(F.struct("created_at", "master_profile_id", "measure")).alias("_m")).select("tenant_id", "rule_id", "a", "_m.*")
        start, size = start + size, size * GROWTH
        if start >= total and found is None:
            return _back_to_raws(raw_values, best)
        best = materialize(best)
        found = best if found is None else found.unionByName(best)
        left = left.join(best.select("tenant_id", "rule_id", "a"), ["tenant_id", "rule_id", "a"], "left_anti")
        if start < total:
            left = materialize(left)
            if left.isEmpty():
                break
    return _back_to_raws(raw_values, found)


def _prefixes(texts: DataFrame, names: list[str], threshold: float) -> DataFrame:
    """(names..., n, grams, sign, df, gram, at): every text under the first trigrams of its rare-to-frequent order.

    ``texts``: tenant_id, rule_id, text and further columns that make its rows distinct. Two sets can only reach the threshold if their first
    ``n - ceil(t n) + 1`` trigrams intersect (Chaudhuri et al. 2006, Bayardo et al. 2007). ``sign`` has the parity of the trigrams per hash
    class: two sets differ in at least as many trigrams as their signs differ in bits.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    texts = texts.withColumn("grams", trigrams("text")).withColumn("n", F.size("grams")).where("n > 0")
    tokens = texts.select(*names, "n", F.explode("grams").alias("gram"))
    frequency = tokens.groupBy("tenant_id", "rule_id", "gram").agg(F.count("*").alias("df"))
    ranked = tokens.join(frequency, ["tenant_id", "rule_id", "gram"]).groupBy(*names, "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("sorted"))
    keep = F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)).cast("int") + 1
    sign = "aggregate(grams, 0L, (s, g) -> s ^ shiftleft(1L, cast(pmod(xxhash64(g), 64) as int)))"
    return ranked.select(*names, "n", F.col("sorted.gram").alias("grams"), F.posexplode(F.slice("sorted", F.lit(1), keep)).alias("at", "e")).select(
        *names, "n", "grams", F.expr(sign).alias("sign"), F.col("e.df").alias("df"), F.col("e.gram").alias("gram"), "at")


def _band(n, threshold: float):
    """Lengths in a geometric row: sets similar enough lie in the same band or in neighbouring ones."""
    return F.floor(F.log(n) / -math.log(min(threshold, 0.9)) + F.lit(1e-9)).cast("int")


def _side(prefixes: DataFrame, names: list[str], mark: str) -> DataFrame:
    return prefixes.select("tenant_id", "rule_id", "gram", "df", *[F.col(c).alias(f"{c}_{mark}") for c in [*names, "n", "grams", "sign", "at"]])


def _met(one: DataFrame, two: DataFrame, threshold: float, heavy: int = HEAVY_GRAM) -> DataFrame:
    """Similar pairs of two sides (``_side``) with ``measure``, each pair once.

    Rows meet under a trigram and length band; a heavy trigram's rows are dealt over shares on one side and copied to them on the other.
    A pair is measured only at its first common trigram, if what follows there can still reach the overlap (position filter, Xiao et al. 2008)
    and the signs do not differ too much.
    """
    shares = F.ceil(F.col("df") / heavy).cast("int")
    a = one.withColumn("share", F.pmod(F.xxhash64("grams_a"), shares).cast("int")).withColumn(
        "band", F.explode(F.array(*[_band(F.col("n_a"), threshold) + d for d in (-1, 0, 1)])))
    b = two.withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1))).withColumn("band", _band(F.col("n_b"), threshold)).drop("df")
    need = F.ceil((F.col("n_a") + F.col("n_b")) * F.lit(threshold / (1 + threshold)) - F.lit(1e-9))
    long_enough = (F.least("n_a", "n_b") + F.lit(1e-9)) >= F.greatest("n_a", "n_b") * F.lit(threshold)
    position = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= need
    apart = F.bit_count(F.col("sign_a").bitwiseXOR(F.col("sign_b"))) <= F.col("n_a") + F.col("n_b") - 2 * need
    before = F.arrays_overlap(F.slice("grams_a", F.lit(1), F.col("at_a")), F.slice("grams_b", F.lit(1), F.col("at_b")))
    met = a.join(b, ["tenant_id", "rule_id", "gram", "band", "share"]).where(long_enough & position & apart).where(~before)
    return met.withColumn("measure", similarity("grams_a", "grams_b")).where(F.col("measure") >= threshold - 1e-9)


def similar_texts(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(tenant_id, rule_id, a, b, measure) of all similar pairs of distinct texts (tenant_id, rule_id, text) of two tables."""
    sides = [df.select(F.lit(side).alias("side"), "tenant_id", "rule_id", "text") for side, df in (("a", left), ("b", right))]
    prefixes = _prefixes(sides[0].unionByName(sides[1]), ["side", "tenant_id", "rule_id", "text"], threshold)
    one, two = (_side(prefixes.where(F.col("side") == m), ["text"], m) for m in "ab")
    return _met(one, two, threshold).select("tenant_id", "rule_id", F.col("text_a").alias("a"), F.col("text_b").alias("b"), "measure")


def _size_class(n: int) -> int:
    return n if n <= EXACT_SIZES else EXACT_SIZES + int(math.log(n / EXACT_SIZES) / math.log(GROWING))


def _subset_plan(sizes: list[int], threshold: float) -> dict[int, tuple[list[tuple[int, np.ndarray]], int]]:
    """Per set size: (seed, places of each subset in the rare-to-frequent order) for every class of partner sizes, and the trigrams to be put under alone.

    Two sets with ``need`` common trigrams have ``l`` of them among the first ``size - need + l`` of each (Wang et al. 2012). ``l`` is as large as
    the number of subsets allows; where only 1 is left, one prefix serves all partners.
    """
    classes: dict[int, list[int]] = {}
    for n in sizes:
        classes.setdefault(_size_class(n), []).append(n)
    out = {}
    for n in sizes:
        own, subsets, alone = _size_class(n), [], 0
        for other, members in classes.items():
            need = math.ceil((min(classes[own]) + min(members)) * threshold / (1 + threshold) - 1e-6)
            if need > min(n, max(members)):
                continue
            most = max(*classes[own], *members) - need
            together = max(k for k in range(1, LARGEST + 1) if k == 1 or k <= need and math.comb(k + most, k) <= SUBSETS)
            if together == 1:
                alone = n - max(1, math.ceil(n * threshold - 1e-6)) + 1
                continue
            seed = (min(own, other) << 40) + (max(own, other) << 8) + together
            subsets.append((seed, np.array(list(combinations(range(n - need + together), together)), dtype=np.int64)))
        out[n] = subsets, alone
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _put_under(plan: dict, threshold: float):
    """(id, scope, n, sign, tokens) -> (subset, id, n, sign): every text under the subsets of its plan."""
    width = -math.log(min(threshold, 0.9))

    def run(batches):
        for batch in batches:
            ids, n, sign = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "n", "sign"))
            scope = batch.column("scope").to_numpy().view(np.uint64)
            flat = batch.column("tokens").flatten().to_numpy().view(np.uint64)
            starts = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
            for size in np.unique(n).tolist():
                rows = np.flatnonzero(n == size)
                tokens, base = flat[starts[rows][:, None] + np.arange(size)], _mixed(scope[rows])[:, None]
                subsets, alone = plan[size]
                # Sizes similar enough lie in the same band or in neighbouring ones, so they meet under one of two.
                band = int(math.log(size) / width + 1e-9)
                puts = subsets + [(-1 - band - d, np.arange(alone)[:, None]) for d in (0, 1) if alone]
                for seed, places in puts:
                    h = base ^ np.uint64(seed & 0xFFFFFFFFFFFFFFFF)
                    for k in range(places.shape[1]):
                        h = _mixed(h + tokens[:, places[:, k]])
                    each = places.shape[0]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(h.ravel().view(np.int64)), pa.array(np.repeat(ids[rows], each)), pa.array(np.repeat(n[rows], each)),
                        pa.array(np.repeat(sign[rows], each))], names=["subset", "id", "n", "sign"])
    return run


def _ranked_sets(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The numbered texts with their trigrams, and (id, scope, n, tokens, sign): trigrams of a text from rare to frequent, with their sign (see ``_prefixes``)."""
    scope = ["tenant_id", "rule_id"]
    texts = texts.dropna(subset=scope).withColumn("grams", trigrams("text")).withColumn("n", F.size("grams")).where("n > 0")
    texts = materialize(texts.withColumn("id", F.monotonically_increasing_id()))
    tokens = texts.select("id", *scope, F.explode("grams").alias("gram"))
    frequency = tokens.groupBy(*scope, "gram").agg(F.count("*").alias("df"))
    ranked = tokens.join(frequency, [*scope, "gram"]).groupBy("id", F.xxhash64(*scope).alias("scope")).agg(
        F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("sorted"))
    sign = "aggregate(tokens, 0L, (s, g) -> s ^ shiftleft(1L, cast(pmod(g, 64) as int)))"
    ranked = ranked.select("id", "scope", F.size("sorted").alias("n"), F.transform("sorted", lambda e: F.xxhash64(e["gram"])).alias("tokens"))
    return texts, materialize(ranked.withColumn("sign", F.expr(sign)))


def _meeting(ranked: DataFrame, threshold: float) -> DataFrame:
    """(id_a, id_b), id_a < id_b: texts that meet under a subset and whose lengths and signs allow them to be similar, each pair once."""
    sizes = [r.n for r in ranked.select("n").distinct().orderBy("n").collect()]
    put = ranked.mapInArrow(_put_under(_subset_plan(sizes, threshold), threshold), "subset long, id long, n int, sign long")
    one, two = (put.select("subset", *[F.col(c).alias(f"{c}_{m}") for c in ("id", "n", "sign")]) for m in "ab")
    need = F.ceil((F.col("n_a") + F.col("n_b")) * F.lit(threshold / (1 + threshold)) - F.lit(1e-6))
    apart = F.bit_count(F.col("sign_a").bitwiseXOR(F.col("sign_b"))) <= F.col("n_a") + F.col("n_b") - 2 * need
    return one.join(two, "subset").where((F.col("id_a") < F.col("id_b")) & (need <= F.least("n_a", "n_b")) & apart).select("id_a", "id_b").distinct()


def similar_pairs(texts: DataFrame, threshold: float) -> DataFrame:
    """(tenant_id, rule_id, a, b, measure) of all similar pairs of the distinct texts (tenant_id, rule_id, text) of one table, in both directions
    and of each text with itself.

    Names made of few trigrams have many of them in common with very many others, so texts meet under several common trigrams at once, not under
    one. Of what meets, lengths and signs are looked at first; the trigrams are fetched for the pairs that are left.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    scope = ["tenant_id", "rule_id"]
    texts, ranked = _ranked_sets(texts)
    side = lambda m: texts.select(F.col("id").alias(f"id_{m}"), *[F.col(c).alias(f"{c}_{m}") for c in (*scope, "text", "grams")])
    pairs = _meeting(ranked, threshold).join(side("a"), "id_a").join(side("b"), "id_b").where("tenant_id_a = tenant_id_b and rule_id_a = rule_id_b")
    pairs = materialize(pairs.withColumn("measure", similarity("grams_a", "grams_b")).where(F.col("measure") >= threshold - 1e-9).select(
        F.col("tenant_id_a").alias("tenant_id"), F.col("rule_id_a").alias("rule_id"), F.col("text_a").alias("a"), F.col("text_b").alias("b"), "measure"))
    return pairs.unionByName(pairs.select(*scope, F.col("b").alias("a"), F.col("a").alias("b"), "measure")).unionByName(
        texts.select(*scope, F.col("text").alias("a"), F.col("text").alias("b"), F.lit(1.0).alias("measure")))


def fuzzy_edges(values: DataFrame, rules, node: str = "seq") -> DataFrame:
    """(u, v, rule_id, attribute), u > v: edges between the first nodes of similar texts that connect whatever the trigram rules connect.

    ``values``: (tenant_id, rule_id, attribute, value, node). Rows with one and the same text are linked by equality already,
    so one node per text stands for them. Not every similar pair is put out: the texts under a trigram are first measured against one of them
    (a star), twice with another hub, and only texts that are still apart after that meet each other.
    """
    names = ["tenant_id", "rule_id", "attribute", "text", "node"]
    first = values.groupBy("tenant_id", "rule_id", "attribute", F.col("value").alias("text")).agg(F.min(node).alias("node"))
    parts = [_connecting(_prefixes(first.where(F.col("rule_id") == r.id), names, r.threshold), r.threshold) for r in rules]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _connecting(prefixes: DataFrame, threshold: float) -> DataFrame:
    prefixes = materialize(prefixes.withColumn("band", _band(F.col("n"), threshold)))
    key, about = ["tenant_id", "rule_id", "gram", "band"], ["node", "attribute", "n", "grams", "sign", "at"]
    names = ["node", "attribute"]
    edges, roots = None, None
    for turn in range(3):
        rows = prefixes.withColumn("root", F.col("node")) if roots is None else prefixes.join(
            roots.withColumnRenamed("root", "r"), "node", "left").withColumn("root", F.coalesce("r", "node")).drop("r")
        if turn < 2:
            order = F.col("node") if turn == 0 else F.xxhash64("node", "gram")
            hubs = rows.groupBy(*key).agg(F.min(F.struct(order.alias("o"), F.struct(*about, "root").alias("h"))).alias("m"), F.min("root").alias("lo"),
                                          F.max("root").alias("hi")).where("lo < hi").select(*key, F.col("m.h").alias("h"))
            met = lookup_join(rows, hubs, key).where("h is not null and root <> h.root")
            pairs = met.select("tenant_id", "rule_id", *[F.col(f"h.{c}").alias(f"{c}_a") for c in about], *[F.col(c).alias(f"{c}_b") for c in about])
            found = pairs.withColumn("measure", similarity("grams_a", "grams_b")).where(F.col("measure") >= threshold - 1e-9)
        else:
            several = rows.groupBy("tenant_id", "rule_id", "gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
            rest = materialize(lookup_join(rows.drop("band"), several.select("tenant_id", "rule_id", "gram", F.lit(True).alias("open")),
                                           ["tenant_id", "rule_id", "gram"]).where("open").drop("open"))
            one, two = (_side(rest, [*names, "root"], m) for m in "ab")
            found = _met(one, two, threshold).where("node_a < node_b and root_a <> root_b")
        own = found.select(F.greatest("node_a", "node_b").alias("u"), F.least("node_a", "node_b").alias("v"), "rule_id",
                           F.col("attribute_a").alias("attribute")).where("u <> v").distinct()
        edges = materialize(own if edges is None else edges.unionByName(own))
        if turn < 2:
            roots = connected_components(edges.select("u", "v"))
    return edges


def _deletions(text, max_distance: int):
    """The text and every text left after deleting up to ``max_distance`` characters."""
    variants = F.array(text)
    for _ in range(max_distance):
        shorter = F.flatten(F.transform(variants, lambda s: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))),
            lambda i: F.concat(F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1)))))
        variants = F.array_distinct(F.concat(variants, shorter))
    return variants


def levenshtein_match(raw_values: DataFrame, master_values: DataFrame, max_distance: int = 1) -> DataFrame:
    """Nearest master value within an edit distance of 1 or 2.

    Two texts within distance d share a text left after deleting at most d characters from each, so equality on deletion
    variants finds every pair; the variants are nearly whole values, so few distinct values share one.
    """
    if max_distance not in (1, 2):
        raise ValueError("max_distance must be 1 or 2")
    left, right = _distinct_values(raw_values, master_values)
    key = ["tenant_id", "rule_id", "variant"]
    a = left.withColumn("variant", F.explode(_deletions(F.col("a"), max_distance)))
    b = right.withColumn("variant", F.explode(_deletions(F.col("b"), max_distance)))
    hits = a.join(b, key).withColumn("measure", F.levenshtein("a", "b")).where(F.col("measure") <= max_distance)
    best = hits.groupBy("tenant_id", "rule_id", "a").agg(
        F.min(F.struct("measure", "created_at", "master_profile_id")).alias("_m")).select(
        "tenant_id", "rule_id", "a", "_m.*")
    return _back_to_raws(raw_values, best)
