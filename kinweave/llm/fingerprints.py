"""Homomorphic document fingerprints: sums of wide vectors hashed from paragraphs.

A paragraph's vector has ``EQUAL`` lanes of hash bits, summed modulo 2**32, which tell multisets of paragraphs apart, and 64
likeness lanes, the +1 or -1 of each hash bit summed over the paragraph's runs of three words, modulo 2**32 as well. A
document's fingerprint is the sum over its paragraphs, so their order does not matter and a paragraph is inserted or deleted
by adding or subtracting its vector. The inner product of likeness lanes estimates how many runs two documents share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kinweave.plans.ordering import add_dense_rank_number
from kinweave.plans.storage import materialize

EQUAL = 8
PACKED = 32
MODULUS = 1 << 32
#: One bit in either half of a long: two counters per sum, each good for 2**31 runs.
PAIR = (1 << 32) + 1


def _equal_lane(paragraphs: Column, k: int) -> Column:
    def bits(p: Column) -> Column:
        # The lane's number seeds the hash of the paragraph, so paragraphs that meet in one pair of lanes do not meet in the others.
        hashed = F.xxhash64(F.lit(k // 2), p)
        return F.shiftrightunsigned(hashed, 32) if k % 2 else hashed.bitwiseAND(F.lit(MODULUS - 1))

    return F.aggregate(paragraphs, F.lit(0).cast("long"), lambda total, p: (total + bits(p)) % MODULUS)


def _runs(text: Column) -> Column:
    """Hashes of the runs of three words of every paragraph; a shorter paragraph is one run."""
    words = F.transform(F.split(text, "\n"), lambda p: F.split(p, "[\\x20\\x09-\\x0D]+"))
    return F.flatten(F.transform(words, lambda w: F.when(F.size(w) < 3, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])))))


def fingerprint_rows(texts: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key..., n_runs, equal, packed): the fingerprint of every row's text; ``key`` is unique, ``text`` not NULL."""
    equal = [_equal_lane(F.split(text, "\n"), k).alias(f"e{k}") for k in range(EQUAL)]
    # Two steps: what stands beside an explode is computed again for every row it makes.
    arrays = texts.select(*key, *equal, _runs(F.col(text)).alias("runs"))
    runs = arrays.select(*key, *[f"e{k}" for k in range(EQUAL)], F.explode("runs").alias("h"))
    sums = runs.groupBy(*key).agg(
        F.count("*").alias("n_runs"), *[F.max(f"e{k}").alias(f"e{k}") for k in range(EQUAL)],
        *[F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(PAIR))).alias(f"p{k}") for k in range(PACKED)])
    return sums.select(*key, "n_runs", F.array(*[f"e{k}" for k in range(EQUAL)]).alias("equal"),
                       F.array(*[f"p{k}" for k in range(PACKED)]).alias("packed"))


def likeness_lanes(packed: Column, n_runs: Column) -> Column:
    """64 sums of +1 and -1 from the counters of set bits."""
    low = F.transform(packed, lambda p: p.bitwiseAND(F.lit(MODULUS - 1)) * 2 - n_runs)
    high = F.transform(packed, lambda p: F.shiftrightunsigned(p, 32) * 2 - n_runs)
    return F.concat(low, high)


def as_text(equal: Column, lanes: Column) -> Column:
    """The fingerprint as hex digits, eight per lane."""
    return F.concat_ws("", F.transform(F.concat(equal, lanes), lambda v: F.lpad(F.hex(F.pmod(v, F.lit(MODULUS))), 8, "0")))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: twice the inner product over both squared lengths; equal lanes give 1."""
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)

    lengths = dot(a, a) + dot(b, b)
    return F.when(a == b, F.lit(1.0)).when(lengths == 0, F.lit(0.0)).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot(a, b) * 2 / lengths)))


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one row per input row.

    The edited text has its last ``floor(n_chars / 2)`` code points replaced by the first as many, or all, of the next document
    in descending doc_id order; after the last comes the first, so a single document is its own next one. NULL texts are
    empty. Ids without a value come last; rows of one id are ordered by a hash of their text, and rows equal in both count once in the order and
    get the same result. Other columns are ignored.
    """
    key = ["k1", "k2"]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = rows.select(F.xxhash64("doc_id", "text").alias("k1"), F.hash("text", "doc_id").alias("k2"), "doc_id", "text")
    ids = keyed.groupBy(*key).agg(F.min("doc_id").alias("doc_id"), F.min(F.length("text")).alias("n"), F.count("*").alias("copies"))
    placed = materialize(add_dense_rank_number(ids, [F.col("doc_id").desc_nulls_last(), F.col("k1"), F.col("k2")]))
    total = placed.count()
    after = placed.select(F.col("k1").alias("next1"), F.col("k2").alias("next2"), F.col("position").alias("at"))
    links = materialize(placed.join(after, F.col("position") % total + 1 == F.col("at")).drop("at", "position"))

    # One exchange of the texts serves the givers and the takers, so both read the same columns. The first of equal rows stands for all.
    before = W.partitionBy(*key).orderBy("doc_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    single = keyed.withColumn("nth", F.count("*").over(before)).where("nth = 1")
    wanted = links.select(F.col("next1").alias("k1"), F.col("next2").alias("k2"), F.col("k1").alias("to1"), F.col("k2").alias("to2"),
                          F.floor(F.col("n") / 2).cast("int").alias("half"))
    given = single.join(wanted, key).select(F.col("to1").alias("k1"), F.col("to2").alias("k2"), F.expr("substring(text, 1, half)").alias("gift"))
    n = F.length("text")
    both = single.join(given, key).select(*key, "text", F.concat(
        F.substring("text", F.lit(1), (n - F.floor(n / 2)).cast("int")), "gift").alias("edited"))
    versions = both.select(*key, F.explode(F.array(
        F.struct(F.lit(0).alias("edit"), F.col("text").alias("t")), F.struct(F.lit(1).alias("edit"), F.col("edited").alias("t")))).alias("v"))
    versions = versions.select(*key, F.col("v.edit").alias("edit"), F.col("v.t").alias("t"), F.sha2("v.t", 256).alias("sha"))
    prints = materialize(fingerprint_rows(versions, [*key, "edit", "sha"], "t"))

    lanes = likeness_lanes(F.col("packed"), F.col("n_runs"))
    own = prints.where("edit = 0").select(*key, F.col("equal").alias("e"), lanes.alias("l"))
    edited = prints.where("edit = 1").select(*key, F.col("sha").alias("edited_sha256"), F.col("equal").alias("ee"), lanes.alias("el"))
    following = own.select(F.col("k1").alias("next1"), F.col("k2").alias("next2"), F.col("l").alias("nl"))
    joined = links.join(own, key).join(edited, key).join(following, ["next1", "next2"])
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), "edited_sha256", as_text(F.col("e"), F.col("l")).alias("fingerprint"),
        as_text(F.col("ee"), F.col("el")).alias("edited_fingerprint"), likeness(F.col("l"), F.col("el")).alias("near_edited"),
        likeness(F.col("l"), F.col("nl")).alias("near_next"))
