"""Filter audit, vector codes and shards against plain loops, and their defined results on odd and empty tables."""

from itertools import permutations

import brute
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from kinweave.llm import filter_audit, queries, sharding, vector_codes

AUDIT = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
LABELS = "doc_id long, quality int, toxic int, part string, mask int, n long"


def audit_rows(df):
    got = df.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[c] for c in AUDIT) for r in got}
    assert len(out) == len(got)
    return out


def code_rows(df):
    return sorted(map(tuple, df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def test_ranks_are_lexicographic():
    for n in range(1, 6):
        for rank, order in enumerate(permutations(range(n))):
            assert filter_audit.lehmer_rank(order, n) == rank


def test_every_mask_goes_once_in_every_order():
    for n in (1, 3, 5):
        orders = list(permutations(range(n)))
        gone = {}
        for mask, step, start, stop in filter_audit.removal_intervals(n):
            for rank in range(start, stop):
                assert (mask, rank) not in gone
                gone[mask, rank] = step
        for mask in range(1, 1 << n):
            for rank, order in enumerate(orders):
                assert gone[mask, rank] == 1 + next(k for k, f in enumerate(order) if mask >> f & 1)
        assert len(gone) == (2 ** n - 1) * len(orders)


def test_audit_small(spark):
    docs, labels = queries.table(spark, SMALL, "documents"), queries.table(spark, SMALL, "labels")
    want = brute.audit([(r.doc_id, r.text, r.lang) for r in docs.collect()], [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])
    assert audit_rows(queries.op11_filter_audit(spark, SMALL)) == want


def test_audit_odd(spark, odd, empty):
    marks = [(1, 1, 0), (1, 0, 1), (6, 1, 1), (9, 0, None), (None, 1, 1), (99, 1, 1), (8, None, 1)]
    labels = spark.createDataFrame([(*m, "x", 3, 9) for m in marks], LABELS)
    rows = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    got = audit_rows(filter_audit.audit_filters(odd, labels))
    assert got == brute.audit(rows, marks)
    assert {p for p, _, _ in got} == {"", "de", "en", "fr"} and len(got) == 4 * 600
    assert filter_audit.audit_filters(empty, labels).count() == 0
    assert audit_rows(filter_audit.audit_filters(odd, labels.limit(0))) == brute.audit(rows, [])
    # By another column, with a NULL part and a part that is the empty string.
    by_source = filter_audit.audit_filters(odd.withColumn("source", F.when(F.col("source") == "a", "").otherwise(F.col("source"))), labels, part="source")
    assert {r.part for r in by_source.collect()} == {"", "b", "c", "d"}


def test_audit_of_other_filters(spark):
    masks = spark.createDataFrame([("x", 1, 5, 1, 0), ("x", 3, 2, 2, 1), ("x", 0, 4, 4, 0), ("x", 3, 1, 0, 0)], "part string, mask int, n long, good long, toxic long")
    got = audit_rows(filter_audit.audit_orders(masks, "PQ"))
    assert got == {("x", "PQ", 1): (4, 8, 0, 5, 3, 1, 13), ("x", "PQ", 2): (4, 0, 3, 0, 0, 0, 3),
                   ("x", "QP", 1): (9, 3, 0, 0, 2, 1, 3), ("x", "QP", 2): (4, 5, 3, 5, 1, 0, 13)}


def test_codes_small(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in queries.table(spark, SMALL, "embeddings").collect()]
    assert code_rows(queries.op12_vector_codes(spark, SMALL)) == sorted(brute.vector_codes(rows), key=repr)


VECTORS = "vec_id long, embedding array<float>, label int, vec string, code string, error long, key string, n long"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "v", "c", 1, "k", 2) for i, v, label in rows], VECTORS)


def test_codes_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [0.5] * 16, 1), (5, [0.5] * 16, 1), (3, [float(k) for k in range(16)], None), (None, [-0.25] * 16, None), (None, None, 2),
            (7, [0.0] * 15 + [nan], 1), (8, [inf] * 16, 1), (9, [None] + [0.0] * 15, 1), (10, [], 2), (11, [1.0, -1.0, 0.3], 2),
            (3, [float(-k) for k in range(16)], 4), (12, [1e-9] * 16, 4), (13, [-1e-9] * 16, 4)]
    want = sorted(brute.vector_codes([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows]), key=repr)
    got = code_rows(vector_codes.compress_vectors(vectors(spark, rows)))
    assert got == want and len(got) == 9
    assert vector_codes.compress_vectors(vectors(spark, [])).count() == 0
    assert vector_codes.compress_vectors(vectors(spark, [(1, None, 1)])).count() == 0
    assert code_rows(vector_codes.compress_vectors(vectors(spark, [(1, [], 1)])))[0][1:4] == ("00" * 8, 0, 0)


def test_codes_of_huge_components_stay_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(size=8) * 10.0 ** rng.integers(-3, 38)], k % 3) for k in range(60)]
    got = code_rows(vector_codes.compress_vectors(vectors(spark, rows), parts=4, entries=5, rounds=3))
    assert got == sorted(brute.vector_codes(rows, 4, 5, 3), key=repr)


def test_masks_find_the_nearest_entry_among_ties_and_many_entries():
    rng = np.random.default_rng(4)
    for count, width in ((1, 1), (3, 2), (16, 8), (130, 5)):
        entries = rng.integers(-6, 7, (count, width))
        x = rng.integers(-9, 10, (400, width))
        code, best = vector_codes.Nearest(entries).find(x)
        d = ((x[:, None] - entries[None]) ** 2).sum(2)
        assert (code == d.argmin(1)).all() and (best == d.min(1)).all()


def test_masks_are_all_entries_within_the_radius():
    rng = np.random.default_rng(5)
    entries, x = rng.integers(-50, 50, (70, 4)), rng.integers(-60, 60, (200, 4))
    radius = rng.integers(0, 60, 200)
    found = vector_codes.Nearest(entries).candidates(x, radius)
    near = (abs(x[:, None] - entries[None]) <= radius[:, None, None]).all(2)
    assert all(((found[:, e // 64] >> np.uint64(e % 64) & np.uint64(1)).astype(bool) == near[:, e]).all() for e in range(70))


def shard_rows(df):
    return sorted(map(tuple, df.select("doc_id", "size", "text_crc32", "shard", "slot").collect()), key=repr)


def test_shards_small(spark, small):
    got = queries.op13_sharding(spark, SMALL)
    assert shard_rows(got) == sorted(brute.byte_shards(small, queries.SHARDS), key=repr)
    rows = got.collect()
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    line = sorted(rows, key=lambda r: r.doc_id)
    assert [r.shard for r in line] == sorted(r.shard for r in line)
    sizes, largest = np.bincount([r.shard for r in line], [r.size for r in line], queries.SHARDS), max(r.size for r in line)
    assert abs(sizes - sizes.mean()).max() <= largest


def test_shards_odd(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for shards in (1, 3, 16):
        assert shard_rows(sharding.shard_documents(odd, shards)) == sorted(brute.byte_shards(rows, shards), key=repr)
    assert sharding.shard_documents(empty, 16).count() == 0


def test_shards_of_repeated_rows_split_one_id(save):
    docs = save([(7, "same text", "en", "a")] * 300 + [(None, "x" * (k % 5), "en", "a") for k in range(200)])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sharding.shard_documents(docs.repartition(7), 16)
    assert shard_rows(got) == sorted(brute.byte_shards(rows, 16), key=repr)
    assert got.where("doc_id = 7").select("shard").distinct().count() > 8


def test_prefix_sums_follow_any_order(spark):
    rows = spark.createDataFrame([(k % 3, k, 10 * k + 1) for k in range(50)], "a int, b int, size long")
    got = sharding.prefix_sums(rows, [F.desc("a"), F.asc("b")]).collect()
    line, before = sorted(got, key=lambda r: (-r.a, r.b)), 0
    for place, r in enumerate(line):
        assert (r._place, r._before) == (place, before)
        before += r.size


@pytest.mark.parametrize("query", ["op13_sharding"])
def test_native_plans_hold_no_python(spark, query):
    plan = queries.QUERIES[query](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
