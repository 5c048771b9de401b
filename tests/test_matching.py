"""Match rules against brute force over all pairs."""

import random
import re
from itertools import combinations

import pytest

from kinweave.config import Rule
from kinweave.operators import matching, similarity, vectors

RAW = "raw_profile_id string, tenant_id string, email string, phone_number string, last_name string, city string"
MASTER = "master_profile_id string, tenant_id string, created_at long, email string, phone_number string, last_name string, city string"


def people(seed, n, masters):
    rng = random.Random(seed)
    pick = lambda p, k: None if rng.random() < 0.25 else f"{p}{rng.randrange(k)}"
    row = lambda: (pick("E", 8), pick("p", 8), pick("n", 5), pick("c", 3))
    raws = [(f"r{i}", f"t{rng.randrange(2)}", *row()) for i in range(n)]
    return raws, [(f"m{i:02d}", f"t{rng.randrange(2)}", rng.randrange(5), *row()) for i in range(masters)]


def frames(spark, seed=1, n=60, masters=40):
    raws, ms = people(seed, n, masters)
    return raws, ms, spark.createDataFrame(raws, RAW), spark.createDataFrame(ms, MASTER)


def same(a, b):
    return a is not None and b is not None and a.lower() == b.lower()


def test_weighted_match(spark):
    raws, ms, r, m = frames(spark)
    weights = {"email": 3.0, "phone_number": 2.0, "last_name": 1.5, "city": 1.0}
    want = {}
    for rid, t, *rv in raws:
        best = []
        for mid, mt, at, *mv in ms:
            s = sum(w for w, a, b in zip(weights.values(), rv, mv) if same(a, b))
            if mt == t and s >= 2.5:
                best.append((-s, at, mid))
        if best:
            want[rid] = (min(best)[2], -min(best)[0])
    got = {x.raw_profile_id: (x.master_profile_id, x.score) for x in matching.probabilistic_match(r, m, weights, 2.5).collect()}
    assert got == want


@pytest.mark.parametrize("conflicts", [0, 1, 2, 3])
def test_merge_guard(spark, conflicts):
    raws, ms, r, m = frames(spark, seed=conflicts)
    want = {}
    for rid, t, *rv in raws:
        ok = []
        for mid, mt, at, *mv in ms:
            clash = sum(1 for a, b in zip(rv[:3], mv[:3]) if a is not None and b is not None and a.lower() != b.lower())
            if mt == t and same(rv[3], mv[3]) and clash <= conflicts:
                ok.append((at, mid))
        if ok:
            want[rid] = min(ok)[1]
    got = {x.raw_profile_id: x.master_profile_id
           for x in matching.merge_guard(r, m, "city", ["email", "phone_number", "last_name"], conflicts).collect()}
    assert got == want


def names(spark, seed, letters="abc", n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(3, 8)))
    raws = [(f"r{i}", "t", word() + " " + word()) for i in range(n)]
    ms = [(f"m{i:02d}", "t", i, word() + " " + word()) for i in range(n)]
    rule = [Rule(1, "name", "fuzzy_trgm", 0.4)]
    r = matching.raw_rule_values(spark.createDataFrame(raws, "raw_profile_id string, tenant_id string, name string"), rule)
    m = matching.master_rule_values(spark.createDataFrame(ms, "master_profile_id string, tenant_id string, created_at long, name string"), rule)
    return raws, ms, r, m


def grams(text):
    return {p[i:i + 3] for w in text.split() for p in ["  " + w + " "] for i in range(len(w) + 1)}


@pytest.mark.parametrize("threshold", [0.25, 0.4, 0.7])
def test_trigram_match_is_complete(spark, threshold):
    raws, ms, r, m = names(spark, 5)
    want = {}
    for rid, _, a in raws:
        hits = [(at, mid) for mid, _, at, b in ms if len(grams(a) & grams(b)) / len(grams(a) | grams(b)) >= threshold - 1e-9]
        if hits:
            want[rid] = min(hits)[1]
    got = {x.raw_profile_id: x.master_profile_id for x in similarity.trigram_match(r, m, threshold).collect()}
    assert got == want


def words(rng, most):
    return " ".join("".join(rng.choice("ab1") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, most)))


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.8, 1.0])
def test_similar_pairs_of_one_table(spark, threshold):
    """Short and long texts, of two tenants and none, and texts without trigrams."""
    rng = random.Random(7)
    texts = {words(rng, 4) for _ in range(70)} | {words(rng, 20) for _ in range(15)} | {f"Customer#{k:09d}" for k in range(995, 1035)} | {"", "#!"}
    texts |= {t + " b" for t in list(texts)[::5]}
    rows = [(tenant, 4, t) for tenant in ("t0", "t1", None) for t in sorted(texts) if tenant != "t1" or rng.random() < 0.5]
    got = similarity.similar_pairs(spark.createDataFrame(rows, "tenant_id string, rule_id int, text string"), threshold).collect()
    want = {}
    for tenant, r, a in rows:
        for other, _, b in rows:
            x, y = (grams(re.sub("[^a-z0-9]+", " ", text.lower())) for text in (a, b))
            if tenant is not None and tenant == other and x | y and len(x & y) / len(x | y) >= threshold - 1e-9:
                want[tenant, r, a, b] = len(x & y) / len(x | y)
    assert len(got) == len(want) and {tuple(r)[:4]: r.measure for r in got} == pytest.approx(want)


def test_numbered_names_meet_few_others(spark):
    """Names of few trigrams share most of them with very many others, but are compared with few."""
    names = spark.range(20_000, 24_000).selectExpr("'t' as tenant_id", "4 as rule_id", "format_string('Customer#%09d', id) as text")
    met = similarity._meeting(similarity._ranked_sets(names)[1], 0.8).count()
    similar = similarity.similar_pairs(names, 0.8).where("a < b").count()
    assert similar <= met <= 8 * 4000


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


@pytest.mark.parametrize("distance", [1, 2])
def test_edit_distance_match_is_complete(spark, distance):
    raws, ms, r, m = names(spark, 9, letters="ab")
    want = {}
    for rid, _, a in raws:
        hits = [(edit(a, b), at, mid) for mid, _, at, b in ms if edit(a, b) <= distance]
        if hits:
            want[rid] = min(hits)[2]
    got = {x.raw_profile_id: x.master_profile_id for x in similarity.levenshtein_match(r, m, distance).collect()}
    assert got == want and got


def test_active_rules(spark):
    rows = [(2, "phone_number", True, "ACTIVE", "exact", None, "non_null"), (1, "email", True, "ACTIVE", "exact", None, "non_null"),
            (3, "city", True, "ACTIVE", "none", None, None), (4, "x", False, "ACTIVE", "exact", None, None),
            (5, "y", True, "INACTIVE", "exact", None, None), (6, "last_name", True, "ACTIVE", "fuzzy_trgm", 0.7, None)]
    meta = spark.createDataFrame(rows, "id int, attribute_internal_code string, is_identity_resolution boolean, status string, "
                                       "matching_rule string, matching_threshold double, consolidation_rule string")
    assert [r.attribute for r in matching.active_rules(meta)] == ["email", "phone_number", "last_name"]


@pytest.mark.parametrize("metric,limit", [("cosine", 0.4), ("l2", None)])
def test_neighbours_with_copies(spark, metric, limit):
    import numpy as np
    rng = np.random.default_rng(4)
    base = rng.normal(size=(90, 6)).astype("float32").astype("float64")
    data = [base[0] if i % 3 == 0 else base[i] for i in range(90)]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "item_id long, vec array<double>")
    got = {}
    for r in vectors.nearest_neighbours(df.withColumnRenamed("item_id", "query_id"), df, 4, metric, limit, block=8).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.item_id))
    want = {}
    for q in range(90):
        if metric == "cosine":
            d = [1 - float(data[q] @ x / np.linalg.norm(data[q]) / np.linalg.norm(x)) for x in data]
        else:
            d = [float(np.linalg.norm(data[q] - x)) for x in data]
        order = sorted((round(d[i], 9), i) for i in range(90) if i != q and (limit is None or d[i] < limit))[:4]
        if order:
            want[q] = [(n + 1, i) for n, (_, i) in enumerate(order)]
    assert {k: sorted(v) for k, v in got.items()} == want


def test_pair_counts_of_runs(spark):
    from kinweave.operators import jobs
    rng = random.Random(2)
    a = {f"r{i}": f"a{rng.randrange(6)}" for i in range(40)}
    b = {f"r{i}": f"b{rng.randrange(6)}" for i in range(5, 45)}
    df = lambda d: spark.createDataFrame(list(d.items()), "raw_profile_id string, master_profile_id string")
    got = jobs.diff_resolutions(df(a), df(b)).first()
    pairs = lambda d: {(x, y) for x, y in combinations(sorted(d), 2) if d[x] == d[y]}
    assert (got.together_a, got.together_b, got.together_both) == (len(pairs(a)), len(pairs(b)), len(pairs(a) & pairs(b)))
    assert (got.only_a, got.only_b) == (5, 5)
