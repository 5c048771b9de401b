"""The set-based rounds give exactly the result of the row-by-row process."""

import random

import pytest

from kinweave.operators.sequential import resolve_in_order


def one_by_one(rows):
    """rows: (seq, tenant, prior, a, b) in order -> {seq: master}."""
    masters, out = [], {}
    for seq, tenant, prior, a, b in rows:
        a, b = a or None, b or None
        hit = None
        if not prior:
            for slot, value in (("a", a), ("b", b)):
                if value is not None and hit is None:
                    hit = next((m for m in masters if m["t"] == tenant and m[slot] == value), None)
        if hit is None:
            hit = {"id": seq, "t": tenant, "a": a, "b": b}
            masters.append(hit)
        else:
            hit["a"] = hit["a"] if hit["a"] is not None else a
            hit["b"] = hit["b"] if hit["b"] is not None else b
        out[seq] = hit["id"]
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame([(s * 3 + 5, t, p, a, b) for s, t, p, a, b in rows],
                               "seq long, tenant_id string, is_prior boolean, email_key string, phone_key string")
    got = {r.seq: r.master for r in resolve_in_order(df, **options).collect()}
    return {(s - 5) // 3: (m - 5) // 3 for s, m in got.items()}


def random_rows(seed, n, keys_a, keys_b, hot=0.0, priors=0, tenants=1, blanks=0.3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = None if rng.random() < blanks else ("hot" if rng.random() < hot else f"e{rng.randrange(keys_a)}")
        b = None if rng.random() < blanks else ("hot" if rng.random() < hot else f"p{rng.randrange(keys_b)}")
        if rng.random() < 0.03:
            a = ""
        rows.append((i, f"t{rng.randrange(tenants)}", i < priors, a, b))
    return rows


CASES = {
    "sparse": dict(n=120, keys_a=60, keys_b=60),
    "dense": dict(n=150, keys_a=12, keys_b=12),
    "hot value": dict(n=200, keys_a=80, keys_b=80, hot=0.4),
    "prior masters": dict(n=150, keys_a=25, keys_b=25, priors=40),
    "tenants": dict(n=150, keys_a=15, keys_b=15, tenants=3),
    "few blanks": dict(n=150, keys_a=30, keys_b=10, blanks=0.05),
    "many blanks": dict(n=150, keys_a=8, keys_b=8, blanks=0.6),
}


def test_random_rows(spark):
    """Many random histories at once: tenants do not see each other."""
    parts = []
    for name, options in CASES.items():
        for seed in (1, 2, 3):
            parts.append([(t + f"-{name}-{seed}", p, a, b) for _, t, p, a, b in random_rows(seed, **options)])
    rng = random.Random(7)
    queue, mixed = [list(p) for p in parts], []
    while any(queue):
        q = rng.choice([q for q in queue if q])
        mixed.append(q.pop(0))
    mixed.sort(key=lambda r: not r[1])
    rows = [(i, *r) for i, r in enumerate(mixed)]
    assert run(spark, rows, block_bits=6, min_hot_rows=60) == one_by_one(rows)


@pytest.mark.parametrize("order", ["ABC", "CAB"])
def test_order_matters(spark, order):
    values = {"A": ("e1", None), "B": (None, "p1"), "C": ("e1", "p1")}
    rows = [(i, "t", False, *values[x]) for i, x in enumerate(order)]
    assert run(spark, rows) == one_by_one(rows)
    assert len(set(one_by_one(rows).values())) == (2 if order == "ABC" else 1)


def test_hot_value_needs_few_rounds(spark):
    """One phone on a third of all rows, each with its own mail, settles at once."""
    rows = [(i, "t", False, f"e{i % 700}", "hot" if i % 3 == 0 else f"p{i % 900}") for i in range(2000)]
    assert run(spark, rows, max_rounds=12, min_hot_rows=100) == one_by_one(rows)


def test_repeated_pair_needs_few_rounds(spark):
    """The same mail and phone on many rows, where the mail never gets an owner."""
    rows = [(0, "t", False, "e0", "hot")] + [(i, "t", False, f"e{1 + i % 2}", "hot") for i in range(1, 600)]
    assert run(spark, rows, max_rounds=6) == one_by_one(rows)
