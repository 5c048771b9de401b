"""Plain loops that the operators are compared with. Rows are (doc_id, text) pairs or dictionaries of a small table."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction


def words(text):
    return (text or "").encode().split()


def repeats(rows, size=50):
    """{doc_id: (n_words, n_removed, sha256 of the kept words)}"""
    first, out = {}, {}
    split = sorted((d, words(t)) for d, t in rows)
    for d, w in split:
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i:i + size]), d)
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < d:
                gone[i:i + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_components(rows, percent=85):
    """{doc_id: (n_shingles, component_id, kept)}"""
    sets = {d: shingles(t) for d, t in rows}
    holders, common = defaultdict(list), Counter()
    for d, s in sets.items():
        for v in s:
            common.update((o, d) for o in holders[v])
            holders[v].append(d)
    up = {d: d for d in sets}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            lo, hi = sorted((top(a), top(b)))
            up[hi] = lo
    return {d: (len(s), top(d), top(d) == d) for d, s in sets.items()}


def exact_groups(rows):
    """{doc_id: (keep_id, group_size, kept, sha256)}"""
    groups = defaultdict(list)
    for d, t in rows:
        groups["".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")].append((-len(t or ""), d))
    return {d: (min(g)[1], len(g), d == min(g)[1], hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for _, d in g}


def edits(rows):
    """{doc_id: (n_chars, sha256 of the edited text)}"""
    line = sorted(((d, t or "") for d, t in rows), reverse=True)
    out = {}
    for k, (d, t) in enumerate(line):
        half = len(t) // 2
        after = line[(k + 1) % len(line)][1]
        out[d] = (len(t), hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest())
    return out


def fingerprint(text):
    """(hex digits, likeness lanes): sums over paragraphs modulo 2**32, the seeds of Spark's chained hash written out."""
    import xxhash

    def chain(*parts):
        seed = 42
        for p in parts:
            seed = xxhash.xxh64_intdigest(p, seed)
        return seed

    equal, lanes = [0] * 8, [0] * 64
    for p in text.split("\n"):
        for k in range(8):
            h = chain((k // 2).to_bytes(4, "little"), p.encode())
            equal[k] += h >> 32 if k % 2 else h & 0xFFFFFFFF
        w = [x.encode() for x in re.split("[\x20\x09-\x0d]+", p)]
        for run in [w[i:i + 3] for i in range(len(w) - 2)] or [[b" ".join(w)]]:
            h = chain(*run)
            # Lane k counts bit k, lane 32 + k the bit 32 above it.
            for k in range(32):
                lanes[k] += 1 if h >> k & 1 else -1
                lanes[32 + k] += 1 if h >> (k + 32) & 1 else -1
    return "".join(f"{v % 2**32:08X}" for v in equal + lanes), lanes


def likeness(a, b):
    if a == b:
        return 1.0
    lengths = sum(x * x for x in a) + sum(x * x for x in b)
    return min(1.0, max(0.0, 2 * sum(x * y for x, y in zip(a, b)) / lengths)) if lengths else 0.0


def targets(sizes, cap=3):
    """{source: target} from {source: size}, sharing the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        if not free:
            return fixed
        unit = (total - sum(fixed.values())) / sum(weight[s] for s in free)
        above = [s for s in free if unit * weight[s] > cap * sizes[s]]
        if not above:
            return fixed | {s: unit * weight[s] for s in free}
        fixed |= {s: float(cap * sizes[s]) for s in above}


def base_scores(rows):
    """{doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)}"""
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    tokens = {d: [*(t or "").encode().lower().split(), None] for d, t in rows}
    count = Counter(x for d, w in tokens.items() if not held[d] for x in w)
    n, v = sum(count.values()), len(count)
    return {d: (held[d], len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w))
            for d, w in tokens.items()}


def best_path(word, scores, longest, byte_ids, unknown):
    """Viterbi; ``scores``: {piece: (id, score)}."""
    best = [(0.0, [])]
    for stop in range(1, len(word) + 1):
        found = None
        for start in range(max(0, stop - longest), stop):
            piece = scores.get(word[start:stop])
            if piece is None and stop - start > 1:
                continue
            s = best[start][0] + (piece[1] if piece else unknown)
            if found is None or s > found[0]:
                found = (s, best[start][1] + ([piece[0]] if piece else [byte_ids[b] for b in word[start].encode()]))
        best.append(found)
    return best[-1][1]


def audit(rows, labels):
    """{(part, order, step): (kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)}; rows: (doc_id, text, part)."""
    first, marks = {}, defaultdict(lambda: (False, False))
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    for d, q, x in labels:
        if d is not None:
            marks[d] = (marks[d][0] or q == 1, marks[d][1] or x == 1)
    parts = defaultdict(list)
    for d, t, part in rows:
        t = t or ""
        w = [x for x in re.split("[\x20\x09-\x0d]+", t) if x]
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": d is not None and first[t] < d}
        parts[part or ""].append((fails, *marks[d]))
    out, total = {}, Counter()
    for part, docs in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = list(docs)
            for step, f in enumerate(order, 1):
                gone, left = [x for x in left if x[0][f]], [x for x in left if not x[0][f]]
                total[part, f] += len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(x[0][f] for x in docs) - len(gone),
                    sum(x[0][f] and sum(x[0].values()) == 1 for x in docs), sum(x[1] for x in gone), sum(x[2] for x in gone))
    return {(p, o, s): (*v, total[p, o[s - 1]]) for (p, o, s), v in out.items()}


def vector_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """[(vec_id, code, error, label_error, digest)] from (vec_id, vector, label) in plain integers."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts))
    whole = [[math.floor(Fraction(x) * scale) for x in v] + [0] * (width * parts - len(v)) for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(whole[k], p) for k in first] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        members = defaultdict(list)
        for v in whole:
            for p in range(parts):
                members[p, nearest(v, p)[1]].append(cut(v, p))
        for (p, e), m in members.items():
            books[p][e] = [sum(x) // len(m) for x in zip(*m)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    found = [[nearest(v, p) for p in range(parts)] for v in whole]
    errors, by_label, most = [sum(d for d, _ in f) for f in found], Counter(), (1 << 63) - 1
    for (_, _, label), e in zip(kept, errors):
        by_label[label] += min(e, most)
    return [(i, "".join(f"{e:02x}" for _, e in f), min(err, most), min(by_label[label], most), digest)
            for (i, _, label), f, err in zip(kept, found, errors)]


def byte_shards(rows, shards):
    """[(doc_id, size, crc, shard, slot)] from (doc_id, text): shards of the middle byte in id order."""
    line = sorted(((d is None, d or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for d, t in rows))
    total, before, slots, out = sum(x[3] for x in line), 0, Counter(), []
    for none, d, crc, size in line:
        shard = (2 * before + size) * shards // (2 * total)
        out.append((None if none else d, size, crc, shard, slots[shard]))
        slots[shard] += 1
        before += size
    return out
