"""Operators against plain loops on the smallest table, and their defined results on odd and empty tables."""

import hashlib
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from conftest import SMALL

from kinweave.llm import exact_dedup, fingerprints, language_id, lm_scoring, minhash_dedup, mixing, queries, rans, substring_dedup, token_output
from kinweave.llm import sentencepiece_lattice as lattice
from kinweave.llm import url_filter
from kinweave.llm.text import crc_remainder
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("public_tokenizers")


def rows(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def test_substring_small(spark, small):
    got = queries.op1_substring_dedup(spark, SMALL)
    assert rows(got, "n_words", "n_removed", "kept_sha256") == brute.repeats(small)


def test_substring_odd(odd, empty):
    got = defaultdict(list)
    for r in substring_dedup.find_repeats(odd).collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == odd.count()
    assert got[1][0].n_words == got[2][0].n_words == got[3][0].n_words == 0
    assert got[4][0].n_removed == 0 and got[5][0].n_removed == 60 and got[5][0].kept_text == "tail"
    assert [r.n_removed for r in got[6]] == [60, 60] and got[6][0].spans[0].asDict() == {"start": 0, "stop": 60}
    assert {r.n_removed for r in got[None]} == {0}
    assert got[8][0].n_removed == 40_000 and got[8][0].kept_text == "end"
    assert substring_dedup.find_repeats(empty).count() == 0


def test_language_small(spark, small):
    got = queries.op2_language_id(spark, SMALL).collect()
    known = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    held = [r for r in got if r.held_out and known[r.doc_id]]
    assert len(got) == len(small) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.lang_pred == known[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd(odd, empty):
    model = language_id.fit(odd, crc_remainder(F.col("doc_id"), 5) != 0)
    assert set(model.labels) == {"de", "en", "fr"} or set(model.labels) < {"de", "en", "fr"}
    got = language_id.identify(odd.select("doc_id", "text", "score"), model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score"] and got.count() == odd.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in got.where("doc_id in (1, 2, 3, 12)").collect())
    nothing = language_id.fit(empty, F.lit(True))
    assert {r.lang_pred for r in language_id.identify(odd.select("text"), nothing).collect()} == {"und"}
    assert language_id.identify(empty, nothing).count() == 0 and language_id.keep_identified(odd, model).columns == odd.columns


def test_temperature_of_a_faultless_sample_is_not_certain():
    logits = np.array([[9.0, 0.0], [0.0, 9.0]] * 20)
    t = language_id.temperature(logits, np.array([0, 1] * 20))
    assert 0.9 < 1 / (1 + np.exp(-9 / t)) < 0.99


def test_long_text_in_parts_counts_every_gram(monkeypatch):
    text = "Ärger mit langen Texten, 12 mal. " * 50
    whole = language_id.term_counts(text)
    monkeypatch.setattr(language_id, "CHARS_AT_ONCE", 37)
    assert (language_id.term_counts(text) == whole).all()


def test_near_small(spark, small):
    assert rows(queries.op3_minhash_dedup(spark, SMALL), "n_shingles", "component_id", "kept") == brute.near_components(small)


def test_near_groups(save):
    """A large group of edited copies, a passage that all share, short texts at the threshold."""
    rng = np.random.default_rng(1)
    base = [f"b{i}" for i in range(300)]
    docs = []
    for k in range(150):
        own = list(base)
        for i in rng.integers(0, 300, 3):
            own[i] = f"edit{rng.integers(1000)}"
        docs.append((k, " ".join(own)))
    passage = " ".join(f"p{i}" for i in range(60))
    docs += [(1000 + k, passage + " " + " ".join(f"u{k}_{i}" for i in range(k % 40))) for k in range(120)]
    docs += [(2000 + k, " ".join(f"s{i}" for i in range(8 + k % 5))) for k in range(20)]
    got = rows(minhash_dedup.near_duplicates(save([(d, t, None, None) for d, t in docs])), "n_shingles", "component_id", "kept")
    assert got == brute.near_components(docs)


def test_near_odd(odd, empty):
    got = defaultdict(list)
    for r in minhash_dedup.near_duplicates(odd).collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == odd.count()
    assert got[1][0].n_shingles == got[3][0].n_shingles == 0 and got[1][0].component_id == 1
    assert got[5][0].component_id == 4 and {r.component_id for r in got[6]} == {4} and got[8][0].component_id == 7
    assert all(r.component_id is None and r.kept for r in got[None])
    assert sorted(r.n_shingles for r in got[9]) == [1, 1, 1]
    kept = minhash_dedup.keep_representatives(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} >= {1, 2, 3, 4, 7, 9, 10, 11, 12, None} and kept.where("doc_id in (5, 6, 8)").count() == 0
    assert minhash_dedup.near_duplicates(empty).count() == 0 and minhash_dedup.keep_representatives(empty).count() == 0


def test_overlap_bound():
    """The retained values that a linked pair of sizes n <= m certainly shares, where that is more than SURE."""
    k = minhash_dedup.K
    for n in range(1, 400):
        for m in range(n, n * 100 // 85 + 1):
            inside = -(-85 * (n + m) // 185)
            if inside > n:
                continue
            outside = n + m - 2 * inside
            sure = inside if m <= k else inside - (m - k) if n <= k else k - outside
            for size in (n, m):
                assert minhash_dedup.least_overlap(size) <= max(sure, minhash_dedup.SURE)


def links_at(docs, percent):
    """{doc_id: smallest reachable id} by plain loops over all pairs."""
    sets, up = {d: brute.shingles(t) for d, t in docs}, {d: d for d, _ in docs}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(sets)
    for k, b in enumerate(ids):
        for a in ids[:k]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                lo, hi = sorted((top(a), top(b)))
                up[hi] = lo
    return {d: top(d) for d in ids}


def test_near_at_80_percent(spark, save):
    """Pairs from 0.76 to 0.88, of short and of long texts: the stage's 80 % links more than op3's 85 %."""
    import corpus_pipeline

    docs, bands = [], set()
    for size in (12, 40, 70, 150, 400, 1500):
        for k, share in enumerate((0.76, 0.79, 0.80, 0.81, 0.83, 0.845, 0.85, 0.88)):
            n = size + 4
            words, base = [f"s{size}k{k}w{i}" for i in range(n)], 100 * size + 2 * k
            changed = round(size * (1 - share))  # shingles the second text loses at its end and the first never had
            docs += [(base, " ".join(words)), (base + 1, " ".join(words[:n - changed]))]
            j = len(brute.shingles(docs[-1][1])) / len(brute.shingles(docs[-2][1]))
            bands.add("mid" if 0.8 <= j < 0.85 else "other")
    docs += [(900_000 + k, " ".join([*(f"h{i}" for i in range(60)), *(f"h{k}x{i}" for i in range(7 + k % 3))])) for k in range(40)]
    assert bands == {"mid", "other"}
    saved = save([(d, t, None, None) for d, t in docs])
    for percent in (80, 85):
        got = rows(minhash_dedup.near_duplicates(saved, percent=percent), "component_id")
        assert {d: c for d, (c,) in got.items()} == links_at(docs, percent)
    want = links_at(docs, 80)
    assert want != links_at(docs, 85)
    stage = dict(corpus_pipeline.STAGES)["near_dedup"](spark, saved, SMALL)
    assert sorted(r.doc_id for r in stage.collect()) == sorted(d for d, c in want.items() if d == c)


def test_overlap_bound_at_80_percent():
    k = minhash_dedup.K
    assert minhash_dedup.SURE == 33 and minhash_dedup.sure_overlap(80) == 28
    for n in range(1, 400):
        for m in range(n, n * 100 // 80 + 1):
            inside = -(-80 * (n + m) // 180)
            if inside > n:
                continue
            outside = n + m - 2 * inside
            sure = inside if m <= k else inside - (m - k) if n <= k else k - outside
            for size in (n, m):
                assert minhash_dedup.least_overlap(size, 80) <= max(sure, minhash_dedup.sure_overlap(80))


@pytest.fixture(scope="module")
def pieces():
    return lattice.load_pieces(tokenizers.path(queries.PIECES))


def test_pieces_small(spark, small, pieces):
    table, got = {t: (i, s) for t, i, s in zip(pieces.texts, pieces.ids, pieces.scores)}, {}
    for r in queries.op4_sentencepiece(spark, SMALL).collect():
        got[r.doc_id] = r
    memory = {}
    for d, t in small:
        ids = []
        for w in lattice.words_of(t):
            if w == lattice.LITERAL:
                ids += [pieces.bytes[b] for b in "▁".encode()]
                continue
            if w not in memory:
                memory[w] = brute.best_path(w, table, pieces.longest, pieces.bytes, lattice.UNKNOWN_SCORE)
            ids += memory[w]
        assert got[d].ids == ids and got[d].n_tokens == len(ids)
        assert got[d].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_pieces_odd(odd, empty, pieces):
    want = sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in odd.collect())
    got = lattice.round_trip(odd, pieces).collect()
    assert sorted(r.decoded_sha256 for r in got) == want
    assert all(r.ids == [] and r.n_tokens == 0 for r in got if r.doc_id in (1, 2))
    assert lattice.round_trip(empty, pieces).count() == 0


def test_pieces_are_the_best_path_over_the_whole_text(save, pieces):
    """Runs of blanks, indented code, words of more than MAX_WORD characters with and without places to cut."""
    rng = np.random.default_rng(5)
    letters = "abcdefghijklmnopqrstuvwxyz/.-=_0123456789"
    texts = [
        "a  b", "  two before", "end  ", " ", "def f(x):\n    if x:\n        return  x\n\n\tdone", " " * 200 + "far", "漢字仮名交じり文" * 20,
        "การทดสอบข้อความยาว" * 12, "https://example.org/" + "".join(letters[i] for i in rng.integers(0, len(letters), 300)), "A" * 500, "=" * 130 + "  " + "internationalization" * 9,
        "| a   | bb  |\n|" + "-" * 90 + "|", "x" * 63 + "internationalization",
    ]
    table = {t: (i, s) for t, i, s in zip(pieces.texts, pieces.ids, pieces.scores)}
    got = {r.doc_id: r for r in lattice.round_trip(save([(k, t, None, None) for k, t in enumerate(texts)]), pieces).collect()}
    for k, t in enumerate(texts):
        want = brute.best_path("▁" + t.replace(" ", "▁"), table, pieces.longest, pieces.bytes, lattice.UNKNOWN_SCORE)
        score = {i: s for i, s in table.values()}
        assert got[k].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() and got[k].n_tokens == len(got[k].ids)
        total = [sum(score.get(i, lattice.UNKNOWN_SCORE / 3) for i in ids) for ids in (got[k].ids, want)]
        assert got[k].ids == want or (len(got[k].ids) == len(want) and abs(total[0] - total[1]) < 1e-6), t
    assert got[0].n_tokens < 5


def test_pieces_over_the_end_of_a_word():
    """A table whose pieces reach over blanks and line feeds is followed too."""
    odd = lattice.Pieces(["▁", "a", "b", "a▁b", "\n", "b\n"], list(range(6)), [-2.0, -3.0, -3.0, -1.0, -2.0, -1.0], list(range(6, 262)), 262)
    cut = lattice.Cutter(odd)
    assert cut.over and "".join(lattice.words_of("a b\na b", cut)) == "▁a▁b\na▁b"
    assert lattice.words_of("a b", cut) == ["▁", "a▁b"]


def reference_tokens(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizers.path(queries.TOKENIZER))
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def test_tokens_small(spark, small):
    line, start, want = sorted(small), 0, {}
    for (d, _), ids in zip(line, reference_tokens([t for _, t in line])):
        want[d] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert rows(queries.op5_token_output(spark, SMALL), "start", "n_tokens", "ids_crc32") == want


def test_tokens_odd(odd, empty):
    path = tokenizers.path(queries.TOKENIZER)
    got = sorted(token_output.round_trip(odd, path, queries.VOCABULARY, 2, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([r.doc_id for r in odd.collect()], key=lambda d: (d is not None, d or 0))
    assert sorted(r.ids for r in got) == sorted(reference_tokens([r.text for r in odd.collect()]))
    assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:]))
    assert token_output.round_trip(empty, path, queries.VOCABULARY, 2).count() == 0


def test_rans_blocks():
    rng = np.random.default_rng(3)
    for n in (1, 2, 63, 64, 5000, 400_000):
        ids = np.minimum(rng.zipf(1.3, n) - 1, 49_000)
        coder = rans.Coder(rans.quantize(np.bincount(ids, minlength=49_408)))
        block = coder.encode(ids, 17)
        got, first = coder.decode(block)
        assert (got == ids).all() and first == 17
    part, _ = coder.decode(block, range(1, 2))
    at = rans.SEGMENT * rans.LANES
    assert (part == ids[at:at + len(part)]).all() and len(part)
    with pytest.raises(ValueError):
        coder.decode(block[:-1] + bytes([block[-1] ^ 1]))


def test_fingerprints_small(spark, small):
    got = queries.op6_fingerprints(spark, SMALL).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == brute.edits(small)
    text = {d: t or "" for d, t in small}
    assert len({r.fingerprint for r in got}) == len({text[r.doc_id] for r in got})
    assert all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in got)
    assert np.mean([r.near_edited > r.near_next for r in got]) > 0.9
    line = sorted(text.items(), reverse=True)
    own = {d: brute.fingerprint(t) for d, t in line}
    for k, (d, t) in enumerate(line):
        after, half = line[(k + 1) % len(line)], len(t) // 2
        edited = brute.fingerprint(t[:len(t) - half] + after[1][:half])
        r = next(r for r in got if r.doc_id == d)
        assert (r.fingerprint, r.edited_fingerprint) == (own[d][0], edited[0])
        assert r.near_edited == pytest.approx(brute.likeness(own[d][1], edited[1]))
        assert r.near_next == pytest.approx(brute.likeness(own[d][1], own[after[0]][1]))


def test_fingerprints_are_sums_over_paragraphs(spark, save):
    docs = save([(1, "a b c d\ne f g", None, None), (2, "e f g\na b c d", None, None), (3, "a b c d", None, None), (4, "e f g", None, None)])
    got = {r.doc_id: r for r in fingerprints.fingerprint_rows(docs.select("doc_id", "text"), ["doc_id"], "text").collect()}
    assert got[1].equal == got[2].equal and got[1].packed == got[2].packed
    assert [(a + b) % fingerprints.MODULUS for a, b in zip(got[3].equal, got[4].equal)] == got[1].equal
    assert [a + b for a, b in zip(got[3].packed, got[4].packed)] == got[1].packed


def test_fingerprints_odd(odd, empty):
    got = fingerprints.fingerprint_edits(odd).collect()
    assert len(got) == odd.count()
    assert {r.n_chars for r in got if r.doc_id in (1, 2)} == {0} and len({r.fingerprint for r in got if r.doc_id in (4, 6)}) == 1
    assert fingerprints.fingerprint_edits(empty).count() == 0
    alone = fingerprints.fingerprint_edits(odd.where("doc_id = 7")).first()
    assert alone.near_next == 1.0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://NET/", "http://a.Net", "http://a.net/x", "https://example.net/en/1?q#f", "x://en.example.net/en/",
            "http://example.net/en", "http://bexample.net/en/1", "http://example.com/de/", "http://a.b.example.com/de/x", "http://example.com/fr/",
            "http://w.org/fr/", "http://org/fr/", "http://org.com/fr/", "http://net./a", "http://a?b://net/", "http://x.net?/en/", "http://a\x01.net/"]
    pages = spark.createDataFrame([(k, u, 3) for k, u in enumerate(urls + urls)], "page_id long, url string, host long")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(pages, queries.URL_RULES).collect()}

    def judge(url):
        if url is None or "://" not in url:
            host = path = ""
        else:
            rest = url.split("://", 1)[1]
            cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
            host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fit = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fit)[1:] if fit else (None, "allow")

    assert got == {k: judge(u) for k, u in enumerate(urls + urls)}
    assert {r.verdict for r in url_filter.filter_urls(pages, [], default="block").collect()} == {"block"}
    assert url_filter.filter_urls(pages.where("false"), queries.URL_RULES).count() == 0
    nested = [("block", "com", ""), ("allow", "a.com", ""), ("block", "b.a.com", ""), ("allow", "c.com", "/x"), ("block", "c.com", "/x/y")]
    hosts = ["com", "a.com", "z.a.com", "b.a.com", "q.b.a.com", "c.com/x/yz", "c.com/xz", "ab.com", "net"]
    named = spark.createDataFrame([(k, f"http://{h}") for k, h in enumerate(hosts)], "page_id long, url string")
    found = {hosts[r.page_id]: r.rule for r in url_filter.filter_urls(named, nested).collect()}
    assert found == {"com": "com", "a.com": "a.com", "z.a.com": "a.com", "b.a.com": "b.a.com", "q.b.a.com": "b.a.com", "c.com/x/yz": "c.com/x/y",
                     "c.com/xz": "c.com/x", "ab.com": "com", "net": None}


def test_exact_small(spark, small):
    assert rows(queries.op8_exact_dedup(spark, SMALL), "keep_id", "group_size", "kept", "text_sha256") == brute.exact_groups(small)


def test_exact_hot_and_rare(save):
    docs = [(k, ["hot text", "hot\ttext ", "warm"][k % 3] if k < 900 else f"rare {k % 1300}", None, None) for k in range(3000)]
    assert rows(exact_dedup.exact_dedup(save(docs)), "keep_id", "group_size", "kept", "text_sha256") == brute.exact_groups([d[:2] for d in docs])


def test_exact_odd(odd, empty):
    got = exact_dedup.exact_dedup(odd).collect()
    assert len(got) == odd.count()
    groups = defaultdict(list)
    for r in got:
        groups[r.text_sha256].append(r)
    assert all(sum(r.kept for r in g) == 1 and {r.group_size for r in g} == {len(g)} for g in groups.values())
    kept = exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns and kept.count() == len(groups)
    assert {r.text for r in kept.where("doc_id = 9").collect()} == {"one  two", "other text of the id"}
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.keep_first(empty).count() == 0


def test_mixing_small(spark, small):
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    sizes, per = {d: len(brute.words(t)) for d, t in small}, defaultdict(int)
    for d, n in sizes.items():
        per[source[d]] += n
    want, taken = brute.targets(per), defaultdict(int)
    got = queries.op9_mixing(spark, SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, queries.op9_mixing(spark, SMALL).collect()))
    for r in got:
        s = source[r.doc_id]
        taken[s] += r.taken
        assert r.size == sizes[r.doc_id] and r.source_size == per[s] and r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
        assert abs(r.target - want[s]) <= 1e-9 * want[s]
    for s, n in taken.items():
        # No document that is not taken once more would bring the source nearer.
        whole = int(want[s] // per[s]) if per[s] else 0
        rest = [r.size for r in got if source[r.doc_id] == s and r.size and r.taken == whole * r.size]
        assert all(abs(n + size - want[s]) >= abs(n - want[s]) - 1e-6 for size in rest)
        assert abs(n - want[s]) <= max([r.size for r in got if source[r.doc_id] == s], default=0) / 2 + 1e-6


def test_mixing_odd(odd, empty):
    got = mixing.mix_sources(odd).collect()
    assert len(got) == odd.count() and all(r.taken <= 3 * r.size for r in got)
    assert {r.target for r in got if r.doc_id == 4} == {3.0 * 180}
    again = mixing.mixed(odd)
    assert again.columns == odd.columns and again.where("trim(text) = '' or text is null").count() == 0
    assert again.count() == sum(r.copies for r in got if r.size)
    assert mixing.mix_sources(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_scores_small(spark, small):
    want = brute.base_scores(small)
    got = queries.op10_lm_scoring(spark, SMALL).collect()
    assert len(got) == len(small)
    for r in got:
        assert tuple(r[c] for c in ("held_out", "n_tokens", "n_known", "train_tokens")) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4]) and r.score < 0
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_are_normalised():
    unigram = np.full(lm_scoring.CLASSES, 1 / lm_scoring.CLASSES)
    model = lm_scoring.LogBilinear(unigram)
    rng = np.random.default_rng(5)
    target = rng.integers(0, 7, 20_000)
    context = (np.append(0, target[:-1])) * lm_scoring.CLASSES
    model.train((context // lm_scoring.CLASSES + 1) % 7, context, rng)
    every = np.arange(lm_scoring.CLASSES)
    total = (10 ** model.log10(every, np.full(lm_scoring.CLASSES, 3 * lm_scoring.CLASSES))).sum()
    assert total == pytest.approx(1, abs=1e-4)
    assert model.log10(np.array([4]), np.array([3 * lm_scoring.CLASSES]))[0] > np.log10(2 / lm_scoring.CLASSES)


def test_scores_odd(odd, empty):
    got = lm_scoring.score_documents(odd, crc_remainder(F.col("doc_id"), 7) != 2).collect()
    assert len(got) == odd.count() and {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    none = lm_scoring.score_documents(odd, F.lit(False)).collect()
    assert {r.train_tokens for r in none} == {0} and {r.base_score for r in none} == {0.0}
    assert lm_scoring.score_documents(empty, F.lit(True)).count() == 0


def test_sql(spark):
    import duckdb
    from check import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        df = queries.QUERIES[name](spark, SMALL)
        rel = con.execute(sql)
        assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in rel.description], rel.fetchall()), name


def test_special_strings_in_other_cases():
    """Only the exact special string is one id; what lower-casing would turn into one is ordinary text."""
    path = tokenizers.path(queries.TOKENIZER)
    from kinweave.llm.vocabulary import WordEncoder
    tool = WordEncoder(path)
    special = [t.decode() for t in tool.special]
    texts = [f"{a}{s}{b}" for s in special for v in (s, s.upper(), s.title()) for a, b in (("", ""), ("A ", " b."), ("x", "Y"), ("One, ", "!"))
             for s in (v,)]
    ids, counts = tool.encode(texts)
    stops = np.cumsum(counts)
    for text, stop, n in zip(texts, stops, counts):
        assert list(ids[stop - n:stop]) == tool.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_mixing_splits_rows_that_share_an_id(save):
    """Rows without an id, and rows equal in everything, are taken one by one."""
    rows = [(None, " ".join(f"w{k}" for _ in range(10)), "en", "a") for k in range(20)]
    rows += [(5, "same " * 10, "en", "b")] * 30 + [(k, "own " * 7, "en", "c") for k in range(100, 150)]
    docs = save(rows)
    got, taken, target = mixing.mix_sources(docs.repartition(5)).collect(), defaultdict(int), {}
    assert len(got) == 100
    for r in got:
        taken[r.target] += r.taken
        target[r.target] = r.size
    assert all(abs(t - n) <= size / 2 + 1e-6 for (t, n), size in zip(taken.items(), target.values()))
    mixed = mixing.mixed(docs.repartition(3))
    assert mixed.count() == sum(r.copies for r in got)
    assert sorted(map(tuple, mixing.mix_sources(docs).collect()), key=repr) == sorted(map(tuple, got), key=repr)


def test_near_of_many_equal_rows(save):
    """Two near texts, each in hundreds of equal rows, are one pair of texts."""
    base = [f"b{i}" for i in range(80)]
    other = [*base[:79], "end"]
    docs = save([(k % 2, " ".join(base if k % 2 else other), "en", "a") for k in range(600)])
    nodes = minhash_dedup.near_duplicates(docs).collect()
    assert len(nodes) == 600 and {r.component_id for r in nodes} == {0}
    rows_ = docs.select("doc_id", "text")
    sets = minhash_dedup.sketches(rows_)
    keys = sets.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("text_key").alias("text_key"))
    assert minhash_dedup._packed_texts(rows_, keys).count() == 2


def test_latin_text_is_cut_into_the_tokenizers_own_runs():
    """Each run is encoded once whatever stands beside it, and the ids are the tokenizer's; other texts are cut into words."""
    from kinweave.llm.vocabulary import WordEncoder
    tool = WordEncoder(tokenizers.path(queries.TOKENIZER), "<u2")
    want = lambda text: tool.tokenizer.encode(text, add_special_tokens=False).ids
    tool.encode_each(["Wort,wort;WORT 3wort", "(wort) wort!"])
    assert set(tool.runs) == {b"wort", b",", b";", b"3", b"(", b")", b"!"} and not tool.words
    latin, rng = [chr(c) for c in range(256)], np.random.default_rng(3)
    texts = ["".join(rng.choice(latin + [*"''stdm ,."] * 9, 12)) for _ in range(500)] + [
        "".join(rng.choice([*latin, "\u0301", "\u212a", "\u0130", "\u2019", "\u1e9e"], 6)) for _ in range(500)]
    texts += ["don't 'Sa I'LL", "\u00c4rger e\u0301t\u00e9", "a" * 200, "\u00bd1\u00b2", "", None]
    for text, ids in zip(texts, tool.encode_each(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == (want(text) if text else []), text
    wide, counts = WordEncoder(tokenizers.path(queries.TOKENIZER)).encode(texts)
    assert wide.tolist() == [i for t in texts if t for i in want(t)] and counts.sum() == len(wide) and wide.dtype == np.uint32


def test_near_duplicates_take_texts_in_small_batches(save, monkeypatch):
    """What a task holds does not depend on how many rows Spark would hand over at once."""
    from kinweave.plans import storage
    seen, own, docs = [], minhash_dedup.materialize, save([(k, f"some words of text {k % 7} and more", "en", "a") for k in range(50)])
    conf = docs.sparkSession.conf
    monkeypatch.setattr(minhash_dedup, "materialize", lambda df: seen.append(int(conf.get(storage.BATCH_ROWS))) or own(df))
    before = conf.get(storage.BATCH_ROWS)
    assert sorted(r.kept for r in minhash_dedup.near_duplicates(docs).collect()) == [False] * 43 + [True] * 7
    assert seen and max(seen) <= storage.TEXT_ROWS and conf.get(storage.BATCH_ROWS) == before
    conf.set(storage.BATCH_ROWS, "3")
    try:
        minhash_dedup.components(docs)
        assert seen[-1] == 3 and conf.get(storage.BATCH_ROWS) == "3"
    finally:
        conf.set(storage.BATCH_ROWS, before)


def test_pieces_blocks_hold_no_words(pieces):
    """A block's distinct words are written once, for their shards; the block keeps their places only."""
    import pyarrow as pa
    texts = [" ".join(f"w{k * 7919 % 10007}x" for k in range(j, j + 400)) for j in range(0, 4000, 400)] + [None, "", "a\u2581b\n c"]
    cut = lattice.Cutter(pieces)
    own, asked = lattice._cut_block(pa.table({"doc_id": list(range(len(texts))), "text": texts}), cut, 16)
    docs, shard, at = lattice._open_block(own)
    names = [w for _, data in asked for w in lattice._read_words(data)]
    assert [s for s, data in asked for _ in lattice._read_words(data)] == shard.tolist() and len(names) == len(set(names))
    want = [lattice.words_of(t, cut) for t in texts]
    assert docs.column("n").to_pylist() == list(map(len, want))
    assert [(names + [lattice.LITERAL])[k] for k in at] == [w for ws in want for w in ws]
