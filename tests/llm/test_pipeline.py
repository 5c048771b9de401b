"""The pipeline's stages against plain loops, each on its own input, and on odd and empty tables."""

import hashlib
from collections import Counter

import brute
import pytest
from conftest import SMALL

import corpus_pipeline
from kinweave.llm import mixing

STAGES = dict(corpus_pipeline.STAGES)


def save(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """The rows of every stage, each stage run on the one before."""
    root, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = save(stage(spark, docs, SMALL), root / name)
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_order_and_columns(results):
    assert list(STAGES) == ["language_id", "exact_dedup", "near_dedup", "mixing", "sentencepiece"]
    assert all(results[name].columns == results["documents"].columns for name in list(STAGES)[:-1])


def test_language_keeps_clean_documents(results):
    before, after = pairs(results["documents"]), set(pairs(results["language_id"]))
    assert after <= set(before)
    assert len(after) >= 0.97 * sum(any(c.isalpha() for c in t or "") for _, t in before)


def test_exact(results):
    want = brute.exact_groups(pairs(results["language_id"]))
    assert sorted(d for d, _ in pairs(results["exact_dedup"])) == sorted(d for d, w in want.items() if w[2])


def test_near(results):
    want = brute.near_components(pairs(results["exact_dedup"]), corpus_pipeline.NEAR_PERCENT)
    assert sorted(d for d, _ in pairs(results["near_dedup"])) == sorted(d for d, w in want.items() if w[2])


def test_mixing(results):
    taken = Counter(d for d, _ in pairs(results["mixing"]))
    want = {r.doc_id: r.copies for r in mixing.mix_sources(results["near_dedup"]).collect() if r.size and r.copies}
    assert taken == want


def test_pieces(results):
    want = sorted((d, hashlib.sha256((t or "").encode()).hexdigest()) for d, t in pairs(results["mixing"]))
    assert sorted((r.doc_id, r.decoded_sha256) for r in results["sentencepiece"].collect()) == want


def test_run_is_the_stages_in_order(spark, results):
    got = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, results["sentencepiece"].collect()))


@pytest.mark.parametrize("name", list(STAGES))
def test_odd_and_empty_tables(spark, odd, empty, name):
    got = STAGES[name](spark, odd, SMALL)
    nothing = STAGES[name](spark, empty, SMALL)
    assert nothing.count() == 0
    assert got.count() <= 3 * odd.count()
    if name != "sentencepiece":
        assert got.columns == nothing.columns == odd.columns
        # Columns with the names of the operators' own keep the input's values; stages only choose rows.
        assert set(map(str, got.collect())) <= set(map(str, odd.collect()))
