import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

SMALL = "/root/testdata/sf0.001"
COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, node long, block long, payload string, label string, "
           "lang_pred string, score double, size long, h long, s string, root long, row long, text_key long, _id long, key string, "
           "_key string, _n long, _place long, _size long, _copies long, _copy long, own string, best long, stay long, mix string")


@pytest.fixture(scope="session")
def small(spark):
    """(doc_id, text) of the smallest documents table."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def save(spark, tmp_path_factory):
    """Store rows (doc_id, text, lang, source) with many more columns whose names the operators use themselves."""
    def run(rows):
        path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
        full = [(d, t, lang, source, None if t is None else len(t), *[None] * 5, 0.5, 7, 7, "x", 7, 7, 7, 7, "k",
                 "user", 9, 9, 9, 9, 9, f"own {k}", k, k, "m") for k, (d, t, lang, source) in enumerate(rows)]
        spark.createDataFrame(full, COLUMNS).write.parquet(path)
        return spark.read.parquet(path)
    return run


@pytest.fixture(scope="session")
def odd(save):
    """NULLs, blanks, a very long text, ties, repeated rows, odd characters."""
    passage = " ".join(f"w{i}" for i in range(60))
    long = " ".join(f"x{i % 977}y{i % 13}" for i in range(40_000))
    return save([
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, "a"), (4, passage, "en", None), (5, passage + " tail", "fr", "b"),
        (6, passage, "en", None), (6, passage, "en", None), (7, long, "en", "b"), (8, long + " end", "fr", "b"), (9, "one two", None, "c"),
        (9, "one  two", "de", "c"), (9, "other text of the id", "de", "c"), (None, passage, "en", "a"), (None, None, None, None),
        (10, "Ünï ▁ cödé \x00 \ufffe 漢字 'S  ▁▁\r\n<|endoftext|> !!..", "fr", "d"), (11, "A" * 300, "en", "d"), (12, "12 34 !!", "en", "d"),
    ])


@pytest.fixture(scope="session")
def empty(save):
    return save([])
