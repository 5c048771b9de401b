"""A training-data pipeline over ``documents``: each stage works on all rows that the one before kept.

Stages are written as Parquet in the shared working folder and read again, so that a lost executor never repeats earlier ones. All
but the last return the columns of ``documents``; the last returns what ``sentencepiece_lattice.round_trip`` does.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import language_id, minhash_dedup, mixing, sentencepiece_lattice
from kinweave.llm.exact_dedup import keep_first
from kinweave.llm.queries import PIECES, table
from kinweave.llm.text import crc_remainder
from kinweave.plans.storage import working_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; NULL and empty texts, texts without letters and doubtful ones go.

    The classifier learns from at most ``language_id.SAMPLE`` labelled rows; repeated rows are judged alike, very long texts as a whole. Without any
    label nothing is recognised and nothing stays; an empty table stays empty. Columns keep their values whatever their names.
    """
    model = language_id.fit(docs, crc_remainder(F.col("doc_id"), 5) != 0)
    return language_id.keep_identified(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts equal without blanks: the longest original, then the smallest id, NULL ids last.

    NULL counts as empty, so one row without text stays; of rows equal in id and text one stays. Whole texts of any length are compared.
    """
    return keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the smallest id: five-word shingles of whole texts, Jaccard 0.8 or more.

    Rows without words or without an id are no duplicates and stay, rows equal in id and text stay once.
    """
    return minhash_dedup.keep_representatives(docs, percent=NEAR_PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, up to three times; documents without words are left out.

    NULL is a source of its own. Of equal rows any may be the ones taken; a document larger than its source's whole target may be left out.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): piece ids of every row and the digest of the text they decode to.

    NULL and empty texts have no ids; repeated rows are encoded one by one; very long texts and words as a whole.
    """
    import public_tokenizers

    return sentencepiece_lattice.round_trip(docs, sentencepiece_lattice.load_pieces(public_tokenizers.path(PIECES)))


#: Near duplicates of the pipeline have a shingle Jaccard of at least this; op3's own contract is 85.
NEAR_PERCENT = 80

STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: The classifier and the hash choices cannot be written in SQL; ``tests/llm/test_pipeline.py`` checks the rows by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{working_dir(spark)}/pipeline-{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
