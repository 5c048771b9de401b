"""Token ids of a corpus as compressed binary blocks in document order, and back.

Layout of an output folder: ``table`` holds (id, frequency), the one frequency table all blocks share; ``blocks`` holds one row
per block: its documents with their lengths, and the coded bytes of ``rans``. Parquet is only the container, so any store Spark
writes to can hold the files. Blocks know their place in the whole output and decode independently.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.blocks import slices
from kinweave.llm.rans import Coder, quantize
from kinweave.llm.vocabulary import encoder
from kinweave.plans.storage import working_dir

BLOCK_IDS = 1 << 20
TEXTS_AT_ONCE = 4_000_000


def encode_texts(docs: DataFrame, path: str, vocabulary: int, end_id: int | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, part, before, n_tokens, ids) in ascending doc_id order: partition by partition, NULL ids first.

    ``ids`` holds little-endian unsigned integers, 16 bits wide if the vocabulary allows; ``before`` counts the ids before a
    document in its partition. Rows of one doc_id are ordered by their text.
    """
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches):
        part, before, tool = TaskContext.get().partitionId(), 0, encoder(path, width)
        end = b"" if end_id is None else np.array([end_id], width).tobytes()
        for batch in batches:
            for piece in slices(batch, "text", TEXTS_AT_ONCE):
                ids = [found + end for found in tool.encode_each(piece.column("text").to_pylist())]
                own = np.array([len(i) for i in ids], np.int64) // np.dtype(width).itemsize
                sums = before + np.cumsum(own)
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), pa.array(np.full(len(own), part, np.int32)), pa.array(sums - own), pa.array(own), pa.array(ids, pa.binary()),
                ], names=["doc_id", "part", "before", "n_tokens", "ids"])
                before = int(sums[-1])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        run, "doc_id long, part int, before long, n_tokens long, ids binary")


def id_counts(tokens: DataFrame, vocabulary: int) -> DataFrame:
    """(id, n) over all documents, summed in every task first."""
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), width)
            total += np.bincount(ids, minlength=vocabulary)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int64)), pa.array(total[there])], names=["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, folder: str, path: str, vocabulary: int, end_id: int | None = None,
                      doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode all texts (NULL: empty) and write them below ``folder``. An empty table gives files without rows."""
    spark = docs.sparkSession
    encode_texts(docs, path, vocabulary, end_id, doc_id, text).write.parquet(f"{folder}/ids")
    tokens = spark.read.parquet(f"{folder}/ids")
    counts = id_counts(tokens, vocabulary).toPandas()  # at most one row per vocabulary entry
    all_counts = np.zeros(vocabulary, np.int64)
    all_counts[counts["id"].astype(int)] = counts["n"]
    freq = quantize(all_counts)
    known = np.flatnonzero(freq)
    spark.createDataFrame(pd.DataFrame({"id": known.astype("int64"), "frequency": freq[known].astype("int64")}),
                          "id long, frequency long").coalesce(1).write.parquet(f"{folder}/table")
    sizes = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).toPandas().sort_values("part")  # one row per partition
    offset = dict(zip(sizes["part"], np.cumsum(sizes["n"]) - sizes["n"])) if len(sizes) else {}
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def blocks(batches):
        coder, held, size = None, [], 0

        def close():
            part, before = held[0][1], held[0][2]
            coded = coder.encode(np.frombuffer(b"".join(h[4] for h in held), width), int(offset[part]) + before)
            return pa.RecordBatch.from_arrays([
                pa.array([int(offset[part]) + before]), pa.array([size]), pa.array([[h[0] for h in held]], pa.list_(pa.int64())),
                pa.array([[h[3] for h in held]], pa.list_(pa.int64())), pa.array([coded], pa.binary()),
            ], names=["first", "n", "doc_ids", "lengths", "coded"])

        for batch in batches:
            coder = coder or Coder(freq)
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and (row[1] != held[0][1] or row[2] != held[-1][2] + held[-1][3] or size + row[3] > BLOCK_IDS):
                    yield close()
                    held, size = [], 0
                held.append(row)
                size += row[3]
        if held:
            yield close()

    tokens.mapInArrow(blocks, "first long, n long, doc_ids array<long>, lengths array<long>, coded binary").write.parquet(f"{folder}/blocks")


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in a folder: ids decoded and checked block by block.

    ``start`` is the number of ids of all documents before; ``ids_crc32`` covers the ids as little-endian 32-bit integers.
    """
    shared = spark.read.parquet(f"{folder}/table").toPandas()  # bounded by the vocabulary
    freq = np.zeros(int(shared["id"].max()) + 1 if len(shared) else 1, np.uint64)
    freq[shared["id"].astype(int)] = shared["frequency"]

    def run(batches):
        coder = None
        for batch in batches:
            coder = coder or Coder(freq)
            for docs, lengths, coded in zip(*[batch.column(c) for c in ("doc_ids", "lengths", "coded")]):
                ids, first = coder.decode(coded.as_buffer())
                lengths = np.array(lengths.as_py(), np.int64)
                stops = np.cumsum(lengths)
                wide = ids.astype("<u4")
                crc = [zlib.crc32(wide[b - n:b]) for b, n in zip(stops, lengths)]
                columns = [docs.values, pa.array(first + stops - lengths), pa.array(lengths), pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]), pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = spark.read.parquet(f"{folder}/blocks").select("doc_ids", "lengths", "coded")
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def round_trip(docs: DataFrame, path: str, vocabulary: int, end_id: int | None, with_ids: bool = False) -> DataFrame:
    """Write the corpus to a new folder in the shared working directory and read it back."""
    folder = f"{working_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_token_files(docs, folder, path, vocabulary, end_id)
    return read_token_files(docs.sparkSession, folder, with_ids)
