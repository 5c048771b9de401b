"""Blocks of documents that ask shards of a distributed table and read the answers next to their texts.

Texts are packed into compressed blocks of a few megabytes and exchanged once by block; every later pass of the same plan
reuses that exchange. A pass sends one row per block and shard with what the block wants to know, already combined inside the
block; each shard sees all blocks' rows for its share of the keys and answers per block. Nothing is broadcast, a frequent
key costs one entry per block, and both block and shard have a bounded size whatever the corpus is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 6_000_000
BLOCK_DOCS = 20_000
SHARD_BYTES = 16_000_000
REQUEST = "shard int, block long, data binary"
REPLY = "block long, data binary"


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0


def shard_count(n_bytes: int) -> int:
    """Shards so that each serves about ``SHARD_BYTES`` of text."""
    return max(8, -(-n_bytes // SHARD_BYTES))


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each; a longer text is a part of its own."""
    start, held = 0, 0
    for k, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        if held and held + n > most:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def pack(docs: DataFrame, text: str = "text", exchange: bool = True) -> DataFrame:
    """(block, payload): all columns of ``docs`` in compressed Arrow streams, dealt by block if ``exchange``.

    Read ``docs`` from stored files, so that a lost task packs the same rows again.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        part, number, held, size, rows = TaskContext.get().partitionId(), 0, [], 0, 0

        def close():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(pa.Table.from_batches(held).combine_chunks())
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "payload"])

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
            start = 0
            for k, n in enumerate(sizes):
                if rows and (size + n > BLOCK_BYTES or rows >= BLOCK_DOCS):
                    if k > start:
                        held.append(batch.slice(start, k - start))
                    yield close()
                    number, held, size, rows, start = number + 1, [], 0, 0, k
                size, rows = size + int(n), rows + 1
            held.append(batch.slice(start))
        if rows:
            yield close()

    packed = docs.mapInArrow(run, "block long, payload binary")
    return packed.repartition("block") if exchange else packed


def unpack(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def ask(blocks: DataFrame, request: Callable[[int, pa.Table], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Rows (shard, block, data) that ``request(block, documents)`` yields for every block."""
    def run(batches):
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                yield _rows(block, request(block, unpack(payload.as_buffer())))

    return blocks.mapInArrow(run, REQUEST)


def _rows(block: int, found) -> pa.RecordBatch:
    shards, data = [], []
    for s, d in found:
        shards.append(s)
        data.append(d)
    return pa.RecordBatch.from_arrays([
        pa.array(shards, pa.int32()), pa.array([block] * len(shards), pa.int64()), pa.array(data, pa.binary())],
        names=["shard", "block", "data"])


def answer(requests: DataFrame, reply: Callable[[list[tuple[int, bytes]]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Rows (block, data) that ``reply([(block, data)])`` yields for every shard."""
    def run(table: pa.Table) -> pa.Table:
        out = list(reply(list(zip(table.column("block").to_pylist(), table.column("data").to_pylist()))))
        return pa.table({"block": pa.array([o[0] for o in out], pa.int64()), "data": pa.array([o[1] for o in out], pa.binary())})

    return requests.groupBy("shard").applyInArrow(run, REPLY)


def _joined(blocks: DataFrame, replies: DataFrame, run, schema) -> DataFrame:
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


def ask_again(blocks: DataFrame, replies: DataFrame, request: Callable[[int, pa.Table, list[bytes]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Like ``ask``, with the replies each block has got."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for block, payload in zip(left.column("block").to_pylist(), left.column("payload")):
            out.append(_rows(block, request(block, unpack(payload.as_buffer()), right.column("data").to_pylist())))
        return pa.Table.from_batches(out, schema=_rows(0, []).schema)

    return _joined(blocks, replies, run, REQUEST)


def finish(blocks: DataFrame, replies: DataFrame, last: Callable[[pa.Table, list[bytes]], pa.Table], schema: str) -> DataFrame:
    """The rows that ``last(documents, replies)`` makes of every block."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.concat_tables([last(unpack(p.as_buffer()), right.column("data").to_pylist()) for p in left.column("payload")])

    return _joined(blocks, replies, run, schema)


# -- words and their hashes ------------------------------------------------------------------------------------------------

def words_of(texts: list[str | None]) -> tuple[list[bytes], np.ndarray]:
    """(words ``[^\\x20\\x09-\\x0D]+`` of all texts as UTF-8, number of words of each text); NULL has none."""
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        if text:
            own = text.encode().split()
            counts[k] = len(own)
            words.extend(own)
    return words, counts


def word_hashes(words: list[bytes]) -> np.ndarray:
    """128-bit hashes as an array (n, 2) of unsigned longs."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two, order mattering; multiply and shift as in the murmur finaliser."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` consecutive rows, by doubling."""
    n = len(hashes) - length + 1
    if n <= 0:
        return hashes[:0]
    span, size, done, at = hashes, 1, None, 0
    while True:
        if length & size:
            piece = span[at:at + n]
            done, at = (piece if done is None else mix(done, piece)), at + size
        if size * 2 > length:
            return done
        span, size = mix(span[:len(span) - size], span[size:]), size * 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n, size = len(values) - width + 1, 1
    if n <= 0:
        return values[:0]
    while size * 2 <= width:
        values, size = np.minimum(values[:len(values) - size], values[size:]), size * 2
    return np.minimum(values[:n], values[width - size:width - size + n])


def split_by(shard: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(shard, the columns' entries of it), in the order they have."""
    order = np.argsort(shard, kind="stable")
    ordered = shard[order]
    cuts = np.flatnonzero(np.diff(ordered)) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        yield int(shard[rows[0]]), [c[rows] for c in columns]


def to_bytes(*arrays: np.ndarray) -> bytes:
    """Arrays of one length behind each other; ``from_bytes`` takes their types again."""
    return len(arrays[0]).to_bytes(8, "little") + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def from_bytes(data: bytes, *types: str) -> list[np.ndarray]:
    n, at, out = int.from_bytes(data[:8], "little"), 8, []
    for t in types:
        out.append(np.frombuffer(data, t, n, at))
        at += n * np.dtype(t).itemsize
    return out
