"""Repeated passages: windows of consecutive words that an earlier document also has.

Count-min prefilter. A window enters the sketch through its representative, the least hash among the runs of ``RUN`` words in
it: equal windows have equal representatives, so a representative's number of documents is never below its windows'. Every block
of documents makes a sparse count-min sketch of its representatives, shards merge the sketches of all blocks, and a cell
that reached two marks its representatives as repeated. Too high estimates are possible, too low ones are not. Only the windows estimated
repeated are grouped exactly, by 128-bit hashes of their word sequences, to find the smallest document of each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm import blocks as B

WINDOW = 50
RUN = 25
DEPTH, WIDTH = 2, 1 << 22
TWICE = np.uint32(1 << 31)
#: Rows without an id: never a source of removals and never shortened.
NO_ID = np.iinfo(np.int64).max


class Windows:
    """All windows of a block's documents."""

    def __init__(self, docs: pa.Table, size: int):
        self.size = size
        self.words, self.counts = B.words_of(docs.column("text").to_pylist())
        self.ids = docs.column("doc_id").to_numpy() if docs.column("doc_id").null_count == 0 else np.array(
            [NO_ID if d is None else d for d in docs.column("doc_id").to_pylist()], np.int64)
        self.ends = np.cumsum(self.counts)
        self.hashes = B.word_hashes(self.words)
        n = max(0, len(self.words) - size + 1)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)[:n]
        self.starts = np.flatnonzero(np.arange(n) + size <= self.ends[self.doc]) if n else np.zeros(0, np.int64)
        self.of = self.doc[self.starts]

    def representatives(self) -> np.ndarray:
        run = min(RUN, self.size)
        return B.sliding_min(B.run_hashes(self.hashes[:, 0], run), self.size - run + 1)[self.starts]

    def sequences(self, keep: np.ndarray | None = None) -> np.ndarray:
        return B.run_hashes(self.hashes, self.size)[self.starts if keep is None else self.starts[keep]]


def _cells(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard of each key, its ``DEPTH`` cells there)."""
    cells = np.stack([(B.mix(keys, np.full(1, r + 1, np.uint64)) % np.uint64(WIDTH)).astype(np.uint32) + np.uint32(r * WIDTH)
                      for r in range(DEPTH)])
    return (B.mix(keys, np.zeros(1, np.uint64)) % np.uint64(shards)).astype(np.int64), cells


def find_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, spans), one row per input row.

    A word goes when it is covered by a window of ``window`` words whose sequence also starts in a document with a smaller
    doc_id, judged on the input. Ids are integers; rows that repeat an id do not remove each other's words; rows without
    an id stay whole and remove nothing. NULL and empty texts have no words. ``spans`` are the removed word ranges
    [start, stop); ``kept_text`` joins the kept words by one space. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    shards = B.shard_count(B.text_bytes(rows))
    packed = B.pack(rows)

    def sketch(_, table):
        w = Windows(table, window)
        known = w.ids[w.of] != NO_ID
        rep, doc = w.representatives()[known], w.ids[w.of][known]
        if not len(rep):
            return
        fresh = np.append(True, (rep[1:] != rep[:-1]) | (doc[1:] != doc[:-1]))
        pairs = np.unique(np.rec.fromarrays([rep[fresh], doc[fresh]], names="rep,doc"))
        keys, documents = np.unique(pairs.rep, return_counts=True)
        shard, cells = _cells(keys, shards)
        for s, (own, n) in B.split_by(shard, cells.T, documents):
            code, at = np.unique(own.ravel(), return_inverse=True)
            sums = np.bincount(at.ravel(), weights=np.repeat(n, DEPTH))
            yield s, B.to_bytes(np.where(sums > 1, code | TWICE, code).astype(np.uint32))

    def merge(sketches):
        counts = np.zeros(DEPTH * WIDTH, np.uint8)
        decoded = []
        for block, data in sketches:
            (code,) = B.from_bytes(data, "<u4")
            cell = code & ~TWICE
            counts[cell] = np.minimum(counts[cell] + 1 + (code >= TWICE), 2)
            decoded.append((block, cell))
        for block, cell in decoded:
            often = cell[counts[cell] > 1]
            if len(often):
                yield block, B.to_bytes(often)

    def candidates(_, table, replies):
        if not replies:
            return
        w = Windows(table, window)
        rep = w.representatives()
        keys, at = np.unique(rep, return_inverse=True)
        shard, cells = _cells(keys, shards)
        # Cells are numbered within a shard, so a reply of another shard may hold the same number: that only adds candidates.
        often = np.unique(np.concatenate([B.from_bytes(r, "<u4")[0] for r in replies]))
        repeated = np.isin(cells, often).all(axis=0)[at] & (w.ids[w.of] != NO_ID)
        hashes, doc = w.sequences(repeated), w.ids[w.of[repeated]]
        if not len(doc):
            return
        order = np.lexsort((doc, hashes[:, 1], hashes[:, 0]))
        hashes, doc = hashes[order], doc[order]
        first = np.append(True, (hashes[1:] != hashes[:-1]).any(axis=1))
        starts = np.flatnonzero(first)
        several = (np.maximum.reduceat(doc, starts) > doc[starts]).astype(np.uint8)
        hashes, doc = hashes[starts], doc[starts]
        for s, columns in B.split_by((hashes[:, 0] % np.uint64(shards)).astype(np.int64), hashes[:, 0], hashes[:, 1], doc, several):
            yield s, B.to_bytes(*columns)

    def group(requests):
        parts = [(block, B.from_bytes(data, "<u8", "<u8", "<i8", "u1")) for block, data in requests]
        a, b, doc, several = (np.concatenate([p[1][k] for p in parts]) for k in range(4))
        block = np.repeat([p[0] for p in parts], [len(p[1][0]) for p in parts])
        order = np.lexsort((doc, b, a))
        a, b, doc, several, block = a[order], b[order], doc[order], several[order], block[order]
        starts = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        sizes = np.diff(np.append(starts, len(a)))
        least = doc[starts]
        common = (np.maximum.reduceat(doc, starts) > least) | np.maximum.reduceat(several, starts).astype(bool)
        hit = np.repeat(common, sizes)
        least = np.repeat(least, sizes)[hit]
        for k, columns in B.split_by(block[hit], a[hit], b[hit], least):
            yield k, B.to_bytes(*columns)

    def remove(table, replies):
        w = Windows(table, window)
        covered = np.zeros(len(w.words) + 1, np.int64)
        if replies:
            parts = [B.from_bytes(r, "<u8", "<u8", "<i8") for r in replies]
            a, b, least = (np.concatenate([p[k] for p in parts]) for k in range(3))
            order = np.argsort(a, kind="stable")
            a, b, least = a[order], b[order], least[order]
            own = w.sequences()
            at = np.minimum(np.searchsorted(a, own[:, 0]), len(a) - 1)
            ids = w.ids[w.of]
            gone = w.starts[(a[at] == own[:, 0]) & (b[at] == own[:, 1]) & (least[at] < ids) & (ids != NO_ID)]
            covered[gone] += 1
            np.subtract.at(covered, gone + window, 1)
        lost = np.cumsum(covered[:-1]) > 0
        texts, spans, removed = [], [], []
        for stop, n in zip(w.ends, w.counts):
            own = lost[stop - n:stop]
            words = w.words[stop - n:stop]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]))) if own.any() else np.zeros(0, np.int64)
            spans.append([{"start": int(x), "stop": int(y)} for x, y in zip(edges[::2], edges[1::2])])
            removed.append(int(own.sum()))
            texts.append(b" ".join(words if not len(edges) else [x for x, y in zip(words, own) if not y]).decode())
        return pa.table({
            "doc_id": table.column("doc_id"), "n_words": pa.array(w.counts), "n_removed": pa.array(removed, pa.int64()),
            "kept_text": pa.array(texts, pa.string()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))})

    often = B.answer(B.ask(packed, sketch), merge)
    repeats = B.answer(B.ask_again(packed, often, candidates), group)
    return B.finish(packed, repeats, remove, "doc_id long, n_words long, n_removed long, kept_text string, "
                                             "spans array<struct<start:long,stop:long>>")
