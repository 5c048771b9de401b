"""Corpus scores of a log-bilinear neural language model.

The model predicts the class of the next token from the classes of the two tokens before (Mnih and Hinton 2007): frequent tokens
and the document end are classes of their own, all others share a class by their ending. A token's probability is its class's,
normalised over all classes, times its smoothed share of the class, so known tokens and one unknown per class sum up to one.
Class vectors are trained in numpy with noise-contrastive estimation, in every task on its own documents, and averaged over tasks;
each training document is used once. Token counts cover all training documents: blocks ask shards for the tokens they hold.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm import blocks as B
from kinweave.llm.vocabulary import TAIL
from kinweave.plans.storage import materialize

OWN, ENDINGS = 159, 96
#: Class 0 is the document end, then the frequent tokens, then the endings.
CLASSES = 1 + OWN + ENDINGS
DIMENSION, NOISE, BATCH, RATE = 16, 24, 1024, 0.25
ROUNDS = 2
CONTEXTS_AT_ONCE = 8192


@dataclass
class Vocabulary:
    """Bounded facts about the training tokens: the frequent ones, sums per class, and totals."""

    own: np.ndarray        # hashes of the tokens with a class of their own, sorted
    own_class: np.ndarray
    tokens: np.ndarray     # per class
    types: np.ndarray      # per class
    documents: int

    @property
    def total(self) -> int:
        return int(self.tokens.sum())

    @property
    def distinct(self) -> int:
        return int(self.types.sum())

    def unigram(self) -> np.ndarray:
        return (self.tokens + 1.0) / (self.tokens + 1.0).sum()

    def classes(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        if not len(self.own):
            return 1 + OWN + endings
        at = np.minimum(np.searchsorted(self.own, hashes), len(self.own) - 1)
        return np.where(self.own[at] == hashes, self.own_class[at], 1 + OWN + endings)


class Tokens:
    """The distinct tokens of some documents and the sequence they form, every document closed by its end."""

    def __init__(self, table: pa.Table):
        texts = [t.encode().lower() if t else b"" for t in table.column("text").to_pylist()]  # bytes: only A-Z change
        split = [t.split() for t in texts]
        self.counts = np.array([len(s) for s in split], np.int64)
        words = [w for s in split for w in s]
        self.train = np.array(table.column("train").to_pylist(), bool)
        hashes = B.word_hashes(words)[:, 0]
        self.distinct, first, self.at = np.unique(hashes, return_index=True, return_inverse=True)
        self.endings = np.array([zlib.crc32(words[i].rstrip(TAIL)[-3:]) % ENDINGS for i in first], np.int64)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)

    def training_counts(self) -> np.ndarray:
        return np.bincount(self.at[self.train[self.doc]], minlength=len(self.distinct)).astype(np.int64)

    def with_ends(self, of_words: np.ndarray, end) -> np.ndarray:
        """Per token of the sequence: the value of its word, ``end`` for the ends."""
        out = np.full(len(self.at) + len(self.counts), end, of_words.dtype)
        out[np.arange(len(self.at)) + self.doc] = of_words[self.at]
        return out

    def sequence(self, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class of each token, classes before it as one number, document of each token)."""
        own = self.with_ends(vocabulary.classes(self.distinct, self.endings), 0)
        doc = np.repeat(np.arange(len(self.counts)), self.counts + 1)
        one, two = np.append(0, own[:-1]), np.append([0, 0], own[:-2])[:len(own)]
        starts = np.cumsum(self.counts + 1) - self.counts - 1
        one[starts] = 0
        two[starts] = 0
        two[np.minimum(starts + 1, len(own) - 1)] = 0
        return own, one * CLASSES + two, doc


class LogBilinear:
    SHAPES = ((CLASSES, DIMENSION), (CLASSES, DIMENSION), (CLASSES,), (DIMENSION,), (DIMENSION,))

    def __init__(self, unigram: np.ndarray, flat: np.ndarray | None = None):
        self.cumulated, self.log_noise = np.cumsum(unigram), np.log(NOISE * unigram).astype(np.float32)
        if flat is None:
            rng = np.random.default_rng(7)
            self.parts = [rng.normal(0, 0.1, s) for s in self.SHAPES[:2]] + [np.log(unigram), np.ones(DIMENSION), np.ones(DIMENSION)]
        else:
            self.parts = [p.reshape(s) for p, s in zip(np.split(flat, np.cumsum([np.prod(s) for s in self.SHAPES])[:-1]), self.SHAPES)]
        self.parts = [p.astype(np.float32) for p in self.parts]
        self.squares = [np.full(s, 1e-2, np.float32) for s in self.SHAPES]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    def train(self, target: np.ndarray, context: np.ndarray, rng: np.random.Generator) -> None:
        for start in range(0, len(target), BATCH):
            self._step(target[start:start + BATCH], context[start:start + BATCH], rng)

    def _step(self, w: np.ndarray, context: np.ndarray, rng: np.random.Generator) -> None:
        seen, out, bias, near, far = self.parts
        one, two = np.divmod(context, CLASSES)
        v1, v2 = seen[one], seen[two]
        q = v1 * near + v2 * far
        drawn = np.searchsorted(self.cumulated, rng.random(NOISE)).clip(max=CLASSES - 1)
        real = 1 / (1 + np.exp(np.einsum("ij,ij->i", q, out[w]) + (bias - self.log_noise)[w]))  # 1 - P(real | target)
        fake = -1 / (1 + np.exp((self.log_noise - bias)[drawn] - q @ out[drawn].T))               # -P(real | noise)
        d_q = real[:, None] * out[w] + fake @ out[drawn]
        d_out, d_bias = _sums(w, real[:, None] * q), np.bincount(w, real, CLASSES)
        np.add.at(d_out, drawn, fake.T @ q)
        np.add.at(d_bias, drawn, fake.sum(0))
        d_seen = _sums(one, d_q * near) + _sums(two, d_q * far)
        slopes = (d_seen, d_out, d_bias, np.einsum("ij,ij->j", d_q, v1), np.einsum("ij,ij->j", d_q, v2))
        for part, square, g in zip(self.parts, self.squares, slopes):
            g = g / np.float32(len(w))
            square += g * g
            part += np.float32(RATE) * g / np.sqrt(square)

    def log10(self, target: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities: one matrix product per batch of distinct contexts."""
        seen, out, bias, near, far = self.parts
        codes, at = np.unique(context, return_inverse=True)
        order = np.argsort(at, kind="stable")
        stops = np.searchsorted(at[order], np.arange(0, len(codes) + CONTEXTS_AT_ONCE, CONTEXTS_AT_ONCE))
        result = np.empty(len(target))
        for k in range(len(stops) - 1):
            lo = k * CONTEXTS_AT_ONCE
            one, two = np.divmod(codes[lo:lo + CONTEXTS_AT_ONCE], CLASSES)
            s = (seen[one] * near + seen[two] * far) @ out.T + bias
            top = s.max(1, keepdims=True)
            s -= top + np.log(np.exp(s - top).sum(1, keepdims=True))
            rows = order[stops[k]:stops[k + 1]]
            result[rows] = s[at[rows] - lo, target[rows]]
        return result / np.log(10)


def _sums(at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the rows by class."""
    order = np.argsort(at, kind="stable")
    ordered = at[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    out = np.zeros((CLASSES, rows.shape[1]), np.float32)
    out[ordered[starts]] = np.add.reduceat(rows[order], starts)
    return out


def count_tokens(packed: DataFrame, shards: int) -> DataFrame:
    """Replies (block, data) with the training count of every token of a block, and statistics under block -1."""
    def request(_, table):
        t = Tokens(table)
        for s, columns in B.split_by((t.distinct % np.uint64(shards)).astype(np.int64), t.distinct, t.training_counts(), t.endings.astype("u1")):
            yield s, B.to_bytes(*columns)

    def reply(requests):
        parts = [(block, B.from_bytes(data, "<u8", "<i8", "u1")) for block, data in requests]
        keys, first, at = np.unique(np.concatenate([p[1][0] for p in parts]), return_index=True, return_inverse=True)
        total = np.bincount(at, np.concatenate([p[1][1] for p in parts]), len(keys)).astype(np.int64)
        ending = np.concatenate([p[1][2] for p in parts])[first].astype(np.int64)
        shard, start = int(keys[0] % np.uint64(shards)), 0
        for block, p in parts:
            yield block, B.to_bytes(np.append(shard, total[at[start:start + len(p[0])]]).astype("<i8"))
            start += len(p[0])
        top = np.lexsort((keys, -total))[:OWN]
        known = total > 0
        yield -1, B.to_bytes(keys[top], total[top], ending[top]) + B.to_bytes(
            np.bincount(ending, total, ENDINGS).astype("<i8"), np.bincount(ending[known], minlength=ENDINGS).astype("<i8"))

    return B.answer(B.ask(packed, request), reply)


def learn_vocabulary(replies: DataFrame, documents: int) -> Vocabulary:
    """Combine the statistics of all shards; what reaches the driver is bounded by the number of classes."""
    def rows(batches):
        for batch in batches:
            for data in batch.column("data").to_pylist():
                keys, n, ending = B.from_bytes(data, "<u8", "<i8", "<i8")
                sums, types = B.from_bytes(data[8 + 24 * len(keys):], "<i8", "<i8")
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat([0, 1], [len(keys), ENDINGS]).astype(np.int32)),
                    pa.array(np.append(keys.astype("<i8"), np.arange(ENDINGS))), pa.array(np.append(n, sums)), pa.array(np.append(ending, types)),
                ], names=["kind", "key", "n", "m"])

    stats = materialize(replies.where("block = -1").select("data").mapInArrow(rows, "kind int, key long, n long, m long"))
    sums = stats.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).collect()
    top = stats.where("kind = 0 and n > 0").orderBy(F.col("n").desc(), "key").limit(OWN).collect()
    tokens, types = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in sums:
        tokens[1 + OWN + r.key], types[1 + OWN + r.key] = r.n, r.m
    for k, r in enumerate(top):
        tokens[1 + k], types[1 + k] = r.n, 1
        tokens[1 + OWN + r.m] -= r.n
        types[1 + OWN + r.m] -= 1
    tokens[0], types[0] = documents, int(documents > 0)
    own = np.array([r.key for r in top], np.int64).astype(np.uint64)
    order = np.argsort(own)
    return Vocabulary(own[order], 1 + order, tokens, types, documents)


def fit(packed: DataFrame, vocabulary: Vocabulary) -> LogBilinear:
    """Train in every task and average, weighted by tokens; each round takes other documents."""
    unigram = vocabulary.unigram()
    model = LogBilinear(unigram)
    for turn in range(ROUNDS):
        start = model.flat()

        def run(batches, start=start, turn=turn):
            own, n = LogBilinear(unigram, start.copy()), 0
            for batch in batches:
                for payload in batch.column("payload"):
                    table = B.unpack(payload.as_buffer())
                    mine = table.filter(pa.array(np.array(table.column("train").to_pylist(), bool) & (np.arange(table.num_rows) % ROUNDS == turn)))
                    if mine.num_rows:
                        target, context, _ = Tokens(mine).sequence(vocabulary)
                        own.train(target, context, np.random.default_rng(n))
                        n += len(target)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(start))), pa.array(own.flat().astype(np.float64) * n), pa.array(np.full(len(start), float(n)))], names=["i", "v", "n"])

        means = packed.select("payload").mapInArrow(run, "i long, v double, n double").groupBy("i").agg(
            (F.sum("v") / F.sum("n")).alias("v")).collect()  # one row per parameter
        if means:
            flat = start.copy()
            flat[[r.i for r in means]] = [r.v for r in means]
            model = LogBilinear(unigram, flat)
    return model


def score_documents(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score), one row per document.

    Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of the whole text, A-Z lower-cased, and one document end; NULL is empty. Counts
    and vectors come from the rows where ``train`` holds. ``base_score`` is the add-one unigram log10 probability, ``score`` the
    model's. Without training rows every token has the unknown's probability. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    shards = B.shard_count(B.text_bytes(rows))
    packed = materialize(B.pack(rows, exchange=False))
    replies = materialize(count_tokens(packed, shards))
    vocabulary = learn_vocabulary(replies, rows.where("train").count())
    model = fit(packed, vocabulary)
    flat, unigram = model.flat(), vocabulary.unigram()
    n, v = vocabulary.total, vocabulary.distinct
    in_class = np.log10(np.where(np.arange(CLASSES) > OWN, vocabulary.tokens + vocabulary.types + 1.0, 1.0))

    def last(table, answers):
        t = Tokens(table)
        count = np.zeros(len(t.distinct), np.int64)
        shard = (t.distinct % np.uint64(shards)).astype(np.int64)
        for a in answers:
            (got,) = B.from_bytes(a, "<i8")
            count[shard == got[0]] = got[1:]
        own, context, doc = t.sequence(vocabulary)
        c = t.with_ends(count, vocabulary.documents)
        share = np.where(own > OWN, np.log10(c + 1.0) - in_class[own], 0.0)
        docs_here = len(t.counts)
        base = np.bincount(doc, np.log10((c + 1.0) / (n + v + 1.0)), docs_here)
        score = np.bincount(doc, LogBilinear(unigram, flat).log10(own, context) + share, docs_here)
        return pa.table({
            "doc_id": table.column("doc_id"), "n_tokens": pa.array(t.counts + 1),
            "n_known": pa.array(np.bincount(doc, c > 0, docs_here).astype(np.int64)), "train_tokens": pa.array(np.full(docs_here, n, np.int64)),
            "base_score": pa.array(base), "score": pa.array(score)})

    return B.finish(packed.repartition("block"), replies.where("block >= 0"), last,
                    "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
