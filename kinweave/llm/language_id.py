"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Weights are learned with follow-the-regularised-leader (McMahan et al. 2013) under an elastic net, so most stay zero, and the
probabilities are calibrated with one temperature. Document frequencies come from all training documents; the classifier is
fitted on a documented bounded sample of them (``SAMPLE`` rows, spread evenly over the labels); predictions read whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StructType

from kinweave.llm.blocks import slices

FEATURES = 1 << 14
SAMPLE = 4000
CALIBRATE_EVERY = 5
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.1
CHARS_AT_ONCE = 1_000_000
#: Text of the rows that are put out at once.
BYTES_AT_ONCE = 1_000_000
UNKNOWN = "und"
MIN_SCORE = 0.35

_letters: list[np.ndarray] = []


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text; everything but letters is one blank (0)."""
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(_letters[0][codes], codes, 0).astype(np.uint32)


def term_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed 1-, 2- and 3-grams of the whole text; None without any letter."""
    total, letters = np.zeros(FEATURES, np.int64), False
    shift = np.uint32(32 - FEATURES.bit_length() + 1)
    for start in range(0, len(text or ""), CHARS_AT_ONCE):
        # Two characters of the part before, so that no n-gram is lost at the cut.
        lead = min(start, 2)
        c = _codes(text[start - lead:start + CHARS_AT_ONCE])
        letters = letters or bool(c.any())
        one = (c + np.uint32(1)) * np.uint32(2654435761)
        two = (one[:-1] ^ np.uint32(0x9E3779B9)) * np.uint32(2246822519) + c[1:]
        three = (two[:-1] ^ np.uint32(0x85EBCA6B)) * np.uint32(3266489917) + c[2:]
        for grams, n in ((one, 1), (two * np.uint32(668265263), 2), (three * np.uint32(374761393), 3)):
            if len(grams):
                total += np.bincount((grams ^ (grams >> np.uint32(15)))[max(0, lead - n + 1):] * np.uint32(2654435761) >> shift, minlength=FEATURES)
    return total if letters else None


@dataclass
class LanguageModel:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def vector(self, counts: np.ndarray) -> np.ndarray:
        v = counts * self.idf
        return np.append(v / max(np.sqrt(v @ v), 1e-12), 1.0)

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = term_counts(text) if self.labels else None
        if counts is None:
            return UNKNOWN, 0.0
        p = _softmax(self.vector(counts) @ self.weights / self.temperature)
        best = int(np.argmax(p))
        return self.labels[best], float(p[best])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], size: int, classes: int) -> np.ndarray:
    """Weights after ``EPOCHS`` passes over sparse rows (indices, values, class)."""
    z, n = np.zeros((size, classes)), np.zeros((size, classes))

    def weights(z, n):
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > L1, w, 0.0)

    for epoch in range(EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            at, value, label = rows[k]
            w = weights(z[at], n[at])
            error = _softmax(value @ w)
            error[label] -= 1
            g = np.outer(value, error)
            n_new = n[at] + g * g
            z[at] += g - (np.sqrt(n_new) - np.sqrt(n[at])) / ALPHA * w
            n[at] = n_new
    return weights(z, n)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by a search over a fine grid.

    Labels count as right with probability ``(n + 1) / (n + 2)`` (rule of succession), so that a faultless sample of n rows does
    not claim certainty.
    """
    n = len(labels)
    if not n:
        return 1.0
    grid = np.exp(np.linspace(-5, 5, 201))
    loss = []
    for t in grid:
        log_p = np.log(np.maximum(_softmax(logits / t), 1e-12))
        right = log_p[np.arange(n), labels]
        wrong = (log_p.sum(axis=1) - right) / max(logits.shape[1] - 1, 1)
        loss.append(-((n + 1) * right + wrong).mean() / (n + 2))
    return float(grid[int(np.argmin(loss))])


def document_frequencies(train: DataFrame) -> np.ndarray:
    """Documents that hold each feature; the last entry is the number of documents."""
    def run(batches):
        total = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                counts = term_counts(text.as_py())
                if counts is not None:
                    total[:-1] += counts > 0
                    total[-1] += 1
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int64)), pa.array(total[there])], names=["feature", "n"])

    rows = train.select("text").mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(FEATURES + 1, np.int64)
    for r in rows:  # at most one row per feature
        out[r.feature] = r.n
    return out


def fit(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", label: str = "lang") -> LanguageModel:
    """Learn from the rows where ``train`` holds and the label is known."""
    rows = docs.where(train & F.col(label).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(label).alias("label"), F.xxhash64(doc_id).alias("h"))
    df = document_frequencies(rows)
    place = F.row_number().over(W.partitionBy("label").orderBy("h", "doc_id"))
    # A hash threshold per label leaves about twice SAMPLE rows of it before they are ranked, however frequent it is.
    ids = rows.where("text is not null").select("doc_id", "label", "h")
    sizes = ids.groupBy("label").agg(F.count("*").alias("n"))
    share = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    few = ids.join(sizes, "label").where(share * F.col("n") <= 2 * SAMPLE)
    chosen = few.withColumn("place", place).where(F.col("place") <= SAMPLE).orderBy("place", "h", "label").limit(SAMPLE)

    def sparse(batches):
        for batch in batches:
            out = []
            for h, known, raw in zip(*[batch.column(c).to_pylist() for c in ("h", "label", "text")]):
                counts = term_counts(raw)
                if counts is not None:
                    at = np.flatnonzero(counts)
                    out.append((h, known, at.astype("<u4").tobytes(), counts[at].astype("<u4").tobytes()))
            yield pa.RecordBatch.from_pylist([dict(zip(("h", "label", "at", "counts"), o)) for o in out], schema=pa.schema(
                [("h", pa.int64()), ("label", pa.string()), ("at", pa.binary()), ("counts", pa.binary())]))

    # Bounded: SAMPLE ids are broadcast, and as many sparse rows of at most FEATURES entries come back.
    sample = rows.join(F.broadcast(chosen.select("doc_id", "label").distinct()), ["doc_id", "label"], "left_semi")
    got = sorted(sample.select("h", "label", "text").mapInArrow(sparse, "h long, label string, at binary, counts binary").collect())
    labels = sorted({r.label for r in got})
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    model = LanguageModel(labels, idf, np.zeros((FEATURES + 1, len(labels))), 1.0)
    examples = []
    for r in got:
        at, counts = np.frombuffer(r.at, "<u4").astype(np.int64), np.frombuffer(r.counts, "<u4")
        v = counts * idf[at]
        examples.append((np.append(at, FEATURES), np.append(v / np.sqrt(v @ v), 1.0), labels.index(r.label)))
    learn = [e for k, e in enumerate(examples) if k % CALIBRATE_EVERY]
    check = [e for k, e in enumerate(examples) if k % CALIBRATE_EVERY == 0]
    if labels:
        model.weights = ftrl(learn, FEATURES + 1, len(labels))
        model.temperature = temperature(np.array([v @ model.weights[at] for at, v, _ in check]), np.array([c for *_, c in check]))
    return model


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The input's columns and ``lang_pred``, ``score``; columns of these names are replaced.

    NULL texts and texts without a letter are ``und`` with score 0, as is everything when nothing could be learned.
    """
    base = docs.drop("lang_pred", "score")

    def run(batches):
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    added = StructType().add("lang_pred", "string").add("score", "double")
    return base.mapInArrow(run, StructType([*base.schema.fields, *added.fields]))


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows whose language is recognised with a calibrated probability of at least ``MIN_SCORE``, columns unchanged."""
    def run(batches):
        for batch in batches:
            for piece in slices(batch, text, BYTES_AT_ONCE):
                found = [model.predict(t.as_py()) for t in piece.column(text)]
                yield piece.filter(pa.array([lang != UNKNOWN and score >= MIN_SCORE for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
