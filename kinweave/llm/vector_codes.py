"""Product codes of vectors in exact integer arithmetic.

Vectors become integers and are cut into parts; every part position has a small codebook, refined by rounds of assignment and averaging.
The nearest entry is found by slicing and intersecting: per dimension the entries' coordinates are sorted, and position j carries the bit
mask of the first j entries, so the entries inside a range of that dimension are one XOR of two masks. The distance to a near entry gives
the radius; the masks of all dimensions are ANDed, and only entries left in the result are measured. Whatever lies nearer than the radius
lies within it in every dimension, so the search is exact.

Each round is one pass in which every task sends one sum per codebook component; Spark adds them up and the driver holds the codebooks,
``entries`` times the vector's length. All arithmetic is exact: batches and codebooks whose squares could pass 64 bits use Python integers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.plans.skew import lookup_join
from kinweave.plans.storage import materialize

#: Components that a task turns into integers at once.
AT_ONCE = 1 << 21
#: Sums are sent in limbs of this size, so that those of any finite components stay exact.
LIMB = 10**18
LARGEST = (1 << 63) - 1


class Nearest:
    """Exact nearest entry of one codebook (entries, width), ties to the lower index."""

    def __init__(self, entries: np.ndarray):
        self.entries, (count, width) = entries, entries.shape
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, axis=0)
        bits = np.zeros((count, -(-count // 64)), np.uint64)
        for e in range(count):
            bits[e, e // 64] = np.uint64(1) << np.uint64(e % 64)
        #: masks[d, j]: the entries with the j smallest coordinates in dimension d.
        self.masks = np.zeros((width, count + 1, bits.shape[1]), np.uint64)
        for d in range(width):
            self.masks[d, 1:] = np.bitwise_or.accumulate(bits[self.order[:, d]], axis=0)
        self.widest = max(range(width), key=lambda d: self.sorted[-1, d] - self.sorted[0, d])

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Bit masks (rows, words) of the entries within ``radius`` of the row in every dimension."""
        found = None
        for d in range(x.shape[1]):
            low = np.searchsorted(self.sorted[:, d], x[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], x[:, d] + radius, "right")
            here = self.masks[d, high] ^ self.masks[d, low]
            found = here if found is None else found & here
        return found

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each row."""
        count = len(self.entries)
        at = np.searchsorted(self.sorted[:, self.widest], x[:, self.widest])
        near = [_squares(x - self.entries[self.order[np.clip(at + k, 0, count - 1), self.widest]]) for k in (-1, 0)]
        found = self.candidates(x, _root(np.minimum(*near)))
        code, best = np.zeros(len(x), np.int64), None
        for e in range(count):
            rows = np.flatnonzero(found[:, e // 64] >> np.uint64(e % 64) & np.uint64(1))
            if not len(rows):
                continue
            d = _squares(x[rows] - self.entries[e])
            if best is None:
                best = np.full(len(x), -1, d.dtype)
            nearer = (best[rows] < 0) | (d < best[rows])
            code[rows[nearer]], best[rows[nearer]] = e, d[nearer]
        return code, best if best is not None else np.zeros(len(x), np.int64)


def _squares(difference: np.ndarray) -> np.ndarray:
    return (difference * difference).sum(axis=1)


def _root(squares: np.ndarray) -> np.ndarray:
    """An integer at least as large as the square root."""
    if squares.dtype == object:
        return np.array([math.isqrt(s) + 1 for s in squares], dtype=object)
    return np.ceil(np.sqrt(squares.astype(np.float64))).astype(np.int64) + 1


def to_integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) for finite floats; ``scale`` is a power of two, so the products are exact. Python integers where int64 is too small."""
    limit = math.isqrt((1 << 60) // max(1, values.shape[-1]))
    scaled = np.floor(values * float(scale)) if not values.size or np.abs(values).max() < limit else None
    if scaled is not None and (not scaled.size or np.abs(scaled).max() < limit):
        return scaled.astype(np.int64)
    exact = [math.floor(v * scale) if abs(v) < 2.0**52 else int(v) * scale for v in values.ravel().tolist()]
    return np.array([*exact, None], dtype=object)[:-1].reshape(values.shape)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as floats, zeros behind shorter ones."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _pieces(batch: pa.RecordBatch, vec: str, width: int, scale: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, integer matrix) of bounded slices of a batch."""
    step = max(1, AT_ONCE // width)
    column = batch.column(batch.schema.get_field_index(vec))
    for start in range(0, batch.num_rows, step):
        yield start, to_integers(_matrix(column.slice(start, step), width), scale)


class Codebooks:
    """Integer codebooks: ``entries`` (parts, entries, width of a part)."""

    def __init__(self, entries: list[list[list[int]]], scale: int):
        self.scale = scale
        largest = max((abs(v) for p in entries for e in p for v in e), default=0)
        width = len(entries[0][0]) * len(entries) if entries and entries[0] else 1
        kind = np.int64 if largest < math.isqrt((1 << 60) // max(1, width)) else object
        self.entries = np.array(entries, dtype=kind)

    @property
    def length(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(int(v)) for v in self.entries.ravel()).encode()).hexdigest()

    def finders(self) -> list[Nearest]:
        return [Nearest(part) for part in self.entries]

    def split(self, x: np.ndarray) -> np.ndarray:
        return x.reshape(len(x), self.entries.shape[0], self.entries.shape[2])


def kept_vectors(rows: DataFrame, vec: str) -> DataFrame:
    """Rows whose vector is not NULL and has neither NULL nor non-finite components."""
    finite = F.forall(F.col(vec), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col(vec).isNotNull() & finite)


def _round_sums(books: Codebooks):
    """Task function: one row per codebook component with the sum of the parts assigned to its entry, and at position -1 their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = books.finders()
        parts, count, width = books.entries.shape
        sums, sizes = np.zeros((parts, count, width), dtype=object), np.zeros((parts, count), dtype=object)
        for batch in batches:
            for _, x in _pieces(batch, "vec", books.length, books.scale):
                cut = books.split(x)
                for p, finder in enumerate(finders):
                    code = finder.find(cut[:, p])[0]
                    for e in np.unique(code):
                        sums[p, e] += cut[code == e, p].sum(axis=0)
                        sizes[p, e] += int((code == e).sum())
        out = []
        for p, e in zip(*np.nonzero(sizes)):
            for pos, value in enumerate((sizes[p, e], *sums[p, e]), -1):
                sign, value, limb = (-1 if value < 0 else 1), abs(int(value)), 0
                while value or not limb:
                    out.append((int(p), int(e), pos, limb, sign * (value % LIMB)))
                    value, limb = value // LIMB, limb + 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(),) * 4 + (pa.int64(),))], names=[
                "part", "entry", "pos", "limb", "value"])
    return run


def train(rows: DataFrame, parts: int, entries: int, rounds: int, scale: int) -> Codebooks | None:
    """Codebooks from kept rows (vec_id, vec): the first ``entries`` ids' parts, then ``rounds`` rounds of assignment and averaging.

    NULL ids come last; of rows with one id the smaller vector comes first. Vectors shorter than the longest one, or whose length is no
    multiple of ``parts``, count as if zeros followed. Fewer rows than entries give smaller codebooks, no rows give None.
    """
    longest = rows.agg(F.max(F.size("vec"))).first()[0]
    if longest is None:
        return None
    width = max(1, -(-longest // parts))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), F.col("vec")).limit(entries).collect()
    start = [to_integers(np.array([[*r.vec, *[0.0] * (width * parts - len(r.vec))]], dtype=np.float64), scale)[0].tolist() for r in first]
    books = Codebooks([[v[p * width:(p + 1) * width] for v in start] for p in range(parts)], scale)
    for _ in range(rounds):
        sums = rows.select("vec").mapInArrow(_round_sums(books), "part int, entry int, pos int, limb int, value long")
        total = sums.groupBy("part", "entry", "pos", "limb").agg(F.sum(F.col("value").cast("decimal(19,0)")).alias("value"))
        found: dict[tuple[int, int], dict[int, int]] = {}
        for r in total.collect():  # as many rows as the codebooks have components
            cell = found.setdefault((r.part, r.entry), {})
            cell[r.pos] = cell.get(r.pos, 0) + int(r.value) * LIMB**r.limb
        following = books.entries.tolist()
        for (p, e), cell in found.items():
            following[p][e] = [cell[pos] // cell[-1] for pos in range(width)]
        books = Codebooks(following, scale)
    return books


def encode(rows: DataFrame, books: Codebooks, digits: int = 2) -> DataFrame:
    """``rows`` (any columns, ``vec`` among them) with ``code`` and ``error`` in place of the vector.

    An error beyond the largest long is given as that.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = books.finders()
        for batch in batches:
            codes, errors = [], []
            for _, x in _pieces(batch, "vec", books.length, books.scale):
                cut = books.split(x)
                found = [finder.find(cut[:, p]) for p, finder in enumerate(finders)]
                codes += ["".join(f"{c:0{digits}x}" for c in row) for row in np.stack([c for c, _ in found], axis=1).tolist()]
                errors += [min(LARGEST, sum(int(d) for d in row)) for row in zip(*(d.tolist() for _, d in found))]
            rest = [(f, batch.column(i)) for i, f in enumerate(batch.schema) if f.name != "vec"]
            yield pa.RecordBatch.from_arrays([c for _, c in rest] + [pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                                             names=[f.name for f, _ in rest] + ["code", "error"])

    kinds = [f"`{c}` {kind}" for c, kind in rows.dtypes if c != "vec"]
    return rows.mapInArrow(run, ", ".join([*kinds, "code string", "error long"]))


def compress_vectors(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label", parts: int = 8,
                     entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), one row per kept row.

    Rows whose vector is NULL or holds NULL or non-finite components are dropped; see ``train`` for the codebooks and ``Nearest`` for the
    search. ``code`` has two hex digits per part, ``error`` is the sum of the final squared distances, ``label_error`` its sum over all rows
    with that label (NULL labels together; at most the largest long). Repeated rows get equal codes, other columns are ignored, an empty
    table gives an empty result.
    """
    rows = kept_vectors(vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vec).cast("array<double>").alias("vec")), "vec")
    books = train(rows.select("vec_id", "vec"), parts, entries, rounds, scale)
    if books is None:
        return rows.select("vec_id", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")],
                           F.lit("").alias("codebooks_sha256"))
    keyed = rows.select("vec_id", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")).alias("key"), "vec")
    coded = materialize(encode(keyed, books))
    summed = coded.groupBy("key").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST)).cast("long").alias("label_error"))
    return lookup_join(coded, summed, "key").select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
