"""Near duplicates by word shingles: bottom-k sketches of one hash function, inverted lists, exact confirmation.

1. Every document becomes its set of hashed shingles; documents with equal sets are one node. A node keeps the ``K`` smallest
   hashes as its sketch.
2. Inverted lists hold the nodes of a retained value. Two sets that are similar enough share at least ``least_overlap`` retained
   values, so each node enters only the lists of its rarest ones (prefix filter over the exact frequency order): a passage
   that many documents share makes no long list, and no value is ignored.
3. A list is worked off without pairing all its members: every member meets one hub; then lists that still hold several
   components try another hub. Nodes of lists that are left with several components are joined on their full sets, with exact
   prefix and position filters. A union sketch estimates each pair first, sets of at most ``K`` shingles are decided by it,
   and exact Jaccard on the full sets confirms.
   Links inside a component are not looked for, since they cannot change it.

The similarity is an argument in percent. The overlap bound holds for certain for sets up to ``K / 0.37`` shingles or so at 85 %
(about 140 at 80 %); beyond that it fails for a pair at the threshold with a probability below 1e-10 (binomial tail).
"""

from __future__ import annotations

from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kinweave.llm import blocks as B
from kinweave.llm.text import free_name, quoted
from kinweave.operators.components import connected_components
from kinweave.plans.storage import materialize, text_batches

SHINGLE = 5
PERCENT = 85
K = 64
TAIL = 1e-10
PARITY = 8
#: Text that a task shingles at once: its words and their hashes take some 40 times as much memory.
BYTES_AT_ONCE = 500_000
#: Compressed text at once where sets are made again.
PACKED_AT_ONCE = 250_000


@cache
def sure_overlap(percent: int) -> int:
    """The largest number of common values that a ``K``-value sample of a union at the threshold misses with less than ``TAIL``."""
    q, below = percent / 100, 0.0
    for s in range(K + 1):
        below += comb(K, s) * q ** s * (1 - q) ** (K - s)
        if below >= TAIL:
            return s
    return K


SURE = sure_overlap(PERCENT)


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Retained values that a set of ``n`` shingles shares with any set similar enough, at least."""
    lost = -(-n * (100 - percent) // percent)  # elements of the union outside the intersection, at most
    return max(sure_overlap(percent), K - lost) if n >= K else min(-(-n * percent // 100), K - lost)


def shingle_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text index) of the distinct shingles of each text, ordered by text and hash."""
    words, counts = B.words_of([t if t is None else t.translate(_LOWER) for t in texts])
    hashes = B.word_hashes(words)
    doc = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    runs = B.run_hashes(hashes, SHINGLE)[:, 0] if len(words) >= SHINGLE else np.zeros(0, np.uint64)
    whole = np.flatnonzero(np.arange(len(runs)) + SHINGLE <= ends[doc[:len(runs)]])
    h, d = [runs[whole]], [doc[whole]]
    for k in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        n = int(counts[k])
        h.append(B.mix(B.run_hashes(hashes[ends[k] - n:ends[k]], n)[:1, 0], np.full(1, n, np.uint64)))
        d.append(np.full(1, k))
    h, d = np.concatenate(h), np.concatenate(d)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    fresh = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])) if len(h) else np.zeros(0, bool)
    return h[fresh], d[fresh]


_LOWER = {c: c + 32 for c in range(65, 91)}


def _stored(df: DataFrame) -> DataFrame:
    with text_batches(df.sparkSession):
        return materialize(df)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, row, n, node, sketch): set size, a hash of the set (NULL for an empty one), its smallest hashes.

    ``row`` numbers the rows; it is stable once the result is stored.
    """
    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for piece in B.slices(batch, "text", BYTES_AT_ONCE):
                h, d = shingle_sets(piece.column("text").to_pylist())
                n = np.bincount(d, minlength=piece.num_rows)
                stops = np.cumsum(n)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(B.mix(h, np.full(1, 11, np.uint64)))])
                node = (sums[stops] - sums[stops - n]).astype(np.int64)  # a sum over the set, modulo 2**64
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), piece.column("text_key"), pa.array(np.arange(row, row + len(n))), pa.array(n), pa.array(node, mask=n == 0),
                    pa.array([h[b - c:b - c + min(c, K)].tobytes() for b, c in zip(stops, n)], pa.binary()),
                ], names=["doc_id", "text_key", "row", "n", "node", "sketch"])
                row += len(n)

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        run, "doc_id long, text_key long, row long, n long, node long, sketch binary")


def inverted_lists(nodes: DataFrame, percent: int) -> DataFrame:
    """(value, node, n): each node under the rarest of its retained values that others retain too."""
    def explode(batches):
        for batch in batches:
            kept = [np.frombuffer(s, "<i8") for s in batch.column("sketch").to_pylist()]
            sizes = [len(s) for s in kept]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(kept)), pa.array(np.repeat(batch.column("node").to_numpy(), sizes)),
                pa.array(np.repeat(batch.column("n").to_numpy(), sizes))], names=["value", "node", "n"])

    values = nodes.select("node", "n", "sketch").mapInArrow(explode, "value long, node long, n long")
    shared = values.groupBy("value").agg(F.count("*").alias("often")).where("often > 1")
    kept = F.least(F.col("n"), F.lit(K))
    lost = F.ceil(F.col("n") * (100 - percent) / percent)
    overlap = F.when(F.col("n") >= K, F.greatest(F.lit(sure_overlap(percent)), K - lost)).otherwise(
        F.least(F.ceil(F.col("n") * percent / 100), K - lost))
    # Values of one node only come first in the order of frequency; they fill the prefix without making a list.
    take = kept - overlap + 1 - (kept - F.size("found"))
    by_node = values.join(shared, "value").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("often", "value"))).alias("found"))
    prefix = by_node.where(take > 0).select("node", "n", F.explode(F.slice("found", F.lit(1), take.cast("int"))).alias("f"))
    return prefix.select(F.col("f.value").alias("value"), "node", "n")


def _fits(a, b, percent: int):
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)


def _hub_pairs(lists: DataFrame, order, percent: int) -> DataFrame:
    """Pairs (a, b) of every list's hub, the member first in ``order``, with its members in other components."""
    hubs = lists.groupBy("value").agg(F.min(F.struct(order.alias("o"), "node", "n", "root")).alias("hub"), F.min("root").alias("lo"),
                                      F.max("root").alias("hi")).where("lo < hi")
    met = lists.join(hubs, "value").where((F.col("root") != F.col("hub.root")) & _fits(F.col("n"), F.col("hub.n"), percent))
    return met.select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct()


def _parities(texts: DataFrame) -> DataFrame:
    """(node, s0, s1, ...): which of ``64 * PARITY`` hash classes hold an odd number of the node's shingles.

    Two sets differ in at least as many shingles as their parities differ in bits.
    """
    def run(batches):
        zip_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for piece in B.slices(batch, "packed", PACKED_AT_ONCE):
                h, d = shingle_sets([zip_.decompress(t).decode() for t in piece.column("packed").to_pylist()])
                at = d * (64 * PARITY) + (h % np.uint64(64 * PARITY)).astype(np.int64)
                odd = (np.bincount(at, minlength=piece.num_rows * 64 * PARITY) % 2).astype(np.uint8)
                words = np.packbits(odd, bitorder="little").view("<i8").reshape(-1, PARITY)
                yield pa.RecordBatch.from_arrays([piece.column("node"), *map(pa.array, words.T)], names=["node", *[f"s{k}" for k in range(PARITY)]])

    schema = "node long, " + ", ".join(f"s{k} long" for k in range(PARITY))
    return texts.select("node", "packed").mapInArrow(run, schema)


def _other_pairs(lists: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes in different components that may still be linked, smaller node first.

    Only nodes of lists with several components take part. They are joined once more on their full sets, where the prefix and
    position filters are exact: what a node holds alone counts against it, and with it the sizes it can be linked with. Pairs
    whose parities differ in more bits than linked sets may differ in shingles are not even put out.
    """
    several = lists.groupBy("value").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("value")
    open_nodes = lists.join(several, "value").select("node", "n", "root").distinct()

    def explode(batches):
        zip_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for piece in B.slices(batch, "packed", PACKED_AT_ONCE):
                h, d = shingle_sets([zip_.decompress(t).decode() for t in piece.column("packed").to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))] + [
                    pa.array(piece.column(c).to_numpy()[d]) for c in ("node", "n", "root")], names=["value", "node", "n", "root"])

    values = texts.join(open_nodes, "node").select("packed", "node", "n", "root").mapInArrow(
        explode, "value long, node long, n long, root long")
    shared = values.groupBy("value").agg(F.count("*").alias("often")).where("often > 1")
    alone = F.col("n") - F.size("found")
    take = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - alone
    full = values.join(shared, "value").groupBy("node", "n", "root").agg(F.sort_array(F.collect_list(F.struct("often", "value"))).alias("found"))
    prefix = full.where(take > 0).select("node", "n", "root", alone.alias("alone"), F.posexplode(F.slice("found", F.lit(1), take.cast("int"))).alias("k", "f"))
    # At most n - alone - k values are common, so the other set has at most this many.
    most = F.floor((F.col("n") - F.col("alone") - F.col("k")) * (100 + percent) / percent) - F.col("n")
    short = prefix.select(F.col("f.value").alias("value"), "node", "n", "root", most.alias("most"))
    useful = short.groupBy("value").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("least")).where("lo < hi")
    kept = short.join(useful.select("value", "least"), "value").where("most >= least").drop("least")
    lists = _stored(kept.join(_parities(texts.join(open_nodes, "node")), "node"))
    names = ["node", "n", "root", "most", *[f"s{k}" for k in range(PARITY)]]
    left = lists.select("value", *[F.col(c).alias(f"{c}_a") for c in names])
    right = lists.select("value", *[F.col(c).alias(f"{c}_b") for c in names])
    met = left.join(right, "value").where("node_a < node_b and root_a != root_b and n_a <= most_b and n_b <= most_a")
    apart = sum((F.bit_count(F.col(f"s{k}_a").bitwiseXOR(F.col(f"s{k}_b"))) for k in range(PARITY)), F.lit(0))
    met = met.where(apart * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _estimated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs that the union sketch lets through; ``sure`` marks those it decides."""
    def run(batches):
        for batch in batches:
            keep, sure = [], []
            for x, y, nx, ny in zip(*[batch.column(c).to_pylist() for c in ("sa", "sb", "na", "nb")]):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = np.intersect1d(x, y, assume_unique=True)
                if nx <= K and ny <= K:
                    sure.append(100 * len(both) >= percent * (nx + ny - len(both)))
                    keep.append(sure[-1])
                else:
                    union = np.union1d(x, y)[:K]
                    common = int(np.searchsorted(both, union[-1], "right"))
                    keep.append(common >= least_overlap(max(min(nx, ny), K), percent))
                    sure.append(False)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sure, pa.bool_())], names=["a", "b", "sure"]).filter(
                pa.array(keep, pa.bool_()))

    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long, sure boolean")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full shingle sets are similar enough."""
    def run(batches):
        zip_, last, own = zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            keep = []
            for a, x, y in zip(*[batch.column(c).to_pylist() for c in ("a", "ta", "tb")]):
                if a != last:  # rows of a hub come together
                    last, own = a, shingle_sets([zip_.decompress(x).decode()])[0]
                other = shingle_sets([zip_.decompress(y).decode()])[0]
                both = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(own) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = texts.select(F.col("node").alias("a"), F.col("packed").alias("ta")), texts.select(F.col("node").alias("b"), F.col("packed").alias("tb"))
    return pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _packed_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, packed): the compressed text of one document of each node."""
    def run(batches):
        zip_ = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(
                [None if t is None else zip_.compress(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())],
                names=["doc_id", "text_key", "packed"])

    packed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, "doc_id long, text_key long, packed binary")
    return packed.dropDuplicates(["doc_id", "text_key"]).join(nodes, ["doc_id", "text_key"]).select("node", "packed")


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_key, n, root), stored: the component of every row, NULL for rows that take part in no link."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = _stored(sketches(rows))
    whose = sets.where("node is not null and doc_id is not null")
    first = whose.groupBy("node").agg(F.min(F.struct("doc_id", "row")).alias("first")).select(F.col("first.row").alias("row"))
    nodes = _stored(whose.join(first, "row").drop("row"))
    lists = _stored(inverted_lists(nodes, percent))
    listed = lists.select("node").distinct()
    # The text of a node's first document; an id may have several texts, so the text's hash is part of the key.
    keys = nodes.join(listed, "node", "left_semi").select("node", "doc_id", "text_key")
    texts = _stored(_packed_texts(rows, keys))
    links, roots = None, None
    for turn in range(3):
        with_root = lists.withColumn("root", F.col("node")) if roots is None else lists.join(
            roots.withColumnRenamed("root", "r"), "node", "left").withColumn("root", F.coalesce("r", "node")).drop("r")
        order = F.col("node") if turn == 0 else F.xxhash64("node", "value")
        pairs = _hub_pairs(with_root, order, percent) if turn < 2 else _other_pairs(with_root, texts, percent)
        estimated = _stored(_estimated(pairs, nodes, percent))
        found = estimated.where("sure").select("a", "b").unionByName(_confirmed(estimated.where("not sure"), texts, percent))
        edges = found.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        links = _stored(edges if links is None else edges.unionByName(links))
        roots = connected_components(links)
    named = sets.select("doc_id", "text_key", "n", "node").join(roots, "node", "left").withColumn(
        "root", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "node")))
    return _stored(named.select("doc_id", "text_key", "n", "root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row.

    A set holds the distinct runs of five words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased), or the whole sequence of a shorter
    text; NULL texts and texts without words have an empty set and no links. Documents are linked when
    ``100 * intersection >= percent * union``; ``component_id`` is the smallest doc_id reachable and ``kept`` says whether it is the row's own.
    Ids are integers. Rows that share an id and a text are equal in all columns; rows that share an id with other texts are judged
    one by one. A row without an id takes part in no link and is kept. Other columns are ignored.
    """
    named = components(docs, doc_id, text, percent)
    least = named.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    component = F.coalesce("least", "doc_id")
    return named.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of each component, columns unchanged: the smallest id, then the smallest hash of the text.

    Rows without words or id are no duplicates of anything and stay, but rows that repeat both id and text stay once.
    """
    named = components(docs, doc_id, text, percent)
    first = named.where("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("f")).select("f.*")
    own, stay = free_name(docs.columns, "own"), free_name(docs.columns, "stay")
    staying = first.unionByName(named.where("root is null").select("doc_id", "text_key").distinct()).select(
        F.struct(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).alias(stay))
    keyed = docs.withColumn(own, F.struct(F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("key")))
    joined = keyed.join(staying, F.col(f"{own}.id").eqNullSafe(F.col(f"{stay}.id")) & (F.col(f"{own}.key") == F.col(f"{stay}.key")))
    place = F.row_number().over(W.partitionBy(stay).orderBy(f"{own}.key"))
    return joined.withColumn(own, place).where(F.col(own) == 1).select(*quoted(docs.columns))
