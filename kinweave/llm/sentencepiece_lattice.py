"""Sub-word encoding by a relational lattice, and decoding.

Texts are cut into words as SentencePiece marks them (a leading ``▁`` for every blank before the word), so that no piece reaches
over a cut; longer ones are cut where no piece can, or else along their best path. The distinct words of every shard are exploded
into substrings of bounded length, an equi-join with the piece table leaves the edges of each word's lattice, edges are grouped
by word, and Spark's ``aggregate`` folds Viterbi over them in order of their end. Characters without a piece become bytes, so
decoding is exact. Blocks of documents ask for the words they hold and put the answers together.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from kinweave.llm import blocks as B

MAX_PIECES = 1_000_000
MAX_WORD = 64
UNKNOWN_SCORE = -40.0
BLANK = "▁"
#: Blanks and the word behind them.
WORD = re.compile(" +[^ ]*|[^ ]+")
#: The same in a text of several lines, with the line feeds.
LINED = re.compile("\n| +[^ \n]*|[^ \n]+")
#: Stands for a ``▁`` of the text itself, which is written as bytes; no word of a text has ``▁`` behind another character.
LITERAL = "\x00" + BLANK
#: Between words; no byte of UTF-8.
APART = b"\xff"
#: Partitions of the lattice per shuffle partition, so that a partition's edges are grouped in memory, and shards per partition.
FINER, SHARDS = 6, 2
#: First characters by which the pieces that may begin at a place are told apart.
HEAD = 3


@dataclass
class Pieces:
    """A piece table: text, id and score of the ordinary pieces, the ids of the 256 bytes, and the number of ids."""

    texts: list[str]
    ids: list[int]
    scores: list[float]
    bytes: list[int]
    size: int

    def table(self, spark: SparkSession) -> DataFrame:
        if self.size > MAX_PIECES:
            raise ValueError(f"at most {MAX_PIECES} pieces")
        return spark.createDataFrame(pa.table({
            "piece": self.texts, "id": pa.array(self.ids, pa.int32()), "score": pa.array(self.scores, pa.float64())}))

    @property
    def longest(self) -> int:
        return max(map(len, self.texts), default=1)


def load_pieces(path: str) -> Pieces:
    """Pieces of a SentencePiece model with byte fallback.

    A merge model's scores are negated ranks; they are read as a Zipf distribution over ranks, so that a path's score is a log
    probability. Other models' scores are log probabilities already.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.vocab_size()
    plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    scores = np.array([model.get_score(i) for i in plain])
    if len(scores) and (scores == np.round(scores)).all():
        scores = -np.log1p(-scores) - np.log(np.log(max(size, 3)) + 0.5772)
    names = {model.id_to_piece(i): i for i in range(size) if model.is_byte(i)}
    return Pieces([model.id_to_piece(i) for i in plain], plain, scores.tolist(), [names[f"<0x{b:02X}>"] for b in range(256)], size)


class Cutter:
    """Cuts marked text so that the best paths of the parts make up the best path of the whole."""

    def __init__(self, pieces: Pieces):
        self.scores, self.longest = dict(zip(pieces.texts, pieces.scores)), pieces.longest
        #: Two neighbouring characters that no piece holds can be cut apart.
        self.joints = {t[i:i + 2] for t in pieces.texts for i in range(len(t) - 1)}
        #: Whether a piece reaches over the end of a word, so that words are no parts.
        self.over = any("\n" in j or j[1] == BLANK != j[0] for j in self.joints)

    def __call__(self, run: str) -> list[str]:
        ends = [i for i in range(1, len(run)) if run[i - 1:i + 1] not in self.joints]
        out: list[str] = []
        for start, stop in zip([0, *ends], [*ends, len(run)]):
            part = run[start:stop]
            out.extend([part] if len(part) <= MAX_WORD else self.best(part))
        return out

    def best(self, run: str) -> list[str]:
        """The pieces of the best path, and characters without a piece; ties as in ``best_paths``."""
        scores, longest = self.scores, self.longest
        best, back = [0.0], [0]
        for stop in range(1, len(run) + 1):
            top, at = None, 0
            for start in range(max(0, stop - longest), stop):
                score = scores.get(run[start:stop])
                if score is None:
                    if stop - start > 1:
                        continue
                    score = UNKNOWN_SCORE
                if top is None or best[start] + score > top:
                    top, at = best[start] + score, start
            best.append(top)
            back.append(at)
        out, stop = [], len(run)
        while stop:
            out.append(run[back[stop]:stop])
            stop = back[stop]
        return out[::-1]


def words_of(text: str | None, cut: Cutter | None = None) -> list[str]:
    """Words whose concatenation is ``▁`` and the text with ``▁`` for blanks; line feeds and literal ``▁`` are words of their own.

    A run of blanks stays with the word behind it. ``cut`` divides words of more than ``MAX_WORD`` characters.
    """
    out: list[str] = []
    if cut is not None and cut.over:
        for j, run in enumerate((" " + text).split(BLANK) if text else []):
            if j:
                out.append(LITERAL)
            out.extend(cut(run.replace(" ", BLANK)) if run else [])
        return out
    for n, line in enumerate(text.split("\n") if text else []):
        if n:
            out.append("\n")
        for word in WORD.findall(line if n else " " + line):
            out.extend(_parts(word, cut))
    return out


def _parts(word: str, cut: Cutter | None) -> list[str]:
    """A word with its blanks marked, in parts if it holds a literal ``▁`` or is too long."""
    if BLANK not in word and (len(word) <= MAX_WORD or cut is None):
        return [word.replace(" ", BLANK)]
    out: list[str] = []
    for j, run in enumerate(word.split(BLANK)):
        if j:
            out.append(LITERAL)
        run = run.replace(" ", BLANK)
        if run:
            out.extend([run] if len(run) <= MAX_WORD or cut is None else cut(run))
    return out


class Places(dict):
    """Numbers of distinct words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _write_words(words: list[str]) -> bytes:
    return zstandard.compress(APART.join([w.encode() for w in words]), 6)


def _read_words(data: bytes) -> list[str]:
    return [w.decode() for w in zstandard.decompress(data).split(APART)]


def best_paths(words: DataFrame, pieces: DataFrame) -> DataFrame:
    """(shard, place, path) of words (shard, place, word): piece ids, or ``-1 - start`` for a character without a piece.

    Substrings are exploded from every start as far as the longest piece with the same first ``HEAD`` characters reaches; longer ones are
    in no piece.
    """
    starts = words.select("shard", "place", "word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("start"))
    reach = pieces.where(F.length("piece") >= HEAD).groupBy(F.substring("piece", 1, HEAD).alias("head")).agg(F.max(F.length("piece")).alias("reach"))
    headed = starts.withColumn("head", F.expr(f"substring(word, start + 1, {HEAD})")).join(F.broadcast(reach), "head", "left")
    parts = headed.select("shard", "place", "word", "start", F.explode(F.sequence(F.lit(1), F.least(
        F.coalesce("reach", F.lit(HEAD - 1)), F.length("word") - F.col("start")))).alias("n"))
    edges = parts.select("shard", "place", "start", "n", F.expr("substring(word, start + 1, n)").alias("piece")).join(
        F.broadcast(pieces), "piece", "left").where("id is not null or n = 1")
    edge = F.struct((F.col("start") + F.col("n")).alias("stop"), "start", F.coalesce("score", F.lit(UNKNOWN_SCORE)).alias("score"),
                    F.coalesce("id", -1 - F.col("start")).alias("code"))
    lattice = edges.groupBy("shard", "place").agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    # best: the best path to every position before ``stop``; top: the best one to ``stop`` so far. Edges come by their end, so a position
    # is closed once and only the path to the current end changes.
    return lattice.selectExpr("shard", "place", """
        aggregate(edges,
            named_struct('best', slice(array(named_struct('score', 0D, 'path', cast(array() as array<int>))), 1, 0), 'stop', 0,
                         'top', named_struct('score', 0D, 'path', cast(array() as array<int>))),
            (s, e) -> if(e.stop = s.stop,
                if(s.best[e.start].score + e.score > s.top.score,
                    named_struct('best', s.best, 'stop', s.stop, 'top', named_struct(
                        'score', s.best[e.start].score + e.score, 'path', concat(s.best[e.start].path, array(e.code)))),
                    s),
                named_struct('best', concat(s.best, array(s.top)), 'stop', e.stop, 'top', if(e.start = s.stop,
                    named_struct('score', s.top.score + e.score, 'path', concat(s.top.path, array(e.code))),
                    named_struct('score', s.best[e.start].score + e.score, 'path', concat(s.best[e.start].path, array(e.code)))))),
            s -> s.top.path) as path""")


def _cut_block(table: pa.Table, cut: Cutter, shards: int) -> tuple[bytes, list[tuple[int, bytes]]]:
    """(a block as every document's places among its distinct words, which lie by shard, [(shard, its words)]).

    The place behind the last is the literal mark.
    """
    seen = Places()
    upto, found = [0], []
    for text in table.column("text").to_pylist():
        if text:
            found.extend(map(seen.__getitem__, words_of(text, cut) if cut.over else LINED.findall(" " + text)))
        upto.append(len(found))
    place = Places()
    parts = [[place[p] for p in ([w] if cut.over else _parts(w, cut))] for w in seen]
    sizes, flat, first = np.array([len(p) for p in parts], np.int64), np.array([i for p in parts for i in p], np.int64), np.array(found, np.int64)
    n = sizes[first]
    ends = np.cumsum(n)
    at = flat[np.repeat((np.cumsum(sizes) - sizes)[first] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
    counts = np.diff(np.concatenate([[0], ends])[np.array(upto)])
    mark = place.pop(LITERAL, None)
    names = list(place)
    shard = (B.word_hashes([w.encode() for w in names])[:, 0] % np.uint64(shards)).astype(np.int64)
    order = sorted(range(len(names)), key=lambda k: (shard[k], names[k]))
    rank = np.full(len(names) + (mark is not None), len(names), np.int64)
    old = np.fromiter(place.values(), np.int64, len(names))
    rank[old[order]] = np.arange(len(names))
    kind = "<u2" if len(names) < 1 << 16 else "<u4"
    ids = pa.BufferOutputStream()
    docs = pa.table({"doc_id": table.column("doc_id"), "n": pa.array(counts)})
    with pa.ipc.new_stream(ids, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(docs.combine_chunks())
    stored = [ids.getvalue().to_pybytes(), zstandard.compress(B.to_bytes(shard[order].astype("<u4")), 1),
              zstandard.compress(B.to_bytes(rank[at].astype(kind)), 6)]
    asked = B.split_by(shard[order], np.array([names[k] for k in order], object))
    return np.array([len(p) for p in stored], "<i8").tobytes() + kind.encode() + b"".join(stored), [(s, _write_words(own.tolist())) for s, (own,) in asked]


def _open_block(payload) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """(documents with their number of words, shard of each word, places of all documents' words)."""
    data = bytes(payload)
    sizes, kind, at = np.frombuffer(data, "<i8", 3), data[24:27].decode(), 27
    parts = []
    for n in sizes.tolist():
        parts.append(data[at:at + n])
        at += n
    (shard,) = B.from_bytes(zstandard.decompress(parts[1]), "<u4")
    (places,) = B.from_bytes(zstandard.decompress(parts[2]), kind)
    return pa.ipc.open_stream(parts[0]).read_all(), shard.astype(np.int64), places


def encode(docs: DataFrame, pieces: Pieces, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids), one row per input row. NULL and empty texts have no ids; other columns are ignored.

    Of paths with equal scores the one whose last piece starts first wins, then its predecessor's, and so on.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    parts = FINER * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = SHARDS * parts
    byte_ids = np.array(pieces.bytes, np.int64)
    cut = Cutter(pieces)

    # Texts are cut into words once. A block's row (key -1 - block) holds places only, its words go to their shards (key shard).
    def cut_blocks(batches):
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                own, asked = _cut_block(B.unpack(payload.as_buffer()), cut, shards)
                yield pa.RecordBatch.from_arrays([
                    pa.array([-1 - block, *[s for s, _ in asked]], pa.int64()), pa.array([block] * (len(asked) + 1), pa.int64()),
                    pa.array([own, *[d for _, d in asked]], pa.binary())], names=["key", "block", "data"])

    def distinct(table: pa.Table) -> pa.Table:
        shard = table.column("key")[0].as_py()
        words = sorted(set().union(*map(_read_words, table.column("data").to_pylist()))) if shard >= 0 else []
        return pa.table({"shard": pa.array([shard] * len(words), pa.int64()),
                         "place": pa.array(range(len(words)), pa.int32()), "word": pa.array(words, pa.string())})

    def reply(asked: pa.Table, paths: pa.Table) -> pa.Table:
        shard = asked.column("key")[0].as_py()
        lists = [_read_words(d) for d in asked.column("data").to_pylist()] if shard >= 0 else []
        words = sorted(set().union(*lists))
        place = {w: k for k, w in enumerate(words)}
        order = np.argsort(paths.column("place").to_numpy())
        codes = paths.column("path").to_pylist()
        ids = []
        for w, k in zip(words, order):
            path = codes[k]
            if min(path) < 0:
                path = [i for c in path for i in ([c] if c >= 0 else byte_ids[list(w[-1 - c].encode())].tolist())]
            ids.append(np.array(path, "<u4"))
        blocks, data = [-1 - b for b in asked.column("block").to_pylist()][:len(lists)], []
        for own in lists:
            got = [ids[place[w]] for w in own]
            data.append(zstandard.compress(B.to_bytes(np.array([shard], "<i8")) + B.to_bytes(
                np.array([len(g) for g in got], "<u2")) + np.concatenate(got).astype("<u2" if pieces.size <= 1 << 16 else "<u4").tobytes(), 3))
        return pa.table({"key": pa.array(blocks, pa.int64()), "data": pa.array(data, pa.binary())})

    def last(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.column("key")[0].as_py() >= 0:
            return nothing
        return pa.concat_tables([put_together(p.as_buffer(), right.column("data").to_pylist()) for p in left.column("data")])

    def put_together(payload, answers) -> pa.Table:
        docs, shard, at = _open_block(payload)
        sizes, ids = np.zeros(len(shard) + 1, np.int64), {}
        for a in map(zstandard.decompress, answers):
            (s,) = B.from_bytes(a, "<i8")
            (n,) = B.from_bytes(a[16:], "<u2")
            lo = np.searchsorted(shard, s[0])
            sizes[lo:lo + len(n)] = n
            ids[int(s[0])] = np.frombuffer(a, "<u2" if pieces.size <= 1 << 16 else "<u4", -1, 24 + 2 * len(n))
        sizes[-1] = 3
        # Words lie by shard, and so do the answers.
        flat = np.concatenate([*[ids[s] for s in sorted(ids)], byte_ids[list(BLANK.encode())]]).astype(np.int32)
        starts = np.cumsum(sizes) - sizes
        n = sizes[at]
        ends = np.cumsum(n)
        take = np.repeat(starts[at] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(docs.column("n").to_numpy())])]
        return pa.table({"doc_id": docs.column("doc_id"), "n_tokens": pa.array(np.diff(upto)), "ids": pa.chunked_array(
            [pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(flat[take], pa.int32()))])})

    # One exchange by key for blocks, distinct words and answers; all read it in the same partitions.
    dealt = B.pack(rows, exchange=False).mapInArrow(cut_blocks, "key long, block long, data binary").repartition(parts, "key")
    # Dealt by shard again, as Spark does not see that the function keeps it: edges, paths and answers then need no exchange.
    words = dealt.groupBy("key").applyInArrow(distinct, "shard long, place int, word string").repartition(parts, "shard")
    paths = best_paths(words, pieces.table(spark))
    replies = dealt.groupBy("key").cogroup(paths.groupBy("shard")).applyInArrow(reply, "key long, data binary")
    schema = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), StructField("n_tokens", LongType()), StructField("ids", ArrayType(IntegerType()))])
    nothing = to_arrow_schema(schema).empty_table()
    return dealt.groupBy("key").cogroup(replies.groupBy("key")).applyInArrow(last, schema)


def decode(ids: Column, pieces: Pieces) -> Column:
    """The text of an array of ids: built-in functions only, exact for what ``encode`` made."""
    by_id = [""] * pieces.size
    for piece, i in zip(pieces.texts, pieces.ids):
        by_id[i] = piece.replace(BLANK, " ").encode().hex()
    for b, i in enumerate(pieces.bytes):
        by_id[i] = f"{b:02x}"
    table = F.split(F.lit(",".join(by_id)), ",")
    joined = F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")
    # The first word's mark stands before the text.
    return F.decode(F.unhex(F.substring(joined, F.lit(3), F.length(joined))), "utf-8")


def round_trip(docs: DataFrame, pieces: Pieces, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): the ids and the digest of the text they decode to (NULL: of the empty text)."""
    coded = encode(docs, pieces, doc_id, text)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2(decode(F.col("ids"), pieces), 256).alias("decoded_sha256"))
