"""Registered queries of the training-data operators with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import language_id
from kinweave.llm.exact_dedup import exact_dedup
from kinweave.llm.filter_audit import audit_filters
from kinweave.llm.fingerprints import fingerprint_edits
from kinweave.llm.lm_scoring import score_documents
from kinweave.llm.minhash_dedup import near_duplicates
from kinweave.llm.mixing import mix_sources
from kinweave.llm.sentencepiece_lattice import load_pieces
from kinweave.llm.sentencepiece_lattice import round_trip as piece_round_trip
from kinweave.llm.sharding import shard_documents
from kinweave.llm.substring_dedup import find_repeats
from kinweave.llm.text import crc_remainder
from kinweave.llm.token_output import round_trip
from kinweave.llm.url_filter import filter_urls
from kinweave.llm.vector_codes import compress_vectors

#: Fixed values of the url query: verdict, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

#: Fixed values of the token queries: piece file; tokenizer file, number of ids, id that ends a document.
PIECES = "piece_bpe_32k.model"
TOKENIZER, VOCABULARY, END_ID = "word_bpe_49k.json", 49_408, 2

#: Fixed values of the vector code query: parts, entries, rounds, scale.
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
SHARDS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rest = crc_remainder(F.col("doc_id"), 5)
    model = language_id.fit(docs, rest != 0)
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return piece_round_trip(table(spark, sf_dir, "documents"), load_pieces(public_tokenizers.path(PIECES)))


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), VOCABULARY, END_ID)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("copies")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = crc_remainder(F.col("doc_id"), 7)
    scores = score_documents(table(spark, sf_dir, "documents"), rest != 2)
    return scores.withColumn("held_out", F.coalesce(rest == 2, F.lit(False))).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(table(spark, sf_dir, "embeddings"), parts=PARTS, entries=ENTRIES, rounds=ROUNDS, scale=SCALE)


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), SHARDS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_language_id": op2_language_id,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_token_output": op5_token_output,
    "op6_fingerprints": op6_fingerprints,
    "op7_url_filters": op7_url_filters,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_mixing": op9_mixing,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_filter_audit": op11_filter_audit,
    "op12_vector_codes": op12_vector_codes,
    "op13_sharding": op13_sharding,
}

def _codes_sql() -> str:
    """The vector codes, one group of views per round of assignment and averaging."""
    distance = "list_sum(list_transform(list_zip(p.v, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    views = [f"""WITH k AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) - 1 AS n,
                        list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
                 FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (SELECT n, vec_id, label, part, v[part * len(v) // {PARTS} + 1:(part + 1) * len(v) // {PARTS}] AS v
              FROM (SELECT *, unnest(range({PARTS})) AS part FROM k)),
        b0 AS (SELECT part, n AS entry, v AS c FROM p WHERE n < {ENTRIES})"""]
    for r in range(ROUNDS + 1):
        views.append(f"""m{r} AS (SELECT n, part, min({distance} * {ENTRIES} + entry) AS m FROM p JOIN b{r} b USING (part) GROUP BY n, part)""")
        if r < ROUNDS:
            views.append(f"""s{r} AS (SELECT part, m % {ENTRIES} AS entry, pos, sum(x)::BIGINT AS s, count(*) AS q
                  FROM (SELECT part, m, unnest(v) AS x, unnest(range(len(v))) AS pos FROM p JOIN m{r} USING (n, part)) GROUP BY ALL),
        b{r + 1} AS (SELECT part, entry, coalesce(f.c, b.c) AS c FROM b{r} b LEFT JOIN
                  (SELECT part, entry, list((s - ((s % q) + q) % q) // q ORDER BY pos) AS c FROM s{r} GROUP BY ALL) f USING (part, entry))""")
    return ",\n        ".join(views) + f""",
        e AS (SELECT n, string_agg(printf('%02x', m % {ENTRIES}), '' ORDER BY part) AS code, sum(m // {ENTRIES})::BIGINT AS error
              FROM m{ROUNDS} GROUP BY n)
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b{ROUNDS}) AS codebooks_sha256
        FROM e JOIN k USING (n)"""


ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS s
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) > 49)),
        f AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM win JOIN f USING (s) WHERE first < doc_id),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id),
        lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)""",
    "op3_minhash_dedup": r"""
        WITH RECURSIVE d AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
              FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
        e AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
        both_ways AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
        reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT a, y FROM reach JOIN both_ways ON x = b)
        SELECT r.a AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(b) AS component_id, r.a = min(b) AS kept
        FROM reach r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a""",
    "op7_url_filters": r"""
        WITH r(verdict, rh, rp) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'),
                                           ('allow', 'org', '/fr/')),
        u AS (SELECT row_number() OVER () AS n, page_id,
                     coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                     coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
        m AS (SELECT n, arg_max(struct_pack(rule := rh || rp, verdict := verdict), length(rh) + length(rp)) AS won
              FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY n)
        SELECT page_id, host, path, won.rule AS rule, coalesce(won.verdict, 'allow') AS verdict FROM u LEFT JOIN m USING (n)""",
    "op8_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS s
                   FROM documents),
        w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY s ORDER BY n DESC, doc_id) AS keep_id,
                     count(*) OVER (PARTITION BY s) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(s) AS text_sha256 FROM w""",
    "op11_filter_audit": r"""
        WITH l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
        d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
              FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
        f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                     (len(w) < 100)::INT AS a, (100 * len(list_distinct(w)) < 80 * len(w))::INT AS b,
                     (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT AS c,
                     regexp_matches(t, '[#$%&*|]')::INT AS d, coalesce(first < doc_id, false)::INT AS e
              FROM w LEFT JOIN l USING (doc_id)),
        m AS (SELECT part, [a, b, c, d, e] AS fails, a + b + c + d + e AS n_fails, count(*) AS n,
                     sum(good)::BIGINT AS good, sum(toxic)::BIGINT AS toxic FROM f GROUP BY ALL),
        x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM x p, x q, x r, x s, x t
              WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
        g AS (SELECT filter_order, m.*, list_transform(range(1, 6), lambda i: fails[unicode(filter_order[i]) - 64]) AS hit
              FROM o, m),
        h AS (SELECT *, coalesce(list_position(hit, 1), 6) AS gone, unnest(range(1, 6)) AS step FROM g),
        a AS (SELECT part, filter_order, step, filter_order[step] AS letter, sum(CASE WHEN gone > step THEN n ELSE 0 END)::BIGINT AS kept,
                     sum(CASE WHEN gone = step THEN n ELSE 0 END)::BIGINT AS removed,
                     sum(CASE WHEN hit[step] = 1 AND gone < step THEN n ELSE 0 END)::BIGINT AS redundant,
                     sum(CASE WHEN hit[step] = 1 AND n_fails = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
                     sum(CASE WHEN gone = step THEN good ELSE 0 END)::BIGINT AS good_lost,
                     sum(CASE WHEN gone = step THEN toxic ELSE 0 END)::BIGINT AS toxic_lost FROM h GROUP BY ALL)
        SELECT * EXCLUDE (letter), sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley FROM a""",
    "op12_vector_codes": _codes_sql(),
    "op13_sharding": f"""
        WITH k AS (SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda a, b: CASE WHEN a & 1 = 1
                     THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, x)) AS k),
        b AS (SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b FROM documents),
        d AS (SELECT doc_id, len(b) + 1 AS size, xor(list_reduce(b, lambda a, x: xor(a >> 8, k[(xor(a, x) & 255) + 1]), 4294967295), 4294967295)
                     AS text_crc32 FROM b, k),
        s AS (SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total FROM d),
        c AS (SELECT *, ((2 * upto - size) * {SHARDS} // (2 * total))::INT AS shard FROM s)
        SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY upto) - 1 AS slot,
               NULL::INT AS grown_shard FROM c""",
}
