"""The registered queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kessan.llm import (
    anchored_pii,
    best_two_fit,
    byte_bpe,
    impact_topk,
    importance_resampling,
    licence_scan,
    multi_index_hashing,
    ordinal_quality,
    prefix_trie,
    relative_lz,
    simhash_blocks,
    sorted_projections,
    warc_revisits,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of every document, fitted on the labels, and whether it is kept."""
    return ordinal_quality.rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every twentieth vector, in whole sixty-fourths."""
    return impact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("key") % 20 == 0, k=20, scale=64)


SQL["op2_impact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 20"""


@query
def op3_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found of every hundredth vector."""
    return multi_index_hashing.nearest(table(spark, sf_dir, "embeddings"), F.col("key") % 100 == 0, k=10)


@query
def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, copies resolved into revisits, and the archives read back."""
    records = warc_revisits.archive_pages(table(spark, sf_dir, "pages"), "2024-01-01T00:00:00Z", least_bytes=0)
    return records.select(
        F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to",
    )


SQL["op4_warc_revisits"] = """
WITH named AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), digits AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) % 32 + 1, 1)), '')
    AS payload_digest FROM named
), grouped AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS original FROM digits)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to FROM grouped"""


@query
def op5_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated passages of 35 words and more, as digests."""
    found = relative_lz.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return found.select("doc_id", "n_words", "n_removed", digest, F.size("factors").cast("long").alias("n_factors"))


@query
def op6_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1,024 tokens."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return best_two_fit.pack_documents(table(spark, sf_dir, "documents"), path, end_id=2, capacity=1024)


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded by the rank file and decoded again, as digests."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern)
    decoded = byte_bpe.decode(encoded.select("doc_id", "ids"), path, pattern)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def listed(spans, kinds: tuple[str, ...]):
    """Spans of some kinds as ``kind:start:end``, joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query
def op8_anchored_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every text."""
    found = anchored_pii.find(table(spark, sf_dir, "documents"))

    def counted(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(counted, anchored_pii.BASE_KINDS),
        F.sha2(listed(F.col("spans"), anchored_pii.BASE_KINDS), 256).alias("base_sha256"),
        listed(F.col("spans"), anchored_pii.KINDS).alias("spans"),
    )


@query
def op9_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash_blocks.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)


#: Short documents with a licence sentence are named as licence files.
NOTICE = 400


@query
def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document, own or inherited. Documents become files: notices are the
    ``LICENSE`` files of a directory per source and language, the others lie in directories below."""
    home = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")))
    number = F.lpad(F.col("doc_id").cast("string"), 12, "0")
    notice = F.coalesce((F.char_length("text") <= NOTICE) & F.col("text").rlike(licence_scan.CUES), F.lit(False))
    below = F.concat_ws("/", home, F.substring(number, 12, 1), number)
    path = F.when(notice, F.concat(home, F.lit("/LICENSE-"), number)).otherwise(below)
    return licence_scan.scan(table(spark, sf_dir, "documents").withColumn("path", path))


_HEADERS = """
WITH files AS (
  SELECT doc_id, dir || CASE WHEN whole THEN '/LICENSE-' || number ELSE '/' || substr(number, 12, 1) || '/' || number END AS path, dir, text, whole
  FROM (SELECT doc_id, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS number, coalesce(source, 'none') || '/' || coalesce(lang, 'none') AS dir, text,
    coalesce(length(text) <= {notice} AND regexp_matches(text, '{cues}'), false) AS whole FROM documents)
), headers AS (
  SELECT doc_id, path, dir, whole, CASE WHEN whole THEN text WHEN regexp_matches(text, '{cues}') THEN array_to_string(list_filter(
    string_split_regex(regexp_replace(text, '([.!?])[ \t\n\r\f\v]+', '\1' || chr(10), 'g'), '\n'), lambda x: regexp_matches(x, '{cues}')), chr(10)) END AS header FROM files
), templates(licence, bag) AS (VALUES {templates}),
bags AS (SELECT bag, sum(n) AS n FROM (SELECT header AS bag, count(*) AS n FROM headers WHERE length(trim(header)) > 0 GROUP BY header
  UNION ALL SELECT bag, 1 FROM templates) GROUP BY bag),
terms AS (SELECT bag, n, word, count(*) AS tf FROM (SELECT bag, n, unnest(list_filter(string_split_regex(
  regexp_replace(lower(bag), '[.]([^a-z0-9]|$)', ' \1', 'g'), '[^a-z0-9.+-]+'), lambda w: w <> '')) AS word FROM bags) GROUP BY bag, n, word),
weights AS (SELECT bag, word, tf * (ln((1.0 + (SELECT sum(n) FROM bags)) / (1 + sum(n) OVER (PARTITION BY word))) + 1) AS weight FROM terms),
units AS (SELECT bag, word, weight / sqrt(sum(weight * weight) OVER (PARTITION BY bag)) AS unit FROM weights),
scores AS (SELECT u.bag, t.licence, round(sum(u.unit * v.unit), 6) AS score FROM units u JOIN units v ON u.word = v.word
  JOIN templates t ON t.bag = v.bag GROUP BY u.bag, t.licence, t.bag),
best AS (SELECT bag, licence, score FROM scores QUALIFY row_number() OVER (PARTITION BY bag ORDER BY score DESC, licence) = 1),
scanned AS (SELECT doc_id, path, dir, whole, b.licence, b.score FROM headers h LEFT JOIN best b ON h.header = b.bag AND b.score >= 0.6),
own AS (SELECT dir, arg_min(licence, path) AS theirs FROM scanned WHERE whole AND licence IS NOT NULL GROUP BY dir)
SELECT doc_id, path, coalesce(licence, theirs) AS licence, score, CASE WHEN licence IS NULL AND theirs IS NOT NULL THEN own.dir END AS inherited_from
FROM scanned LEFT JOIN own USING (dir)"""
SQL["op10_licence_scan"] = _HEADERS.format(
    notice=NOTICE,
    cues=licence_scan.CUES,
    templates=", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licence_scan.known_templates()),
)


@query
def op11_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector, within its label."""
    return sorted_projections.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


SQL["op11_sorted_projections"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE label IS NOT NULL
  AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
  AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e)) / sqrt(list_inner_product(b.e, b.e)) >= 0.93
), reached AS (SELECT a AS vec_id, a AS other FROM links UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a),
roots AS (SELECT vec_id, min(other) AS root FROM reached GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN roots USING (vec_id) LEFT JOIN counts USING (vec_id)"""


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations."""
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"), family=5, most=8)


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents weighed by their words towards the benchmark, and a tenth of them drawn."""
    return importance_resampling.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
        share=(10, 100), least_words=20, max_run=1, buckets=10_000, seed=2024,
    )
