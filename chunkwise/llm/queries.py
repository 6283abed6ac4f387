"""One registered query per operator, over its whole table, with production parameters.

``QUERIES`` maps a name to a builder ``(spark, sf_dir) -> DataFrame``;
``ORACLES`` holds DuckDB SQL for the queries that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.config import work_dir

from . import ann, bpe, conversations, cross_tokens, decontamination, langid, near_dedup, packing, pii, token_counts, toxicity, url_filter, warc
from .common import id_remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str) -> str:
    """The place of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@_query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.find_leaks(docs, benchmark, error_share=0.1)


@_query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    counts = [F.size(f"base.{k}").cast("bigint").alias(f"n_{k}") for k in pii.KINDS]
    base, spans = pii.span_text(F.col("base")), pii.span_text(F.col("found"))
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


@_query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    remainder = id_remainder(F.col("doc_id"), 5)
    model = toxicity.train(docs, labels, learn=remainder != 0, rows_per_class=4000)
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", (remainder == 0).alias("held_out"), "score", "predicted")


@_query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = id_remainder(F.col("doc_id"), 4)
    model = langid.train(docs, learn=remainder != 2, docs_per_language=1500)
    found = langid.identify(docs, model)
    return found.select("doc_id", (remainder == 2).alias("held_out"), "lang_pred", "score", "accepted")


@_query
def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path, min_revisit_bytes=0)
    records = warc.read_archive(spark, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


@_query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, threshold=80)


@_query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), capacity=2048, end_id=1, keep_ids=True).drop("ids")


URL_RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]


@_query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    model = url_filter.train(url_filter.labelled_by_rules(pages, URL_RULES, rows_kept=4000))
    return url_filter.judge(pages, URL_RULES, model)


@_query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, tokenizer_file("piece_bpe_32k.model"), limit=4096)


@_query
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 20 == 0, k=20)


@_query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))


@_query
def op12_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cross_tokens.align(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


@_query
def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokenizer_file("byte_bpe_50k.json")
    done = bpe.decode_documents(bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    decoded = F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    return done.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), bpe.ids_digest(F.col("ids")).alias("ids_sha256"), decoded)


# Every page is a record; of equal payloads the smallest page id is the response.
# Base32 of a SHA-1: five hexadecimal digits are four base-32 ones.
ORACLES["op5_warc_archive"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id,
         octet_length(encode(payload)) AS payload_bytes,
         array_to_string([
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + CAST((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)
           for i in range(32)], '') AS payload_digest,
         min(page_id) OVER (PARTITION BY payload) AS leader
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> leader THEN leader END AS refers_to,
       true AS intact
FROM d
"""

# Links from counts of shared shingles, components by walking the links. The driver's
# small table takes about a second; on large ones the shingle join is what the
# forest avoids.
ORACLES["op6_near_duplicates"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
           ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
  WHERE 100 * least(m.n, n.n) >= 80 * greatest(m.n, n.n)
  GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(m.n) + any_value(n.n) - count(*))
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x
)
SELECT r.x AS doc_id, coalesce(any_value(z.n), 0)::BIGINT AS n_shingles, min(r.y) AS component_id, r.x = min(r.y) AS kept
FROM reach r LEFT JOIN sizes z ON z.doc_id = r.x GROUP BY r.x
"""
